"""Statistics, votes, shares and gates (the aggregations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import gates, rank, stats
from partloom.operators.spread import spread
from partloom.queries.base import OBS, PARTS, lab_sql, observations, parts, query, rounded


@query(
    "a01_robust_stats",
    f"""WITH {OBS}, q AS (SELECT view_id, category, count(price) AS n, median(price) AS median, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3, mad(price) AS mad FROM obs GROUP BY ALL)
SELECT view_id, category, n, round(median, 4) AS median, round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, round(mad, 4) AS mad FROM q""",
)
def a01(spark, d):
    return rounded(stats.robust_stats(observations(spark, d), ["view_id", "category"], "price"), 4)


@query(
    "a02_weighted_median",
    f"""WITH {OBS}, v AS (SELECT part_id, price, sum(weight) AS w FROM obs WHERE weight > 0 GROUP BY ALL),
r AS (SELECT part_id, price, sum(w) OVER (PARTITION BY part_id ORDER BY price) AS run, sum(w) OVER (PARTITION BY part_id) AS total FROM v)
SELECT part_id, min(price) AS weighted_median FROM r WHERE run >= total / 2 GROUP BY part_id""",
)
def a02(spark, d):
    return stats.weighted_median(observations(spark, d), ["part_id"], "price", "weight")


@query("a03_weighted_scores", f"WITH {OBS} SELECT part_id, round(sum(score * weight) / sum(weight), 6) AS score, round(sum(tax * weight) / sum(weight), 6) AS tax FROM obs GROUP BY part_id")
def a03(spark, d):
    return rounded(stats.weighted_scores(observations(spark, d), ["part_id"], ["score", "tax"], "weight"))


@query("a04_observation_weight", f"WITH {OBS} SELECT part_id, round(sum(CASE WHEN weight >= 1 THEN (1 - tax) * least(1.0, log2(weight) / 12) ELSE 0 END), 6) AS weight FROM obs GROUP BY part_id")
def a04(spark, d):
    o = observations(spark, d)
    return rounded(o.groupBy("part_id").agg(F.sum(stats.observation_weight(F.col("weight"), 1 - F.col("tax"))).alias("weight")))


@query(
    "a05_categorical_consensus",
    f"""WITH {OBS}, c AS (SELECT part_id, category, count(*) AS votes, sum(score) AS confidence FROM obs GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY category = 'N', votes DESC, round(confidence, 8) DESC, category) AS k FROM c)
SELECT part_id, category, votes, round(confidence, 6) AS confidence FROM r WHERE k = 1""",
)
def a05(spark, d):
    return rounded(stats.categorical_consensus(observations(spark, d), ["part_id"], "category", "score", ["N"]))


@query(
    "a06_consensus_gate",
    f"""WITH {OBS}, main AS (SELECT part_id, CASE WHEN part_id % 3 = 0 THEN 'review' WHEN part_id % 3 = 1 THEN 'matched' ELSE 'none' END AS status, min(category) AS grp, max(score) AS conf, part_id % 17 = 0 AS multi FROM obs GROUP BY part_id),
votes AS (SELECT part_id, CASE WHEN line < 7 THEN category END AS vg, score AS vc FROM obs WHERE view_id % 2 = 0),
m AS (SELECT main.*, count(*) FILTER (WHERE vg = grp AND vc >= 0.8) AS a, count(*) FILTER (WHERE vg <> grp AND vc >= 0.6) AS c, count(*) FILTER (WHERE vg IS NULL AND vc >= 0.6) AS u, min(vc) FILTER (WHERE vg = grp AND vc >= 0.8) AS low
  FROM main LEFT JOIN votes USING (part_id) GROUP BY main.part_id, status, grp, conf, multi),
d AS (SELECT *, CASE WHEN status = 'review' AND NOT multi AND c = 0 AND u = 0 AND a >= 2 THEN 'promoted_auto' WHEN status IN ('matched', 'review') AND (multi OR c > 0) THEN 'downgraded_preserve' WHEN status <> 'matched' THEN 'unchanged'
  WHEN u > 0 OR a < 2 THEN 'downgraded_review' ELSE 'kept_auto' END AS decision FROM m)
SELECT part_id, decision, CASE WHEN decision <> 'downgraded_preserve' THEN grp END AS category, CASE WHEN decision = 'promoted_auto' THEN low ELSE conf END AS score, a AS agreeing, c AS conflicting, u AS unresolved FROM d""",
)
def a06(spark, d):
    o = observations(spark, d)
    status = F.when(F.col("part_id") % 3 == 0, "review").when(F.col("part_id") % 3 == 1, "matched").otherwise("none")
    main = o.groupBy("part_id").agg(F.min("category").alias("category"), F.max("score").alias("score")).withColumn("status", status).withColumn("multi", F.col("part_id") % 17 == 0)
    votes = o.where("view_id % 2 = 0").select("part_id", F.when(F.col("line") < 7, F.col("category")).alias("category"), "score")
    return gates.consensus_gate(main, votes, ["part_id"], "category", "score")


@query(
    "a08_fuse_evidence",
    f"""WITH {OBS}, p AS (SELECT part_id, view_id, median(score) AS score, median(tax) AS tax, min(status) AS lo, max(status) AS hi FROM obs GROUP BY ALL),
f AS (SELECT part_id, count(*) AS views, min(lo) AS lo, max(hi) AS hi, median(score) AS score, median(tax) AS tax, quantile_cont(score, 0.75) - quantile_cont(score, 0.25) AS ds, quantile_cont(tax, 0.75) - quantile_cont(tax, 0.25) AS dt FROM p GROUP BY part_id),
r AS (SELECT *, concat_ws(',', CASE WHEN views < 2 THEN 'too_few_views' END, CASE WHEN lo <> hi THEN 'class_conflict' END, CASE WHEN ds > 0.3333 THEN 'score_dispersion' END, CASE WHEN dt > 0.3333 THEN 'tax_dispersion' END) AS reasons FROM f)
SELECT part_id, views, round(score, 6) AS score, round(tax, 6) AS tax, CASE WHEN reasons = '' THEN 'auto' ELSE 'preserve' END AS mode, reasons FROM r""",
)
def a08(spark, d):
    return gates.fuse_evidence(spread(observations(spark, d), ["part_id"]), ["part_id"], ["score", "tax"], "status", "view_id", 0.3333)


HSV = """hsv AS (SELECT part_id, brand, mx AS v, CASE WHEN mx = 0 THEN 0 ELSE (mx - mn) / mx END AS s,
  CASE WHEN mx = mn THEN 0 WHEN mx = fr THEN (((fg - fb) / (mx - mn)) % 6 + 6) % 6 WHEN mx = fg THEN (fb - fr) / (mx - mn) + 2 ELSE (fr - fg) / (mx - mn) + 4 END / 6 AS h
  FROM (SELECT part_id, brand, r / 255.0::DOUBLE AS fr, g / 255.0::DOUBLE AS fg, b / 255.0::DOUBLE AS fb, greatest(r, g, b) / 255.0::DOUBLE AS mx, least(r, g, b) / 255.0::DOUBLE AS mn FROM parts)),
col AS (SELECT *, CASE WHEN v < 0.12 THEN 'black' WHEN s < 0.18 AND v > 0.85 THEN 'white' WHEN s < 0.18 THEN 'grey' ELSE list_extract(['red', 'yellow', 'green', 'cyan', 'blue', 'magenta'], CAST(floor(h * 6 + 0.5) AS BIGINT) % 6 + 1) END AS colour FROM hsv)"""


@query("a09_colour_distribution", f"WITH {PARTS}, {HSV}, n AS (SELECT brand, colour, count(*) AS n FROM col GROUP BY ALL) SELECT brand, colour, n, round(n / sum(n) OVER (PARTITION BY brand), 6) AS share FROM n")
def a09(spark, d):
    from pyspark.sql import Window

    n = color.add_colour_features(parts(spark, d), "r", "g", "b").groupBy("brand", "colour").agg(F.count(F.lit(1)).alias("n"))
    return rounded(n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("brand"))))


_SHARES = """sa AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE line <= 3 GROUP BY ALL), ta AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS a FROM sa),
sb AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE line > 3 GROUP BY ALL), tb AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS b FROM sb)"""


@query(
    "a10_histogram_score",
    f"""WITH {OBS}, x AS (SELECT part_id, category, sum(weight) FILTER (line <= 3) AS a, sum(weight) FILTER (line > 3) AS b FROM obs GROUP BY ALL), t AS (SELECT *, sum(a) OVER (PARTITION BY part_id) AS p, sum(b) OVER (PARTITION BY part_id) AS q FROM x)
SELECT part_id, floor(coalesce(sum(least(coalesce(a, 0) * q, coalesce(b, 0) * p)) / max(p * q), 0) * 1000000 + 0.5) / 1000000 AS intersection FROM t GROUP BY part_id""",
)
def a10(spark, d):
    o = observations(spark, d)
    return rounded(stats.histogram_score(o.where("line <= 3"), o.where("line > 3"), ["part_id"], "category", "weight"))


@query(
    "a11_group_recall",
    f"""WITH {OBS}, {_SHARES}, r AS (SELECT part_id, least(1.0, coalesce(b, 0) / least(0.95, greatest(0.001, 0.5 * a))) AS r FROM ta LEFT JOIN tb USING (part_id, category))
SELECT part_id, count(*) AS bins, round(avg(r), 6) AS macro, round(min(r), 6) AS minimum FROM r GROUP BY part_id""",
)
def a11(spark, d):
    o = observations(spark, d)
    return rounded(stats.group_recall(o.where("line <= 3"), o.where("line > 3"), ["part_id"], "category", "weight"))


@query(
    "a16_medoid_colour",
    f"""WITH {PARTS}, {lab_sql("parts", "part_id, brand")}, m AS (SELECT brand, median(lab_l) AS ml, median(lab_a) AS ma, median(lab_b) AS mb FROM lab GROUP BY brand),
k AS (SELECT brand, part_id, lab_l, lab_a, lab_b, row_number() OVER (PARTITION BY brand ORDER BY round(sqrt(power(lab_l - ml, 2) + power(lab_a - ma, 2) + power(lab_b - mb, 2)), 8), part_id) AS r FROM lab JOIN m USING (brand)),
e AS (SELECT lab.brand, k.part_id AS medoid, sqrt(power(lab.lab_l - k.lab_l, 2) + power(lab.lab_a - k.lab_a, 2) + power(lab.lab_b - k.lab_b, 2)) AS d FROM lab JOIN k ON lab.brand = k.brand AND k.r = 1)
SELECT brand, medoid, count(*) AS n, round(avg(CASE WHEN d <= 20 THEN 1.0 ELSE 0 END), 6) AS inliers, round(quantile_cont(d, 0.9), 4) AS p90 FROM e GROUP BY ALL""",
)
def a16(spark, d):
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    out = stats.medoid_colour(p, ["brand"], "part_id")
    return out.select("brand", "medoid", "n", F.round("inliers", 6).alias("inliers"), F.round("p90", 4).alias("p90"))


@query("a17_median_of_medians", f"WITH {OBS}, p AS (SELECT part_id, view_id, count(*) AS n, median(price) AS price, median(tax) AS tax FROM obs GROUP BY ALL) SELECT part_id, count(*) AS views, round(median(price), 4) AS price, round(median(tax), 4) AS tax FROM p WHERE n >= 2 GROUP BY part_id")
def a17(spark, d):
    return rounded(stats.median_of_medians(spread(observations(spark, d), ["part_id"]), ["part_id"], "view_id", ["price", "tax"], least=2), 4)


@query(
    "a20_share_winner",
    f"""WITH {OBS}, c AS (SELECT part_id, category, sum(weight) AS n FROM obs GROUP BY ALL), s AS (SELECT part_id, category, round(n / sum(n) OVER (PARTITION BY part_id), 8) AS share FROM c),
t AS (SELECT *, row_number() OVER w AS r, round(share - coalesce(lead(share) OVER w, 0), 8) AS margin FROM s WINDOW w AS (PARTITION BY part_id ORDER BY share DESC, category)),
u AS (SELECT *, CASE WHEN share < 0.4 THEN 'share_below_floor' WHEN margin < 0.1 THEN 'margin_below_floor' END AS reason FROM t WHERE r = 1)
SELECT part_id, CASE WHEN reason IS NULL THEN category END AS winner, round(share, 6) AS share, round(margin, 6) AS margin, reason FROM u""",
)
def a20(spark, d):
    return rounded(stats.share_winner(observations(spark, d), ["part_id"], "category", "weight", 0.4, 0.1))


@query(
    "a22_multiview_support",
    f"""WITH {OBS}, b AS (SELECT asset_id, category, count(DISTINCT view_id) AS views FROM obs WHERE score >= 0.3 GROUP BY ALL), n AS (SELECT *, count(*) OVER (PARTITION BY asset_id) AS g FROM b)
SELECT asset_id, category, views FROM n WHERE g = 1 AND views >= 2""",
)
def a22(spark, d):
    return stats.multiview_support(observations(spark, d), ["asset_id"], "category", "view_id", F.col("score") >= 0.3)


@query(
    "a23_collapse",
    f"""WITH {OBS}, c AS (SELECT view_id, part_id, count(*) AS n, count(DISTINCT category) AS c FROM obs GROUP BY ALL)
SELECT view_id, round(max(n) / sum(n), 6) AS dominant_share, count(*) AS "values", CAST(sum(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS collisions, max(n) / sum(n) > 0.02 AS collapsed FROM c GROUP BY view_id""",
)
def a23(spark, d):
    return rounded(stats.collapse(observations(spark, d), ["view_id"], "part_id", "category", 0.02))


@query(
    "a24_confidence_gate",
    f"""WITH {OBS}, p AS (SELECT part_id, max(score) AS c1, max(tax) * 12 AS c2, CASE WHEN count(*) > 28 THEN max(score) - avg(score) END AS margin, sum(weight) / 1000 - 0.5 AS visible, part_id % 11 = 0 AS risk FROM obs GROUP BY part_id),
q AS (SELECT *, least(c1, c2) AS low FROM p), s AS (SELECT *,
  concat_ws(',', CASE WHEN risk THEN 'risk' END, CASE WHEN low < 0.5 THEN 'confidence_too_low' END, CASE WHEN visible <= 0 THEN 'not_visible' END) AS severe,
  concat_ws(',', CASE WHEN low < 0.8 AND low >= 0.5 THEN 'confidence_below_auto' END, CASE WHEN margin IS NULL THEN 'margin_missing' END, CASE WHEN margin < 0.05 THEN 'margin_too_small' END, CASE WHEN visible > 0 AND visible < 0.1 THEN 'hardly_visible' END) AS mild FROM q)
SELECT part_id, CASE WHEN severe <> '' THEN 'preserve' WHEN mild <> '' THEN 'review' ELSE 'auto' END AS mode, concat_ws(',', nullif(severe, ''), nullif(mild, '')) AS reasons FROM s""",
)
def a24(spark, d):
    o = observations(spark, d).groupBy("part_id").agg(
        F.max("score").alias("c1"), (F.max("tax") * 12).alias("c2"), F.when(F.count(F.lit(1)) > 28, F.max("score") - F.avg("score")).alias("margin"), (F.sum("weight") / 1000 - 0.5).alias("visible")
    )
    return gates.confidence_gate(o.withColumn("risk", F.col("part_id") % 11 == 0), ["c1", "c2"], "margin", "visible", "risk").select("part_id", "mode", "reasons")


@query(
    "a25_quality_gate",
    f"""WITH {OBS}, e AS (SELECT *, bool_or(category = 'A') OVER (PARTITION BY asset_id) AS has FROM obs), v AS (SELECT * FROM e WHERE NOT has OR category = 'A'),
g AS (SELECT asset_id, count(*) AS views, avg(score) AS mean, min(score) AS least, count(*) FILTER (WHERE score < 0.2) AS failing FROM v GROUP BY asset_id),
r AS (SELECT *, concat_ws(',', CASE WHEN views < 2 THEN 'too_few_views' END, CASE WHEN round(mean, 8) < 0.5 THEN 'mean_too_low' END, CASE WHEN failing > 0 THEN 'view_too_low' END) AS reasons FROM g)
SELECT asset_id, views, round(mean, 6) AS mean, least, failing, reasons = '' AS passed, reasons FROM r""",
)
def a25(spark, d):
    return rounded(gates.quality_gate(observations(spark, d).withColumn("enforced", F.col("category") == "A"), ["asset_id"], "score", "enforced", 0.5, 0.2, 2))


@query(
    "a26_publish_gate",
    f"""WITH {OBS}, k AS (SELECT *, CASE category WHEN 'A' THEN 'fallback' WHEN 'R' THEN 'neutral' ELSE CASE WHEN line = 7 THEN 'unresolved' ELSE 'direct' END END AS kind FROM obs),
g AS (SELECT view_id, avg(CASE WHEN kind = 'fallback' THEN 1.0 ELSE 0 END) AS fallback, avg(CASE WHEN kind = 'neutral' THEN 1.0 ELSE 0 END) AS neutral, avg(CASE WHEN kind = 'unresolved' THEN 1.0 ELSE 0 END) AS unresolved, sum(CASE WHEN kind = 'fallback' THEN weight ELSE 0 END) / sum(weight) AS visible_fallback FROM k GROUP BY view_id),
r AS (SELECT *, concat_ws(',', CASE WHEN round(fallback, 8) > 0.34 THEN 'fallback_over_limit' END, CASE WHEN round(visible_fallback, 8) > 0.33 THEN 'visible_fallback_over_limit' END) AS reasons FROM g)
SELECT view_id, round(fallback, 6) AS fallback, round(neutral, 6) AS neutral, round(unresolved, 6) AS unresolved, round(visible_fallback, 6) AS visible_fallback, reasons = '' AS published, reasons FROM r""",
)
def a26(spark, d):
    kind = F.when(F.col("category") == "A", "fallback").when(F.col("category") == "R", "neutral").when(F.col("line") == 7, "unresolved").otherwise("direct")
    return rounded(gates.publish_gate(observations(spark, d).withColumn("kind", kind), ["view_id"], "kind", "weight", {"fallback": 0.34, "visible_fallback": 0.33}))


@query(
    "a27_photometric_cohort",
    f"""WITH {OBS} SELECT asset_id, count(*) AS views, round(max(score) - min(score), 6) AS span, bool_and(line <= 6) AND bool_and(category <> 'N') AND round(max(score) - min(score), 8) <= 0.4 AS promoted FROM obs GROUP BY asset_id""",
)
def a27(spark, d):
    o = observations(spark, d).withColumn("complete", F.col("line") <= 6).withColumn("review", F.col("category") != "N")
    return rounded(gates.photometric_cohort(o, ["asset_id"], "complete", "review", "score", 0.4))


_STATUS = "CASE WHEN score >= 0.7 THEN 'PASS' WHEN score >= 0.3 THEN 'REVIEW' WHEN score >= 0.1 THEN 'NONE' ELSE 'FAIL' END"


@query(
    "a28_aggregate_status",
    f"""WITH {OBS}, s AS (SELECT asset_id, {_STATUS} AS st FROM obs), g AS (SELECT asset_id, count(*) FILTER (WHERE st = 'PASS') AS passed, count(*) FILTER (WHERE st = 'REVIEW') AS review, count(*) FILTER (WHERE st = 'FAIL') AS failed FROM s GROUP BY asset_id)
SELECT *, CASE WHEN failed > 0 THEN 'FAIL' WHEN review > 0 THEN 'REVIEW' WHEN passed > 0 THEN 'PASS' ELSE 'INSUFFICIENT' END AS status FROM g""",
)
def a28(spark, d):
    return gates.aggregate_status(observations(spark, d).withColumn("st", F.expr(_STATUS)), ["asset_id"], "st")


@query(
    "a29_qc_rollup",
    f"""WITH {OBS}, m AS (SELECT asset_id, max(score) AS score, max(tax) AS tax, avg(weight) AS weight FROM obs GROUP BY asset_id),
l AS (SELECT asset_id, CASE WHEN score > 0.95 THEN 2 WHEN score > 0.8 THEN 1 ELSE 0 END AS a, CASE WHEN tax > 0.075 THEN 2 WHEN tax > 0.05 THEN 1 ELSE 0 END AS b, CASE WHEN weight > 40 THEN 2 WHEN weight > 30 THEN 1 ELSE 0 END AS c FROM m)
SELECT asset_id, CAST((a > 0)::INT + (b > 0)::INT + (c > 0)::INT AS BIGINT) AS findings, list_extract(['pass', 'warning', 'error'], greatest(a, b, c) + 1) AS status FROM l""",
)
def a29(spark, d):
    m = observations(spark, d).groupBy("asset_id").agg(F.max("score").alias("score"), F.max("tax").alias("tax"), F.avg("weight").alias("weight"))
    return gates.qc_rollup(m, ["asset_id"], {"score": (0.8, 0.95), "tax": (0.05, 0.075), "weight": (30, 40)})


@query(
    "a31_next_gain",
    """WITH h AS (SELECT user_id, event_id, 0.5 + value / 200 AS gain, (value % 50) / 50 - 0.5 AS err FROM events),
l AS (SELECT *, row_number() OVER w AS r, lead(gain) OVER w AS g0, lead(err) OVER w AS e0 FROM h WINDOW w AS (PARTITION BY user_id ORDER BY event_id DESC)),
s AS (SELECT *, g0 IS NOT NULL AND abs(err - e0) > 1e-9 AND abs(ln(gain) - ln(g0)) > 1e-9 AS ok FROM l WHERE r = 1),
p AS (SELECT *, CASE WHEN ok THEN exp(ln(gain) - err * (ln(gain) - ln(g0)) / (err - e0)) ELSE gain * (1 - 0.5 * err) END AS raw FROM s)
SELECT user_id, CASE WHEN abs(err) <= 0.02 THEN 'matched' WHEN ok THEN 'secant' ELSE 'damped' END AS action, round(CASE WHEN abs(err) <= 0.02 THEN gain ELSE greatest(gain * 0.25, least(gain * 4, raw)) END, 6) AS next_gain FROM p""",
)
def a31(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("user_id", "event_id", (0.5 + F.col("value") / 200).alias("gain"), ((F.col("value") % 50) / 50 - 0.5).alias("err"))
    return rounded(gates.next_gain(e, ["user_id"], "event_id", "gain", "err"))


@query(
    "a32_component_consensus",
    f"""WITH {OBS}, m AS (SELECT part_id AS member, part_id // 3 AS component, min(category) AS choice, max(score) AS conf, part_id % 23 = 0 AS locked FROM obs GROUP BY part_id),
rk AS (SELECT member, component, candidate, row_number() OVER (PARTITION BY member ORDER BY s DESC, candidate) AS rank FROM (SELECT part_id AS member, part_id // 3 AS component, category AS candidate, round(sum(score), 6) AS s FROM obs GROUP BY ALL)),
sz AS (SELECT component, count(DISTINCT member) AS members, count(DISTINCT CASE WHEN locked THEN choice END) AS locks, min(CASE WHEN locked THEN choice END) AS lk FROM m GROUP BY component),
v AS (SELECT component, choice, count(*) AS n, sum(conf) AS s FROM m GROUP BY ALL), t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY n DESC, round(s, 8) DESC, choice) AS r FROM v) WHERE r = 1),
sh AS (SELECT component, candidate, count(DISTINCT member) AS cm, sum(rank) AS su, max(rank) AS mx FROM rk GROUP BY ALL),
f AS (SELECT * FROM (SELECT sh.*, row_number() OVER (PARTITION BY component ORDER BY su, mx, candidate) AS r FROM sh JOIN sz USING (component) WHERE cm = members) WHERE r = 1),
o AS (SELECT sz.component, members, CASE WHEN locks = 1 THEN 'locked' WHEN locks > 1 THEN 'keep' WHEN n * 2 > members THEN 'majority' WHEN candidate IS NOT NULL THEN 'ranking' ELSE 'none' END AS route, lk, t.choice AS top, candidate FROM sz LEFT JOIN t USING (component) LEFT JOIN f USING (component))
SELECT component, members, route, CASE route WHEN 'locked' THEN lk WHEN 'majority' THEN top WHEN 'ranking' THEN candidate END AS choice FROM o""",
)
def a32(spark, d):
    o = observations(spark, d).withColumn("component", F.floor(F.col("part_id") / 3).cast("long")).withColumnRenamed("part_id", "member")
    m = o.groupBy("member", "component").agg(F.min("category").alias("choice"), F.max("score").alias("conf")).withColumn("locked", F.col("member") % 23 == 0)
    r = rank.rank_scores(o.groupBy("member", "component", F.col("category").alias("candidate")).agg(F.round(F.sum("score"), 6).alias("s")), ["member"], "s", "candidate")
    return gates.component_consensus(m, r, ["component"], "member", "choice", "conf", "locked")


@query("a33_coating_components")
def a33(spark, d):
    """Order-dependent clusters; tested against brute force."""
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    return gates.coating_components(p, ["brand", "type"], "part_id", "price", 40.0)


@query(
    "f_colour_features",
    f"""WITH {PARTS}, {HSV}, {lab_sql("parts", "part_id, brand")} SELECT part_id, round(lab_l, 4) AS l, round(lab_a, 4) AS a, round(lab_b, 4) AS b, round(h, 5) AS h, round(s, 5) AS s, round(v, 5) AS v, colour FROM lab JOIN col USING (part_id)""",
)
def f_features(spark, d):
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    return p.select("part_id", *[F.round(f"lab.{c}", 4).alias(c) for c in "lab"], *[F.round(f"hsv.{c}", 5).alias(c) for c in "hsv"], "colour")
