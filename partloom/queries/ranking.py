"""Ranking, windows and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from partloom.operators import assembly, rank
from partloom.operators.spread import spread
from partloom.queries.base import OBS, PARTS, observations, parts, query, rounded

#: Candidates of a part: its views with one score for each lane.
CAND = "cand AS (SELECT part_id, view_id, round(max(score), 6) AS colour, round(avg(tax), 6) AS texture, round(sum(weight), 6) AS pixels, min(category) = 'A' AS gate FROM obs GROUP BY ALL)"


def candidates(spark, d):
    o = spread(observations(spark, d), ["part_id"])
    return o.groupBy("part_id", "view_id").agg(F.round(F.max("score"), 6).alias("colour"), F.round(F.avg("tax"), 6).alias("texture"), F.round(F.sum("weight"), 6).alias("pixels"), (F.min("category") == "A").alias("gate"))


def lanes(spark, d):
    return rank.rank_lanes(candidates(spark, d), ["part_id"], "view_id", ["colour", "texture", "pixels"])


LANES = "lanes AS (" + " UNION ALL ".join(f"SELECT part_id, view_id, '{x}' AS lane, row_number() OVER (PARTITION BY part_id ORDER BY {x} DESC, view_id) AS rank FROM cand" for x in ("colour", "texture", "pixels")) + ")"


@query("w01_rank_scores", f"WITH {OBS}, {CAND} SELECT * FROM (SELECT part_id, view_id, colour, row_number() OVER (PARTITION BY part_id ORDER BY colour DESC, view_id) AS rank FROM cand) WHERE rank <= 5")
def w01(spark, d):
    return rank.rank_scores(candidates(spark, d).select("part_id", "view_id", "colour"), ["part_id"], "colour", "view_id", 5)


_WEIGHTS = {"colour": 0.8, "texture": 1.2, "pixels": 0.2}


@query(
    "w02_rrf",
    f"""WITH {OBS}, {CAND}, {LANES}, f AS (SELECT part_id, view_id, round(sum(CASE lane WHEN 'colour' THEN 0.8::DOUBLE WHEN 'texture' THEN 1.2::DOUBLE ELSE 0.2::DOUBLE END / (60 + rank)), 10) AS fused FROM lanes GROUP BY ALL)
SELECT part_id, view_id, round(fused, 8) AS fused, row_number() OVER (PARTITION BY part_id ORDER BY fused DESC, view_id) AS rank FROM f""",
)
def w02(spark, d):
    return rounded(rank.rrf(lanes(spark, d), ["part_id"], "view_id", "lane", _WEIGHTS), 8)


@query(
    "w03_search",
    f"""WITH {PARTS}, t AS (SELECT part_id, unnest(string_split(name, ' ')) AS w, 3 AS k FROM parts UNION ALL SELECT part_id, lower(type), 2 FROM parts UNION ALL SELECT part_id, lower(brand), 1 FROM parts),
s AS (SELECT part_id, sum(k) AS score FROM t WHERE w IN ('small', 'widget', 'economy', 'brand#13') GROUP BY part_id)
SELECT part_id, CAST(score AS BIGINT) AS score FROM s JOIN parts USING (part_id) WHERE size <= 30 ORDER BY score DESC, part_id LIMIT 20""",
)
def w03(spark, d):
    """Faceted search: hard facets, then weighted words of the fields, then the best twenty."""
    fields = [(F.split("name", " "), 3), (F.array(F.lower("type")), 2), (F.array(F.lower("brand")), 1)]
    return assembly.faceted_search(parts(spark, d), "part_id", F.col("size") <= 30, fields, ["small", "widget", "economy", "brand#13"], 20)


@query(
    "w05_compatibility",
    f"""WITH {OBS}, {CAND}, s AS (SELECT part_id, view_id, round(0.25 * coalesce(pixels / 200, 0.5) + 0.5 * coalesce(nullif(colour, 0), 0.5) + 0.25 * texture * 12 - CASE WHEN gate THEN 0.5 ELSE 0 END - CASE WHEN view_id % 7 = 0 THEN 0.4 ELSE 0 END - CASE WHEN texture < 0.02 THEN 0.2 ELSE 0 END, 6) AS score FROM cand)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY score DESC, view_id) AS rank FROM s) WHERE rank <= 4""",
)
def w05(spark, d):
    """Composite compatibility with penalties; a missing signal counts one half."""
    c = candidates(spark, d)
    score = rank.compatibility({"retrieval": F.col("pixels") / 200, "colour": F.nullif("colour", F.lit(0.0)), "texture": F.col("texture") * 12}, {"colour_gate": F.col("gate"), "transmission": F.col("view_id") % 7 == 0, "texture_mismatch": F.col("texture") < 0.02})
    return rank.rank_scores(c.select("part_id", "view_id", F.round(score, 6).alias("score")), ["part_id"], "score", "view_id", 4)


@query(
    "w06_lane_order",
    f"""WITH {OBS}, {CAND}, {LANES}, f AS (SELECT part_id, view_id, min({{'n': CAST(list_position(['texture', 'colour', 'pixels'], lane) AS BIGINT), 'r': rank}}) AS o FROM lanes WHERE rank <= 2 GROUP BY ALL)
SELECT * FROM (SELECT part_id, view_id, o.n AS lane_no, o.r AS lane_rank, row_number() OVER (PARTITION BY part_id ORDER BY o.n, o.r, view_id) AS rank FROM f) WHERE rank <= 4""",
)
def w06(spark, d):
    return rank.lane_order(lanes(spark, d).where("rank <= 2"), ["part_id"], "view_id", "lane", ["texture", "colour", "pixels"], 4)


@query(
    "w07_lane_quota",
    f"""WITH {OBS}, {CAND}, {LANES}, t AS (SELECT part_id, view_id, lane, rank, row_number() OVER (PARTITION BY part_id, lane ORDER BY rank, view_id) AS round FROM lanes)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY round, list_position(['texture', 'colour', 'pixels'], lane), view_id) AS slot FROM t) WHERE slot <= 7""",
)
def w07(spark, d):
    return rank.lane_quota(lanes(spark, d), ["part_id"], "view_id", "lane", ["texture", "colour", "pixels"], 7)


@query(
    "w07_stratified",
    f"""WITH {OBS}, {CAND}, {LANES}, c AS (SELECT *, count(*) OVER (PARTITION BY part_id) AS c FROM lanes WHERE lane = 'colour')
SELECT part_id, view_id, rank FROM c WHERE c <= 3 OR list_contains([CAST(floor(0 * (c - 1) / 2) AS BIGINT), CAST(floor(1 * (c - 1) / 2) AS BIGINT), CAST(floor(2 * (c - 1) / 2) AS BIGINT)], rank - 1)""",
)
def w07b(spark, d):
    return rank.stratified_order(lanes(spark, d).where("lane = 'colour'"), ["part_id"], 3).select("part_id", "view_id", "rank")


@query(
    "w08_select_winner",
    f"""WITH {OBS}, {CAND}, b AS (SELECT part_id, min(view_id) AS base FROM cand GROUP BY part_id), k AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY texture DESC, view_id) AS r FROM cand)
SELECT b.part_id, CASE WHEN k.view_id <> base AND round(k.texture - c.texture, 8) >= 0.015 THEN k.view_id ELSE base END AS selected, k.view_id <> base AND round(k.texture - c.texture, 8) >= 0.015 AS changed, round(k.texture - c.texture, 6) AS gain
FROM b JOIN cand c ON c.part_id = b.part_id AND c.view_id = b.base JOIN k ON k.part_id = b.part_id AND k.r = 1""",
)
def w08(spark, d):
    c = candidates(spark, d)
    return rounded(rank.select_winner(c, c.groupBy("part_id").agg(F.min("view_id").alias("view_id")), ["part_id"], "view_id", "texture"))


@query(
    "w09_tiered_winner",
    f"""WITH {OBS}, {CAND}, e AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY colour DESC, texture DESC, view_id) AS r FROM cand WHERE gate AND pixels > 60)
SELECT k.part_id, e.view_id AS winner, CASE WHEN e.view_id IS NULL THEN 'no_eligible_candidate' END AS reason FROM (SELECT DISTINCT part_id FROM cand) k LEFT JOIN e ON e.part_id = k.part_id AND r = 1""",
)
def w09(spark, d):
    return rank.tiered_winner(candidates(spark, d), ["part_id"], F.col("gate") & (F.col("pixels") > 60), [F.desc("colour"), F.desc("texture")], "view_id")


@query(
    "w10_group_step",
    f"""WITH {OBS}, {CAND}, b AS (SELECT *, view_id = min(view_id) OVER (PARTITION BY part_id) AND part_id % 7 <> 0 AS base FROM cand),
m AS (SELECT part_id, view_id AS winner, texture AS score, texture - lead(texture) OVER w AS margin, row_number() OVER w AS r FROM b WINDOW w AS (PARTITION BY part_id ORDER BY texture DESC, view_id)),
g AS (SELECT part_id, max(CASE WHEN base THEN view_id END) AS base, max(CASE WHEN base THEN texture END) AS bs FROM b GROUP BY part_id),
s AS (SELECT m.*, base, CASE WHEN base IS NULL THEN 'no_baseline' WHEN winner = base THEN 'baseline_best' WHEN round(score - bs, 8) < 0.02 THEN 'gain_too_small' WHEN margin IS NOT NULL AND round(margin, 8) < 0.004 THEN 'margin_too_small' ELSE 'changed' END AS reason FROM m JOIN g USING (part_id) WHERE r = 1)
SELECT part_id, reason, CASE WHEN reason = 'changed' THEN winner ELSE base END AS selected FROM s""",
)
def w10(spark, d):
    from pyspark.sql import Window

    c = candidates(spark, d).withColumn("base", (F.col("view_id") == F.min("view_id").over(Window.partitionBy("part_id"))) & (F.col("part_id") % 7 != 0))
    return rank.group_step(c, ["part_id"], "view_id", "texture", "base", 0.02, 0.004)


@query(
    "w11_select_membership",
    f"""WITH {OBS}, v AS (SELECT part_id, view_id, max(CASE WHEN line > 3 THEN score END) AS m1, max(CASE WHEN line <= 3 THEN score END) AS m0 FROM obs GROUP BY ALL),
g AS (SELECT part_id, count(*) FILTER (WHERE round(m1 - m0, 8) > 0.05) AS improved, count(*) FILTER (WHERE round(m1 - m0, 8) < -0.3) AS regressed, round(avg(m1) - avg(m0), 8) AS gain FROM v GROUP BY part_id)
SELECT part_id, improved, regressed, CASE WHEN coalesce(gain, -1) >= 0.015 AND improved >= 2 AND regressed = 0 THEN 'M1' ELSE 'M0' END AS mode FROM g""",
)
def w11(spark, d):
    o = observations(spark, d)
    v = o.groupBy("part_id", "view_id").agg(F.max(F.when(F.col("line") > 3, F.col("score"))).alias("m1"), F.max(F.when(F.col("line") <= 3, F.col("score"))).alias("m0"))
    return rank.select_membership(v, ["part_id"], "m1", "m0")


@query(
    "w12_guard_choice",
    f"""WITH {OBS}, {CAND}, c AS (SELECT part_id, max(view_id) AS choice FROM cand GROUP BY part_id), b AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY colour DESC, view_id) AS r FROM cand)
SELECT c.part_id, CASE WHEN round(b.colour - x.colour, 8) > CASE WHEN c.part_id % 5 = 0 THEN 0 ELSE 0.2 END THEN b.view_id ELSE c.choice END AS choice FROM c JOIN cand x ON x.part_id = c.part_id AND x.view_id = c.choice JOIN b ON b.part_id = c.part_id AND b.r = 1""",
)
def w12(spark, d):
    """The limit is zero for colour-critical parts."""
    c = candidates(spark, d)
    chosen = c.groupBy("part_id").agg(F.max("view_id").alias("choice"))
    return rank.guard_choice(chosen, c, ["part_id"], "view_id", "colour", F.when(F.col("part_id") % 5 == 0, 0.0).otherwise(0.2))


@query(
    "w13_order_agreement",
    f"""WITH {OBS}, {CAND}, f AS (SELECT part_id, arg_max(view_id, {{'a': colour, 'b': -view_id}}) AS f FROM cand GROUP BY part_id), r AS (SELECT part_id, arg_max(view_id, {{'a': colour, 'b': view_id}}) AS r FROM cand GROUP BY part_id)
SELECT part_id, CASE WHEN f = r THEN f END AS choice, CASE WHEN f = r THEN 'agreed' ELSE 'tournament' END AS route FROM f FULL JOIN r USING (part_id)""",
)
def w13(spark, d):
    c = candidates(spark, d)
    pick = lambda o: c.groupBy("part_id").agg(F.max_by("view_id", F.struct("colour", o)).alias("view_id"))
    return rank.order_agreement(pick(-F.col("view_id")), pick(F.col("view_id")), ["part_id"], "view_id")


@query(
    "w14_best_observation",
    f"""WITH {OBS}, {CAND}, m AS (SELECT *, max(pixels) OVER (PARTITION BY part_id) AS mx FROM cand), k AS (SELECT * FROM m WHERE mx < 150 OR pixels >= 0.75 * mx)
SELECT part_id, view_id, pixels FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY CASE WHEN mx < 150 THEN texture ELSE colour END DESC, pixels DESC, view_id DESC) AS r FROM k) WHERE r = 1""",
)
def w14(spark, d):
    return rank.best_observation(candidates(spark, d), ["part_id"], "view_id", "pixels", "texture", "colour", enough=150).select("part_id", "view_id", "pixels")


@query(
    "w15_margin",
    f"""WITH {OBS}, {CAND} SELECT part_id, winner, score, alternative, round(margin, 6) AS margin FROM (SELECT part_id, view_id AS winner, texture AS score, lead(view_id) OVER w AS alternative, texture - lead(texture) OVER w AS margin, row_number() OVER w AS r FROM cand WINDOW w AS (PARTITION BY part_id ORDER BY texture DESC, view_id)) WHERE r = 1""",
)
def w15(spark, d):
    return rounded(rank.margin(candidates(spark, d), ["part_id"], "texture", "view_id"))


@query(
    "w16_nonregression",
    f"""WITH {OBS}, a AS (SELECT part_id, avg(score) AS score, avg(tax) AS tax FROM obs WHERE line <= 3 GROUP BY part_id), b AS (SELECT part_id, avg(score) AS score, avg(tax) AS tax FROM obs WHERE line > 3 GROUP BY part_id),
ua AS (SELECT part_id, 'score' AS metric, score AS v FROM a UNION ALL SELECT part_id, 'tax', tax FROM a), ub AS (SELECT part_id, 'score' AS metric, score AS v FROM b UNION ALL SELECT part_id, 'tax', tax FROM b),
j AS (SELECT part_id, metric, round(ub.v - ua.v, 6) AS delta FROM ua FULL JOIN ub USING (part_id, metric))
SELECT *, CASE WHEN delta IS NULL THEN 'missing' WHEN delta < -0.01 THEN 'regressed' WHEN delta > 0.01 THEN 'improved' ELSE 'same' END AS status FROM j""",
)
def w16(spark, d):
    o = observations(spark, d)
    half = lambda c: o.where(c).groupBy("part_id").agg(F.avg("score").alias("score"), F.avg("tax").alias("tax"))
    return rank.nonregression(half("line <= 3"), half("line > 3"), ["part_id"], ["score", "tax"], 0.01)


@query(
    "w17_repair_plan",
    f"""WITH {OBS}, s AS (SELECT view_id, category, part_id, count(DISTINCT asset_id) AS views FROM obs GROUP BY ALL), m AS (SELECT DISTINCT view_id, category FROM obs WHERE category <> 'N')
SELECT * FROM (SELECT s.view_id, s.category, s.part_id, views, row_number() OVER (PARTITION BY s.view_id ORDER BY views DESC, s.category, s.part_id) AS "order" FROM s JOIN m USING (view_id, category) WHERE views >= 2 AND s.part_id % 9 <> 0) WHERE "order" <= 12""",
)
def w17(spark, d):
    from partloom.operators.gates import repair_plan

    o = observations(spark, d)
    support = o.groupBy("view_id", "category", "part_id").agg(F.count_distinct("asset_id").alias("views"))
    missing = o.where("category <> 'N'").select("view_id", "category").distinct()
    vetoes = o.where("part_id % 9 = 0").select("view_id", "part_id").distinct()
    return repair_plan(missing, support, vetoes, ["view_id"], "part_id", "category", "views", 2, 12).select("view_id", "category", "part_id", "views", "order")


@query(
    "w18_resolve_limitations",
    f"""WITH {OBS}, f AS (SELECT asset_id, part_id, view_id FROM obs WHERE score < 0.1), ok AS (SELECT part_id, count(DISTINCT view_id) AS n FROM obs WHERE score >= 0.9 GROUP BY part_id), own AS (SELECT DISTINCT asset_id, view_id FROM obs WHERE category = 'A')
SELECT asset_id, part_id, view_id, CASE WHEN own.asset_id IS NOT NULL THEN 'owner_elsewhere' WHEN n > 0 THEN 'delivered_in_other_view' ELSE 'unresolved' END AS resolution FROM (SELECT DISTINCT * FROM f) LEFT JOIN ok USING (part_id) LEFT JOIN own USING (asset_id, view_id)""",
)
def w18(spark, d):
    """Each failure by the first explanation that holds: another owner in the view, delivered in another view, or none."""
    o = observations(spark, d)
    failures = o.where("score < 0.1").select("asset_id", "part_id", "view_id").distinct()
    why = [("owner_elsewhere", o.where("category = 'A'"), ["asset_id", "view_id"]), ("delivered_in_other_view", o.where("score >= 0.9"), ["part_id"])]
    return assembly.resolve_limitations(failures, ["asset_id", "part_id", "view_id"], why)


@query(
    "w19_region_recovery",
    f"""WITH {OBS}, a AS (SELECT asset_id, category, count(*) AS n FROM obs WHERE line <= 4 GROUP BY ALL), b AS (SELECT asset_id, category, count(*) AS n FROM obs WHERE line > 2 GROUP BY ALL),
wa AS (SELECT asset_id, arg_max(category, {{'n': n, 'c': -ascii(category)}}) AS w FROM a GROUP BY asset_id), wb AS (SELECT asset_id, arg_max(category, {{'n': n, 'c': -ascii(category)}}) AS w FROM b GROUP BY asset_id), v AS (SELECT asset_id, count(DISTINCT view_id) AS views FROM obs GROUP BY asset_id)
SELECT wa.asset_id, wa.w AS category, views FROM wa JOIN wb ON wa.asset_id = wb.asset_id AND wa.w = wb.w JOIN v ON v.asset_id = wa.asset_id WHERE views >= 2""",
)
def w19(spark, d):
    """A decision needs two views, and the winners of both sources must agree."""
    o = observations(spark, d)
    counts = lambda c: o.where(c).groupBy("asset_id", "category").agg(F.count(F.lit(1)).alias("n"))
    return assembly.agreed_winner(counts("line <= 4"), counts("line > 2"), o, ["asset_id"], "category", "n", "view_id")


@query(
    "p07_systematic_sample",
    f"""WITH {OBS}, i AS (SELECT asset_id, part_id, view_id, line, price, row_number() OVER (PARTITION BY asset_id ORDER BY line, part_id, view_id, price) - 1 AS i, count(*) OVER (PARTITION BY asset_id) AS c FROM obs)
SELECT asset_id, part_id, view_id, line, price FROM i WHERE c <= 3 OR i IN (0, floor((c - 1) / 2), c - 1)""",
)
def p07(spark, d):
    o = observations(spark, d).select("asset_id", "part_id", "view_id", "line", "price")
    return rank.systematic_sample(o, ["asset_id"], 3, ["line", "part_id", "view_id", "price"])


@query(
    "j18_merge_rankings",
    f"""WITH {OBS}, {CAND}, {LANES}, a AS (SELECT part_id, view_id, rank AS a FROM lanes WHERE lane = 'colour' AND rank <= 4), b AS (SELECT part_id, view_id, rank AS b FROM lanes WHERE lane = 'texture' AND rank <= 4)
SELECT part_id, view_id, row_number() OVER (PARTITION BY part_id ORDER BY least(coalesce(a, 1 << 30), coalesce(b, 1 << 30)), coalesce(a, 1 << 30), view_id) AS rank FROM a FULL JOIN b USING (part_id, view_id)""",
)
def j18(spark, d):
    x = lanes(spark, d).where("rank <= 4")
    return rank.merge_rankings(x.where("lane = 'colour'"), x.where("lane = 'texture'"), ["part_id"], "view_id")
