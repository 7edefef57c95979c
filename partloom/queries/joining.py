"""Joins, graphs, cohorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import assembly, gates, graph, joins, mesh
from partloom.operators.spread import spread
from partloom.plans import rules
from partloom.queries.base import OBS, PARTS, lab_sql, observations, parts, query, rounded, table


@query(
    "j01_reconcile",
    """WITH r AS (SELECT o_orderkey AS k, count(*) AS registered FROM orders GROUP BY 1), p AS (SELECT l_orderkey AS k, count(*) AS planned FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
SELECT k, coalesce(registered, 0) AS registered, coalesce(planned, 0) AS planned, CASE WHEN registered IS NULL THEN 'unexpected' WHEN planned IS NULL THEN 'missing' WHEN registered > 1 OR planned > 1 THEN 'duplicate' ELSE 'covered' END AS status FROM r FULL JOIN p USING (k)""",
)
def j01(spark, d):
    return joins.reconcile(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("k")), ["k"])


@query(
    "j02_canonicalize_votes",
    f"""WITH {OBS}, a AS (SELECT view_id, category, count(DISTINCT status) AS n, min(status) AS c FROM obs WHERE part_id % 40 = 1 GROUP BY ALL)
SELECT asset_id, part_id, view_id, category, CASE WHEN n = 1 THEN c END AS canonical, CASE WHEN n IS NULL THEN 'unknown' WHEN n > 1 THEN 'ambiguous' ELSE 'resolved' END AS resolution FROM obs LEFT JOIN a USING (view_id, category)""",
)
def j02(spark, d):
    o = observations(spark, d)
    return joins.canonicalize_votes(o.select("asset_id", "part_id", "view_id", "category"), o.where("part_id % 40 = 1"), ["view_id"], "category", "status")


@query("j03_allow_and_exclude", f"WITH {OBS} SELECT asset_id, part_id, line, price FROM obs WHERE part_id IN (SELECT p_partkey FROM part WHERE p_size <= 25) AND view_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000)")
def j03(spark, d):
    allowed = table(spark, d, "part").where("p_size <= 25").select(F.col("p_partkey").alias("part_id"))
    barred = table(spark, d, "supplier").where("s_acctbal < 3000").select(F.col("s_suppkey").alias("view_id"))
    return joins.exclude_members(joins.enforce_allowlist(observations(spark, d), allowed, ["part_id"]), barred, ["view_id"]).select("asset_id", "part_id", "line", "price")


_SEEN = "seen AS (SELECT DISTINCT asset_id, view_id % 3 AS view_id, parts.part_id, type AS family, r, g, b FROM obs JOIN parts USING (part_id))"


def seen(spark, d):
    p = color.add_colour_features(parts(spark, d), "r", "g", "b").select("part_id", F.col("type").alias("family"), "lab")
    o = observations(spark, d).select("asset_id", (F.col("view_id") % 3).alias("view_id"), "part_id").distinct()
    return o.join(p, "part_id").withColumn("weight", F.lit(0.7) + (F.col("part_id") % 3) * 0.1)


@query(
    "j04_appearance_links",
    f"""WITH {OBS}, {PARTS}, {_SEEN}, {lab_sql("seen", "asset_id, view_id, part_id, family")}, w AS (SELECT *, 0.7::DOUBLE + (part_id % 3) * 0.1::DOUBLE AS weight FROM lab),
p AS (SELECT x.asset_id, x.part_id AS part_a, y.part_id AS part_b, least(x.weight, y.weight) AS w, x.family = y.family AS same, sqrt(power(x.lab_l - y.lab_l, 2) + power(x.lab_a - y.lab_a, 2) + power(x.lab_b - y.lab_b, 2)) AS d
  FROM w x JOIN w y ON x.asset_id = y.asset_id AND x.view_id = y.view_id AND x.part_id < y.part_id)
SELECT asset_id, part_a, part_b, round(sum(CASE WHEN same AND d <= 60 THEN w ELSE 0 END), 6) AS support FROM p GROUP BY ALL HAVING round(sum(CASE WHEN same AND d <= 60 THEN w ELSE 0 END), 8) >= 0.6 AND NOT bool_or((NOT same OR d > 90) AND w >= 0.8)""",
)
def j04(spark, d):
    return rounded(joins.appearance_links(seen(spark, d), ["asset_id"], "part_id", "view_id", "family", "weight", radius=60, conflict=90))


_BOXES = "box AS (SELECT p_brand AS brand, p_partkey AS id, p_partkey * 13 % 97 AS x0, p_partkey * 29 % 89 AS y0, p_partkey * 13 % 97 + p_size AS x1, p_partkey * 29 % 89 + p_size AS y1 FROM part)"


@query(
    "j05_box_overlap",
    f"""WITH {_BOXES}, p AS (SELECT l.brand, l.id AS id_l, r.id AS id_r, (least(l.x1, r.x1) - greatest(l.x0, r.x0)) AS w, (least(l.y1, r.y1) - greatest(l.y0, r.y0)) AS h, least((l.x1 - l.x0) * (l.y1 - l.y0), (r.x1 - r.x0) * (r.y1 - r.y0)) AS a FROM box l JOIN box r ON l.brand = r.brand AND l.id < r.id)
SELECT brand, id_l, id_r, round(w * h / a::DOUBLE, 6) AS overlap FROM p WHERE w > 0 AND h > 0 AND w * h / a::DOUBLE >= 0.2""",
)
def j05(spark, d):
    k = F.col("p_partkey")
    b = table(spark, d, "part").select(F.col("p_brand").alias("brand"), k.alias("id"), (k * 13 % 97).alias("x0"), (k * 29 % 89).alias("y0"), (k * 13 % 97 + F.col("p_size")).alias("x1"), (k * 29 % 89 + F.col("p_size")).alias("y1"))
    return rounded(joins.box_overlap(b, b, ["brand"], 25.0, 0.2).where("id_l < id_r"))


_BITS = "bits AS (SELECT vec_id, list_transform(embedding[1:64], lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS s FROM embeddings)"
_PAIRS = "pairs AS (SELECT x.vec_id AS id_a, y.vec_id AS id_b, CAST(list_sum(list_transform(list_zip(x.s, y.s), lambda z: abs(z[1] - z[2]))) AS BIGINT) AS distance FROM bits x JOIN bits y ON x.vec_id < y.vec_id)"


def pairs(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", joins.sign_bits("embedding").alias("bits"))
    return joins.hamming_pairs(e, "vec_id", "bits", 14)


@query("j06_hamming_pairs", f"WITH {_BITS}, {_PAIRS} SELECT * FROM pairs WHERE distance <= 14")
def j06(spark, d):
    return pairs(spark, d)


_KNN = """q AS (SELECT vec_id AS query, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 100 = 0), bank AS (SELECT vec_id AS candidate, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT query, candidate, round(list_cosine_similarity(q.v, bank.v), 6) AS score FROM q, bank)"""


@query("j07_knn", f"WITH {_KNN} SELECT query, candidate, round(score, 4) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, candidate) AS rank FROM s) WHERE rank <= 10")
def j07(spark, d):
    """Queries: the rows whose id is divisible by 100, against all rows."""
    e = table(spark, d, "embeddings")
    out = joins.knn(e.where("vec_id % 100 = 0"), e, "vec_id", "vec_id", "embedding", 10)
    return out.select("query", "candidate", F.round("score", 4).alias("score"), "rank")


@query("j08_set_similarity")
def j08(spark, d):
    """Sets are the vectors of a label; tested against brute force."""
    tokens = table(spark, d, "embeddings").select(F.col("label").alias("entity"), F.col("vec_id").alias("token"), F.col("embedding").alias("vec"))
    labels = tokens.select("entity").distinct()
    p = labels.select(F.col("entity").alias("left")).join(labels.select(F.col("entity").alias("right")), F.col("left") < F.col("right"))
    return rounded(joins.set_similarity(p, tokens))


@query("j09_nearest_colour")
def j09(spark, d):
    """Every part against the suppliers' colours; CIEDE2000 is tested with published values."""
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    k = F.col("s_suppkey")
    s = color.add_colour_features(table(spark, d, "supplier").select(k.alias("colour_id"), (k * 53 % 256).alias("r"), (k * 71 % 256).alias("g"), (k * 113 % 256).alias("b")), "r", "g", "b")
    return rounded(joins.nearest_colour(p, s, ["part_id"], "colour_id", 3), 4)


@query(
    "j10_channel_prior",
    f"""WITH {PARTS}, p AS (SELECT part_id AS "group", CASE WHEN r > 64 THEN r / 255.0::DOUBLE END AS rough, CASE WHEN g > 64 THEN g / 255.0::DOUBLE END AS metal FROM parts), s AS (SELECT s_suppkey AS profile, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 10 / 10.0::DOUBLE END AS rough, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 7 / 7.0::DOUBLE END AS metal FROM supplier)
SELECT "group", profile, round(prior, 6) AS prior, channels, row_number() OVER (PARTITION BY "group" ORDER BY round(prior, 8) DESC NULLS LAST, profile) AS rank FROM (SELECT "group", profile, CASE WHEN p.rough IS NULL OR s.rough IS NULL THEN CASE WHEN p.metal IS NULL OR s.metal IS NULL THEN NULL ELSE 1 - abs(p.metal - s.metal) END WHEN p.metal IS NULL OR s.metal IS NULL THEN 1 - abs(p.rough - s.rough) ELSE (2 - abs(p.rough - s.rough) - abs(p.metal - s.metal)) / 2 END AS prior,
  CAST((p.rough IS NOT NULL AND s.rough IS NOT NULL)::INT + (p.metal IS NOT NULL AND s.metal IS NOT NULL)::INT AS BIGINT) AS channels FROM p, s) QUALIFY rank <= 5""",
)
def j10(spark, d):
    p = parts(spark, d).select("part_id", F.when(F.col("r") > 64, F.col("r") / 255.0).alias("rough"), F.when(F.col("g") > 64, F.col("g") / 255.0).alias("metal"))
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(k.alias("profile"), F.when(k % 3 > 0, (k % 10) / 10.0).alias("rough"), F.when(k % 4 > 0, (k % 7) / 7.0).alias("metal"))
    return rounded(joins.channel_prior(p, s, "part_id", "profile", ["rough", "metal"], 5))


_POINTS = "pt AS (SELECT vec_id AS id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"


@query(
    "j12_nearest_points",
    f"""WITH {_POINTS}, m AS (SELECT s.id AS source, t.id AS target, round(sqrt(power(s.x - t.x, 2) + power(s.y - t.y, 2) + power(s.z - t.z, 2)), 6) AS distance FROM pt s JOIN pt t ON s.label % 2 = 0 AND t.label % 2 = 1)
SELECT source, target, distance FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY distance, target) AS r FROM m WHERE distance <= 0.05) WHERE r = 1""",
)
def j12(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")])
    return joins.nearest_points(e.where("label % 2 = 0"), e.where("label % 2 = 1"), [], list("xyz"), 0.05)


@query(
    "j13_default_export",
    f"""WITH {PARTS}, c AS (SELECT x.part_id, y.part_id AS candidate, 80 * (x.r // 64 = y.r // 64)::INT - 35 * (x.r // 64 <> y.r // 64)::INT + 4 * (string_split(x.name, ' ')[1] = string_split(y.name, ' ')[1])::INT + 4 * (string_split(x.name, ' ')[2] = string_split(y.name, ' ')[2])::INT + 45 * (x.part_id = y.part_id)::INT AS score FROM parts x JOIN parts y USING (brand) WHERE y.size % 3 = 0)
SELECT part_id, candidate, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY score DESC, candidate) AS r FROM c) WHERE r = 1 AND score > 0""",
)
def j13(spark, d):
    p = parts(spark, d).withColumn("tone", F.floor(F.col("r") / 64)).withColumn("words", F.split("name", " "))
    return assembly.default_choice(p, p.where("size % 3 = 0"), "brand", "part_id", "tone", "words")


@query(
    "j14_match_project",
    """WITH g AS (SELECT l_orderkey AS k, string_agg(CAST(l_linenumber AS VARCHAR) || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS topo FROM lineitem GROUP BY 1)
SELECT a.k AS asset, min(p.k) AS project FROM g a LEFT JOIN g p ON a.topo = p.topo AND p.k % 10 = 0 WHERE a.k % 10 <> 0 GROUP BY a.k""",
)
def j14(spark, d):
    """Assets to the first project of equal topology digest."""
    li = table(spark, d, "lineitem")
    topo = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))), lambda s: F.concat(s["l_linenumber"].cast("string"), s["l_returnflag"])), ","), 256)
    g = li.groupBy(F.col("l_orderkey").alias("k")).agg(topo.alias("topo"))
    return assembly.match_by_digest(g.where("k % 10 <> 0"), g.where("k % 10 = 0"), "k", "topo")


@query("j15_verify_dependencies", "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'missing' WHEN doc_id % 5 = 0 THEN 'stale' ELSE 'fresh' END AS status FROM documents")
def j15(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    recorded = docs.withColumn("digest", F.when(F.col("doc_id") % 5 == 0, F.lit("old")).otherwise(F.col("digest")))
    return joins.verify_dependencies(recorded, docs.where("doc_id % 7 <> 0"), "doc_id", "digest")


@query(
    "j16_layered_precedence",
    f"""WITH {OBS}, {PARTS}, a AS (SELECT part_id, min(category) AS v FROM obs WHERE score >= 0.95 GROUP BY 1), b AS (SELECT part_id, max(category) AS v FROM obs WHERE tax >= 0.08 GROUP BY 1)
SELECT part_id, coalesce(a.v, b.v, CASE WHEN size < 10 THEN type END) AS material, CASE WHEN a.v IS NOT NULL THEN 'direct' WHEN b.v IS NOT NULL THEN 'review' WHEN size < 10 THEN 'rule' ELSE 'unassigned' END AS layer FROM parts LEFT JOIN a USING (part_id) LEFT JOIN b USING (part_id)""",
)
def j16(spark, d):
    o, p = observations(spark, d), parts(spark, d)
    direct = o.where("score >= 0.95").groupBy("part_id").agg(F.min("category").alias("material"))
    review = o.where("tax >= 0.08").groupBy("part_id").agg(F.max("category").alias("material"))
    rule = p.where("size < 10").select("part_id", F.col("type").alias("material"))
    return joins.layered_precedence([("direct", direct), ("review", review), ("rule", rule)], p, ["part_id"], "material")


@query("j17_assign_one_to_one")
def j17(spark, d):
    """The views of an order to poses; tested against all assignments."""
    o = spread(observations(spark, d), ["asset_id"]).groupBy("asset_id", F.col("line").alias("view"), (F.col("view_id") % 5).alias("pose")).agg(F.round(F.max("score"), 6).alias("score"))
    return joins.assign_one_to_one(o, ["asset_id"], "view", "pose", "score").select("asset_id", F.array_join("path", ",", "-").alias("path"), F.round("total", 6).alias("total"), "matched")


@query(
    "g01_connected_components",
    f"""WITH RECURSIVE {_BITS}, {_PAIRS}, e AS (SELECT id_a AS a, id_b AS b FROM pairs WHERE distance <= 14 UNION ALL SELECT id_b, id_a FROM pairs WHERE distance <= 14),
r AS (SELECT vec_id AS node, vec_id AS reach FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach)
SELECT node, min(reach) AS component FROM r GROUP BY node""",
)
def g01(spark, d):
    return graph.connected_components(pairs(spark, d).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), table(spark, d, "embeddings").select(F.col("vec_id").alias("node")))


@query(
    "g02_drop_small_components",
    f"""WITH {OBS}, c AS (SELECT asset_id, category AS component, count(*) AS members, sum(weight) AS total FROM obs GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY members DESC, component) AS r, sum(members) OVER (PARTITION BY asset_id) AS am, sum(total) OVER (PARTITION BY asset_id) AS tt FROM c),
n AS (SELECT *, r > 1 AND (members < 2 OR total < 0.1 * tt) AS minor FROM m)
SELECT asset_id, component, members, total, minor AND sum(CASE WHEN minor THEN members ELSE 0 END) OVER (PARTITION BY asset_id) / am <= 0.3 AS removed FROM n""",
)
def g02(spark, d):
    sizes = observations(spark, d).groupBy("asset_id", F.col("category").alias("component")).agg(F.count(F.lit(1)).alias("members"), F.sum("weight").alias("total"))
    return graph.drop_small_components(sizes, ["asset_id"], 2, 0.1, 0.3)


@query(
    "g08_distribute_mass",
    f"""WITH {PARTS}, w AS (SELECT part_id, brand, size, sum(size) OVER (PARTITION BY brand) AS s, row_number() OVER (PARTITION BY brand ORDER BY part_id DESC) AS r FROM parts), m AS (SELECT *, round(100.0::DOUBLE * (size / s::DOUBLE), 6) AS m FROM w)
SELECT part_id, brand, round(CASE WHEN r = 1 THEN 100.0::DOUBLE - (sum(m) OVER (PARTITION BY brand) - m) ELSE m END, 3) AS mass FROM m""",
)
def g08(spark, d):
    p = parts(spark, d).select("part_id", "brand", "size").withColumn("total", F.lit(100.0))
    return mesh.distribute_mass(p, ["brand"], "part_id", "size", "total").select("part_id", "brand", F.round("mass", 3).alias("mass"))


@query("g08_estimate_mass", f"WITH {PARTS} SELECT part_id, round(greatest(0.01, least(10000, price * CASE WHEN size % 4 > 0 THEN size / 100.0::DOUBLE ELSE 0.5 END)), 6) AS mass FROM parts")
def g08b(spark, d):
    p = parts(spark, d).withColumn("volume", F.when(F.col("size") % 4 > 0, F.col("size") / 100.0)).withColumn("box", F.lit(0.5))
    return rounded(mesh.estimate_mass(p, "price", "volume", "box").select("part_id", "mass"))


@query(
    "g11_geometry_risk",
    f"""WITH {OBS}, c AS (SELECT asset_id, count(*) AS faces, count(*) FILTER (WHERE category = 'A') AS boundary, count(DISTINCT part_id) AS shells FROM obs GROUP BY asset_id),
r AS (SELECT asset_id, concat_ws(',', CASE WHEN boundary > 3 THEN 'open_boundary' END, CASE WHEN shells > 6 THEN 'many_shells' END, CASE WHEN faces < 2 THEN 'few_faces' END) AS reasons FROM c)
SELECT *, contains(reasons, 'open_boundary') OR contains(reasons, 'few_faces') AS hard FROM r""",
)
def g11(spark, d):
    c = observations(spark, d).groupBy("asset_id").agg(F.count(F.lit(1)).alias("faces"), F.count_if(F.col("category") == "A").alias("boundary"), F.count_distinct("part_id").alias("shells"))
    rules = [("open_boundary", F.col("boundary") > 3), ("many_shells", F.col("shells") > 6), ("few_faces", F.col("faces") < 2)]
    return assembly.geometry_risk(c, ["asset_id"], rules, ["open_boundary", "few_faces"])


@query(
    "g12_ground_contact",
    f"""WITH {PARTS}, b AS (SELECT part_id, brand, r * 1.0::DOUBLE AS lo, r * 1.0::DOUBLE + size AS hi, g * 1.0::DOUBLE AS width FROM parts), w AS (SELECT *, max(hi) OVER (PARTITION BY brand) - min(lo) OVER (PARTITION BY brand) AS h, min(lo) OVER (PARTITION BY brand) AS base, max(width) OVER (PARTITION BY brand) AS mw FROM b)
SELECT part_id, brand, lo - base <= 0.2 * h AND hi - lo <= 0.2 * h AND width >= 0.3 * mw AS ground FROM w""",
)
def g12(spark, d):
    p = parts(spark, d).select("part_id", "brand", F.col("r").cast("double").alias("lo"), (F.col("r") * 1.0 + F.col("size")).alias("hi"), F.col("g").cast("double").alias("width"))
    return mesh.ground_contact(p, ["brand"], "lo", "hi", "width", near=0.2).select("part_id", "brand", "ground")


@query(
    "g13_propagate",
    f"""WITH {PARTS}, a AS (SELECT part_id, brand, type, CASE WHEN part_id % 5 = 0 THEN size % 3 END AS material FROM parts), k AS (SELECT brand, type, count(DISTINCT material) AS n, min(material) AS m FROM a GROUP BY ALL)
SELECT part_id, brand, type, CASE WHEN material IS NOT NULL THEN material WHEN n = 1 THEN m END AS material, CASE WHEN material IS NOT NULL THEN 'own' WHEN n = 1 THEN 'propagated' WHEN n > 1 THEN 'conflict' ELSE 'none' END AS source FROM a JOIN k USING (brand, type)""",
)
def g13(spark, d):
    p = parts(spark, d).select("part_id", "brand", "type", F.when(F.col("part_id") % 5 == 0, F.col("size") % 3).alias("material"))
    return graph.propagate(p, ["brand", "type"], "material")


@query("g14_cohorts", f"WITH {PARTS} SELECT brand, type, count(*) AS members, count(DISTINCT size % 2) = 1 AS unanimous, bool_or(size > 45) AS vetoed FROM parts GROUP BY ALL HAVING count(*) > 1")
def g14(spark, d):
    p = parts(spark, d).withColumn("half", F.col("size") % 2).withColumn("veto", F.col("size") > 45)
    return graph.cohorts(p, ["brand", "type"], "half", "veto")


@query("u01_union_views", f"WITH {OBS} SELECT asset_id, part_id, line, price, NULL::VARCHAR AS category FROM obs WHERE line <= 3 UNION ALL SELECT asset_id, part_id, line, NULL::DOUBLE, category FROM obs WHERE line > 3")
def u01(spark, d):
    o = observations(spark, d)
    return rules.union_views(o.where("line <= 3").select("asset_id", "part_id", "line", "price"), o.where("line > 3").select("asset_id", "part_id", "line", "category"))


@query("u02_same_keys", "SELECT p_partkey AS part_id, 'left_only' AS side FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48) UNION ALL SELECT l_partkey, 'right_only' FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 48 AND l_partkey NOT IN (SELECT p_partkey FROM part))")
def u02(spark, d):
    return rules.same_keys(table(spark, d, "part").select(F.col("p_partkey").alias("part_id")), table(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("part_id")).distinct(), ["part_id"])


_PLANS = """a AS (SELECT p_partkey AS part_id, p_type AS material, p_size AS size FROM part WHERE p_partkey % 11 <> 0), b AS (SELECT p_partkey AS part_id, CASE WHEN p_partkey % 3 = 0 THEN 'PROMO' ELSE p_type END AS material, CASE WHEN p_partkey % 10 = 0 THEN p_size + 1 ELSE p_size END AS size FROM part WHERE p_partkey % 13 <> 0)"""


def plans(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    a = p.where("p_partkey % 11 <> 0").select(k.alias("part_id"), F.col("p_type").alias("material"), F.col("p_size").alias("size"))
    b = p.where("p_partkey % 13 <> 0").select(k.alias("part_id"), F.when(k % 3 == 0, "PROMO").otherwise(F.col("p_type")).alias("material"), F.when(k % 10 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("size"))
    return a, b


@query(
    "u03_plan_delta",
    f"""WITH {_PLANS}, j AS (SELECT part_id, a.part_id AS ka, b.part_id AS kb, a.material IS DISTINCT FROM b.material AS m, a.size IS DISTINCT FROM b.size AS s FROM a FULL JOIN b USING (part_id)),
k AS (SELECT part_id, CASE WHEN ka IS NULL THEN 'added' WHEN kb IS NULL THEN 'removed' WHEN m OR s THEN 'changed' ELSE 'same' END AS kind, m, s FROM j)
SELECT part_id, kind, CASE WHEN kind = 'changed' THEN concat_ws(',', CASE WHEN m THEN 'material' END, CASE WHEN s THEN 'size' END) ELSE '' END AS fields, kind = 'changed' AND NOT s AS permitted FROM k WHERE kind <> 'same'""",
)
def u03(spark, d):
    return rules.plan_delta(*plans(spark, d), ["part_id"], ["material", "size"], ["material"])


@query(
    "u04_candidate_plans",
    """WITH c AS (SELECT s_suppkey AS candidate FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 3)
SELECT p_partkey AS part_id, p_brand AS step_brand, candidate, 'S' || candidate AS material, 'C_' || substr(sha256(p_brand || '|' || candidate), 1, 12) AS candidate_id FROM part, c""",
)
def u04(spark, d):
    """The changes of each candidate plan: one group's parts (here: a brand's) get the candidate's material, all other parts keep theirs. The three best candidates make plans."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_brand").alias("step_brand"))
    best = table(spark, d, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(3).agg(F.sort_array(F.collect_list("s_suppkey")).alias("c")).first()["c"]
    return rules.candidate_plans(p, "step_brand", best).withColumn("material", F.concat(F.lit("S"), F.col("candidate").cast("string")))


@query(
    "u05_apply_review",
    """SELECT p_partkey AS part_id, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN 'REVIEWED' END AS material, CASE p_partkey % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'replace' WHEN 2 THEN 'reject' ELSE 'pending' END AS state FROM part""",
)
def u05(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    decisions = p.where(k % 4 < 3).select(k.alias("part_id"), F.when(k % 4 == 0, "approve").when(k % 4 == 1, "replace").otherwise("reject").alias("decision"), F.lit("REVIEWED").alias("material"))
    return rules.apply_review(p.select(k.alias("part_id"), F.col("p_type").alias("material")), decisions, ["part_id"], "material")
