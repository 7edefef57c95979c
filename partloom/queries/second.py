"""Palettes, lighting, shortlists, second-layer operators and meshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import assembly, fusion, graph, mesh, rank
from partloom.operators.spread import merged, spread
from partloom.queries.base import OBS, PARTS, lab_sql, observations, parts, query, rounded, table
from partloom.queries.ranking import CAND, candidates
from partloom.sources import files

_ONE = f"WITH {OBS}, {CAND}"


@query(
    "a07_fuse_palettes",
    f"""WITH {OBS}, b AS (SELECT asset_id, category, max(n) AS mx FROM (SELECT asset_id, category, view_id, count(*) AS n FROM obs GROUP BY ALL) GROUP BY ALL), s AS (SELECT asset_id, category, count(DISTINCT status || '|' || (line % 2)) AS sig FROM obs GROUP BY ALL),
m AS (SELECT obs.*, CASE WHEN mx = 1 AND sig = 1 THEN category ELSE category || ':' || view_id || ':' || status || '|' || (line % 2) END AS canonical FROM obs JOIN b USING (asset_id, category) JOIN s USING (asset_id, category))
SELECT asset_id, canonical, count(DISTINCT view_id) AS views, count(DISTINCT part_id) AS images, count(*) AS groups, min(status) AS family, count(DISTINCT view_id) >= 2 AND count(DISTINCT part_id) >= 2 AS supported FROM m GROUP BY ALL""",
)
def a07(spark, d):
    o = observations(spark, d).withColumn("finish", (F.col("line") % 2).cast("string"))
    return fusion.fuse_palettes(o, ["asset_id"], "view_id", "category", "status", "finish", "part_id")


@query(
    "a12_mass_audit",
    f"""WITH {OBS}, a AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE line <= 3 GROUP BY ALL), sa AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS a FROM a), b AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE line > 3 GROUP BY ALL), sb AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS b FROM b),
t AS (SELECT *, row_number() OVER w AS r, a - coalesce(lead(a) OVER w, 0) AS m FROM sa WINDOW w AS (PARTITION BY part_id ORDER BY round(a, 8) DESC, category)), j AS (SELECT t.*, coalesce(sb.b, 0) AS b FROM t LEFT JOIN sb USING (part_id, category) WHERE r = 1)
SELECT part_id, category AS dominant, round(a + 1e-9, 5) AS share, round(m + 1e-9, 5) AS margin, round(round(b / a, 8) + 1e-9, 5) AS recall, round(round(a - b, 8) + 1e-9, 5) AS deficit, round(a, 8) >= 0.4 AND round(m, 8) >= 0.05 AND round(b / a, 8) < 0.8 AND round(a - b, 8) >= 0.08 AS hard_failure FROM j""",
)
def a12(spark, d):
    o = observations(spark, d)
    return rounded(fusion.mass_audit(o.where("line <= 3"), o.where("line > 3"), ["part_id"], "category", "weight"), 5, 1e-9)


_ROLE = "CASE WHEN category = 'A' AND line <= 4 THEN 'target_ref' WHEN category = 'R' AND line <= 4 THEN 'anchor_ref' WHEN category = 'A' THEN 'target_ren' WHEN category = 'R' THEN 'anchor_ren' ELSE 'other' END"


@query(
    "a30_lighting_stats",
    f"""WITH {OBS}, m AS (SELECT part_id, view_id % 3 AS view_id, {_ROLE} AS role, weight FROM obs), g AS (SELECT part_id, view_id, median(weight) FILTER (role = 'target_ref') AS a, median(weight) FILTER (role = 'anchor_ref') AS b, median(weight) FILTER (role = 'target_ren') AS c, median(weight) FILTER (role = 'anchor_ren') AS e FROM m GROUP BY ALL),
r AS (SELECT *, concat_ws(',', CASE WHEN a IS NULL THEN 'no_target_ref' END, CASE WHEN b IS NULL THEN 'no_anchor_ref' END, CASE WHEN c IS NULL THEN 'no_target_ren' END, CASE WHEN e IS NULL THEN 'no_anchor_ren' END) AS reasons FROM g)
SELECT part_id, view_id, CASE WHEN reasons = '' THEN round((c / e) / (a / b) + 1e-9, 5) END AS normalised, reasons FROM r""",
)
def a30(spark, d):
    o = observations(spark, d).withColumn("view_id", F.col("view_id") % 3).withColumn("role", F.expr(_ROLE))
    return rounded(fusion.lighting_stats(o, ["part_id"], "view_id", "role", "weight"), 5, 1e-9)


@query("j11_similarity_terms")
def j11(spark, d):
    """The five best of the suppliers' profiles for every part; tested against a plain version."""
    p = color.add_colour_features(parts(spark, d), "r", "g", "b").withColumn("rough", F.col("size") / 50.0).withColumn("metal", F.when(F.col("size") % 2 == 0, 1.0).otherwise(0.0))
    k = F.col("s_suppkey")
    s = color.add_colour_features(table(spark, d, "supplier").select(k.alias("colour_id"), (k * 53 % 256).alias("r"), (k * 71 % 256).alias("g"), (k * 113 % 256).alias("b")), "r", "g", "b").withColumn("rough", (F.col("colour_id") % 10) / 10.0).withColumn("metal", F.col("colour_id") % 2 * 1.0)
    return rounded(fusion.similarity_terms(p, s, "part_id", "colour_id", True, 5), 3)


@query(
    "j19_annotate_groups",
    f"""WITH {PARTS}, g AS (SELECT DISTINCT size % 10 AS colour, CASE WHEN size % 4 = 0 THEN 'any' ELSE type END AS family, 'G' || (size % 10) || CASE WHEN size % 4 = 0 THEN 'any' ELSE type END AS grp FROM parts WHERE part_id % 6 = 0), e AS (SELECT part_id AS entity, size % 12 AS colour, type AS family FROM parts),
n AS (SELECT colour, colour AS near, 0 AS far FROM (SELECT DISTINCT colour FROM e) UNION ALL SELECT colour, colour + 1, 1 FROM (SELECT DISTINCT colour FROM e)),
m AS (SELECT entity, grp, far * 2 + CASE WHEN g.family = e.family THEN 0 ELSE 1 END AS k FROM e JOIN n USING (colour) JOIN g ON g.colour = n.near AND (g.family = e.family OR g.family = 'any')),
b AS (SELECT entity, k, count(DISTINCT grp) AS c, min(grp) AS grp FROM m GROUP BY ALL), f AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY k) AS r FROM b)
SELECT e.entity, CASE WHEN c = 1 THEN f.grp END AS "group", CASE WHEN c = 1 THEN list_extract(['exact', 'exact_wildcard', 'neighbour', 'neighbour_wildcard'], k + 1) WHEN c > 1 THEN 'ambiguous' ELSE 'none' END AS match FROM e LEFT JOIN f ON f.entity = e.entity AND r = 1""",
)
def j19(spark, d):
    p = parts(spark, d)
    family = F.when(F.col("size") % 4 == 0, "any").otherwise(F.col("type"))
    g = p.where("part_id % 6 = 0").select((F.col("size") % 10).alias("colour"), family.alias("family")).distinct().withColumn("group", F.concat(F.lit("G"), F.col("colour").cast("string"), F.col("family")))
    e = p.select(F.col("part_id").alias("entity"), (F.col("size") % 12).alias("colour"), F.col("type").alias("family"))
    near = e.select("colour").distinct().withColumn("near", F.col("colour") + 1)
    return fusion.annotate_groups(e, g, near, "colour", "family")


@query(
    "w04_shortlist",
    f"""{_ONE}, r AS (SELECT part_id, view_id, texture, concat_ws(',', CASE WHEN gate THEN 'gated' END, CASE WHEN colour < 0.3 THEN 'colour_too_low' END) AS reasons FROM cand), k AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY reasons <> '', texture DESC, view_id) AS r FROM r)
SELECT part_id, view_id, reasons, CASE WHEN reasons = '' AND r <= 3 THEN r END AS rank FROM k""",
)
def w04(spark, d):
    out = fusion.shortlist(candidates(spark, d), ["part_id"], "view_id", [("gated", F.col("gate")), ("colour_too_low", F.col("colour") < 0.3)], "texture", 3)
    return out.select("part_id", "view_id", "reasons", "rank")


@query("x03_select_palette", f"""{_ONE} SELECT part_id, view_id FROM (SELECT part_id, view_id, row_number() OVER (PARTITION BY part_id ORDER BY gate DESC, colour DESC, texture DESC, pixels DESC, view_id) AS r FROM cand) WHERE r = 1""")
def x03(spark, d):
    return fusion.select_palette(candidates(spark, d), ["part_id"], "view_id", [F.desc("gate"), F.desc("colour"), F.desc("texture"), F.desc("pixels")]).select("part_id", "view_id")


@query(
    "x04_derive_confidence",
    f"""{_ONE}, m AS (SELECT part_id, bool_or(gate) AS confirmed, count(*) AS views, max(colour) >= 0.9 AS top, max(texture) - min(texture) AS margin FROM cand GROUP BY part_id)
SELECT part_id, CASE WHEN NOT confirmed THEN 0.0::DOUBLE WHEN views >= 2 AND top AND round(margin, 8) >= 0.01 THEN 0.85::DOUBLE ELSE 0.6::DOUBLE END AS confidence FROM m""",
)
def x04(spark, d):
    m = candidates(spark, d).groupBy("part_id").agg((F.max(F.col("gate").cast("int")) == 1).alias("confirmed"), F.count(F.lit(1)).alias("views"), (F.max("colour") >= 0.9).alias("top"), (F.max("texture") - F.min("texture")).alias("margin"))
    return fusion.derive_confidence(m, ["part_id"], "confirmed", "views", "top", "margin")


@query(
    "x05_direct_match",
    f"""{_ONE} SELECT part_id, CASE WHEN round(texture, 8) <= 0.03 AND (nx IS NULL OR round(nx - texture, 8) >= 0.003) THEN view_id END AS match, texture AS error FROM (SELECT *, row_number() OVER w AS r, lead(texture) OVER w AS nx FROM cand WINDOW w AS (PARTITION BY part_id ORDER BY texture, view_id)) WHERE r = 1""",
)
def x05(spark, d):
    return fusion.direct_match(candidates(spark, d), ["part_id"], "view_id", "texture", 0.03, 0.003)


@query(
    "x06_promote_gap",
    f"""{_ONE}, w AS (SELECT *, (CASE WHEN NOT (colour >= 0.9) THEN 1 ELSE 0 END + CASE WHEN NOT (texture >= 0.06) THEN 1 ELSE 0 END) AS n, concat_ws(',', CASE WHEN NOT (colour >= 0.9) THEN 'colour' END, CASE WHEN NOT (texture >= 0.06) THEN 'texture' END) AS why FROM cand),
o AS (SELECT *, min(n) OVER (PARTITION BY part_id) AS best, row_number() OVER (PARTITION BY part_id ORDER BY n, pixels DESC, view_id) AS r FROM w) SELECT part_id, view_id AS promoted, why AS relaxed FROM o WHERE r = 1 AND best > 0""",
)
def x06(spark, d):
    c = candidates(spark, d)
    return fusion.promote_gap(c, ["part_id"], "view_id", [("colour", F.col("colour") >= 0.9), ("texture", F.col("texture") >= 0.06)], "pixels")


@query(
    "x07_extend_components",
    f"""WITH {PARTS}, {lab_sql("parts", "part_id, brand, type, size")}, s AS (SELECT * FROM lab WHERE size > 40), m AS (SELECT l.part_id, s.part_id AS component FROM lab l JOIN s ON l.brand = s.brand AND l.type = s.type AND l.size <= 40 AND sqrt(power(l.lab_l - s.lab_l, 2) + power(l.lab_a - s.lab_a, 2) + power(l.lab_b - s.lab_b, 2)) <= 50)
SELECT part_id, min(component) AS component FROM m GROUP BY part_id HAVING count(DISTINCT component) = 1""",
)
def x07(spark, d):
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    seeds = p.where("size > 40").withColumn("component", F.col("part_id"))
    return fusion.extend_components(seeds, p.where("size <= 40"), [], "brand", "type", 50.0)


@query("x08_part_view_evidence", f"""WITH {OBS}, c AS (SELECT category AS grp, view_id, max(score) AS choice FROM obs WHERE line = 1 GROUP BY ALL) SELECT part_id, category, obs.view_id, count(*) AS votes, max(choice) AS choice FROM obs JOIN c ON category = grp AND obs.view_id = c.view_id GROUP BY ALL""")
def x08(spark, d):
    o = observations(spark, d)
    choices = o.where("line = 1").groupBy("category", "view_id").agg(F.max("score").alias("choice"))
    votes = o.groupBy("part_id", "category", "view_id").agg(F.count(F.lit(1)).alias("votes"))
    return fusion.part_view_evidence(choices, votes, ["part_id", "category", "view_id"])


@query("x09_assignment_margin")
def x09(spark, d):
    """How much the best total falls when a pair is forbidden, over nations' four regions; tested against brute force."""
    n = table(spark, d, "supplier").groupBy((F.col("s_nationkey") % 3).alias("asset_id"), (F.col("s_nationkey") % 4).alias("view"), (F.col("s_suppkey") % 5).alias("pose")).agg(F.round(F.max("s_acctbal") / 10000, 6).alias("score"))
    return assembly.assignment_margin(n, "asset_id", "view", "pose", "score")


@query(
    "x10_delivery_check",
    """SELECT p_partkey AS part_id, CASE WHEN p_partkey % 13 = 0 THEN 'missing' WHEN p_partkey % 10 = 0 THEN 'changed' ELSE 'ok' END AS status FROM part""",
)
def x10(spark, d):
    """Bindings of a delivered copy against the plan: every part bound, and to the planned material."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_type").alias("material"))
    delivered = p.where("part_id % 13 <> 0").withColumn("material", F.when(F.col("part_id") % 10 == 0, F.lit("other")).otherwise(F.col("material")))
    return assembly.delivery_check(p, delivered, "part_id", "material")


@query(
    "x12_part_plan",
    f"""{_ONE}, r AS (SELECT part_id, view_id, row_number() OVER (PARTITION BY part_id ORDER BY colour DESC, view_id) AS rc, row_number() OVER (PARTITION BY part_id ORDER BY texture DESC, view_id) AS rt FROM cand),
f AS (SELECT part_id, view_id, round(0.8::DOUBLE / (60 + rc) + 1.2::DOUBLE / (60 + rt), 10) AS fused FROM r), t AS (SELECT part_id, view_id, row_number() OVER (PARTITION BY part_id ORDER BY fused DESC, view_id) AS k FROM f)
SELECT p_partkey AS part_id, view_id AS material, CASE WHEN view_id IS NULL THEN 'missing' ELSE 'covered' END AS status FROM part LEFT JOIN t ON t.part_id = p_partkey AND k = 1""",
)
def x12(spark, d):
    """Retrieval lanes, fusion, winner and exact cover of the registry: the flagship."""
    registry = table(spark, d, "part").select(F.col("p_partkey").alias("part_id"))
    return assembly.part_plan(candidates(spark, d), registry, "part_id", "view_id", {"colour": 0.8, "texture": 1.2})


@query(
    "x13_colour_plan",
    f"""{_ONE}, b AS (SELECT part_id, max(texture) AS best, min(view_id) AS v FROM cand GROUP BY part_id), k AS (SELECT c.part_id, c.texture AS base, b.best FROM cand c JOIN b ON b.part_id = c.part_id AND b.v = c.view_id)
SELECT part_id, CASE WHEN part_id % 4 = 0 THEN 'not_allowed' WHEN round(best - base, 8) >= 0.02 THEN 'recolour' ELSE 'keep' END AS action FROM k""",
)
def x13(spark, d):
    """Parts that may be recoloured: allowed, and better than their baseline by a gain."""
    c = candidates(spark, d)
    return assembly.colour_plan(c, c.groupBy("part_id").agg(F.min("view_id").alias("view_id")), "part_id", "view_id", "texture", F.col("part_id") % 4 == 0, 0.02)


@query("x14_cohort_optimize", f"WITH {PARTS}, m AS (SELECT brand, median(size) AS shared, count(*) AS members, max(size) AS hi, min(size) AS lo FROM parts GROUP BY brand) SELECT brand, members, shared, greatest(hi - shared, shared - lo) <= 24 AS exact FROM m")
def x14(spark, d):
    return fusion.cohort_optimize(parts(spark, d), ["brand"], "size", 24)


@query("x15_component_inputs", f"WITH {OBS}, {PARTS}, e AS (SELECT part_id, sum(weight) AS w FROM obs GROUP BY part_id) SELECT brand, count(*) AS members, round(median(w), 4) AS median FROM parts JOIN e USING (part_id) WHERE w >= 700 GROUP BY brand HAVING count(*) >= 2")
def x15(spark, d):
    e = observations(spark, d).groupBy("part_id").agg(F.sum("weight").alias("w"))
    return rounded(fusion.component_inputs(parts(spark, d).select("part_id", "brand"), e, ["brand"], "part_id", "w", 700), 4)


@query(
    "x16_corroborate_source",
    f"""WITH {PARTS}, a AS (SELECT part_id, brand, type, CASE WHEN part_id % 4 = 0 THEN size % 5 END AS grp FROM parts), g AS (SELECT brand, type, min(grp) AS g FROM a WHERE grp IS NOT NULL GROUP BY ALL HAVING count(DISTINCT grp) = 1), s AS (SELECT DISTINCT size % 5 AS grp FROM parts WHERE part_id % 4 = 0 AND size % 5 <> 2)
SELECT part_id, brand, type, coalesce(a.grp, g.g) AS grp, a.grp IS NULL AND g.g IS NOT NULL AS corroborated FROM a LEFT JOIN (SELECT * FROM g WHERE g.g IN (SELECT grp FROM s)) g USING (brand, type)""",
)
def x16(spark, d):
    p = parts(spark, d).select("part_id", "brand", "type", F.when(F.col("part_id") % 4 == 0, F.col("size") % 5).alias("grp"))
    return fusion.corroborate_source(p, ["brand", "type"], "grp", p.where("grp is not null and grp <> 2").select("grp").distinct())


@query(
    "x17_accept_retrieval",
    f"""{_ONE}, r AS (SELECT part_id, view_id, CASE WHEN part_id % 9 = 0 THEN k + 1 ELSE k END AS rank FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY texture DESC, view_id) AS k FROM cand) WHERE k <= 3 AND part_id % 11 <> 1),
b AS (SELECT part_id, max(rank) AS mx, count(DISTINCT rank) AS n, count(*) AS al, count(*) FILTER (WHERE view_id % 10 <> 7) AS ok FROM r GROUP BY part_id), q AS (SELECT DISTINCT part_id FROM cand WHERE part_id % 7 <> 2)
SELECT coalesce(q.part_id, b.part_id) AS part_id, CASE WHEN q.part_id IS NULL THEN 'not_requested' WHEN al IS NULL THEN 'missing' WHEN mx <> al OR n <> al THEN 'rank_gap' WHEN ok < al THEN 'not_allowed' ELSE 'ok' END AS status FROM q FULL JOIN b ON q.part_id = b.part_id""",
)
def x17(spark, d):
    c = candidates(spark, d)
    r = rank.rank_scores(c, ["part_id"], "texture", "view_id", 3).where("part_id % 11 <> 1").withColumn("rank", F.when(F.col("part_id") % 9 == 0, F.col("rank") + 1).otherwise(F.col("rank")))
    return fusion.accept_retrieval(c.where("part_id % 7 <> 2"), r, ["part_id"], "view_id", c.where("view_id % 10 <> 7"))


@query("x18_baseline_exemptions", f"WITH {OBS} SELECT part_id, category, count(*) AS rounds, bool_and(score >= 0.05) AS exempt FROM obs GROUP BY ALL")
def x18(spark, d):
    return fusion.baseline_exemptions(observations(spark, d).withColumn("kept", F.col("score") >= 0.05), ["part_id", "category"], "kept")


def boxes(spark, d):
    """A box mesh for each part: six quads over eight vertices, as long, wide and high as its keys say; every fifth lacks its last face."""
    p = spread(parts(spark, d).select("part_id", (F.col("size") + 1.0).alias("w"), (F.col("r") / 16 + 1.0).alias("h"), (F.col("g") / 16 + 1.0).alias("l")), ["part_id"], 24)
    faces = ((0, 3, 2, 1), (4, 5, 6, 7), (0, 1, 5, 4), (1, 2, 6, 5), (2, 3, 7, 6), (3, 0, 4, 7))
    corner = F.explode(F.array(*[F.struct(F.lit(f).alias("face"), F.lit(c).alias("corner"), F.lit(v).alias("vertex")) for f, q in enumerate(faces) for c, v in enumerate(q)]))
    corners = p.select("part_id", corner.alias("c")).select("part_id", "c.*").where("part_id % 5 <> 0 or face < 5")
    at = ((0, 0, 0), (1, 0, 0), (1, 1, 0), (0, 1, 0), (0, 0, 1), (1, 0, 1), (1, 1, 1), (0, 1, 1))
    point = F.explode(F.array(*[F.struct(F.lit(v).alias("vertex"), (F.lit(float(x)) * F.col("w") + F.col("part_id")).alias("x"), (F.lit(float(y)) * F.col("h")).alias("y"), (F.lit(float(z)) * F.col("l")).alias("z")) for v, (x, y, z) in enumerate(at)]))
    return corners, p.select("part_id", point.alias("p")).select("part_id", "p.*")


_DIM = f"WITH {PARTS}, b AS (SELECT part_id, size + 1.0::DOUBLE AS w, r / 16.0::DOUBLE + 1 AS h, g / 16.0::DOUBLE + 1 AS l, part_id % 5 = 0 AS open FROM parts)"


@query("g04_edge_topology", f"{_DIM} SELECT part_id, 12 AS edges, CASE WHEN open THEN 4 ELSE 0 END AS boundary, 0 AS non_manifold, 0 AS inconsistent FROM b")
def g04(spark, d):
    return mesh.edge_topology(boxes(spark, d)[0], ["part_id"])


@query("g05_mesh_metrics", f"{_DIM} SELECT part_id, CASE WHEN open THEN 5 ELSE 6 END AS faces, 0 AS triangles, CASE WHEN open THEN 5 ELSE 6 END AS quads, 0 AS ngons, round(2 * (w * h + w * l + h * l) - CASE WHEN open THEN h * l ELSE 0 END, 4) AS area, 8 AS vertices, round(sqrt(w * w + h * h + l * l), 4) AS diagonal FROM b")
def g05(spark, d):
    return rounded(mesh.mesh_metrics(*boxes(spark, d), ["part_id"]), 4)


@query(
    "g06_region_metrics",
    f"""{_DIM}, f(region, d, e, f, x, y, z, nx, ny, nz) AS (VALUES (0, 'w', 'h', 0, 0.5, 0.5, 0, 0, 0, -1), (1, 'w', 'h', 0, 0.5, 0.5, 1, 0, 0, 1), (2, 'w', 'l', 0, 0.5, 0, 0.5, 0, -1, 0), (3, 'h', 'l', 0, 1, 0.5, 0.5, 1, 0, 0), (4, 'w', 'l', 0, 0.5, 1, 0.5, 0, 1, 0), (5, 'h', 'l', 0, 0, 0.5, 0.5, -1, 0, 0))
SELECT part_id, region, 1 AS faces, round(CASE d WHEN 'w' THEN w ELSE h END * CASE e WHEN 'h' THEN h ELSE l END, 4) AS area, round(part_id + w * CAST(x AS DOUBLE), 4) AS cx, round(h * CAST(y AS DOUBLE), 4) AS cy, round(l * CAST(z AS DOUBLE), 4) AS cz, CAST(nx AS DOUBLE) AS nx, CAST(ny AS DOUBLE) AS ny, CAST(nz AS DOUBLE) AS nz,
  0.0::DOUBLE AS deviation, CASE WHEN NOT open THEN 0 WHEN region = 3 THEN 0 ELSE 1 END AS boundary FROM b, f WHERE NOT open OR region < 5""",
)
def g06(spark, d):
    """Every face of the boxes is a region of its own."""
    c, p = boxes(spark, d)
    t = mesh.triangles(c, p, ["part_id"])
    return rounded(mesh.region_metrics(t, c.select("part_id", "face", F.col("face").alias("region")).distinct(), ["part_id"], c), 4)


@query("g07_signed_volume", f"{_DIM} SELECT part_id, round(w * h * l, 3) AS volume, true AS outward FROM b WHERE NOT open")
def g07(spark, d):
    c, p = boxes(spark, d)
    out = mesh.signed_volume(mesh.triangles(c.where("part_id % 5 <> 0"), p, ["part_id"]), ["part_id"])
    return rounded(out, 3)


@query("g09_geometry_digest", f"{_DIM}, k AS (SELECT round(w, 6) AS w, round(h, 6) AS h, round(l, 6) AS l, open, count(*) AS members FROM b GROUP BY ALL) SELECT members, count(*) AS digests FROM k GROUP BY members")
def g09(spark, d):
    """How many digests stand for how many parts: boxes of equal size, wherever they stand."""
    c, p = boxes(spark, d)
    return mesh.geometry_digest(p, c, ["part_id"]).groupBy("digest").agg(F.count(F.lit(1)).alias("members")).groupBy("members").agg(F.count(F.lit(1)).alias("digests"))


@query("g03_coherent_regions")
def g03(spark, d):
    """Faces of the boxes by normals: six regions a box; tested in the unit tests."""
    c, p = boxes(spark, d)
    t = mesh.with_area(mesh.triangles(c, p, ["part_id"])).where("area > 0")
    faces = t.groupBy("part_id", F.col("face").cast("long").alias("face")).agg(*[(F.sum(f"n{x}") / F.sum(F.col("area") * 2)).alias(f"n{x}") for x in "xyz"])
    e = mesh.directed_edges(c, ["part_id"]).select("part_id", F.col("face").cast("long").alias("face"), F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    adjacency = e.withColumnRenamed("face", "a").join(merged(e.withColumnRenamed("face", "b")), ["part_id", "lo", "hi"]).where("a < b").select("part_id", "a", "b")
    return graph.coherent_regions(faces, adjacency, ["part_id"], 0.5)


@query("g10_uv_overlap")
def g10(spark, d):
    """Two UV triangles for each part; tested against brute force."""
    p = parts(spark, d)
    u = lambda c, m: (F.col(c) % m) / float(m)
    one = p.select("part_id", u("r", 64).alias("u0"), u("g", 64).alias("v0"), u("b", 64).alias("u1"), u("r", 50).alias("v1"), u("g", 50).alias("u2"), u("b", 50).alias("v2"))
    two = p.select("part_id", u("b", 90).alias("u0"), u("r", 90).alias("v0"), u("g", 90).alias("u1"), u("b", 70).alias("v1"), u("r", 70).alias("u2"), (F.col("size") / 40.0).alias("v2"))
    return rounded(mesh.uv_overlap(one.unionByName(two), ["part_id"], 16))


@query("g15_fit_similarity")
def g15(spark, d):
    """A known turn and scale of each region's nations, one of them moved away; tested in the unit tests."""
    n = table(spark, d, "nation").select(F.col("n_regionkey").alias("view"), F.col("n_nationkey").alias("id"), (F.col("n_nationkey") * 7 % 11).cast("double").alias("x"), (F.col("n_nationkey") * 5 % 13).cast("double").alias("y"))
    bad = F.when(F.col("id") < 5, 3.0).otherwise(0.0)
    return rounded(fusion.fit_similarity(n.select("*", (-2 * F.col("y") + 1 + bad).alias("u"), (2 * F.col("x") - 3).alias("v"), F.lit(1.0).alias("w")), ["view"], 0.01))


_MODULE = """/* export material hidden() = 1; */
export material steel_{k}(*) [[ anno::display_name("Steel {k}"), anno::description("Plain"), anno::key_words(string[]("metal", "grey")) ]] = base(color(0.{k}f, 0.5f, 0.25f), roughness: 0.{k}f, metallic: 1.0f);
export material paint_{k}(*) [[ anno::display_name("Paint {k}") ]] = base(color(0.9f, 0.1f, 0.{k}f), roughness: 0.4f, texture_2d("a.png"));
"""


def modules(spark, d):
    k = (F.col("p_partkey") % 9 + 1).cast("string")
    return table(spark, d, "part").select(F.concat(F.lit("lib/"), F.col("p_partkey").cast("string"), F.lit(".mdl")).alias("path"), F.regexp_replace(F.lit(_MODULE), r"\{k\}", k).alias("text"))


@query("s04_scan_library", """SELECT 'lib/' || p_partkey || '.mdl' AS path, n || '_' || (p_partkey % 9 + 1) AS name, CASE n WHEN 'steel' THEN 'Steel ' ELSE 'Paint ' END || (p_partkey % 9 + 1) AS display_name, CASE n WHEN 'steel' THEN 'Plain' END AS description, CASE n WHEN 'steel' THEN 'grey,metal' ELSE '' END AS keywords FROM part, (VALUES ('steel'), ('paint')) t(n)""")
def s04(spark, d):
    return files.scan_library(modules(spark, d)).drop("material_id")


@query("s05_extract_profiles", """SELECT 'lib/' || p_partkey || '.mdl' AS path, CAST('0.' || (p_partkey % 9 + 1) AS DOUBLE) AS r, 0.5::DOUBLE AS g, 0.25::DOUBLE AS b, CAST('0.' || (p_partkey % 9 + 1) AS DOUBLE) AS roughness, 1.0::DOUBLE AS metallic, true AS textured FROM part""")
def s05(spark, d):
    return files.extract_profiles(modules(spark, d), "text").drop("text")


@query("s08_pixel_table", """SELECT p_partkey AS image, x, y, (97 + (p_partkey + y * 4 + x * 2 + 2) % 26) AS r, (97 + (p_partkey + y * 4 + x * 2 + 1) % 26) AS g, (97 + (p_partkey + y * 4 + x * 2) % 26) AS b FROM part, range(2) t1(x), range(2) t2(y)""")
def s08(spark, d):
    """Decoded 2 x 2 images whose bytes are letters that follow from the part's number."""
    k = F.col("p_partkey")
    at = [k + y * 4 + x * 2 + c for y in (0, 1) for x in (0, 1) for c in (0, 1, 2)]
    data = F.concat(*[F.char(97 + a % 26) for a in at]).cast("binary")
    images = table(spark, d, "part").select(k.alias("image"), F.lit(2).alias("width"), F.lit(2).alias("height"), F.lit(3).alias("channels"), data.alias("data"))
    return files.pixel_table(images)
