"""Rules that decide between near cases: composite colour scores, slots, rounds, rule parameters, stops and components."""

from __future__ import annotations

from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import fusion, gates, graph, joins, mesh, rank, spatial, stats
from partloom.operators import pixels as px
from partloom.operators.spread import merged, spread
from partloom.plans import rules
from partloom.queries.base import OBS, PARTS, observations, parts, query, rounded, table
from partloom.queries.images import grid
from partloom.queries.ranking import CAND, LANES, candidates, lanes
from partloom.queries.second import boxes
from partloom.queries.voting import HSV


def coloured(spark, d):
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    return p.select("part_id", "brand", "colour", "size", *[F.col(f"hsv.{c}").alias(c) for c in "hsv"])


_SIDES = f"""WITH {PARTS}, {HSV}, c AS (SELECT col.*, size AS n FROM col JOIN parts USING (part_id)), x AS (SELECT *, part_id % 2 = 0 AS ref FROM c)"""


@query(
    "a09_colour_profile",
    f"""{_SIDES}, cov AS (SELECT brand, sum(CASE WHEN s >= 0.18 AND v >= 0.12 THEN n ELSE 0 END) / sum(n)::DOUBLE AS chromatic FROM x GROUP BY brand),
rs AS (SELECT brand, s, sum(sum(n)) OVER (PARTITION BY brand ORDER BY s) AS run, sum(sum(n)) OVER (PARTITION BY brand) AS tot FROM x GROUP BY brand, s), ms AS (SELECT brand, min(s) AS saturation FROM rs WHERE run >= tot / 2 GROUP BY brand),
rv AS (SELECT brand, v, sum(sum(n)) OVER (PARTITION BY brand ORDER BY v) AS run, sum(sum(n)) OVER (PARTITION BY brand) AS tot FROM x GROUP BY brand, v), mv AS (SELECT brand, min(v) AS value FROM rv WHERE run >= tot / 2 GROUP BY brand),
t AS (SELECT brand, colour, row_number() OVER (PARTITION BY brand ORDER BY sum(n) DESC, colour) AS r FROM x GROUP BY brand, colour)
SELECT brand, round(chromatic, 5) AS chromatic, round(saturation, 5) AS saturation, round(value, 5) AS value, (SELECT string_agg(colour, ',' ORDER BY r) FROM t WHERE t.brand = cov.brand AND r <= 4) AS top FROM cov JOIN ms USING (brand) JOIN mv USING (brand)""",
)
def a09b(spark, d):
    out = stats.colour_distribution(coloured(spark, d), ["brand"], "colour", "size")
    return rounded(out.withColumn("top", F.array_join(F.transform("top", lambda t: t["name"]), ",")), 5)


@query("a09_hue_bins", f"{_SIDES} SELECT brand, CAST(floor(h * 12) AS BIGINT) % 12 AS bin, CAST(sum(n) AS BIGINT) AS size FROM x WHERE s >= 0.18 AND v >= 0.12 GROUP BY ALL")
def a09c(spark, d):
    return stats.hue_bins(coloured(spark, d), ["brand"], "size")


@query("a10_colour_score")
def a10b(spark, d):
    """Colours of the parts with even keys against those with odd keys, by brand; the composite is tested against a plain version."""
    c = coloured(spark, d)
    return rounded(stats.colour_score(c.where("part_id % 2 = 0"), c.where("part_id % 2 = 1"), ["brand"], "colour", "size"), 5)


@query(
    "a11_required_share",
    f"""WITH {OBS}, sa AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE line <= 3 GROUP BY ALL), ta AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS a FROM sa),
sb AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE line > 3 GROUP BY ALL), tb AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS b FROM sb),
se AS (SELECT part_id, category, sum(weight) AS n FROM obs WHERE status = 'F' GROUP BY ALL), te AS (SELECT part_id, category, n / sum(n) OVER (PARTITION BY part_id) AS e FROM se),
r AS (SELECT part_id, least(1.0, coalesce(b, 0) / least(0.95, greatest(0.001, 0.5 * least(a, coalesce(e, 0))))) AS r FROM ta LEFT JOIN tb USING (part_id, category) LEFT JOIN te USING (part_id, category))
SELECT part_id, count(*) AS bins, round(avg(r), 5) AS macro, round(min(r), 5) AS minimum FROM r GROUP BY part_id""",
)
def a11b(spark, d):
    """A bin needs half of its share in the reference or in the evidence (here: of finished lines), whichever is smaller."""
    o = observations(spark, d)
    return rounded(stats.group_recall(o.where("line <= 3"), o.where("line > 3"), ["part_id"], "category", "weight", o.where("status = 'F'")), 5)


@query(
    "a07_painted_split",
    f"""WITH {OBS}, g AS (SELECT *, status || '|' || (line % 2) AS sig, category = 'R' AS seen_only FROM obs), b AS (SELECT asset_id, category, max(n) AS mx FROM (SELECT asset_id, category, view_id, count(*) AS n FROM g GROUP BY ALL) GROUP BY ALL),
c AS (SELECT asset_id, category, sig, count(*) AS n, bool_and(status = 'O') AS p FROM g GROUP BY ALL), s AS (SELECT asset_id, category, count(*) AS sigs, sum((n = 1)::INT) AS singles, bool_and(p) AS painted FROM c GROUP BY ALL),
m AS (SELECT g.*, CASE WHEN mx = 1 AND (sigs = 1 OR (sigs = 2 AND singles = 1 AND painted AND c.n > 1)) THEN category ELSE category || ':' || view_id || ':' || sig END AS canonical FROM g JOIN b USING (asset_id, category) JOIN s USING (asset_id, category) JOIN c USING (asset_id, category, sig))
SELECT asset_id, canonical, count(DISTINCT view_id) AS views, count(DISTINCT part_id) AS images, count(*) AS groups, min(status) AS family, count(DISTINCT view_id) >= 2 AND CASE WHEN bool_and(seen_only) THEN count(DISTINCT part_id) >= count(DISTINCT view_id) ELSE count(DISTINCT part_id) >= 2 END AS supported FROM m GROUP BY ALL""",
)
def a07b(spark, d):
    o = observations(spark, d).withColumn("finish", (F.col("line") % 2).cast("string")).withColumn("only", F.col("category") == "R")
    return fusion.fuse_palettes(o, ["asset_id"], "view_id", "category", "status", "finish", "part_id", ["O"], "only")


@query(
    "a08_metallic",
    f"""WITH {OBS}, k AS (SELECT part_id, count(DISTINCT view_id) AS views, min(status) AS lo, max(status) AS hi FROM obs GROUP BY part_id), p AS (SELECT part_id, view_id, median(tax) AS tax FROM obs GROUP BY ALL), m AS (SELECT part_id, median(tax) AS tax FROM p GROUP BY part_id)
SELECT part_id, views, round(tax, 6) AS tax, CASE WHEN lo = hi THEN CASE WHEN lo = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS metallic FROM k JOIN m USING (part_id)""",
)
def a08b(spark, d):
    """One class of conductive observations suggests 1, one of others 0, never the measured value."""
    return gates.fuse_evidence(spread(observations(spark, d), ["part_id"]), ["part_id"], ["tax"], "status", "view_id", 0.3333, conductive=F.col("status") == "F").select("part_id", "views", F.round("tax", 6).alias("tax"), "metallic")


@query("a31_gain_stops")
def a31b(spark, d):
    """Gains with all stops; tested on histories written out."""
    e = table(spark, d, "events").select("user_id", "event_id", (0.5 + F.col("value") / 200).alias("gain"), ((F.col("value") % 50) / 50 - 0.5).alias("err"))
    return rounded(gates.next_gain(e, ["user_id"], "event_id", "gain", "err", least_gain=0.01, patience=3, least_step=0.01, known=0.001))


@query("a33_appearance_components")
def a33b(spark, d):
    """Parts of one brand and colour as components, with their anchors, families and median colours; tested on parts written out."""
    p = color.add_colour_features(parts(spark, d), "r", "g", "b").withColumn("pixels", F.col("size") * 20)
    linked = p.groupBy("brand", "colour").agg(F.min("part_id").alias("component"))
    members = p.join(linked, ["brand", "colour"]).select("brand", "part_id", "component")
    return rounded(gates.appearance_components(members, p, ["brand"], "part_id", "type", "price", "pixels"), 4)


_GLOBS = [
    {"glob": "*/PROMO/*", "density": 7.8, "friction": 0.4, "material": "steel"},
    {"regex": "BOLT|rod$", "density": 2.7, "material": "alloy"},
    {"glob": "Brand#1?/*", "regex": "^cold", "friction": 0.1},
    {"regex": "widget", "friction": 0.3},
]
_PRESETS = {"steel": {"density": 7.85, "friction": 0.5}, "alloy": {"friction": 0.35}, "ice": {"density": 0.9, "friction": 0.05}}


@query(
    "p06_rule_parameters",
    f"""WITH {PARTS}, q AS (SELECT part_id, name, brand || '/' || type || '/' || part_id AS path, CASE WHEN size % 7 = 0 THEN 'ice' END AS material, CASE WHEN size % 5 = 0 THEN 'alloy' END AS tag FROM parts),
r AS (SELECT *, CASE WHEN path LIKE '%/PROMO/%' THEN 0 WHEN regexp_matches(name, 'BOLT|rod$', 'i') THEN 1 WHEN path LIKE 'Brand#1_/%' OR regexp_matches(name, '^cold', 'i') THEN 2 WHEN regexp_matches(name, 'widget', 'i') THEN 3 END AS rule FROM q),
t AS (SELECT *, CASE rule WHEN 0 THEN 'steel' WHEN 1 THEN 'alloy' ELSE tag END AS own FROM r)
SELECT part_id, rule, CAST(coalesce(CASE WHEN material = 'ice' THEN 0.9 END, CASE rule WHEN 0 THEN 7.8 WHEN 1 THEN 2.7 END, CASE own WHEN 'steel' THEN 7.85 END) AS DOUBLE) AS density,
  CAST(coalesce(CASE WHEN material = 'ice' THEN 0.05 END, CASE rule WHEN 0 THEN 0.4 WHEN 2 THEN 0.1 WHEN 3 THEN 0.3 END, CASE own WHEN 'steel' THEN 0.5 WHEN 'alloy' THEN 0.35 END) AS DOUBLE) AS friction FROM t""",
)
def p06b(spark, d):
    """First rule by path or name; the row's own material overrides its values, the rule's material fills gaps."""
    p = parts(spark, d).select("part_id", "name", F.concat_ws("/", "brand", "type", F.col("part_id").cast("string")).alias("path"), F.when(F.col("size") % 7 == 0, "ice").alias("material"), F.when(F.col("size") % 5 == 0, "alloy").alias("tag"))
    return rules.rule_parameters(p, "path", "name", "material", "tag", _GLOBS, _PRESETS, ["density", "friction"]).select("part_id", "rule", "density", "friction")


@query(
    "w07_lane_slots",
    f"""WITH {OBS}, {CAND}, {LANES}, t AS (SELECT part_id, view_id, lane, rank, row_number() OVER (PARTITION BY part_id, lane ORDER BY rank, view_id) AS round FROM lanes),
o AS (SELECT *, CASE WHEN round = 1 THEN list_position(['texture', 'colour', 'pixels'], lane) ELSE list_position(['colour', 'texture', 'pixels'], lane) END AS n FROM t)
SELECT part_id, view_id, lane, rank, round, slot FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY round, n, view_id) AS slot FROM o) WHERE slot <= 8""",
)
def w07c(spark, d):
    return rank.lane_slots(lanes(spark, d), ["part_id"], "view_id", "lane", 8, ["texture", "colour", "pixels"], ["colour", "texture", "pixels"])


@query(
    "w10_group_round",
    f"""WITH {OBS}, {CAND}, c AS (SELECT *, view_id % 6 = 0 AS base, pixels >= 10 AS comparable, texture >= 0.03 AS whole FROM cand), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY view_id) AS k FROM c WHERE base) WHERE k = 1),
t AS (SELECT *, row_number() OVER w AS r, lead(colour) OVER w AS nx FROM c WINDOW w AS (PARTITION BY part_id ORDER BY colour DESC, view_id)),
u AS (SELECT t.part_id, t.view_id, b.view_id AS base_id, CASE WHEN b.view_id IS NULL OR NOT b.comparable THEN 'baseline_not_comparable' WHEN t.view_id = b.view_id THEN 'baseline_best' WHEN t.whole AND NOT b.whole THEN 'all_views_pass'
  WHEN t.colour - b.colour < 0.05 - 1e-12 THEN 'gain_too_small' WHEN nx IS NOT NULL AND t.colour - nx < 0.015 - 1e-12 THEN 'margin_too_small' ELSE 'improved' END AS reason FROM t LEFT JOIN b USING (part_id) WHERE r = 1)
SELECT part_id, reason, CASE WHEN reason IN ('all_views_pass', 'improved') THEN view_id ELSE base_id END AS selected FROM u""",
)
def w10b(spark, d):
    c = candidates(spark, d).withColumns({"base": F.col("view_id") % 6 == 0, "comparable": F.col("pixels") >= 10, "whole": F.col("texture") >= 0.03})
    return rank.group_round(c, ["part_id"], "view_id", "colour", "base", "comparable", "whole", 0.05, 0.015)


@query("g04_loose_and_pieces", f"WITH {PARTS} SELECT part_id, CASE WHEN size % 3 = 0 THEN 1 ELSE 0 END AS loose, 1 AS components FROM parts")
def g04b(spark, d):
    """Points that no face uses (every third box has one more) and pieces of the boxes."""
    corners, points = boxes(spark, d)
    more = parts(spark, d).where("size % 3 = 0").select("part_id", F.lit(99).alias("vertex"), *[F.lit(0.0).alias(c) for c in "xyz"])
    return mesh.loose_vertices(corners, points.unionByName(more), ["part_id"]).join(merged(mesh.face_components(corners, ["part_id"])), "part_id")


@query(
    "g12_up_axis",
    f"""WITH {PARTS}, b AS (SELECT part_id, brand, r * 1.0::DOUBLE AS lo, r * 1.0::DOUBLE + size AS hi, g * 1.0::DOUBLE AS width, CAST(replace(brand, 'Brand#', '') AS BIGINT) % 2 = 0 AS leans FROM parts), w AS (SELECT *, max(hi) OVER p - min(lo) OVER p AS h, min(lo) OVER p AS base, max(width) OVER p AS mw FROM b WINDOW p AS (PARTITION BY brand))
SELECT part_id, brand, CASE WHEN NOT leans THEN lo - base <= 0.2 * h AND hi - lo <= 0.2 * h AND width >= 0.3 * mw END AS ground, CASE WHEN leans THEN 'up_axis_not_aligned' ELSE 'checked' END AS state FROM w""",
)
def g12b(spark, d):
    """Assets whose up vector leans are skipped with a state."""
    leans = F.regexp_replace("brand", "Brand#", "").cast("long") % 2 == 0
    p = parts(spark, d).select("part_id", "brand", F.col("r").cast("double").alias("lo"), (F.col("r") * 1.0 + F.col("size")).alias("hi"), F.col("g").cast("double").alias("width"), F.lit(0.05).alias("ux"), F.when(leans, 0.7).otherwise(0.02).alias("uy"), F.when(leans, 0.71).otherwise(-0.99).alias("uz"))
    return mesh.ground_contact(p.withColumn("up", mesh.up_axis("ux", "uy", "uz")), ["brand"], "lo", "hi", "width", near=0.2, up="up").select("part_id", "brand", "ground", "state")


@query(
    "g13_propagation_vetoes",
    f"""WITH {PARTS}, a AS (SELECT part_id, brand, type, CASE WHEN part_id % 9 = 0 THEN size % 2 END AS material, CASE WHEN size % 4 = 0 THEN 'p' END AS params, part_id % 63 = 0 AS faces FROM parts),
k AS (SELECT brand, type, count(DISTINCT material) AS n, min(material) AS m, count(DISTINCT CASE WHEN material IS NOT NULL THEN coalesce(params, '') END) AS ps, bool_or(faces) FILTER (material IS NOT NULL) AS fs FROM a GROUP BY ALL),
s AS (SELECT a.*, m, CASE WHEN material IS NOT NULL THEN 'own' WHEN n > 1 THEN 'conflict' WHEN ps > 1 THEN 'parameters_differ' WHEN fs THEN 'face_subsets' WHEN n = 1 THEN 'propagated' ELSE 'none' END AS source FROM a JOIN k USING (brand, type))
SELECT part_id, brand, type, CASE WHEN source = 'own' THEN material WHEN source = 'propagated' THEN m END AS material, source FROM s""",
)
def g13b(spark, d):
    """Nothing goes from members whose parameters differ, nor from members assigned by face subsets."""
    k = F.col("part_id")
    p = parts(spark, d).select("part_id", "brand", "type", F.when(k % 9 == 0, F.col("size") % 2).alias("material"), F.when(F.col("size") % 4 == 0, "p").alias("params"), (k % 63 == 0).alias("faces"))
    return graph.propagate(p, ["brand", "type"], "material", "params", "faces").select("part_id", "brand", "type", "material", "source")


_PLACES = f"WITH {PARTS}, a AS (SELECT brand, part_id AS id, r::DOUBLE AS x, g::DOUBLE AS y FROM parts WHERE part_id % 2 = 0), b AS (SELECT brand, part_id AS id, r::DOUBLE AS x, g::DOUBLE AS y FROM parts WHERE part_id % 2 = 1)"


def places(spark, d):
    p = parts(spark, d).select("brand", F.col("part_id").alias("id"), F.col("r").cast("double").alias("x"), F.col("g").cast("double").alias("y"))
    return p.where("id % 2 = 0"), p.where("id % 2 = 1")


@query(
    "j12_point_distances",
    f"""{_PLACES}, m AS (SELECT a.brand, a.id, min(round(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)), 6)) AS d FROM a LEFT JOIN b ON a.brand = b.brand AND round(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)), 6) <= 20 GROUP BY ALL)
SELECT brand, count(d) AS matched, count(*) - count(d) AS unmatched, round(avg(d), 5) AS mean, round(sqrt(avg(d * d)), 5) AS rms, round(max(d), 5) AS largest FROM m GROUP BY brand""",
)
def j12b(spark, d):
    """How far the parts with even keys are from those with odd keys of their brand."""
    return rounded(joins.point_distances(*places(spark, d), ["brand"], ["x", "y"], 20.0), 5)


@query(
    "j12_weld_points",
    f"""{_PLACES.replace("WITH", "WITH RECURSIVE", 1)}, u AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY id) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b)),
w AS (SELECT DISTINCT brand, 0::BIGINT AS n, []::STRUCT(id BIGINT, x DOUBLE, y DOUBLE)[] AS reps FROM u UNION ALL SELECT w.brand, u.n,
  CASE WHEN len(list_filter(reps, lambda q: sqrt(power(q.x - u.x, 2) + power(q.y - u.y, 2)) <= 8)) > 0 THEN reps ELSE list_append(reps, {{'id': u.id, 'x': u.x, 'y': u.y}}) END FROM w JOIN u ON u.brand = w.brand AND u.n = w.n + 1),
r AS (SELECT brand, unnest(arg_max(reps, n)) AS q FROM w GROUP BY brand)
SELECT u.brand, u.id, min(r.q.id) AS welded FROM u JOIN r ON r.brand = u.brand AND r.q.id <= u.id AND sqrt(power(r.q.x - u.x, 2) + power(r.q.y - u.y, 2)) <= 8 GROUP BY u.brand, u.id""",
)
def j12c(spark, d):
    """Parts of a brand within 8 of an earlier representative are one; the SQL takes them one after another."""
    a, b = places(spark, d)
    return spatial.weld_points(a.unionByName(b), ["brand"], ["x", "y"], 8.0)


_SEGMENT = lambda a, b: f"(SELECT power(p1 - {a}1 - t * ({b}1 - {a}1), 2) + power(p2 - {a}2 - t * ({b}2 - {a}2), 2) + power(p3 - {a}3 - t * ({b}3 - {a}3), 2) FROM (SELECT greatest(0, least(1, ((p1 - {a}1) * ({b}1 - {a}1) + (p2 - {a}2) * ({b}2 - {a}2) + (p3 - {a}3) * ({b}3 - {a}3)) / (power({b}1 - {a}1, 2) + power({b}2 - {a}2, 2) + power({b}3 - {a}3, 2)))) AS t))"
_PRODUCT = lambda a, b, c, d: " + ".join(f"({a}{i} - {b}{i}) * ({c}{i} - {d}{i})" for i in (1, 2, 3))


@query(
    "j12_nearest_surface",
    f"""WITH {PARTS}, tri AS (SELECT brand, part_id AS triangle, r::DOUBLE AS a1, g::DOUBLE AS a2, b::DOUBLE AS a3, r + size::DOUBLE AS b1, g + 1.0::DOUBLE AS b2, b::DOUBLE AS b3, r::DOUBLE AS c1, g + size::DOUBLE AS c2, b + 2.0::DOUBLE AS c3 FROM parts),
pt AS (SELECT brand, l_orderkey * 10 + l_linenumber AS id, (l_orderkey * 17 % 300)::DOUBLE AS p1, (l_suppkey * 29 % 300)::DOUBLE AS p2, (l_partkey * 7 % 300)::DOUBLE AS p3 FROM lineitem JOIN parts ON part_id = l_partkey),
pairs AS (SELECT pt.*, tri.* EXCLUDE (brand), {_PRODUCT("b", "a", "b", "a")} AS d00, {_PRODUCT("b", "a", "c", "a")} AS d01, {_PRODUCT("c", "a", "c", "a")} AS d11, {_PRODUCT("p", "a", "b", "a")} AS d20, {_PRODUCT("p", "a", "c", "a")} AS d21 FROM pt JOIN tri ON tri.brand = pt.brand),
s AS (SELECT *, (d11 * d20 - d01 * d21) / (d00 * d11 - d01 * d01) AS v, (d00 * d21 - d01 * d20) / (d00 * d11 - d01 * d01) AS w FROM pairs),
near AS (SELECT brand, id, sqrt(min(least({_SEGMENT("a", "b")}, {_SEGMENT("b", "c")}, {_SEGMENT("a", "c")},
  CASE WHEN v >= 0 AND w >= 0 AND v + w <= 1 THEN {" + ".join(f"power(p{i} - a{i} - v * (b{i} - a{i}) - w * (c{i} - a{i}), 2)" for i in (1, 2, 3))} ELSE 1e18 END))) AS d FROM s GROUP BY brand, id)
SELECT brand, count(*) AS samples, round(avg(d), 4) AS mean, round(sqrt(avg(d * d)), 4) AS rms, round(max(d), 4) AS largest FROM near GROUP BY brand""",
)
def j12d(spark, d):
    """How far places of observations are from the triangles of their brand."""
    p = parts(spark, d)
    at = lambda c, more=0: (F.col(c) + more).cast("double")
    tri = p.select("brand", F.col("part_id").alias("triangle"), at("r").alias("ax"), at("g").alias("ay"), at("b").alias("az"), at("r", F.col("size")).alias("bx"), at("g", 1).alias("by"), at("b").alias("bz"), at("r").alias("cx"), at("g", F.col("size")).alias("cy"), at("b", 2).alias("cz"))
    li = table(spark, d, "lineitem").join(p.select(F.col("part_id").alias("l_partkey"), "brand"), "l_partkey")
    pt = li.select("brand", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_orderkey") * 17 % 300).cast("double").alias("x"), (F.col("l_suppkey") * 29 % 300).cast("double").alias("y"), (F.col("l_partkey") * 7 % 300).cast("double").alias("z"))
    return rounded(spatial.surface_distances(pt, tri, ["brand"]), 4)


@query("a14_silhouette_score")
def a14c(spark, d):
    """The four terms of two masks and their weighted sum; tested on masks written out."""
    return rounded(px.silhouette_score(grid(spark, d), ["image"], "a", "other"))


@query("a18_largest_blobs")
def a18b(spark, d):
    """The largest connected piece of matching pixels in a box; tested on pixels written out."""
    g = grid(spark, d)
    found = g.select("image").distinct().select("image", F.lit(1).alias("x0"), F.lit(1).alias("y0"), F.lit(11).alias("x1"), F.lit(11).alias("y1"))
    return rounded(px.largest_blobs(found, g, "image", F.col("a") & (F.col("r") < 128)))


@query("a19_recover_kinds")
def a19b(spark, d):
    """Regions of one kind that no known box holds; tested on pixels written out."""
    g = grid(spark, d).withColumn("hsv", color.hsv(F.col("r") / 255.0, F.col("g") / 255.0, F.col("b") / 255.0)).select("image", "x", "y", *[F.col(f"hsv.{c}").alias(c) for c in "hsv"])
    known = g.select("image").distinct().select("image", F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.lit(6).alias("x1"), F.lit(6).alias("y1"))
    return px.recover_regions(g.withColumn("kind", px.region_kind("h", "s", "v")), known, "image", "kind", 6)
