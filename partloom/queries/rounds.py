"""Queries of operators that work in rounds, keep state, or search: group tournaments, tails on streams, aliases inside texts, proximity, robust fits, textures and assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import assembly, fusion, joins, rank
from partloom.operators import pixels as px
from partloom.operators.graph import scratch
from partloom.operators.spread import spread
from partloom.plans import rules
from partloom.queries.base import OBS, PARTS, lab_sql, observations, parts, query, rounded, table
from partloom.queries.images import grid
from partloom.streaming import progress


@query("t04_log_tail_stream", "SELECT user_id AS job, event_id AS seq, event_type AS line, from_end FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS from_end FROM events) WHERE from_end <= 20")
def t04_stream(spark, d):
    """The tail of every job once a stream has read all events: the last trigger's tail of each."""
    path = f"{d}/event[s].parquet"  # as a pattern, a stream reads a single file, too
    events = spark.readStream.schema(table(spark, d, "events").schema).parquet(path)
    lines = events.select(F.col("user_id").alias("job"), F.col("event_id").alias("seq"), F.col("event_type").alias("line"))
    folder = scratch(table(spark, d, "events"))
    tails = progress.log_tail_stream(lines, 20, ttl_ms=0)
    tails.writeStream.format("parquet").option("path", f"{folder}/tails").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.schema(tails.schema).parquet(f"{folder}/tails")
    last = seen.groupBy("job").agg(F.max("seen").alias("seen"))
    return seen.join(last, ["job", "seen"]).drop("seen")


#: Groups, and so turns, of an order.
_TURNS = 4
_OFFERS = f"""{OBS}, grp AS (SELECT asset_id, line % {_TURNS} AS line, min(view_id) AS view_id, min(part_id) AS part_id, sum(weight) AS weight FROM obs GROUP BY ALL),
offers AS (SELECT asset_id, line, j, (view_id + j * 7) % 10 AS material, (part_id * 31 + j * 17) % 100 AS score FROM grp, (SELECT unnest(range(3))::BIGINT AS j))"""


def _turn(n: int) -> str:
    return f"""now{n} AS (SELECT asset_id, line FROM queue WHERE turn = {n}),
made{n} AS MATERIALIZED (SELECT q.asset_id, q.line, c.material FROM plan{n - 1} q JOIN offers c ON c.asset_id = q.asset_id AND c.line = q.line AND c.j = q.j),
trial{n} AS MATERIALIZED (SELECT o.asset_id, o.line, o.j, o.j = p.j AS base, o.score + 5 * count(m.line) AS s
  FROM offers o JOIN now{n} n USING (asset_id, line) JOIN plan{n - 1} p ON p.asset_id = o.asset_id AND p.line = o.line LEFT JOIN made{n} m ON m.asset_id = o.asset_id AND m.line <> o.line AND m.material = o.material GROUP BY o.asset_id, o.line, o.j, p.j, o.score),
step{n} AS (SELECT asset_id, line, CASE WHEN list_sort(list({{'s': -s, 'j': j}}))[1].j <> any_value(j) FILTER (base) AND max(s) - any_value(s) FILTER (base) >= 3 AND list_sort(list(-s))[2] + max(s) >= 2 THEN list_sort(list({{'s': -s, 'j': j}}))[1].j ELSE any_value(j) FILTER (base) END AS j FROM trial{n} GROUP BY asset_id, line),
plan{n} AS MATERIALIZED (SELECT p.asset_id, p.line, coalesce(s.j, p.j) AS j FROM plan{n - 1} p LEFT JOIN step{n} s USING (asset_id, line))"""


@query(
    "w10_group_tournament",
    f"""WITH {_OFFERS}, queue AS (SELECT asset_id, line, row_number() OVER (PARTITION BY asset_id ORDER BY weight DESC, line) AS turn FROM grp), plan0 AS (SELECT asset_id, line, 0::BIGINT AS j FROM grp),
{", ".join(_turn(n) for n in range(1, _TURNS + 1))} SELECT asset_id, line, j FROM plan{_TURNS}""",
)
def w10_tournament(spark, d):
    """The groups of an order choose one of three materials by turns: each scores its own offer and a bonus for lines that by then have the same."""
    o = spread(observations(spark, d), ["asset_id"]).groupBy("asset_id", (F.col("line") % _TURNS).alias("line")).agg(F.min("view_id").alias("view_id"), F.min("part_id").alias("part_id"), F.sum("weight").alias("weight"))
    offers = o.select("asset_id", "line", "view_id", "part_id", F.explode(F.array(*[F.lit(j).cast("long") for j in range(3)])).alias("j"))
    offers = offers.select("asset_id", "line", "j", ((F.col("view_id") + F.col("j") * 7) % 10).alias("material"), ((F.col("part_id") * 31 + F.col("j") * 17) % 100).alias("score"))
    scorer = rank.coupled_scorer(offers, ["asset_id"], "line", "j", "material", 5)
    plan, _ = rank.group_tournament(o.select("asset_id", "line", F.lit(0).cast("long").alias("j")), offers, o.select("asset_id", "line", F.col("weight").alias("footprint")), ["asset_id"], "line", "j", scorer, 3, 2)
    return plan


#: Words of part names in a script without spaces, and aliases in both scripts.
_SIGNS = {"small": "小型", "large": "大型", "cold": "冷轧", "hot": "热轧", "widget": "部件", "bolt": "螺栓", "rod": "钢棒", "blue": "蓝色", "red": "红色"}
_ALIASES = [("小型", "size:s"), ("大型", "size:l"), ("轧", "made:rolled"), ("冷轧", "temp:low"), ("型部", "never"), ("螺栓", "shape:rod"), ("钢棒", "shape:rod"), ("rod", "word:rod"), ("small", "word:small"), ("色蓝", "never"), ("蓝色", "colour:blue")]
_SIGNED = "p_name"
for _word, _sign in _SIGNS.items():
    _SIGNED = f"replace({_SIGNED}, '{_word} ', '{_sign}')"


@query(
    "p03_canonicalize_any",
    f"""WITH t AS (SELECT p_partkey AS part_id, lower({_SIGNED}) AS text FROM part), al AS (SELECT * FROM (VALUES {", ".join(map(str, _ALIASES))}) a(alias, canonical)),
m AS (SELECT DISTINCT part_id, canonical FROM t JOIN al ON CASE WHEN octet_length(encode(alias)) = length(alias) THEN list_contains(regexp_split_to_array(text, '[^a-z0-9]+'), alias) ELSE contains(text, alias) END)
SELECT part_id, coalesce(string_agg(canonical, ',' ORDER BY canonical), '') AS canonical FROM t LEFT JOIN m USING (part_id) GROUP BY part_id""",
)
def p03_any(spark, d):
    """Part names partly written in a script without spaces: its aliases are found inside the text, others as words."""
    text = F.col("name")
    for word, sign in _SIGNS.items():
        text = F.replace(text, F.lit(f"{word} "), F.lit(sign))
    return rules.canonicalize_any(parts(spark, d).select("part_id", text.alias("name")), "part_id", "name", spark.createDataFrame(_ALIASES, "alias string, canonical string"))


_BOXES = "bx AS (SELECT asset_id, view_id % 3 AS view, part_id, min(line * 40 + part_id % 17)::DOUBLE AS x0, min(view_id % 50)::DOUBLE AS y0, min(line * 40 + part_id % 17 + 20 + weight)::DOUBLE AS x1, min(view_id % 50 + 30)::DOUBLE AS y1, max(score) AS weight FROM obs GROUP BY ALL)"


def _boxes(spark, d):
    o = spread(observations(spark, d), ["asset_id"])
    left, low = F.col("line") * 40 + F.col("part_id") % 17, F.col("view_id") % 50
    sides = {"x0": left, "y0": low, "x1": left + 20 + F.col("weight"), "y1": low + 30}
    return o.groupBy("asset_id", (F.col("view_id") % 3).alias("view"), "part_id").agg(*[F.min(e).cast("double").alias(n) for n, e in sides.items()], F.max("score").alias("weight"))


@query(
    "x07_proximity_support",
    f"""WITH {OBS}, {_BOXES}, mb AS (SELECT DISTINCT asset_id, part_id % 2 AS component, part_id FROM obs WHERE part_id % 3 = 0),
n AS (SELECT a.asset_id, a.view, a.part_id, component, max(least(a.weight, b.weight)) AS s FROM bx a JOIN bx b ON a.asset_id = b.asset_id AND a.view = b.view AND a.part_id <> b.part_id JOIN mb ON mb.asset_id = b.asset_id AND mb.part_id = b.part_id
  WHERE sqrt(power(greatest(0, a.x0 - b.x1, b.x0 - a.x1), 2) + power(greatest(0, a.y0 - b.y1, b.y0 - a.y1), 2)) <= greatest(10, least(36, 0.06 * greatest(a.x1 - a.x0, a.y1 - a.y0, b.x1 - b.x0, b.y1 - b.y0))) GROUP BY ALL)
SELECT asset_id, part_id, component, round(sum(s), 6) AS support, count(*) AS views FROM n GROUP BY asset_id, part_id, component""",
)
def x07_support(spark, d):
    """How well the parts of an order stand beside the members of two components."""
    members = spread(observations(spark, d), ["asset_id"]).where("part_id % 3 = 0").select("asset_id", (F.col("part_id") % 2).alias("component"), "part_id").distinct()
    return rounded(fusion.proximity_support(_boxes(spark, d), members, ["asset_id"], "view"))


@query(
    "x07_extend_beside",
    f"""WITH {PARTS}, {OBS}, {lab_sql("parts", "part_id, brand, type, size")}, {_BOXES}, mb AS (SELECT part_id, brand, type, part_id AS component, lab_l, lab_a, lab_b FROM lab WHERE size > 40),
alike AS (SELECT l.part_id, m.component FROM lab l JOIN mb m ON l.brand = m.brand AND l.size <= 40 AND sqrt(power(l.lab_l - m.lab_l, 2) + power(l.lab_a - m.lab_a, 2) + power(l.lab_b - m.lab_b, 2)) <= 60),
n AS (SELECT a.view, a.part_id, mb.component, max(least(a.weight, b.weight)) AS s FROM vx a JOIN vx b ON a.view = b.view AND a.part_id <> b.part_id JOIN mb ON mb.part_id = b.part_id
  WHERE sqrt(power(greatest(0, a.x0 - b.x1, b.x0 - a.x1), 2) + power(greatest(0, a.y0 - b.y1, b.y0 - a.y1), 2)) <= greatest(10, least(36, 0.06 * greatest(a.x1 - a.x0, a.y1 - a.y0, b.x1 - b.x0, b.y1 - b.y0))) GROUP BY ALL),
s AS (SELECT part_id, component, sum(s) AS support FROM n GROUP BY ALL HAVING round(sum(s), 9) >= 0.6)
SELECT part_id, min(component) AS component, round(min(support), 6) AS support FROM s JOIN alike USING (part_id, component) GROUP BY part_id HAVING count(*) = 1""".replace(_BOXES, "vx AS (SELECT view_id AS view, part_id, min(line * 40 + part_id % 17)::DOUBLE AS x0, min(view_id % 50)::DOUBLE AS y0, min(line * 40 + part_id % 17 + 60)::DOUBLE AS x1, min(view_id % 50 + 30)::DOUBLE AS y1, max(score) AS weight FROM obs GROUP BY ALL)"),
)
def x07_beside(spark, d):
    """A part joins the one seed of its brand whose colour is near and that it stands beside in enough views."""
    p = color.add_colour_features(parts(spark, d), "r", "g", "b")
    left, low = F.col("line") * 40 + F.col("part_id") % 17, F.col("view_id") % 50
    sides = {"x0": left, "y0": low, "x1": left + 60, "y1": low + 30}
    boxes = spread(observations(spark, d), ["part_id"]).groupBy(F.col("view_id").alias("view"), "part_id").agg(*[F.min(e).cast("double").alias(n) for n, e in sides.items()], F.max("score").alias("weight"))
    seeds = p.where("size > 40").withColumn("component", F.col("part_id"))
    found = fusion.extend_beside(seeds.withColumn("any", F.lit(1)), p.where("size <= 40").withColumn("any", F.lit(1)), boxes, seeds.select("component", "part_id"), [], "view", "brand", "any", 60.0)
    return rounded(found)


@query("g15_robust_similarity")
def g15_robust(spark, d):
    """A turn, a scale and a move of each brand's parts, a sixth of them moved away; tested against a plain version."""
    p = parts(spark, d).select("brand", F.col("part_id").alias("id"), *[F.col(c).cast("double").alias(n) for c, n in (("r", "x"), ("g", "y"))], (F.col("size") + 10.0).alias("area"), (0.5 + F.col("b") / 512).alias("quality"))
    away = F.when(F.col("id") % 6 == 0, 90.0).otherwise(0.0)
    placed = p.select("*", (0.6 * F.col("x") - 0.8 * F.col("y") + 7 + away).alias("u"), (0.8 * F.col("x") + 0.6 * F.col("y") - 3).alias("v"), F.lit(20.0).alias("diagonal"))
    return rounded(fusion.robust_similarity(placed, ["brand"]), 5)


@query("a13_texture_score")
def a13_score(spark, d):
    """Textures of two readings of each picture at two radii; tested against convolution."""
    g = grid(spark, d).withColumn("l", 0.2126 * F.col("r") + 0.7152 * F.col("g") + 0.0722 * F.col("b")).withColumn("whole", F.lit(True))
    return rounded(px.texture_score(px.detail_histograms(g, ["image"], "l", "whole"), px.detail_histograms(g.withColumn("l", F.col("g") * 1.0), ["image"], "l", "whole"), ["image"]))


@query("j17_assign_optimal")
def j17_optimal(spark, d):
    """Suppliers of a nation to parts by their price, a whole nation at once; a supplier whose number ends in 0 is locked to the part of its number. Tested against all assignments, and on 200 by 200."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("view"))
    bids = observations(spark, d).select(F.col("view_id").alias("view"), F.col("part_id").alias("pose"), (F.col("price") / 100000).alias("score"))
    scores = s.join(bids, "view").groupBy("nation", "view", "pose").agg(F.round(F.max("score"), 6).alias("score"))
    locked = s.where("view % 10 = 0").select("nation", "view", F.col("view").alias("pose"))
    return joins.assign_optimal(scores, ["nation"], "view", "pose", "score", locked)


@query("x09_locked_margin")
def x09_locked(spark, d):
    """As x09_assignment_margin with one pair of each asset locked; tested against brute force."""
    n = table(spark, d, "supplier").groupBy((F.col("s_nationkey") % 3).alias("asset_id"), (F.col("s_nationkey") % 4).alias("view"), (F.col("s_suppkey") % 5).alias("pose")).agg(F.round(F.max("s_acctbal") / 10000, 6).alias("score"))
    locked = n.select("asset_id", F.lit(0).cast(n.schema["view"].dataType).alias("view"), F.lit(0).cast(n.schema["pose"].dataType).alias("pose")).distinct()
    return assembly.assignment_margin(n, "asset_id", "view", "pose", "score", locked)


_VIEWS = "v AS (SELECT DISTINCT part_id, part_id % 100 / 100 AS alignment, part_id % 11 = 0 AS censored FROM obs)"


@query(
    "a12_unreferenced_mass",
    f"""WITH {OBS}, {_VIEWS}, cells AS (SELECT part_id, view_id % 10 AS cell, sum(weight) FILTER (line <= 3) AS n, sum(weight) FILTER (line > 3) AS m FROM obs GROUP BY ALL),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY part_id) AS a, m / sum(m) OVER (PARTITION BY part_id) AS b FROM cells), t AS (SELECT DISTINCT part_id, view_id % 10 AS cell FROM obs WHERE part_id % 2 = 0 AND view_id % 10 IN (3, 4)),
x AS (SELECT v.part_id, b.cell::BIGINT AS cell, coalesce(s.a, 0) AS a, coalesce(s.b, 0) AS b, alignment, censored, t.cell IS NOT NULL AS known FROM v CROSS JOIN (SELECT unnest(range(2, 10)) AS cell) b LEFT JOIN s ON s.part_id = v.part_id AND s.cell = b.cell LEFT JOIN t ON t.part_id = v.part_id AND t.cell = b.cell),
r AS (SELECT *, alignment >= 0.55 AND round(b, 9) >= 0.05 AND round(a, 9) <= 0.01 AND round(greatest(0, b - a), 9) >= 0.05 AS raw_failure FROM x)
SELECT part_id, cell, raw_failure, CASE WHEN censored THEN 'NOT_APPLICABLE' WHEN NOT known AND raw_failure THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN censored THEN 'REFERENCE_MASK_COLOR_CENSORED' WHEN known THEN 'TRUSTED_COMPATIBLE_COLOR_FAMILY' ELSE '' END AS reason FROM r""",
)
def a12_unreferenced(spark, d):
    """Colours (of ten, the first two without chroma) that only the second reading of a part has."""
    o = observations(spark, d).withColumn("cell", (F.col("view_id") % 10).cast("long"))
    views = o.select("part_id", (F.col("part_id") % 100 / 100).alias("alignment"), (F.col("part_id") % 11 == 0).alias("censored")).distinct()
    trusted = o.where("part_id % 2 = 0 and cell in (3, 4)").select("part_id", "cell")
    found = fusion.unreferenced_mass(o.where("line <= 3"), o.where("line > 3"), views, ["part_id"], "cell", "weight", list(range(2, 10)), trusted)
    return found.select("part_id", F.col("cell").cast("long").alias("cell"), "raw_failure", "status", "reason")
