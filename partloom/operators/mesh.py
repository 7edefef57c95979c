"""Mesh tables: face corners (keys, face, corner, vertex) and points (keys, vertex, x, y, z). Each operator is joins on the key and grouped sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partloom.operators.graph import connected_components
from partloom.operators.spread import merged, spread


def directed_edges(corners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, face, u, v): each corner to the next, the last to the first."""
    w = Window.partitionBy(*keys, "face").orderBy("corner")
    whole = Window.partitionBy(*keys, "face")
    following = F.coalesce(F.lead("vertex").over(w), F.min_by("vertex", "corner").over(whole))
    return corners.select(*keys, "face", F.col("vertex").alias("u"), following.alias("v"))


def edge_topology(corners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges of each mesh: all, boundary (one face), non-manifold (over two), and of two faces wound alike."""
    e = directed_edges(corners, keys).select(*keys, F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), F.when(F.col("u") < F.col("v"), 1).otherwise(-1).alias("way"))
    by = e.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("way").alias("s"))
    return by.groupBy(*keys).agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("n") == 1).alias("boundary"), F.count_if(F.col("n") > 2).alias("non_manifold"), F.count_if((F.col("n") == 2) & (F.col("s") != 0)).alias("inconsistent"))


def triangles(corners: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fans of each face around its first corner, with coordinates p, q, r as structs."""
    p = points.select(*keys, "vertex", F.struct("x", "y", "z").alias("at"))
    placed = corners.join(merged(p), [*keys, "vertex"])
    w = Window.partitionBy(*keys, "face").orderBy("corner")
    out = placed.select(*keys, "face", "corner", F.first("at").over(w).alias("p"), F.col("at").alias("q"), F.lead("at").over(w).alias("r"), F.row_number().over(w).alias("__n"))
    return out.where("__n > 1 and r is not null").drop("__n", "corner")


def _cross():
    u = {c: F.col(f"q.{c}") - F.col(f"p.{c}") for c in "xyz"}
    v = {c: F.col(f"r.{c}") - F.col(f"p.{c}") for c in "xyz"}
    return u["y"] * v["z"] - u["z"] * v["y"], u["z"] * v["x"] - u["x"] * v["z"], u["x"] * v["y"] - u["y"] * v["x"]


def with_area(tris: DataFrame) -> DataFrame:
    """Adds nx, ny, nz (twice the area long) and the area."""
    nx, ny, nz = _cross()
    out = tris.withColumns({"nx": nx, "ny": ny, "nz": nz})
    return out.withColumn("area", F.sqrt(F.pow("nx", F.lit(2)) + F.pow("ny", F.lit(2)) + F.pow("nz", F.lit(2))) / 2)


def signed_volume(tris: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed volume of closed meshes, and whether faces point outwards."""
    q, r = {c: F.col(f"q.{c}") for c in "xyz"}, {c: F.col(f"r.{c}") for c in "xyz"}
    cross = q["y"] * r["z"] - q["z"] * r["y"], q["z"] * r["x"] - q["x"] * r["z"], q["x"] * r["y"] - q["y"] * r["x"]
    dot = F.col("p.x") * cross[0] + F.col("p.y") * cross[1] + F.col("p.z") * cross[2]
    return tris.groupBy(*keys).agg((F.sum(dot) / 6).alias("volume")).withColumn("outward", F.col("volume") > 0)


def mesh_metrics(corners: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Faces by arity, area, and the diagonal of the bounding box."""
    arity = corners.groupBy(*keys, "face").agg(F.count(F.lit(1)).alias("k")).groupBy(*keys).agg(F.count(F.lit(1)).alias("faces"), F.count_if(F.col("k") == 3).alias("triangles"), F.count_if(F.col("k") == 4).alias("quads"), F.count_if(F.col("k") > 4).alias("ngons"))
    area = with_area(triangles(corners, points, keys)).groupBy(*keys).agg(F.sum("area").alias("area"))
    span = {c: F.max(c) - F.min(c) for c in "xyz"}
    box = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("vertices"), F.sqrt(sum((span[c] * span[c] for c in "yz"), span["x"] * span["x"])).alias("diagonal"))
    return arity.join(merged(area), list(keys)).join(merged(box), list(keys))


def region_metrics(tris: DataFrame, regions: DataFrame, keys: Sequence[str], corners: DataFrame) -> DataFrame:
    """Of each region of faces: area, area-weighted centroid and normal, the largest angle in degrees between a face's normal and the region's, and the edges at the mesh's boundary (of one face only). regions: (keys, face, region)."""
    k = list(keys)
    t = with_area(tris).join(merged(regions), [*k, "face"])
    middle = [(F.sum(F.col("area") * (F.col(f"p.{c}") + F.col(f"q.{c}") + F.col(f"r.{c}")) / 3) / F.sum("area")).alias(f"c{c}") for c in "xyz"]
    by = t.groupBy(*k, "region").agg(F.count_distinct("face").alias("faces"), F.sum("area").alias("area"), *middle, *[F.sum(f"n{c}").alias(f"__n{c}") for c in "xyz"])
    size = lambda n: F.sqrt(sum((F.col(f"{n}{c}") * F.col(f"{n}{c}") for c in "yz"), F.col(f"{n}x") * F.col(f"{n}x")))
    normals = t.groupBy(*k, "region", "face").agg(*[F.sum(f"n{c}").alias(f"__f{c}") for c in "xyz"]).join(merged(by), [*k, "region"])
    dot = sum((F.col(f"__f{c}") * F.col(f"__n{c}") for c in "yz"), F.col("__fx") * F.col("__nx")) / (size("__f") * size("__n"))
    angle = F.when(size("__f") * size("__n") > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.round(dot, 12))))))
    turned = normals.groupBy(*k, "region").agg(F.max(angle).alias("deviation"))
    e = directed_edges(corners, k).select(*k, "face", F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    single = e.groupBy(*k, "lo", "hi").agg(F.count(F.lit(1)).alias("__e"), F.min("face").alias("face")).where("__e = 1")
    open_edges = single.join(merged(regions), [*k, "face"]).groupBy(*k, "region").agg(F.count(F.lit(1)).alias("boundary"))
    out = by.join(merged(turned), [*k, "region"]).join(merged(open_edges), [*k, "region"], "left")
    return out.select(*k, "region", "faces", "area", "cx", "cy", "cz", *[F.when(size("__n") > 0, F.col(f"__n{c}") / size("__n")).alias(f"n{c}") for c in "xyz"], "deviation", F.coalesce("boundary", F.lit(0)).alias("boundary"))


def geometry_digest(points: DataFrame, corners: DataFrame, keys: Sequence[str], digits: int = 9) -> DataFrame:
    """SHA-256 of a mesh that does not change when it is moved: points relative to the middle of the box, and faces in order. One mesh is one row."""
    mid = points.groupBy(*keys).agg(*[((F.max(c) + F.min(c)) / 2).alias(f"__{c}") for c in "xyz"])
    rel = points.join(merged(mid), list(keys)).select(*keys, "vertex", *[F.format_number(F.round(F.col(c) - F.col(f"__{c}"), digits) + 0.0, digits).alias(c) for c in "xyz"])
    shape = rel.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("vertex", F.concat_ws(",", "x", "y", "z").alias("t")))), lambda s: s["t"]), ";").alias("__p"))
    faces = corners.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("face", "corner", "vertex"))), lambda s: F.concat_ws(":", s["face"].cast("string"), s["vertex"].cast("string"))), ";").alias("__f"))
    return shape.join(merged(faces), list(keys)).select(*keys, F.sha2(F.concat_ws("|", "__p", "__f"), 256).alias("digest"))


def estimate_mass(df: DataFrame, density: str, volume: str, box_volume: str, low: float = 0.01, high: float = 10_000.0) -> DataFrame:
    """Density times volume (the box's, where the volume is missing or zero), within bounds."""
    v = F.when(F.col(volume) > 0, F.col(volume)).otherwise(F.col(box_volume))
    return df.withColumn("mass", F.greatest(F.lit(low), F.least(F.lit(high), F.col(density) * v)))


def distribute_mass(df: DataFrame, keys: Sequence[str], id_col: str, weight: str, total: str) -> DataFrame:
    """Splits a total by weight (evenly, if all weights are zero); the last id takes what rounding leaves."""
    w = Window.partitionBy(*keys)
    share = F.when(F.sum(weight).over(w) > 0, F.col(weight) / F.sum(weight).over(w)).otherwise(1 / F.count(F.lit(1)).over(w))
    part = df.withColumn("__m", F.round(F.col(total) * share, 6)).withColumn("__r", F.row_number().over(w.orderBy(F.desc(id_col))))
    rest = F.col(total) - (F.sum("__m").over(w) - F.col("__m"))
    return part.withColumn("mass", F.when(F.col("__r") == 1, rest).otherwise(F.col("__m"))).drop("__m", "__r")


def uv_overlap(tris: DataFrame, keys: Sequence[str], grid: int) -> DataFrame:
    """Cells of a ``grid`` x ``grid`` unit square whose centre lies in UV triangles (u0..v2): used and overlapping shares, and triangles out of bounds.

    Triangles are dealt by key over as many partitions as their cells need, and stay there.
    """
    tris = spread(tris, keys, grid * grid // 2)
    lo = lambda c: F.floor(F.least(f"{c}0", f"{c}1", f"{c}2") * grid)
    hi = lambda c: F.floor(F.greatest(f"{c}0", f"{c}1", f"{c}2") * grid)
    clip = lambda x: F.greatest(F.lit(0), F.least(F.lit(grid - 1), x))
    cells = tris.withColumn("cu", F.explode(F.sequence(clip(lo("u")), clip(hi("u"))))).withColumn("cv", F.explode(F.sequence(clip(lo("v")), clip(hi("v")))))
    x, y = (F.col("cu") + 0.5) / grid, (F.col("cv") + 0.5) / grid
    side = lambda a, b: (F.col(f"u{b}") - F.col(f"u{a}")) * (y - F.col(f"v{a}")) - (F.col(f"v{b}") - F.col(f"v{a}")) * (x - F.col(f"u{a}"))
    s = [F.signum(side(a, b)) for a, b in ((0, 1), (1, 2), (2, 0))]
    inside = cells.where((F.least(*s) >= 0) | (F.greatest(*s) <= 0)).groupBy(*keys, "cu", "cv").agg(F.count(F.lit(1)).alias("n"))
    used = inside.groupBy(*keys).agg((F.count(F.lit(1)) / (grid * grid)).alias("used"), (F.count_if(F.col("n") > 1) / F.count(F.lit(1))).alias("overlapping"))
    outside = F.greatest("u0", "u1", "u2", "v0", "v1", "v2") > 1
    outs = tris.groupBy(*keys).agg(F.avg((outside | (F.least("u0", "u1", "u2", "v0", "v1", "v2") < 0)).cast("double")).alias("out_of_bounds"))
    return outs.join(merged(used), list(keys), "left").select(*keys, F.coalesce("used", F.lit(0.0)).alias("used"), F.coalesce("overlapping", F.lit(0.0)).alias("overlapping"), "out_of_bounds")


def loose_vertices(corners: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many points of each mesh no face uses."""
    used = corners.select(*keys, "vertex").distinct()
    by = points.join(merged(used.withColumn("__u", F.lit(1))), [*keys, "vertex"], "left").groupBy(*keys).agg(F.count_if(F.col("__u").isNull()).alias("loose"))
    return by


def face_components(corners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many pieces each mesh has, of faces that share an edge."""
    k = list(keys)
    e = directed_edges(corners, k).select(*k, "face", F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"))
    name = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in k], F.col("face").cast("string"))
    named = e.withColumn("node", name)
    first = named.groupBy(*k, "lo", "hi").agg(F.min("node").alias("a"))
    labels = connected_components(named.join(merged(first), [*k, "lo", "hi"]).select("a", F.col("node").alias("b")), named.select("node"))
    return named.select(*k, "node").distinct().join(merged(labels), "node").groupBy(*k).agg(F.count_distinct("component").alias("components"))


#: An axis is up if it holds at least so much of the unit vector, and each other at most so much.
UP, OFF_UP = 0.9, 0.1


def up_axis(x: str, y: str, z: str) -> Column:
    """The axis that an up vector stands along (x, y or z); null if it leans."""
    size = {c: F.abs(F.col(n)) for c, n in zip("xyz", (x, y, z), strict=True)}
    others = lambda c: F.greatest(*[v for n, v in size.items() if n != c])
    return F.coalesce(*[F.when((v >= UP) & (others(c) <= OFF_UP), F.lit(c)) for c, v in size.items()])


def ground_contact(parts: DataFrame, keys: Sequence[str], low: str, high: str, width: str, near: float = 0.02, thin: float = 0.2, wide: float = 0.3, up: str = "") -> DataFrame:
    """Parts that stand on the ground: near the asset's lowest face, thin and wide relative to the asset. With a column ``up`` (of :func:`up_axis`) assets that lean are skipped: ``ground`` is null, and ``state`` says so."""
    w = Window.partitionBy(*keys)
    height = F.max(high).over(w) - F.min(low).over(w)
    at = (F.col(low) - F.min(low).over(w) <= near * height) & (F.col(high) - F.col(low) <= thin * height) & (F.col(width) >= wide * F.max(width).over(w))
    if not up:
        return parts.withColumn("ground", at)
    return parts.withColumn("ground", F.when(F.col(up).isNotNull(), at)).withColumn("state", F.when(F.col(up).isNull(), "up_axis_not_aligned").otherwise("checked"))
