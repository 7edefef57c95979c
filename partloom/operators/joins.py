"""Joins: reconciliation, lookups, colour radius, boxes, grids, Hamming distance and vectors.

Range and distance joins are equi-joins on cells or blocks with the exact predicate after them; none compares all pairs of a table.
Sides are broadcast only behind a count (:func:`small`).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from itertools import combinations, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.functions.color import delta_e2000
from partloom.operators.spread import MOST_PARTITIONS, merged, met, spread

#: Rows, and bytes as they are measured on the rows, of a side that is broadcast at most.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """The table with a broadcast hint if its rows and their bytes (as text) show that it is small; else unchanged, for a shuffle join."""
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).alias("b")).first()
    return F.broadcast(df) if found["n"] <= rows and (found["b"] or 0) <= size else df


def against(queries: DataFrame, bank: DataFrame, key: str) -> DataFrame:
    """Every query with every row of a bank (a library), joined by ``block``: a small bank is one block that is broadcast, a larger one is dealt into blocks by a hash of its key."""
    n = bank.count()
    blocks = max(1, -(-n // BROADCAST_ROWS))
    dealt = bank.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    return queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).join(small(dealt) if blocks == 1 else dealt, "block")


def top_rows(scored: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of each key with their rank: first in each ``block``, then of what the blocks have left."""
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    best = scored.withColumn("rank", place(*keys, "block")).where(F.col("rank") <= k)
    return best.withColumn("rank", place(*keys)).where(F.col("rank") <= k).drop("block")


#: Pairs that one task of :func:`best_rows` scores, more or less.
SCORED_PAIRS = 2_000_000


def best_rows(queries: DataFrame, bank: DataFrame, keys: Sequence[str], candidate: str, score: dict[str, Column], order: Sequence, k: int) -> DataFrame:
    """(keys, candidate, score, rank): the first ``k`` rows of a bank for each query by ``order``, whose last column is the candidate. The columns of ``score`` follow from the sides' columns other than keys and candidate.

    Queries of equal columns are one, and so are rows of the bank, with their first ``k`` candidates: what precedes a kind's first candidate precedes all of them, so the best ``k`` kinds hold the best ``k`` rows.
    """
    own, theirs = [c for c in queries.columns if c not in keys], [c for c in bank.columns if c != candidate]
    place = lambda by, order: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = bank.withColumn("__r", place(theirs, [candidate])).where(F.col("__r") <= k)
    kinds = first.groupBy(*theirs).agg(F.sort_array(F.collect_list(F.struct(candidate))).alias("__ids")).withColumn(candidate, F.get("__ids", F.lit(0))[candidate])
    asked = queries.select(*own).distinct().withColumn("__own", F.struct(*own))
    n = min(MOST_PARTITIONS, -(-asked.count() * kinds.count() // SCORED_PAIRS))
    scored = against(asked.repartition(max(1, n), "__own"), kinds, candidate).select("__own", "block", candidate, "__ids", *[e.alias(c) for c, e in score.items()])
    best = top_rows(scored, ["__own"], order, k).drop("rank", candidate)
    rows = best.withColumn("__id", F.explode("__ids")).select("__own", F.col("__id")[candidate].alias(candidate), *score)
    rows = rows.withColumn("__r", place(["__own"], order)).where(F.col("__r") <= k).drop("__r")
    return queries.select(*keys, F.struct(*own).alias("__own")).join(rows, "__own").withColumn("rank", place(keys, order)).where(F.col("rank") <= k).select(*keys, candidate, *score, "rank")


def reconcile(registry: DataFrame, plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact cover: one row for each key of either side with the status covered, missing, unexpected or duplicate."""
    r = registry.groupBy(*keys).agg(F.count(F.lit(1)).alias("registered"))
    p = plan.groupBy(*keys).agg(F.count(F.lit(1)).alias("planned"))
    status = F.when(F.col("registered").isNull(), "unexpected").when(F.col("planned").isNull(), "missing").when((F.col("registered") > 1) | (F.col("planned") > 1), "duplicate").otherwise("covered")
    return r.join(p, list(keys), "full").select(*keys, F.coalesce("registered", F.lit(0)).alias("registered"), F.coalesce("planned", F.lit(0)).alias("planned"), status.alias("status"))


def canonicalize_votes(votes: DataFrame, association: DataFrame, keys: Sequence[str], group: str, canonical: str) -> DataFrame:
    """Local group names to canonical ones; names with several canonical groups are ambiguous and get null."""
    known = association.groupBy(*keys, group).agg(F.count_distinct(canonical).alias("__n"), F.min(canonical).alias("__c"))
    return votes.join(known, [*keys, group], "left").select(*votes.columns, F.when(F.col("__n") == 1, F.col("__c")).alias("canonical"), F.when(F.col("__n").isNull(), "unknown").when(F.col("__n") > 1, "ambiguous").otherwise("resolved").alias("resolution"))


def enforce_allowlist(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(allowed, list(on), "left_semi")


def exclude_members(df: DataFrame, barred: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(barred, list(on), "left_anti")


def appearance_links(obs: DataFrame, keys: Sequence[str], part: str, view: str, family: str, weight: str, radius: float = 32, conflict: float = 48, support: float = 0.60, veto: float = 0.80, box: str = "", gap: float = 0.0) -> DataFrame:
    """Part pairs that look alike: in one view, of one family, within ``radius`` of each other in Lab, and, if ``box`` names a struct (x0, y0, x1, y1), with at most ``gap`` between their boxes.

    A pair's support is the sum over views of the smaller weight. One view with enough weight that shows the pair far apart or of
    different families vetoes it. Pairs are made inside one view of one asset only; ``obs`` has a struct ``lab``.
    """
    more = lambda n: [F.col(box).alias(f"__b{n}")] if box else []
    side = lambda n: obs.select(*keys, view, F.col(part).alias(f"part_{n}"), F.col(family).alias(f"__f{n}"), F.col(weight).alias(f"__w{n}"), F.col("lab").alias(f"__l{n}"), *more(n))
    pairs = side("a").join(side("b"), [*keys, view]).where("part_a < part_b")
    d = F.sqrt(sum((F.pow(F.col(f"__la.{c}") - F.col(f"__lb.{c}"), F.lit(2)) for c in "ab"), F.pow(F.col("__la.l") - F.col("__lb.l"), F.lit(2))))
    w = F.least("__wa", "__wb")
    like = (F.col("__fa") == F.col("__fb")) & (d <= radius)
    if box:
        like = like & (box_gap("__ba", "__bb") <= gap)
    unlike = ((F.col("__fa") != F.col("__fb")) | (d > conflict)) & (w >= veto)
    out = pairs.groupBy(*keys, "part_a", "part_b").agg(F.sum(F.when(like, w).otherwise(0.0)).alias("support"), F.max(unlike.cast("int")).alias("__v"))
    return out.where((F.col("__v") == 0) & (F.round("support", 8) >= support)).drop("__v")


def box_gap(a: str, b: str) -> Column:
    """The distance between two boxes (structs x0, y0, x1, y1); 0 if they touch or overlap."""
    apart = lambda lo, hi: F.greatest(F.lit(0.0), F.col(f"{a}.{lo}") - F.col(f"{b}.{hi}"), F.col(f"{b}.{lo}") - F.col(f"{a}.{hi}"))
    return F.hypot(apart("x0", "x1"), apart("y0", "y1"))


def box_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], cell: float, min_share: float = 0.0) -> DataFrame:
    """Pairs of boxes (x0, y0, x1, y1) of one key with their intersection over the smaller area.

    Boxes are written to the grid cells they touch; a pair is taken in the cell that holds the corner of its intersection, so it comes out once. Crowded cells are
    dealt over many tasks; the pairs themselves are as many as the boxes' squared number in an area asks for.
    """
    cells = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    side = lambda d, n: d.select(*keys, F.col("id").alias(f"id_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in ("x0", "y0", "x1", "y1")], F.explode(cells("x0", "x1")).alias("cx"), "y0", "y1").select("*", F.explode(cells("y0", "y1")).alias("cy")).drop("y0", "y1")
    pairs = met(side(left, "l"), side(right, "r"), [*keys, "cx", "cy"])
    x0, y0 = F.greatest("x0_l", "x0_r"), F.greatest("y0_l", "y0_r")
    width, height = F.least("x1_l", "x1_r") - x0, F.least("y1_l", "y1_r") - y0
    area = lambda n: (F.col(f"x1_{n}") - F.col(f"x0_{n}")) * (F.col(f"y1_{n}") - F.col(f"y0_{n}"))
    share = width * height / F.least(area("l"), area("r"))
    once = (F.floor(x0 / cell) == F.col("cx")) & (F.floor(y0 / cell) == F.col("cy"))
    return pairs.where((width > 0) & (height > 0) & once).select(*keys, "id_l", "id_r", share.alias("overlap")).where(F.col("overlap") >= min_share)


def sign_bits(vector: str, size: int = 64) -> Column:
    """A long whose bits are the signs of the first ``size`` numbers of a vector (1: positive)."""
    return F.expr(f"aggregate(sequence(0, {size - 1}), 0L, (s, i) -> s | if({vector}[i] > 0, shiftleft(1L, i), 0L))")


def hamming_pairs(df: DataFrame, id_col: str, bits: str, max_distance: int, bands: int = 4, size: int = 64) -> DataFrame:
    """Pairs of ids within ``max_distance`` of ``size`` bits.

    Two codes that differ in so few bits differ in at most ``max_distance // bands`` of one of the bands. So each code meets, band by band, the
    codes of which the band is near its own: the near values of one side are written out, the other side has its own value alone. Equal codes are
    one node; the distance is verified. Few bits for a distance make bands that many codes share: of 64 bits at distance 14, near bands hold some 4 % of all codes.
    """
    cuts = [round(size * i / bands) for i in range(bands + 1)]
    radius = max_distance // bands
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [signed(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in pairwise(cuts)]
    flips = [[signed(sum(1 << i for i in c)) for k in range(radius + 1) for c in combinations(range(a, b), k)] for a, b in pairwise(cuts)]
    codes = df.groupBy(F.col(bits).alias("code")).agg(F.count(F.lit(1)).alias("__n")).select("code")
    own = F.array(*[F.struct(F.lit(i).alias("band"), F.col("code").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
    near = F.concat(*[F.expr(f"transform(array({', '.join(f'{x}L' if x > -(1 << 63) else 'cast(-9223372036854775808 as bigint)' for x in f)}), x -> struct({i} as band, (code ^ x) & {m}L as part))") for i, (m, f) in enumerate(zip(masks, flips, strict=True))])
    a = codes.select(F.col("code").alias("__a"), F.explode(own).alias("k")).select("__a", "k.*")
    b = codes.select(F.col("code").alias("__b"), F.explode(near).alias("k")).select("__b", "k.*")
    far = F.bit_count(F.col("__a").bitwiseXOR(F.col("__b"))).cast("long")
    few = a.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = b.join(F.broadcast(a) if few else merged(a), ["band", "part"])
    linked = met.where(F.col("__a") <= F.col("__b")).withColumn("distance", far).where(F.col("distance") <= max_distance).select("__a", "__b", "distance").distinct()
    side = lambda x: df.select(F.col(id_col).alias(f"id_{x}"), F.col(bits).alias(f"__{x}"))
    met = linked.join(merged(side("a")), "__a").join(merged(side("b")), "__b")
    return met.where((F.col("__a") != F.col("__b")) | (F.col("id_a") < F.col("id_b"))).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "distance")


def dot(a: str, b: str) -> Column:
    """Dot product of two float arrays, summed as doubles."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> cast(x as double) * cast(y as double)), 0D, (s, v) -> s + v)")


def cosine(a: str, b: str) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


#: Vectors of a pack, which meet those of another pack as one product of matrices, and packs of a side that one task reads.
PACK_ROWS, TASK_PACKS = 2048, 4


def packs(df: DataFrame, keys: Sequence[str], name: str, vector: str, end: str) -> DataFrame:
    """(keys, __pack, __ids, __vecs), names ended: the vectors of a key in packs of one size of vectors and at most some ``PACK_ROWS``; a vector that is missing is empty."""
    rows = df.select(*keys, F.col(name).alias("__id"), F.coalesce(F.col(vector), F.array().cast(df.schema[vector].dataType)).alias("__vec"))
    sizes = rows.groupBy(*keys).agg(F.greatest(F.lit(1).cast("bigint"), F.ceil(F.count(F.lit(1)) / PACK_ROWS)).alias("__packs"))
    dealt = rows.join(sizes, list(keys)) if keys else rows.crossJoin(F.broadcast(sizes))  # one number
    dealt = dealt.withColumn("__pack", F.struct(F.size("__vec").alias("size"), F.pmod(F.xxhash64("__id"), F.col("__packs")).alias("n")))
    by = dealt.groupBy(*keys, "__pack").agg(F.collect_list("__id").alias("__ids"), F.collect_list("__vec").alias("__vecs"))
    return by.select(*keys, *[F.col(c).alias(c + end) for c in ("__pack", "__ids", "__vecs")])


def matrices(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of each row of a column of packs as a matrix of doubles, and their lengths. What is missing in a vector is NaN."""
    for pack in batch.column(name):
        m = pack.values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(pack.values), -1)
        yield m, np.sqrt(np.einsum("ij,ij->i", m, m))


def closeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cosines of all vectors of two matrices; NaN where there is none."""
    if not a[0].shape[1] == b[0].shape[1] > 0:
        return np.full((len(a[0]), len(b[0])), np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        return (a[0] / a[1][:, None]) @ (b[0] / b[1][:, None]).T


def knn(query: DataFrame, bank: DataFrame, query_id: str, bank_id: str, vector: str, k: int) -> DataFrame:
    """The ``k`` nearest vectors of a bank by cosine, for each query.

    Packs of queries meet packs of the bank, which keep what may be among their best ``k``, and all that is kept is ranked again. Vectors that have no cosine come last.
    """
    q, b = packs(query, [], query_id, vector, "q"), packs(bank, [], bank_id, vector, "b")
    few = lambda df, pack: df.repartition(max(1, -(-df.select(pack).count() // TASK_PACKS)))
    met = few(b, "__packb").crossJoin(small(few(q, "__packq"), 2 * TASK_PACKS))
    schema = T.StructType([T.StructField("query", query.schema[query_id].dataType), T.StructField("candidate", bank.schema[bank_id].dataType), T.StructField("__s", T.DoubleType())])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (x, y) in enumerate(zip(matrices(batch, "__vecsq"), matrices(batch, "__vecsb"), strict=True)):
                s = np.nan_to_num(closeness(x, y), nan=-np.inf)
                least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
                i, j = np.nonzero(s >= least[:, None] - 2e-6)  # scores of six digits may be equal
                score = np.full(len(i), np.nan)
                if x[0].shape[1] == y[0].shape[1] > 0:
                    dot = lambda a, b: np.add.accumulate(a * b, axis=1)[:, -1]  # noqa: E731  one after another, as in cosine()
                    with np.errstate(invalid="ignore", divide="ignore"):
                        score = dot(x[0][i], y[0][j]) / np.sqrt(dot(x[0], x[0])[i] * dot(y[0], y[0])[j])
                yield pa.RecordBatch.from_arrays([batch.column("__idsq")[row].values.take(pa.array(i)), batch.column("__idsb")[row].values.take(pa.array(j)), pa.array(score, from_pandas=True)], names=schema.names)

    kept = met.mapInArrow(near, schema).select("query", "candidate", F.round("__s", 6).alias("score"))
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "candidate"))).where(F.col("rank") <= k)


def set_similarity(pairs: DataFrame, tokens: DataFrame, keys: Sequence[str] = ("left", "right")) -> DataFrame:
    """Similarity of two sets of vectors: three quarters the mean of both mean best matches, a quarter the cosine of the centroids. tokens: (entity, token, vec).

    Packs of one set meet packs of the other and give the best match of each of their vectors; pairs of vectors are no rows.
    """
    left, right = keys
    p = packs(tokens, ["entity"], "token", "vec", "").select("entity", "__pack", "__ids", "__vecs")
    pack = lambda n: p.select(*[F.col(c).alias(a) for c, a in (("entity", n), ("__pack", f"__pack_{n}"), ("__ids", f"__ids_{n}"), ("__vecs", f"__vecs_{n}"))])
    number = lambda n: pack(n).select(n, f"__pack_{n}")
    plan = pairs.select(left, right).join(number(left), left).join(number(right), right).where(F.col(f"__pack_{left}.size") == F.col(f"__pack_{right}.size"))
    tasks = min(MOST_PARTITIONS, max(tokens.sparkSession.sparkContext.defaultParallelism, -(-plan.count() // TASK_PACKS**2)))
    met = plan.join(merged(pack(left)), [left, f"__pack_{left}"]).repartition(tasks, right, f"__pack_{right}").join(merged(pack(right).repartition(tasks, right, f"__pack_{right}")), [right, f"__pack_{right}"])
    token = tokens.schema["token"].dataType
    schema = T.StructType([*[T.StructField(c, pairs.schema[c].dataType) for c in keys], T.StructField("__left", T.BooleanType()), T.StructField("token", token), T.StructField("m", T.DoubleType())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (x, y) in enumerate(zip(matrices(batch, f"__vecs_{left}"), matrices(batch, f"__vecs_{right}"), strict=True)):
                s = closeness(x, y)
                for axis, side in ((1, left), (0, right)):
                    most, ids = np.fmax.reduce(s, axis=axis), batch.column(f"__ids_{side}")[row].values
                    own = [batch.column(c).take(pa.array(np.full(len(ids), row))) for c in keys]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(ids), side == left)), ids, pa.array(most, from_pandas=True)], names=schema.names)

    most = met.select(left, right, *[f"{c}_{n}" for n in keys for c in ("__ids", "__vecs")]).mapInArrow(best, schema).groupBy(left, right, "__left", "token").agg(F.max("m").alias("m"))
    mean = lambda side: F.avg(F.when(side, F.col("m")))
    both = most.groupBy(left, right).agg(mean(F.col("__left")).alias("__rows"), mean(~F.col("__left")).alias("__cols"))
    spread = tokens.select("entity", F.posexplode("vec").alias("i", "x")).groupBy("entity", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centre = spread.groupBy("entity").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))
    c = lambda n: centre.select(F.col("entity").alias(n), F.col("c").alias(f"c_{n}"))
    out = both.join(c(left), left).join(c(right), right)
    return out.select(left, right, (0.75 * (F.col("__rows") + F.col("__cols")) / 2 + 0.25 * cosine(f"c_{left}", f"c_{right}")).alias("similarity"))


def nearest_colour(obs: DataFrame, catalog: DataFrame, keys: Sequence[str], id_col: str, k: int) -> DataFrame:
    """The ``k`` catalogue colours nearest by CIEDE2000, with similarity exp(-d / 12)."""
    side = catalog.select(F.col(id_col).alias("candidate"), F.col("lab").alias("__c"))
    distance = F.round(delta_e2000(F.col("__o"), F.col("__c")), 6)
    return best_rows(obs.select(*keys, F.col("lab").alias("__o")), side, keys, "candidate", {"distance": distance}, ["distance", "candidate"], k).withColumn("similarity", F.exp(-F.col("distance") / 12))


def channel_prior(groups: DataFrame, profiles: DataFrame, group_id: str, profile_id: str, channels: Sequence[str], k: int) -> DataFrame:
    """The ``k`` best profiles of each group by the mean of 1 - |difference| over the channels that both sides have; profiles that share none come last, with null."""
    g = groups.select(F.col(group_id).alias("group"), *[F.col(c).alias(f"__g_{c}") for c in channels])
    p = profiles.select(F.col(profile_id).alias("profile"), *[F.col(c).alias(f"__p_{c}") for c in channels])
    terms = F.array_compact(F.array(*[1 - F.abs(F.col(f"__g_{c}") - F.col(f"__p_{c}")) for c in channels]))
    prior = F.when(F.size(terms) > 0, F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / F.size(terms))
    return best_rows(g, p, ["group"], "profile", {"prior": prior, "channels": F.size(terms).cast("long")}, [F.round("prior", 8).desc_nulls_last(), "profile"], k)


def point_distances(src: DataFrame, dst: DataFrame, keys: Sequence[str], coords: Sequence[str], radius: float) -> DataFrame:
    """Of each key: how many points of ``src`` have a point of ``dst`` within ``radius``, how many have none, and the mean, root mean square and largest distance of those that have."""
    met = nearest_points(src, dst, keys, coords, radius)
    d = F.col("distance")
    by = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("matched"), F.avg(d).alias("mean"), F.sqrt(F.avg(d * d)).alias("rms"), F.max(d).alias("largest"))
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("points")).join(by, list(keys), "left").select(*keys, F.coalesce("matched", F.lit(0)).alias("matched"), (F.col("points") - F.coalesce("matched", F.lit(0))).alias("unmatched"), "mean", "rms", "largest")


def nearest_points(src: DataFrame, dst: DataFrame, keys: Sequence[str], coords: Sequence[str], radius: float) -> DataFrame:
    """Nearest point of ``dst`` within ``radius`` for each point of ``src``, by an equi-join on grid cells: each source meets its cell and the neighbours."""
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    s = src.select(*keys, F.col("id").alias("source"), *[F.col(c).alias(f"s_{c}") for c in coords], *[cell(c).alias(f"__c_{c}") for c in coords])
    for c in coords:
        s = s.withColumn(f"__c_{c}", F.explode(F.sequence(F.col(f"__c_{c}") - 1, F.col(f"__c_{c}") + 1)))
    d = dst.select(*keys, F.col("id").alias("target"), *[F.col(c).alias(f"d_{c}") for c in coords], *[cell(c).alias(f"__c_{c}") for c in coords])
    gap = F.sqrt(sum((F.pow(F.col(f"s_{c}") - F.col(f"d_{c}"), F.lit(2)) for c in coords[1:]), F.pow(F.col(f"s_{coords[0]}") - F.col(f"d_{coords[0]}"), F.lit(2))))
    met = s.join(d, [*keys, *[f"__c_{c}" for c in coords]]).withColumn("distance", F.round(gap, 6)).where(F.col("distance") <= radius)
    return met.groupBy(*keys, "source").agg(F.min(F.struct("distance", "target")).alias("m")).select(*keys, "source", "m.target", "m.distance")


def verify_dependencies(recorded: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """fresh, stale or missing, for each recorded digest."""
    now = current.select(key, F.col(digest).alias("__now"))
    status = F.when(F.col("__now").isNull(), "missing").when(F.col("__now") == F.col(digest), "fresh").otherwise("stale")
    return recorded.join(now, key, "left").select(key, status.alias("status"))


def layered_precedence(layers: Sequence[tuple[str, DataFrame]], registry: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The value of the first layer that has one, for each registered key, and the layer's name."""
    all_layers = None
    for i, (name, df) in enumerate(layers):
        part = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"), F.lit(i).alias("priority"), F.lit(name).alias("layer"))
        all_layers = part if all_layers is None else all_layers.unionByName(part)
    first = all_layers.groupBy(*keys).agg(F.min(F.struct("priority", "value", "layer")).alias("f"))
    return registry.select(*keys).distinct().join(first, list(keys), "left").select(*keys, F.col("f.value").alias(value), F.coalesce("f.layer", F.lit("unassigned")).alias("layer"))


def assign_one_to_one(scores: DataFrame, keys: Sequence[str], left: str, right: str, score: str, most: int = 12) -> DataFrame:
    """Each left item to at most one right item: highest total, then most matches, then the least path. For a handful of left items: more than ``most`` are an error.

    Rows are dealt by key once. The left items of a key take turns; of the states with equal used sets only the best is kept. Many keys take their turns together, as arrays.
    """
    k = list(keys)
    row = F.struct(F.col(left).alias("l"), F.col(right).cast("string").alias("r"), F.col(score).cast("double").alias("s"))
    usable = F.col(left).isNotNull()
    for c in k:
        usable = usable & F.col(c).isNotNull()
    known = spread(scores.select(*dict.fromkeys([*k, left, right, score])), k)
    slots = known.where(usable).groupBy(*k).agg(F.count_distinct(left).alias("n")).agg(F.max("n")).first()[0] or 0
    if slots > most:
        raise ValueError(f"a key has {slots} items, more than {most}")
    by = known.groupBy(*k).agg(F.array_sort(F.collect_list(F.when(usable, row))).alias("__rows"))
    number = F.transform("__rows", lambda x: F.array_position(F.array_distinct(F.transform("__rows", lambda y: y["l"])), x["l"]).cast("int"))
    packed = by.select(*k, number.alias("__n"), F.transform("__rows", lambda x: x["r"]).alias("__r"), F.transform("__rows", lambda x: x["s"]).alias("__s"))
    schema = T.StructType([*[packed.schema[c] for c in k], T.StructField("path", T.ArrayType(T.StringType())), T.StructField("total", T.DoubleType()), T.StructField("matched", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                path, total, matched = best_paths(*[batch.column(c) for c in ("__n", "__r", "__s")], slots)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in k], path, pa.array(total), pa.array(matched, pa.int32())], names=schema.names)

    return packed.mapInArrow(run, schema)


def best_paths(items: pa.ListArray, rights: pa.ListArray, scores: pa.ListArray, slots: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of each list of choices (item from 1, right item, score): the right item, or null, of each of so many items, the total and the matches of its best assignment."""
    keys, size = len(items), np.diff(items.offsets.to_numpy())
    owner, item = np.repeat(np.arange(keys), size), items.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    name, worth = rights.flatten(), pc.fill_null(scores.flatten(), 0.0).to_numpy(zero_copy_only=False)
    usable = (name.is_valid().to_numpy(zero_copy_only=False)) & scores.flatten().is_valid().to_numpy(zero_copy_only=False)
    words = name.dictionary_encode()
    texts = words.dictionary.to_pylist()
    order = sorted(range(len(texts)), key=lambda i: (texts[i] + ",").encode())  # paths compare as joined text
    place = np.empty(len(texts) + 1, np.int64)
    place[order] = np.arange(len(texts))
    nothing = sum((texts[i] + ",").encode() < b"~," for i in range(len(texts)))  # where no match stands
    code = place[pc.fill_null(words.indices, len(texts)).to_numpy(zero_copy_only=False)] if len(texts) else np.zeros(len(owner), np.int64)
    rank = np.where(code >= nothing, code + 1, code)
    back = [texts[i] for i in order]
    back = [*back[:nothing], None, *back[nothing:]]
    far = len(back)  # stands for no match in used sets
    ending = np.empty(far, np.int64)  # the last of a path has no comma after it
    ending[sorted(range(far), key=lambda i: ("~" if back[i] is None else back[i]).encode())] = np.arange(far)

    of, total, matched = np.arange(keys), np.zeros(keys), np.zeros(keys, np.int64)
    used, path = np.full((keys, 0), far), np.full((keys, 0), nothing)
    for n in range(1, slots + 1):
        chosen = np.flatnonzero((item == n) & usable)
        first, last = np.searchsorted(owner[chosen], of), np.searchsorted(owner[chosen], of, "right")
        many = last - first
        state = np.repeat(np.arange(len(of)), many)
        pick = chosen[np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        free = ~(used[state] == rank[pick][:, None]).any(axis=1)
        state, pick = state[free], pick[free]
        new = total[state] + worth[pick]
        new = np.where(np.abs(new) < 9000, np.sign(new) * np.floor(np.abs(new) * 1e12 + 0.5) / 1e12, new)  # twelve digits, as far as a double has them
        skip = np.full((len(of), 1), nothing)
        of, total, matched = np.concatenate([of[state], of]), np.concatenate([new, total]), np.concatenate([matched[state] + 1, matched])
        path = np.concatenate([np.c_[path[state], rank[pick]], np.c_[path, skip]])
        used = np.sort(np.concatenate([np.c_[used[state], rank[pick]], np.c_[used, np.full((len(skip), 1), far)]]), axis=1)
        least = np.lexsort([ending[path[:, -1]], *path[:, :-1].T[::-1], -matched, -total, *used.T[::-1], of])
        same = (of[least][1:] == of[least][:-1]) & (used[least][1:] == used[least][:-1]).all(axis=1)
        kept = least[np.r_[True, ~same]]
        of, total, matched, used, path = of[kept], total[kept], matched[kept], used[kept], path[kept]
    least = np.lexsort([ending[path[:, -1]], *path[:, :-1].T[::-1], -matched, -total, of]) if slots else np.arange(keys)
    kept = least[np.r_[True, of[least][1:] != of[least][:-1]]] if keys else least
    total, matched, path = total[kept], matched[kept], path[kept]
    values = pa.array(back, pa.string()).take(pa.array(path.reshape(-1)))
    return pa.ListArray.from_arrays(pa.array(np.arange(keys + 1, dtype=np.int32) * slots), values), total, matched


def least_cost(cost: np.ndarray) -> np.ndarray:
    """The column of each row of least total cost, by shortest augmenting paths over whole numbers. There are at least as many columns as rows."""
    n, m = cost.shape
    u, v, owner = np.zeros(n, np.int64), np.zeros(m, np.int64), np.full(m, -1)
    for start in range(n):
        dist, before, done = np.full(m, np.iinfo(np.int64).max // 4), np.full(m, -1), np.zeros(m, bool)
        row, last, far = start, -1, 0
        while True:
            reach = far + cost[row] - u[row] - v
            better = ~done & (reach < dist)
            dist[better], before[better] = reach[better], last
            last = int(np.where(done, np.iinfo(np.int64).max // 2, dist).argmin())
            far = dist[last]
            if owner[last] < 0:
                break
            done[last] = True
            row = owner[last]
        u[start] += far
        u[owner[done]] += far - dist[done]
        v[done] -= far - dist[done]
        while last >= 0:  # the path turns round
            prior = before[last]
            owner[last] = owner[prior] if prior >= 0 else start
            last = prior
    out = np.empty(n, np.int64)
    held = owner >= 0
    out[owner[held]] = np.flatnonzero(held)
    return out


def least_sparse(starts: np.ndarray, columns: np.ndarray, cost: np.ndarray, m: int) -> np.ndarray:
    """The column of each row of least total cost, -1 for none, which costs nothing: as :func:`least_cost`, of the pairs that are there. Row i has ``columns`` and ``cost`` from starts[i] to starts[i + 1]; there are ``m`` columns.

    A row's pairs are sorted once as it is reached and taken as they are needed, so only columns that an augmenting path comes to are held.
    """
    n = len(starts) - 1
    u, v, owner, mate = np.zeros(n, np.int64), np.zeros(m + n, np.int64), np.full(m + n, -1), np.full(n, -1)  # a row without a pair has a column of its own
    for start in range(n):
        done, before, heap, row, far = {}, {}, [], start, 0
        while True:
            own = np.append(columns[starts[row] : starts[row + 1]], m + row)
            reach = np.append(cost[starts[row] : starts[row + 1]], 0) + far - u[row] - v[own]
            order = np.lexsort([own, reach])
            heapq.heappush(heap, (int(reach[order[0]]), int(own[order[0]]), row, 0, reach[order], own[order]))
            while True:
                d, c, r, at, reaches, ways = heapq.heappop(heap)
                if at + 1 < len(ways):
                    heapq.heappush(heap, (int(reaches[at + 1]), int(ways[at + 1]), r, at + 1, reaches, ways))
                if c not in done:
                    break
            done[c], before[c], far = d, r, d
            if owner[c] < 0:
                break
            row = owner[c]
        u[start] += far
        for passed, d in done.items():
            if passed != c:
                u[owner[passed]] += far - d
                v[passed] -= far - d
        while True:  # the path turns round: each of its rows goes on to the column that it reached
            row = before[c]
            owner[c], mate[row], c = row, c, mate[row]
            if row == start:
                break
    return np.where(mate < m, mate, -1)


#: The largest smaller side, and the most cells, of a key's table of scores that :func:`assign_optimal` writes out whole; of a larger one it takes the pairs that are there.
MOST_ITEMS, MOST_CELLS = 2000, 4_000_000


def assign_optimal(scores: DataFrame, keys: Sequence[str], left: str, right: str, score: str, locked: DataFrame | None = None, digits: int = 9) -> DataFrame:
    """(keys, left, right, score, locked) of the pairs of a best one-to-one assignment of each key: highest total of scores (to ``digits``), then most pairs. Keys are solved apart, on as many tasks.

    locked: pairs (keys, left, right) that stand before anything is chosen; they need no score. A pair locked to two partners is an error. A key may be of any size that one task holds.
    Beyond these two rules ties go to pairs that come first by left and right; see :func:`assign_one_to_one` for the least path.
    """
    k = list(keys)
    kind = {f.name: f.dataType for f in scores.schema.fields}
    rows = scores.groupBy(*k, left, right).agg(F.max(score).cast("double").alias("__s")).withColumn("__locked", F.lit(False))
    if locked is not None:
        fixed = locked.select(*k, left, right).distinct()
        rows = rows.join(fixed.withColumn("__fixed", F.lit(True)), [*k, left, right], "full").select(*k, left, right, "__s", F.coalesce("__fixed", F.lit(False)).alias("__locked"))
    schema = T.StructType([*[T.StructField(c, kind[c]) for c in (*k, left, right)], T.StructField(score, T.DoubleType()), T.StructField("locked", T.BooleanType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        fixed = pdf[pdf["__locked"]]
        if fixed[left].duplicated().any() or fixed[right].duplicated().any():
            raise ValueError("an item is locked twice")
        free = pdf[~pdf[left].isin(fixed[left]) & ~pdf[right].isin(fixed[right])]
        lefts, rights = sorted(free[left].unique()), sorted(free[right].unique())
        n, m = len(lefts), len(rights)
        picked = fixed
        if n and m:
            i, j = pd.Index(lefts).get_indexer(free[left]), pd.Index(rights).get_indexer(free[right])
            worth = free["__s"].to_numpy(dtype=float)
            known = np.isfinite(worth)
            value = np.where(known, np.round(np.nan_to_num(worth) * 10**digits), 0).astype(np.int64) * (min(n, m) + 1) + 1  # a pair more decides between equal totals
            price = np.where(known & (value > 0), -value, 1)
            turned = n > MOST_ITEMS or (n > m and n * m > MOST_CELLS)  # rows are the smaller side of a long table
            rows_of, columns_of, size, width = (j, i, m, n) if turned else (i, j, n, m)
            if min(n, m) <= MOST_ITEMS and n * m <= MOST_CELLS:
                cost = np.ones((size, width), np.int64)
                cost[rows_of, columns_of] = price
                cost = np.concatenate([cost, np.zeros((size, size), np.int64)], axis=1)  # no pair costs nothing
                found = least_cost(cost)
            else:
                use = np.flatnonzero(price < 0)
                use = use[np.lexsort([columns_of[use], rows_of[use]])]
                found = least_sparse(np.searchsorted(rows_of[use], np.arange(size + 1)), columns_of[use], price[use], width)
            picked = pd.concat([fixed, free[found[rows_of] == columns_of]])
        return picked.rename(columns={"__s": score, "__locked": "locked"})[[*k, left, right, score, "locked"]]

    return rows.groupBy(*k).applyInPandas(solve, schema)
