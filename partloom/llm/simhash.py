"""SimHash near duplicates: fingerprints, pigeonhole blocks, Hamming links, groups.

Words, fingerprints: a text with A-Z lower-cased is split at ASCII white space; each
run of ``shingle`` words (all words, if there are fewer) is hashed by XXH64, seed 42;
a bit of the fingerprint is 1 if more than half of the hashes have it set.

Links: equal fingerprints are one node, whatever the number of their documents. Each
node is cut into blocks, so that two nodes within ``max_bits`` differing bits are
equal in all but ``max_bits`` blocks; nodes are joined on every such choice of equal
blocks, and the Hamming distance of the pairs is verified. A bucket that holds more than ``bucket`` nodes is
not joined with itself. Its nodes take an exact way without pairs: two
fingerprints differ in at most 2 bits just when some number is at most 1 bit from both, so each
node names the 65 numbers within 1 bit and all that name the same one are linked to the smallest.

Texts alike (:func:`similar_texts`, for the pipeline): 64 bits cannot tell pairs of similarity 0.8 from others and share
blocks too. There a fingerprint is so long that it is cut into ``blocks_for(...)`` blocks of as many bits as the number of documents has:
two texts with the shingle similarity share a block with the wanted probability, and few others do. Pairs of small buckets are sifted by Hamming distance
over all bits; of a bucket with more than ``bucket`` nodes each meets the smallest, and the bucket is cut again by the next two blocks. What is left is verified on
the sets of shingles themselves, so no pair below the similarity is linked: first each node's nearest pair, then those that still lie between two groups.
Nodes of crowded buckets that are near by their probes to one of another group are then joined on the rarest shingles of their sets, as sets of the similarity share one of
those: each with the node in which a shingle stands foremost, then all that are still in different groups. These pairs are sifted and verified likewise, and none with the similarity is left out. So groups are those of all pairs that share a block, whatever ``bucket`` is.

Groups: connected components by alternating large-star and small-star steps, each
step written to the shared folder. Nothing is collected but a count of changes.

Defined results: null and empty texts, and texts of white space, have fingerprint
zero and are linked like others; a null id is a member that is never a group's
name unless all are null; repeated rows are rows of one group; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.llm.common import bounded_batches, released, replaced, shared_folder, slices, stored, texts, with_fields
from partloom.operators.spread import having, merged, met

#: The letters that are lower-cased.
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: White space between words.
_SPACE = " \t\n\x0b\x0c\r"
_OTHER_SPACE = dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")


def fingerprint_of(text: str, shingle: int = 3) -> int:
    """64 bits of one text; zero if it has no words."""
    words = [w for w in text.translate(_LOWER | _OTHER_SPACE).split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(" ".join(words[i : i + shingle]), 42) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):  # bounds the memory of a long text
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """Adds ``fingerprint`` (long, the 64 bits as a signed number), without the text. No shuffle."""
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col, carry)
    schema = with_fields(rows, ["__text"], [("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for batch in slices(batches):
            bits = np.array([fingerprint_of(t, shingle) for t in batch.column("__text").to_pylist()], np.uint64)
            yield replaced(batch, schema, {"fingerprint": pa.array(bits.view(np.int64))})

    return rows.mapInArrow(run, schema)


def _blocks(blocks: int, equal: int) -> list[tuple[int, int]]:
    """(number, mask) of each choice of ``equal`` out of ``blocks`` parts of 64 bits; masks as signed numbers."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, equal)]
    return [(i, m - (1 << 64) if m >> 63 else m) for i, m in enumerate(masks)]


def links(nodes: DataFrame, max_bits: int = 2, blocks: int = 4, bucket: int = 64) -> DataFrame:
    """Edges (a, b), a < b, over distinct fingerprints ``fp``.

    Pairs come from buckets of at most ``bucket`` nodes; a larger bucket gives a star of links for every number near
    its nodes, which connects just the same fingerprints. That way is for ``max_bits`` = 2, and other values are an error.
    """
    choices = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(m).cast("long").alias("mask")) for i, m in _blocks(blocks, blocks - max_bits)])
    keyed = nodes.select("fp", F.explode(choices).alias("c")).select("fp", "c.table", F.expr("fp & c.mask").alias("key"))
    sizes = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = keyed.join(sizes, ["table", "key"])
    if max_bits != 2:
        raise ValueError("crowded buckets are linked for 2 bits only; see similar_texts for greater distances")
    small = shared.where(F.col("size") <= bucket)
    pairs = small.alias("x").join(small.alias("y"), ["table", "key"]).where("x.fp < y.fp and bit_count(x.fp ^ y.fp) <= " + str(int(max_bits))).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    near = F.expr("explode(transform(sequence(0, 64), i -> if(i = 64, fp, fp ^ shiftleft(1L, i))))")
    crowded = shared.where(F.col("size") > bucket).select("fp").distinct().select("fp", near.alias("near"))
    hubs = crowded.groupBy("near").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)  # at most 65 fingerprints
    stars = hubs.select("a", F.explode("all").alias("b")).where("a < b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, folder: str, max_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node of each connected component, for the nodes that have edges.

    Large-star and small-star steps in turn; stars with one centre are what is left when nothing changes. The number
    of rounds grows as the logarithm of the longest path.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), folder, "edges-0")
    for k in range(1, max_rounds + 1):
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        least2 = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least2, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least2.select("u", F.col("m").alias("v")))
        after = stored(small.where("u <> v").distinct(), folder, f"edges-{k}")
        changed = after.exceptAll(current).limit(1).count() + current.exceptAll(after).limit(1).count()
        current = after
        if not changed:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, blocks: int = 4, bucket: int = 64) -> DataFrame:
    """One row for each row of ``df``: the id, ``fingerprint`` (long) and ``component_id``, the smallest id that can be reached over links."""
    folder = shared_folder(df.sparkSession)
    marked = stored(fingerprints(df, id_col, text_col, shingle), folder, "fingerprints")
    nodes = stored(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("first")), folder, "nodes")
    named = _named(nodes, "fp", components(links(nodes.select("fp"), max_bits, blocks, bucket), folder))
    return marked.join(named.withColumnRenamed("fp", "fingerprint"), "fingerprint").select(id_col, "fingerprint", "component_id")


def _named(nodes: DataFrame, node: str, roots: DataFrame) -> DataFrame:
    """(node, component_id): the smallest ``first`` of each node's component. roots: (node, root) as :func:`components` gives them."""
    placed = nodes.join(roots.withColumnRenamed("node", node), node, "left").select(node, "first", F.coalesce("root", node).alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(names, "root").select(node, "component_id")


#: Bits by which pairs of buckets are sifted before all bits are compared.
PROBE = 64
_MIX = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)))


def differing(similarity: float) -> float:
    """The share of bits in which two sets of one size with this Jaccard similarity differ, by expectation: their angle over a half turn."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def blocks_for(documents: int, similarity: float, recall: float) -> tuple[int, int]:
    """(blocks, bits in each): bits enough to give every document a bucket, blocks enough for pairs of the similarity to share one."""
    width = min(48, max(12, math.ceil(math.log2(max(2, documents)))))
    shared = (1 - differing(similarity)) ** width
    return math.ceil(math.log(1 - recall) / math.log(1 - shared)), width


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles_of(texts: Sequence[str], shingle: int) -> list[np.ndarray]:
    """The different shingles of each text, as hashes; none for a text without words."""
    each = [[w for w in t.translate(_LOWER | _OTHER_SPACE).split(" ") if w] for t in texts]
    met = pa.array([w for words in each for w in words], pa.string()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w, 42) for w in met.dictionary.to_pylist()] or [0], np.uint64)
    flat = known[met.indices.to_numpy()] if len(met) else known[:0]
    out, end = [], 0
    for words in each:
        own, end = flat[end : end + len(words)], end + len(words)
        k = min(shingle, len(own))
        hashed = np.zeros(max(0, len(own) - k + 1) if k else 0, np.uint64)
        for i in range(k):
            hashed = hashed * _MIX[0] + own[i : i + len(hashed)]
        out.append(np.unique(_mixed(hashed)))
    return out


def long_fingerprint(hashes: np.ndarray, bits: int) -> np.ndarray:
    """So many bits, each set if it is set in more than half of the hashes of its lane."""
    lanes = np.arange(1, -(-bits // 64) + 1, dtype=np.uint64) * _MIX[0]
    ones = np.zeros(len(lanes) * 64, np.int64)
    for at in range(0, len(hashes), 255):  # sums of 255 bits fit one byte
        lane = _mixed(hashes[at : at + 255, None] + lanes)
        ones += np.unpackbits(lane.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return ones[:bits] * 2 > len(hashes)


def long_fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int, blocks: int, width: int) -> DataFrame:
    """(id, own: a hash of the text, ``blocks`` array<long>, ``probe`` long, n): the bits of a long fingerprint by block, ``PROBE`` further ones, and how many different shingles there are. No shuffle."""
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64("__text").alias("own"), "__text")
    schema = with_fields(rows, ["__text"], [("blocks", T.ArrayType(T.LongType(), False)), ("probe", T.LongType()), ("n", T.LongType())])
    place = 1 << np.arange(width, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for batch in slices(batches, by="__text"):
            sets = shingles_of(batch.column("__text").to_pylist(), shingle)
            bits = np.stack([long_fingerprint(h, blocks * width + PROBE) for h in sets])
            keys = (bits[:, : blocks * width].reshape(len(bits), blocks, width) * place).sum(2)
            probe = np.packbits(bits[:, blocks * width :], axis=1, bitorder="little").view("<i8")[:, 0]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * blocks), pa.array(keys.reshape(-1)))
            yield replaced(batch, schema, {"blocks": lists, "probe": pa.array(probe), "n": pa.array([len(h) for h in sets], pa.int64())})

    return rows.mapInArrow(run, schema)


def _meet(rows: DataFrame, by: Sequence[str], bucket: int, most: int, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of nodes in one bucket of which the probes differ in at most ``most`` bits: all of small buckets, those with the smallest node of crowded ones. And the rows of crowded buckets."""
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "probe")).alias("hub")).where("size > 1")
    shared = stored(rows.join(sizes, list(by)), folder, name)
    side = lambda n: shared.where(F.col("size") <= bucket).select(*by, F.col("node").alias(n), F.col("probe").alias(f"__{n}"))
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= most
    pairs = side("a").join(side("b"), list(by)).where((F.col("a") < F.col("b")) & near("__a", "__b")).select("a", "b")
    crowded = shared.where(F.col("size") > bucket)
    stars = crowded.where((F.col("node") > F.col("hub.node")) & near("probe", "hub.probe")).select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    return pairs.unionByName(stars), crowded.drop("size", "hub")


def _divided(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of keys with more than one group (``root``), and ``main``, the group with most rows of the key."""
    parts = rows.groupBy(*by, "root").agg(F.count(F.lit(1)).alias("members"))
    mixed = parts.groupBy(*by).agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.count(F.lit(1)).alias("groups")).where("groups > 1").drop("groups")
    return rows.join(mixed, list(by))


def _probed(most: int, similarity: float) -> Column:
    """Whether rows a and b are of different groups, their probes differ in at most ``most`` bits and their sizes allow the similarity."""
    sized = F.least("__na", "__nb") >= F.lit(similarity) * F.greatest("__na", "__nb") - 1e-9
    return (F.col("__ra") != F.col("__rb")) & (F.bit_count(F.col("__pa").bitwiseXOR(F.col("__pb"))) <= most) & sized


def _sided(rows: DataFrame, by: Sequence[str], n: str, *more: str) -> DataFrame:
    """A side of a join of nodes, with the columns that :func:`_probed` reads."""
    return rows.select(*by, F.col("node").alias(n), F.col("root").alias(f"__r{n}"), F.col("probe").alias(f"__p{n}"), F.col("n").alias(f"__n{n}"), *[F.col(c).alias(f"__{c}_{n}") for c in more])


def _parted(crowded: DataFrame, by: Sequence[str], similarity: float, most: int, folder: str) -> DataFrame:
    """(node, probe, n): the nodes that share a bucket with one of another group that is near enough by its probe. Pairs are compared, those with nodes outside the bucket's largest group, but none is made."""
    rows = stored(_divided(crowded, by), folder, "mixed")
    outside = rows.where("root <> main")
    back = having(_sided(rows, by, "a"), _sided(outside, by, "b"), by, _probed(most, similarity))
    forth = having(_sided(outside, by, "a"), _sided(rows.where("root = main"), by, "b"), by, _probed(most, similarity))
    return back.unionByName(forth).select(F.col("a").alias("node"), F.col("__pa").alias("probe"), F.col("__na").alias("n")).distinct()


def _postings(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(token, node, probe, n, at, rarest, place) for the rarest shingles of each node that others have too: two sets of the similarity share one of the first ``n - similarity * n + 1``.

    The shingles of all sets are in one order, rare ones first; those of one node alone come before all others and need no row. rarest: the node's shingles with rows; place: this one's place among them; at: among all, from 0.
    """
    held = sets.join(nodes, "node").select("node", F.explode("shingles").alias("token"))
    common = held.groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    ordered = held.join(merged(common), "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("seen", "token"))).alias("all"))
    own = F.col("n") - F.size("all")
    first = F.greatest(F.lit(0), (F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1 - own).cast("int"))
    rows = ordered.join(nodes, "node").select("node", "probe", "n", own.alias("own"), F.transform(F.slice("all", F.lit(1), first), lambda x: x["token"]).alias("rarest"))
    return rows.select("node", "probe", "n", "own", "rarest", F.posexplode("rarest").alias("place", "token")).select("token", "node", "probe", "n", (F.col("own") + F.col("place")).alias("at"), "rarest", "place")


def _allowed(similarity: float) -> Column:
    """Whether what follows a first shared shingle is enough for the similarity."""
    rest = F.least(F.col("__na") - F.col("__at_a"), F.col("__nb") - F.col("__at_b"))
    return rest >= F.lit(similarity / (1 + similarity)) * (F.col("__na") + F.col("__nb")) - 1e-6


def _paired(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _foremost(postings: DataFrame, similarity: float, most: int) -> DataFrame:
    """Pairs (a, b) of each node with the one of another group in which a shared shingle stands foremost: the one with the fewest rare shingles, which many variants of a text are nearest to. No more pairs than postings."""
    hubs = postings.groupBy("token").agg(F.min(F.struct("at", "node", "root", "probe", "n")).alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("token", "hub.*")
    return _paired(_sided(postings, ["token"], "a", "at").join(merged(_sided(hubs, ["token"], "b", "at")), "token").where(_probed(most, similarity) & _allowed(similarity)))


def _across(postings: DataFrame, similarity: float, most: int, folder: str) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that have a rare shingle in common and can have the similarity: all of them, each met at its first shared shingle.

    Of each shingle the nodes outside its largest group meet all others; shingles with many are dealt over shares.
    """
    rows = stored(_divided(postings, ["token"]).withColumn("inner", F.col("root") == F.col("main")), folder, "mixed-tokens")
    side = lambda d, n: _sided(d, ["token"], n, "at", "rarest", "place", "inner")
    once = F.col("__inner_b") | (F.col("a") < F.col("b"))
    before = lambda n: F.slice(f"__rarest_{n}", F.lit(1), F.col(f"__place_{n}"))
    pairs = met(side(rows.where("not inner"), "a"), side(rows, "b"), ["token"])
    return _paired(pairs.where(once & _probed(most, similarity) & _allowed(similarity) & ~F.arrays_overlap(before("a"), before("b"))))


#: Texts that are looked up by a broadcast list at most.
BROADCAST_TEXTS = 500_000


def shingle_sets(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles array<long>) of the texts (node, id, own) that are wanted: their different shingles, as hashes of 64 bits. One row for each node, though its row be repeated."""
    few = wanted.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS
    rows = texts(df, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64("__text").alias("own"), "__text")
    met = rows.join(F.broadcast(wanted) if few else wanted, (rows["id"].eqNullSafe(wanted["id"])) & (rows["own"] == wanted["own"])).select("node", "__text")
    schema = with_fields(met, ["__text"], [("shingles", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for batch in slices(batches, by="__text"):
            sets = shingles_of(batch.column("__text").to_pylist(), shingle)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
            yield replaced(batch, schema, {"shingles": lists})

    return met.mapInArrow(run, schema).groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes of which the sets have this Jaccard similarity or more."""
    side = lambda n: sets.select(F.col("node").alias(n), F.col("shingles").alias(f"__{n}"))
    both = F.size(F.array_intersect("__a", "__b"))
    whole = F.size("__a") + F.size("__b") - both
    return pairs.join(side("b"), "b").join(side("a"), "a").where(both >= F.lit(similarity) * whole - 1e-9).select("a", "b")


def similar_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, recall: float = 0.95, slack: float = 2.5, bucket: int = 4) -> DataFrame:
    """One row for each row of ``df``: the id and ``component_id``, the smallest id that can be reached over links of texts with this Jaccard similarity of their different shingles, or more.

    recall: how many pairs of just this similarity share a block; of more similar ones more do. Pairs are sifted by Hamming distance over all bits, with ``slack`` standard deviations over the
    distance that is expected at the similarity, and then verified by their shingles. Texts of one whole fingerprint are one node and are not compared.
    """
    folder = shared_folder(df.sparkSession)
    blocks, width = blocks_for(df.count(), similarity, recall)
    bits, share = blocks * width, differing(similarity)
    bound = lambda n, over: math.floor(n * share + over * math.sqrt(n * share * (1 - share)))
    marked = stored(long_fingerprints(df, id_col, text_col, shingle, blocks, width), folder, "fingerprints")
    first = marked.groupBy("blocks", "probe").agg(F.min("id").alias("first"), F.min_by(F.struct("id", "own", "n"), F.struct("id", "own")).alias("rep"))
    nodes = stored(first.withColumn("node", F.monotonically_increasing_id()), folder, "nodes")
    own = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.struct(*[F.get("blocks", (i + n) % blocks).alias(c) for n, c in enumerate(("key", "key2", "key3"))]))
    rows = nodes.select("node", "probe", F.posexplode(own).alias("block", "k")).select("node", "probe", "block", "k.*")
    most = bound(PROBE, 3)
    found, crowds = _meet(rows, ["block", "key"], bucket, most, folder, "shared-1")
    crowded = crowds
    for by in (["block", "key", "key2"], ["block", "key", "key2", "key3"]):
        more, crowded = _meet(crowded, by, bucket, most, folder, f"shared-{len(by) - 1}")
        found = found.unionByName(more)
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("blocks").alias(f"__{n}"), F.col("probe").alias(f"__p{n}"), F.col("rep.n").alias(f"__n{n}"))
    apart = F.aggregate(F.zip_with("__a", "__b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.bit_count(F.col("__pa").bitwiseXOR(F.col("__pb"))), lambda s, n: s + n)
    sized = F.least("__na", "__nb") >= F.lit(similarity) * F.greatest("__na", "__nb") - 1e-9
    shared = F.exists(F.zip_with("__a", "__b", lambda x, y: x == y), lambda same: same)
    sifted = lambda pairs: pairs.join(side("a"), "a").join(side("b"), "b").where(sized & shared).select("a", "b", apart.alias("apart")).where(F.col("apart") <= bound(bits + PROBE, slack))
    ends = lambda pairs: pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()

    def sets_of(used: DataFrame, name: str) -> DataFrame:
        wanted = stored(nodes.join(used, "node").select("node", F.col("rep.id").alias("id"), F.col("rep.own").alias("own")), folder, f"wanted-{name}")
        return stored(shingle_sets(df, wanted, id_col, text_col, shingle), folder, f"sets-{name}")

    near = stored(sifted(stored(found.distinct(), folder, "pairs")), folder, "near")
    sets = sets_of(ends(near), "first")
    star = lambda groups: groups.select(F.col("root").alias("a"), F.col("node").alias("b"))
    nearest = near.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("m")).select("m.a", "b")
    groups = stored(components(_alike(nearest, sets, similarity), f"{folder}/nearest"), folder, "groups")
    end = lambda n: groups.select(F.col("node").alias(n), F.col("root").alias(f"__r{n}"))
    between = near.join(nearest, ["a", "b"], "left_anti").join(end("a"), "a", "left").join(end("b"), "b", "left")
    between = between.where(F.coalesce("__ra", "a") != F.coalesce("__rb", "b")).select("a", "b")
    roots = components(star(groups).unionByName(_alike(between, sets, similarity)), f"{folder}/between")

    def further(pairs: DataFrame, name: str) -> DataFrame:
        left = stored(sifted(pairs.join(near.select("a", "b"), ["a", "b"], "left_anti")), folder, f"near-{name}")
        return components(star(roots).unionByName(_alike(left.select("a", "b"), sets, similarity)), f"{folder}/{name}") if left.limit(1).count() else roots

    grouped = lambda d: d.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = grouped(crowds.select("block", "key", "node", "probe").join(nodes.select("node", F.col("rep.n").alias("n")), "node"))
    parted = stored(_parted(placed, ["block", "key"], similarity, most, folder), folder, "parted")
    if parted.limit(1).count():
        sets = sets.unionByName(sets_of(parted.select("node").join(sets.select("node"), "node", "left_anti"), "parted"))
        postings = stored(_postings(parted, sets, similarity), folder, "postings")
        roots = further(_foremost(grouped(postings), similarity, most), "foremost")
        roots = further(_across(grouped(postings), similarity, most, folder), "across")
    named = _named(nodes.select("node", "first"), "node", roots)
    whole = nodes.select("node", "blocks", "probe").join(named, "node").drop("node")
    return marked.join(whole, ["blocks", "probe"]).select(F.col("id").alias(id_col), "component_id")


def as_hex(fingerprint: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
