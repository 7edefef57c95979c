"""Merkle manifest of a dataset by incremental witnesses.

A leaf is the digest of a row. The leaves of a tree (a source) stand by id and are cut into aligned blocks of ``ARITY ** LEVELS``. A task streams the leaves of a
block into an :class:`Appender`: every open subtree keeps the partial witnesses of its leaves, and when the siblings of a subtree are complete each of
its leaves' witnesses is extended by their digests. The roots of blocks are the leaves of the next round and are appended in the same way,
blocks of blocks on further tasks, until each tree has one node; the roots of the trees are appended once more, to the root of all. No task holds more than one block, whatever
the size of a tree, and the number of rounds is the logarithm of the largest tree by base ``ARITY ** LEVELS``.

Leaves are numbered by a range partitioning, so that one source that holds most rows is spread over all tasks; the counts of each task and source
give the numbers. A leaf's whole witness is its own, then that of its block, then that of the block's block, joined by block. Each step is written to the shared folder.

A witness is a byte for each level (place * 4 + number of siblings, itself included), each followed by the other siblings' digests from left to right.

Defined results: null columns are written as ``-``; null ids come first and are not tampered with; a null source is a tree of its own, the first; rows of one id stand by their leaves, and repeated rows
are leaves each; extra columns are left out; an empty table has no leaves and gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partloom.llm.common import shared_folder, stored
from partloom.llm.decontamination import few

#: Children of a node, and levels of a block: 729 leaves.
ARITY, LEVELS = 3, 6
#: The columns of a leaf, in their order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the columns: ``-`` for null, else the UTF-8 bytes' number, a colon and the value."""
    strings = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)) for s in strings]), 256)


def joined(nodes: Sequence[bytes]) -> bytes:
    """The digest of nodes that stand together, written in hex."""
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def levels_of(n: int) -> int:
    """Levels above n nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


class Appender:
    """One aligned block: nodes are appended from the left; ``witnesses`` are theirs, extended as siblings are completed."""

    def __init__(self, levels: int):
        self.levels = levels
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(levels + 1)]  # of each level: digest, first and last leaf of nodes that await siblings
        self.witnesses: list[bytearray] = []

    def append(self, node: bytes) -> None:
        self.witnesses.append(bytearray())
        self._place(0, (node, len(self.witnesses) - 1, len(self.witnesses)))

    def _place(self, level: int, node: tuple[bytes, int, int]) -> None:
        self.open[level].append(node)
        if level < self.levels and len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for place, (_, first, last) in enumerate(run):
            more = bytes([place * 4 + len(run)]) + b"".join(d for k, (d, _, _) in enumerate(run) if k != place)
            for leaf in range(first, last):
                self.witnesses[leaf] += more
        self._place(level + 1, (joined([d for d, _, _ in run]), run[0][1], run[-1][2]))

    def close(self) -> bytes:
        """The root of the block: what is still open is completed with the siblings it has, from the lowest level."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        ((root, _, _),) = self.open[self.levels]
        return root


def siblings(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place, the other siblings) of each level."""
    at = 0
    while at < len(witness):
        place, size = divmod(witness[at], 4)
        yield place, [witness[at + 1 + 32 * k : at + 33 + 32 * k] for k in range(size - 1)]
        at += 1 + 32 * (size - 1)


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and a witness lead to."""
    for place, others in siblings(witness):
        leaf = joined([*others[:place], leaf, *others[place:]])
    return leaf


def proof(witness: bytes) -> bytes:
    return joined([d for _, others in siblings(witness) for d in others])


def numbered(nodes: DataFrame, order: Sequence[str], folder: str, name: str) -> DataFrame:
    """Adds ``rank`` (from 0) inside each ``tree`` by ``order``, and ``n``, the tree's number of nodes. A tree may hold most rows: it lies in many ranges."""
    by = ["tree", *order]
    ordered = nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
    placed = stored(ordered.withColumn("part", F.shiftright("row", 33)), folder, f"{name}-ordered")
    parts = placed.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.select("tree", "part", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(Window.partitionBy("tree")).alias("n"))
    return placed.join(few(stored(counts, folder, f"{name}-counts")), ["tree", "part"]).withColumn("rank", F.col("row") + F.col("shift")).drop("row", "part", "shift")


def _appended(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, rank, n, block, witness, root) of nodes (tree, rank, n, digest): every block streamed through an :class:`Appender`."""
    width = ARITY**levels
    ready = nodes.select("tree", "rank", "n", "digest", F.floor(F.col("rank") / width).alias("block")).repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    schema = "tree string, rank long, n long, block long, witness binary, root binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None

        def done() -> pa.RecordBatch:
            root = block.close()
            names = ["tree", "rank", "n", "block", "witness", "root"]
            columns = [[h[0] for h in held], [h[1] for h in held], [h[2] for h in held], [h[3] for h in held], [bytes(w) for w in block.witnesses], [root] * len(held)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for tree, rank, n, node, number in zip(*[batch.column(c).to_pylist() for c in ("tree", "rank", "n", "digest", "block")], strict=True):
                if (tree, number) != key:
                    if held:
                        yield done()
                    key, held, block = (tree, number), [], Appender(min(levels, levels_of(n)))
                block.append(node)
                held.append((tree, rank, n, number))
        if held:
            yield done()

    return ready.mapInArrow(run, schema)


def grown(leaves: DataFrame, folder: str, name: str, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Witnesses (tree, rank, witness) of leaves (tree, rank, n, digest), and the trees' roots (tree, root). Each round's block roots are appended in the next."""
    rounds, nodes = [], leaves.select("tree", "rank", "n", "digest")
    while True:
        step = stored(_appended(nodes, levels), folder, f"{name}-{len(rounds)}")
        rounds.append(step)
        blocks = step.where(F.col("rank") % ARITY**levels == 0).select("tree", F.col("block").alias("rank"), F.ceil(F.col("n") / ARITY**levels).alias("n"), F.col("root").alias("digest"))
        if not step.where(F.col("n") > ARITY**levels).limit(1).count():
            break
        nodes = blocks
    roots = blocks.select("tree", F.col("digest").alias("root"))
    above = rounds[-1].select("tree", "rank", "witness")
    for step in reversed(rounds[:-1]):
        upper = above.select("tree", F.col("rank").alias("block"), F.col("witness").alias("more"))
        above = step.join(upper, ["tree", "block"]).select("tree", "rank", F.concat("witness", "more").alias("witness"))
    return above, roots


def tampered(text: Column, id_: Column) -> Column:
    """The text without its newlines where 2 divides the crc32 of the id in decimal: a planted fault, by which verification can be tested on any corpus."""
    return F.when(F.crc32(F.encode(id_.cast("string"), "utf-8")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


def manifest(df: DataFrame, folder: str, id_col: str = "doc_id", tree_col: str = "source", columns: Sequence[str] = COLUMNS, found: Sequence[Column] | None = None) -> DataFrame:
    """(id, tree, leaf, checked, subroot, root, witness), digests as binary, one row for each row of ``df``.

    found: the columns as a reader finds them, of which ``checked`` is the leaf; by default those of the rows.
    """
    own = [F.col(f"`{c}`") for c in columns]
    tree = F.when(F.col(f"`{tree_col}`").isNull(), "").otherwise(F.concat(F.lit("="), F.col(f"`{tree_col}`").cast("string")))  # null first
    leaves = df.select(F.col(f"`{id_col}`").alias("id"), tree.alias("tree"), F.unhex(digest(own)).alias("digest"), F.unhex(digest(found or own)).alias("checked"))
    ranked = stored(numbered(stored(leaves, folder, "leaves"), ["id", "digest", "checked"], folder, "leaves"), folder, "leaves-ranked")
    witnesses, subroots = grown(ranked, folder, "trees")
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    tops = stored(numbered(named, ["name"], folder, "tops"), folder, "tops-ranked")
    top_witnesses, root = grown(tops, folder, "root")
    trees = tops.join(top_witnesses, ["tree", "rank"]).join(root, "tree").select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("witness").alias("more"), "root")
    whole = ranked.select("id", "tree", "rank", "digest", "checked").join(witnesses, ["tree", "rank"])
    return whole.join(few(stored(trees, folder, "trees-rooted")), "tree").select("id", "tree", F.col("digest").alias("leaf"), "checked", "subroot", "root", F.concat("witness", "more").alias("witness"))


def verified(manifested: DataFrame) -> DataFrame:
    """Of each row of :func:`manifest`: id, leaf, subroot, root, proof_sha256, folded_root (lowercase hex), and whether the leaf as found leads to the root."""
    schema = f"id {manifested.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, subroot, root, checked, witness = (batch.column(c).to_pylist() for c in ("leaf", "subroot", "root", "checked", "witness"))
            ends = [folded(c, w) for c, w in zip(checked, witness, strict=True)]
            columns = [pa.array([d.hex() for d in x], pa.string()) for x in (leaf, subroot, root, map(proof, witness), ends)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return manifested.mapInArrow(run, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def verify_dataset(df: DataFrame, id_col: str = "doc_id", tree_col: str = "source", columns: Sequence[str] = COLUMNS, text_col: str = "text") -> DataFrame:
    """The manifest of ``df``, and its verification against rows of which the text was tampered with (:func:`tampered`)."""
    found = [tampered(F.col(f"`{c}`"), F.col(f"`{id_col}`")) if c == text_col else F.col(f"`{c}`") for c in columns]
    return verified(manifest(df, shared_folder(df.sparkSession), id_col, tree_col, columns, found)).withColumnRenamed("id", id_col)
