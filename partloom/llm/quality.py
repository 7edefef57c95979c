"""Quality rules with adaptive thresholds from mergeable quantile sketches.

1. Each text gives whole-number counts and, from them, whole-number measures (shares in ten-thousandths, letters of a word in hundredths).
2. A sketch of a measure is a list of buckets with counts: values below ``EXACT`` have a bucket each, greater ones share a bucket as wide as their highest bits but
   six, so that a quantile is at most 1/32 too low, whatever the number of values and their order. Sketches merge by adding the counts of equal buckets; a task
   adds up its own before anything is shuffled, so a source that holds most rows costs a few hundred rows a task.
3. Quantiles of each language and source give its thresholds: the quartile and ``REACH`` times the distance of the quartiles (a least distance, if they are closer) beyond it.
   A group of fewer than ``LEAST`` documents takes those of its language, and a small language those of all: merged sketches.
4. The thresholds are joined with the documents: a document is kept if its base rules hold and no measure lies beyond.

Words are runs other than ASCII white space. A window is three consecutive words; windows found twice or more in a text make all their words repeated.

Defined results: null and empty texts, and texts of white space, have no words, fail the base rules and count in no sketch; null languages and sources are groups of their own;
repeated rows count each; extra columns are left out; a table without a text that passes the base rules has no thresholds and keeps nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.llm.common import bounded_batches, released, replaced, shared_folder, slices, stored, texts, with_fields
from partloom.llm.decontamination import few

#: Characters that count as symbols, and white space.
SYMBOL = r"[#*$%&|<>]"
_SPACE = " \t\n\x0b\x0c\r"
_OTHER_SPACE = dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")
#: Base rules: the least words, and the largest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Values below have a bucket each; a power of two.
EXACT = 64
#: Fewest documents of a group with thresholds of its own, and how many quartile distances are allowed beyond a quartile.
LEAST, REACH = 100, 3
#: Of each measure: SQL for its value, the least distance of the quartiles, and on which sides it is bounded.
MEASURES = {
    "word_length": ("100 * word_chars div nullif(n_words, 0)", 50, (True, True)),
    "symbols": ("10000 * n_symbols div nullif(word_chars, 0)", 100, (False, True)),
    "dup_lines": ("10000 * n_dup_lines div n_lines", 1200, (False, True)),
    "repeats": ("10000 * n_repeat_words div nullif(n_words, 0)", 1200, (False, True)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated(words: pa.Array, texts_of: np.ndarray, n: int) -> np.ndarray:
    """Of each of ``n`` texts, its words that stand in a window of three found twice or more in it. texts_of: the text of each word, in order."""
    out = np.zeros(n, np.int64)
    if len(words) < 3:
        return out
    ids = words.dictionary_encode()
    number, many = ids.indices.to_numpy().astype(np.int64), len(ids.dictionary)
    inside = np.flatnonzero(texts_of[2:] == texts_of[:-2])
    key = texts_of[inside].astype(np.int64)
    for k in range(3):
        _, key = np.unique(key * many + number[inside + k], return_inverse=True)
    again = inside[np.bincount(key)[key] > 1] if len(key) else inside
    met = np.zeros(len(number), bool)
    for k in range(3):
        met[again + k] = True
    return np.bincount(texts_of[met], minlength=n).astype(np.int64)


def counts_of(column: Sequence[str]) -> dict[str, np.ndarray]:
    """The counts of some whole texts."""
    n = len(column)
    words, lines, twice = [], np.zeros(n, np.int64), np.zeros(n, np.int64)
    n_words, chars = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(column):
        own = [w for w in text.translate(_OTHER_SPACE).split(" ") if w]
        split = text.split("\n")
        full = [x for x in split if x.strip(_SPACE)]
        n_words[i], chars[i], lines[i], twice[i] = len(own), sum(map(len, own)), len(split), len(full) - len(set(full))
        words.append(pa.array(own, pa.string()))
    flat = pa.concat_arrays(words)
    symbols = pc.count_substring_regex(pa.array(column, pa.string()), SYMBOL).to_numpy().astype(np.int64)
    return dict(zip(COUNTS, (n_words, chars, symbols, lines, twice, repeated(flat, np.repeat(np.arange(n), n_words), n)), strict=True))


def counted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """The id, the columns to carry, and the counts of each whole text. No shuffle."""
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col, carry)
    schema = with_fields(rows, ["__text"], [(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for batch in slices(batches, by="__text"):
            found = counts_of(batch.column("__text").to_pylist())
            yield replaced(batch, schema, {c: pa.array(x) for c, x in found.items()})

    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bucket(value: Column) -> Column:
    """The least value of the bucket that a whole number from 0 up is in."""
    bits = F.length(F.bin(value)) - F.lit(EXACT.bit_length() - 1)
    return F.when(value < EXACT, value).otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)).cast("long")


def sketches(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, measure, bucket, n) of rows (keys, measure, value)."""
    return values.select(*keys, "measure", bucket(F.col("value")).alias("bucket")).groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return parts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[int, int]]) -> DataFrame:
    """(keys, measure, size, and of each name in ``wanted`` the quantile p / q): the bucket that holds the value of rank ceil(size * p / q)."""
    by = [*keys, "measure"]
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("bucket"))
    total = F.sum("n").over(Window.partitionBy(*by))
    ranked = sketch.select(*by, "bucket", upto.alias("upto"), total.alias("size"))
    return ranked.groupBy(*by).agg(F.first("size").alias("size"), *[F.min(F.when(F.col("upto") * q >= F.col("size") * p, F.col("bucket"))).alias(name) for name, (p, q) in wanted.items()])


def thresholds(documents: DataFrame, folder: str, group: str = "source", within: str = "lang") -> DataFrame:
    """(within, group, bounds: map of measure to size, low, high) for each group that has documents: its own, or else those of ``within``, or else those of all."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(sql).alias("value")) for m, (sql, _, _) in MEASURES.items()]))
    measured = documents.where(~base_failed()).select(within, group, values.alias("v")).select(within, group, "v.*")
    fine = stored(sketches(measured, [within, group]), folder, "sketches")
    spread = F.element_at(F.create_map(*[F.lit(x) for m, (_, least, _) in MEASURES.items() for x in (m, least)]), F.col("measure"))

    def bounds(keys: Sequence[str], sketch: DataFrame, name: str) -> DataFrame:
        found = quantiles(sketch, keys, {"q1": (1, 4), "q3": (3, 4)})
        reach = REACH * F.greatest(F.col("q3") - F.col("q1"), spread)
        entry = F.struct("measure", F.struct("size", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")))
        return found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(name), F.max("size").alias(f"{name}_size"))

    every = bounds([], merged(fine, []), "every").first()["every"] or {}  # a few numbers
    of_all = F.create_map(*[x for m, b in every.items() for x in (F.lit(m), F.struct(F.lit(b["size"]).alias("size"), F.lit(b["low"]).alias("low"), F.lit(b["high"]).alias("high")))]) if every else F.lit(None)
    groups = documents.select(within, group).distinct()
    mine = bounds([within, group], fine, "mine").select(F.col(within).alias("__w"), F.col(group).alias("__g"), "mine", "mine_size")
    theirs = bounds([within], merged(fine, [within]), "theirs").select(F.col(within).alias("__t"), "theirs", "theirs_size")
    out = groups.join(mine, F.col(within).eqNullSafe(F.col("__w")) & F.col(group).eqNullSafe(F.col("__g")), "left").join(theirs, F.col(within).eqNullSafe(F.col("__t")), "left")
    enough = lambda c: F.when(F.col(f"{c}_size") >= LEAST, F.col(c))
    return out.select(within, group, F.coalesce(enough("mine"), enough("theirs"), of_all.cast("map<string,struct<size:bigint,low:bigint,high:bigint>>")).alias("bounds"))


def judged(documents: DataFrame, limits: DataFrame, group: str = "source", within: str = "lang") -> DataFrame:
    """Adds ``base_failed``, ``beyond`` (the measures that lie beyond the thresholds of the document's group) and ``kept``."""
    limit = few(limits.withColumnsRenamed({within: "__w", group: "__g"}))
    joined = documents.join(limit, F.col(within).eqNullSafe(F.col("__w")) & F.col(group).eqNullSafe(F.col("__g")), "left").drop("__w", "__g")
    beyond = []
    for m, (sql, _, (low, high)) in MEASURES.items():
        value, bound = F.expr(sql), F.element_at("bounds", F.lit(m))
        outside = (F.lit(low) & (value < bound["low"])) | (F.lit(high) & (value > bound["high"]))
        beyond.append(F.when(outside, m))
    found = F.when(F.col("n_words") > 0, F.array_compact(F.array(*beyond))).otherwise(F.array().cast("array<string>"))
    out = joined.withColumn("base_failed", base_failed()).withColumn("beyond", found).drop("bounds")
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("beyond") == 0))


def filtered(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: str = "source", within: str = "lang") -> DataFrame:
    """One row for each row of ``df``: id, ``within``, ``group``, the counts, ``base_failed``, ``beyond`` and ``kept``."""
    folder = shared_folder(df.sparkSession)
    documents = stored(counted(df, id_col, text_col, [within, group]), folder, "counts")
    return judged(documents, stored(thresholds(documents, folder, group, within), folder, "thresholds"), group, within)
