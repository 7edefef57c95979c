"""Benchmark decontamination with a distributed positional inverted index, with DataFrame functions only.

1. The terms of the benchmark get numbers, and every posting (term, document, position) of these terms is stored, sorted by
   term in each shard of the corpus, so that a look-up reads the row groups of its terms. A shard is what one task reads of the corpus; nothing
   is shuffled for it while the terms are few enough to be broadcast. One more posting of each document, of no term, holds its number of words.
2. A window of a test item (``length`` words; shorter items are one window) is looked up from its rarest term: each posting of that is a candidate.
   The candidates meet the postings of the second rarest term, and those that are left meet all others. A
   posting meets a candidate by term, document and block of positions; its offset from the candidate tells which place of the window it
   takes. Phrases are candidates of which every place is taken; proximity matches are those
   around which all terms of the window stand within ``near`` words.

Lists of candidates are broadcast while they have at most ``BROADCAST_ROWS`` rows of a few numbers each; beyond, both sides are shuffled.

Defined results: null and empty texts have no words; items without words never match; repeated rows and rows
with a null id are documents of their own; equal windows of several items count for each; empty tables give empty
tables (an empty benchmark: no hits); extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partloom.llm.common import shared_folder, stored, texts

#: The words of texts with A-Z lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that are broadcast at most: terms, counts, windows and candidates of a few numbers each (some 20 MB).
BROADCAST_ROWS = 100_000
#: The number of the posting that holds a document's number of words.
WORDS = -1


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased. For ASCII texts lower() does the same, faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def few(df: DataFrame) -> DataFrame:
    """A stored table, broadcast if it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def build_index(df: DataFrame, terms: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings (t, row, pos) of the numbered terms (term, t), and one of each document with its id and its number of words as position."""
    rows = texts(df, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.concat(words(F.col("__text")), F.array(F.lit(""))).alias("terms"))
    postings = rows.select("row", "id", F.posexplode("terms").alias("pos", "term")).join(few(terms), "term")
    return stored(postings.select("t", "row", F.col("pos").cast("long").alias("pos"), F.when(F.col("t") == WORDS, F.col("id")).alias("id")).sortWithinPartitions("t", "row", "pos"), folder, "index")


def windows(items: DataFrame, item_col: str, text_col: str, length: int) -> DataFrame:
    """Distinct windows with the ids of their items."""
    terms = items.select(F.col(item_col).cast("string").alias("item"), words(F.coalesce(F.col(text_col), F.lit(""))).alias("terms")).where(F.size("terms") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("terms") - (length - 1))))
    each = terms.select("item", "terms", starts.alias("at")).select("item", F.slice("terms", F.col("at"), F.lit(length)).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def lookups(index: DataFrame, each: DataFrame, terms: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Windows of which the corpus has all terms (w, items, size, places: all places of the window as bits, then of its rarest term: t, offset, own places, and
    the second rarest one), and their terms by rarity (w, t, places, rank)."""
    numbered = stored(each.select(F.monotonically_increasing_id().alias("w"), "window", "items"), folder, "windows")
    counts = index.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    placed = numbered.select("w", F.posexplode("window").alias("offset", "term")).join(few(terms), "term")
    by_term = placed.groupBy("w", "t").agg(F.min("offset").alias("offset"), F.bit_or(F.expr("shiftleft(1L, offset)")).alias("places"))
    rarity = F.row_number().over(Window.partitionBy("w").orderBy("n", "t"))
    lists = stored(by_term.join(few(stored(counts, folder, "counts")), "t", "left").withColumn("rank", rarity), folder, "lists")
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    heads = lists.groupBy("w").agg(F.count("n").alias("known"), F.count(F.lit(1)).alias("all"), at(1, "t").alias("t"), at(1, "offset").alias("offset"), at(1, "places").alias("first"), F.coalesce(at(2, "places"), F.lit(0)).alias("second"))
    looked = numbered.select("w", "items", F.size("window").alias("size")).join(heads.where(F.col("known") == F.col("all")).drop("known", "all"), "w")
    return stored(looked.withColumn("places", F.expr("shiftleft(1L, size) - 1")), folder, "lookups"), lists.select("w", "t", "places", "rank")


def meet(candidates: DataFrame, lists: DataFrame, index: DataFrame, length: int, near: int) -> DataFrame:
    """The candidates with the places that postings of ``lists`` take: ``exact`` at their offsets, ``close`` within ``near`` words."""
    reach = max(length - 1, near)
    width = 2 * reach + 8
    block = lambda pos: F.floor(pos / width)
    keys = ["w", "row", "pos"]
    wanted = candidates.join(few(lists), "w").select(*keys, "offset", "t", "places", F.explode(F.array_distinct(F.array(block(F.col("pos") - reach), block(F.col("pos") + reach)))).alias("block"))
    held = index.join(few(lists.select("t").distinct()), "t", "left_semi")
    documents = candidates.select("row").distinct()
    if documents.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # else the join by document would shuffle what it should sift
        held = held.join(F.broadcast(documents), "row", "left_semi")
    postings = held.select("t", "row", F.col("pos").alias("at"), block(F.col("pos")).alias("block"))
    met = postings.join(few(wanted), ["t", "row", "block"])
    place, away = F.col("at") - F.col("pos") + F.col("offset"), F.abs(F.col("at") - F.col("pos"))
    bit = F.when(place.between(0, length - 1), F.expr("shiftleft(1L, int(at - pos + offset))").bitwiseAND(F.col("places")))
    taken = met.select(*keys, F.coalesce(bit, F.lit(0)).alias("exact"), F.when(away <= near, F.col("places")).otherwise(0).alias("close"))
    return taken.unionByName(candidates.select(*keys, "exact", "close")).groupBy(*keys).agg(F.bit_or("exact").alias("exact"), F.bit_or("close").alias("close"))


def matches(index: DataFrame, looked: DataFrame, lists: DataFrame, folder: str, length: int, near: int) -> DataFrame:
    """(row, start, size, items, exact): phrase matches, and proximity matches that are not phrases."""
    heads = few(looked.select("w", "t", "offset", "first"))
    close = F.col("first") if near > 0 else F.lit(0).cast("long")
    found = index.join(heads, "t").select("w", "row", "pos", F.expr("shiftleft(1L, offset)").alias("exact"), close.alias("close"))
    offsets, parts = few(looked.select("w", "offset")), few(looked.select("w", "items", "size", "offset", "places", "first", "second"))
    whole = lambda taken, places: F.col(taken).bitwiseAND(F.col(places)) == F.col(places)
    for name, step in (("rarest", lists.where("rank = 2")), ("others", lists.where("rank > 2 or (rank = 1 and bit_count(places) > 1)"))):
        candidates = stored(found, folder, name)
        found = meet(candidates.join(offsets, "w"), step, index, length, near)
        if name == "rarest":
            found = found.join(parts.select("w", "second"), "w").where(whole("exact", "second") | whole("close", "second") & F.lit(near > 0)).drop("second")
    found = found.join(parts, "w").where(whole("exact", "places") | whole("close", "places") & F.lit(near > 0))
    return found.select("row", (F.col("pos") - F.col("offset")).alias("start"), F.col("size").cast("long").alias("size"), "items", whole("exact", "places").alias("exact"))


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", length: int = 10, near: int = 0) -> DataFrame:
    """One row for each row of ``df``: id, ``n_words``, ``n_hit`` (words inside exact matches), ``items`` (sorted ids of items with exact matches),
    ``near_items`` (of items with proximity matches only), ``contaminated``."""
    if length > 62:
        raise ValueError("windows have at most 62 words")
    spark = df.sparkSession
    folder = shared_folder(spark)
    each = stored(windows(items, item_col, item_text_col, length), folder, "distinct")
    none = spark.range(1).select(F.lit("").alias("term"), F.lit(WORDS).cast("long").alias("t"))
    terms = stored(each.select(F.explode("window").alias("term")).distinct().select("term", F.monotonically_increasing_id().alias("t")).unionByName(none), folder, "terms")
    index = build_index(df, terms, folder, id_col, text_col)
    looked, lists = lookups(index, each, terms, folder)
    found = matches(index, looked, lists, folder, length, near)
    ids = lambda flag: F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(flag, F.col("items"))))))
    spans = F.array_sort(F.collect_set(F.when(F.col("exact"), F.struct("start", "size"))))
    by_row = found.groupBy("row").agg(spans.alias("spans"), ids(F.col("exact")).alias("items"), ids(~F.col("exact")).alias("near_items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(F.greatest(a["end"], s["start"] + s["size"]).alias("end"), (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("n")),
        lambda a: a["n"],
    )
    by_row = by_row.select("row", covered.alias("n_hit"), "items", F.array_except("near_items", "items").alias("near_items"))
    none = F.array().cast("array<string>")
    out = index.where(F.col("t") == WORDS).select("row", "id", F.col("pos").alias("n_words")).join(by_row, "row", "left")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")
    )
