"""Exact duplicates by skew-safe combining, with DataFrame functions only.

1. Each task combines equal texts of its own rows (the partial aggregation before
   the first shuffle), under the text's SHA-256 and a salt that is the task's number modulo ``salts``.
2. Groups of one digest and salt are merged; a group that holds a third of all rows is
   spread over ``salts`` tasks, each of which gets one row from each task before.
3. The winners of the salts are combined for the whole table: at most ``salts`` rows a group.

All three stages have the full text among their keys, so that it is compared in full and
two texts with one digest stay apart. Then every row looks up its group by the digest.
Should a digest hold two texts, the rows look their group up by digest and text instead.

Defined results: null is the empty text; of equal texts the largest id stays; rows that repeat one
id are rows of one document and are all kept if it is; a null id is smaller than any other (if all are null, ``keep_id`` is null
and the rows are kept); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import shared_folder, stored, texts


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32, digest: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row for each row of ``df``: id, ``keep_id``, ``group_size`` long, ``kept`` boolean, ``text_sha256``.

    digest: another function of the text than its SHA-256, as the key of groups (for tests).
    """
    key = digest or (lambda c: F.unhex(F.sha2(c, 256)))
    rows = texts(df, id_col, text_col).select(id_col, "__text", key(F.col("__text")).alias("__digest"))
    local = rows.withColumn("__salt", F.spark_partition_id() % F.lit(salts))
    salted = local.groupBy("__salt", "__digest", "__text").agg(F.max(id_col).alias("keep"), F.count(F.lit(1)).alias("size"))
    whole = salted.groupBy("__digest", "__text").agg(F.max("keep").alias("keep_id"), F.sum("size").alias("group_size"))
    folder = shared_folder(df.sparkSession)
    if digest is None:
        groups = stored(whole.select("__digest", "keep_id", "group_size"), folder, "groups")
        shared = groups.groupBy("__digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    else:
        groups, shared = whole, 1
    if shared:
        found = rows.join(whole, ["__digest", "__text"]).withColumn("text_sha256", F.sha2("__text", 256))
    else:
        found = rows.drop("__text").join(groups, "__digest").withColumn("text_sha256", F.lower(F.hex("__digest")))
    return found.select(id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
