"""Partitions and joins that follow the rows a table will have and not the bytes of the files it comes from."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a partition, after each row of the table has become as many as it will.
PARTITION_ROWS = 500_000


def spread(df: DataFrame, keys: Sequence[str], each: int = 1) -> DataFrame:
    """The rows dealt by ``keys`` over as many partitions as they need once each has become ``each`` rows.

    What is grouped, ranked or joined by these keys and more stays where it is, without a further shuffle. The keys must be many.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * each // PARTITION_ROWS))
    return df.repartition(n, *keys)


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that is sorted and never broadcast: rows that were exploded, or read from files that compress well, are estimated at a fraction of their size."""
    return df.hint("merge")


#: Pairs that one task of :func:`met` compares, more or less, and its partitions at most.
TASK_PAIRS, MOST_PARTITIONS = 20_000_000, 10_000


def _dealt(left: DataFrame, right: DataFrame, on: Sequence[str], both: bool) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__share``, dealt over as many partitions as the pairs of their keys need, whatever the bytes of the tables.

    A key with more than ``TASK_PAIRS`` pairs is dealt over shares (l, r): a left row is in one l, a right row in one r, and each l meets each r. With ``both`` neither side is cut finer than
    the root of ``TASK_PAIRS`` asks for, so that rows are written as often as the pairs' root grows and not the pairs; else r is 1, and each share of left rows meets all right rows.
    """
    k = list(on)
    count = lambda d, n: d.groupBy(*k).agg(F.count(F.lit(1)).alias(n))
    pairs = count(left, "__m").join(merged(count(right, "__n")), k).withColumn("__pairs", (F.col("__m") * F.col("__n")).cast("double"))
    n = min(MOST_PARTITIONS, max(left.sparkSession.sparkContext.defaultParallelism, int((pairs.agg(F.sum("__pairs")).first()[0] or 0) // TASK_PAIRS) + 1))
    cut = F.ceil(F.col("__n") / math.sqrt(TASK_PAIRS)) if both else F.lit(1).cast("bigint")
    shares = merged(pairs.where(F.col("__pairs") > TASK_PAIRS).withColumn("__r", cut).select(*k, "__r", F.ceil(F.col("__pairs") / TASK_PAIRS / F.col("__r")).alias("__l")))
    whole = lambda c: F.coalesce(c, F.lit(1))

    def side(d: DataFrame, mine: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64(*[c for c in d.columns if c not in k]), whole(mine))
        met = d.join(shares, k, "left").withColumn(f"{mine}_at", own).withColumn(f"{other}_at", F.explode(F.sequence(F.lit(0).cast("bigint"), whole(other) - 1)))
        return met.withColumn("__share", F.struct("__l_at", "__r_at")).select(*d.columns, "__share").repartition(n, *k, "__share")

    return side(left, "__l", "__r"), side(right, "__r", "__l")


def met(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The inner join of two tables of which a key may hold very many pairs, in shares of bounded size."""
    l, r = _dealt(left, right, on, True)  # noqa: E741
    return l.join(merged(r), [*on, "__share"]).drop("__share")


def having(left: DataFrame, right: DataFrame, on: Sequence[str], such: Column) -> DataFrame:
    """The left rows that meet some right row of their key such that the condition on columns of both holds: as :func:`met`, but no pair is made. Further columns have different names on both sides."""
    l, r = _dealt(left, right, on, False)  # noqa: E741
    k = [*on, "__share"]
    for c in k:
        r, such = r.withColumnRenamed(c, f"__of_{c}"), such & (F.col(c) == F.col(f"__of_{c}"))
    return l.join(merged(r), such, "left_semi").drop("__share")
