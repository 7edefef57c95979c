"""Registration, and the tables that several queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("asset_id"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("view_id"), F.col("l_linenumber").cast("long").alias("line"),
        F.col("l_quantity").alias("weight"), F.round(F.col("l_discount") * 10, 6).alias("score"), F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("status"), F.round("l_extendedprice", 2).alias("price"), F.round("l_tax", 4).alias("tax"),
    )


OBS = """obs AS (SELECT l_orderkey AS asset_id, l_partkey AS part_id, l_suppkey AS view_id, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS weight, round(l_discount * 10, 6) AS score,
  l_returnflag AS category, l_linestatus AS status, round(l_extendedprice, 2) AS price, round(l_tax, 4) AS tax FROM lineitem)"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(k.alias("part_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").cast("long").alias("size"), F.col("p_retailprice").alias("price"), *[(k * m % 256).alias(c) for c, m in (("r", 37), ("g", 91), ("b", 151))])


PARTS = """parts AS (SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type AS type, CAST(p_size AS BIGINT) AS size, p_retailprice AS price,
  p_partkey * 37 % 256 AS r, p_partkey * 91 % 256 AS g, p_partkey * 151 % 256 AS b FROM part)"""


def rounded(df: DataFrame, digits: int = 6, shift: float = 0.0) -> DataFrame:
    """All doubles, moved by ``shift``, rounded to so many digits for comparison with another engine: the scaled binary number to the nearest whole one, halves away from zero."""
    scale = float(10**digits)
    near = lambda c: F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale + 0.0
    return df.select(*[F.when(F.abs(c) < 1e9, near(F.col(c) + shift)).otherwise(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def linear(c: str) -> str:
    return f"(CASE WHEN {c} <= 0.04045 THEN {c} / 12.92 ELSE power(({c} + 0.055) / 1.055, 2.4) END)"


def lab_sql(source: str, keep: str, name: str = "lab") -> str:
    """CTEs that add lab_l, lab_a, lab_b (from r, g, b of 0 to 255) to the columns ``keep`` of ``source``."""
    f = lambda t: f"(CASE WHEN {t} > power(6.0 / 29, 3) THEN power({t}, 1.0 / 3) ELSE {t} * power(29.0 / 6, 2) / 3 + 4.0 / 29 END)"
    lin = ", ".join(f"{linear(f'(CAST({c} AS DOUBLE) / 255)')} AS l{c}" for c in "rgb")
    return f"""{name}_1 AS (SELECT {keep}, {lin} FROM {source}),
{name}_2 AS (SELECT {keep}, (0.4124564 * lr + 0.3575761 * lg + 0.1804375 * lb) / 0.95047 AS x, 0.2126729 * lr + 0.7151522 * lg + 0.0721750 * lb AS y, (0.0193339 * lr + 0.1191920 * lg + 0.9503041 * lb) / 1.08883 AS z FROM {name}_1),
{name} AS (SELECT {keep}, 116 * {f('y')} - 16 AS lab_l, 500 * ({f('x')} - {f('y')}) AS lab_a, 200 * ({f('y')} - {f('z')}) AS lab_b FROM {name}_2)"""
