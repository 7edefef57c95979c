"""The registered queries of the engine's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partloom.queries import base, exact, images, joining, planning, ranking, rounds, second, voting  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.QUERIES["x12_part_plan"](spark, sf_dir)


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.ORACLE)
