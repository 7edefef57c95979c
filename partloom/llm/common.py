"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows, and bytes of text where a task asks for it, that a Python task turns into lists at one time, whatever Arrow's batch size is.
SLICE_ROWS, SLICE_BYTES = 256, 600_000


#: Rows in a batch between Spark and its Python workers, where the session has Spark's default. Whole texts make the default some ten times as large as the workers need, on both sides.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Sets the rows of a batch for jobs over whole texts, unless the session has a setting of its own."""
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


_held: dict = {}


def held(key: tuple, make: Callable):
    """What a Python worker keeps from one task to the next: the tables of one operator, and nothing of others that ran in it before."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def released() -> None:
    """For tasks that keep nothing: drops what other operators have left in the worker."""
    _held.clear()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or else the context's checkpoint directory: one that all executors see.

    Where neither is set, a local session (as in the tests) gets a temporary folder of this machine; on a
    cluster that is an error. Results are read from the folder when they are used, so it is deleted when the application ends.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "partloom-checkpoints")
        context.setCheckpointDir(root)
    folder = f"{root.rstrip('/')}/partloom-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Writes ``df`` as Parquet below ``folder`` and reads it again: cuts the lineage and survives lost executors."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def dropped(spark: SparkSession, folder: str) -> None:
    """Deletes a folder made by :func:`shared_folder`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def texts(df: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """The id, the text under the name ``text`` (null becomes empty) and the columns to carry, in this order.

    Columns that clash with a name an operator adds are left behind unless they are asked for.
    """
    keep = [c for c in carry if c not in (id_col, text_col)]
    return df.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"), *[F.col(f"`{c}`") for c in keep])


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, by: str = "", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Smaller batches, of at most ``rows`` rows; with the name of a text column, of some ``most`` bytes of it or of one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.arange(batch.num_rows) // rows
        if by:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(by)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            group = group * (size[-1] // most + 1) + size // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in pairwise(cuts):
            yield batch.slice(a, b - a)


def with_fields(df: DataFrame, dropping: Sequence[str], fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    """The schema of ``df`` without some columns and with ``fields`` at its end."""
    names = {name for name, _ in fields} | set(dropping)
    return T.StructType([f for f in df.schema.fields if f.name not in names] + [T.StructField(n, t) for n, t in fields])


def replaced(batch: pa.RecordBatch, schema: T.StructType, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with new columns, in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else batch.column(f.name) for f in schema.fields], names=schema.names)
