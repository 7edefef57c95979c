"""Sealed tables: written aside, described by a manifest with hashes, and published by one rename.

A table is written into a staged folder beside its place, read again from there, and hashed: a digest for each key and each vector, and sums over all rows that do not depend on
their order. The manifest with these is written last, and the staged folder takes its final name in one rename. So a table is either there whole, with a manifest that
speaks for it, or it is not there; a writer that dies leaves a staged folder that no reader opens and that :func:`drop_staged` removes. A table that
is there is never overwritten. On file systems whose rename copies (object stores), give a folder of one that renames.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.plans.rules import framed, sealed_digest

#: Names inside a sealed table's folder, and the mark of a staged one.
DATA, SEAL, MANIFEST, STAGED = "data", "seal", "manifest.json", ".staged-"


class SealBroken(ValueError):
    """A sealed table is missing, incomplete, or does not hold what its manifest says."""


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _sum(digest: Column) -> Column:
    """A sum of the first 15 hex digits of digests: it grows with every row and not with their order."""
    return F.coalesce(F.sum(F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")


def vector_digest(vector: str) -> Column:
    """SHA-256 of a vector's numbers in order; null for no vector."""
    return F.when(F.col(vector).isNotNull(), F.sha2(F.array_join(F.transform(vector, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), ","), 256))


def measure(data: DataFrame, vectors: Sequence[str] = ()) -> dict[str, object]:
    """Number of rows, columns, and the sums of row and vector digests of a table."""
    columns = sorted(data.columns)
    row = F.sha2(framed(columns), 256)
    found = data.agg(F.count(F.lit(1)).alias("rows"), _sum(row).alias("row_sum"), *[_sum(vector_digest(v)).alias(f"v_{i}") for i, v in enumerate(vectors)]).first()
    return {"rows": found["rows"], "columns": [[c, t] for c, t in sorted(data.dtypes)], "row_sum": found["row_sum"], "vector_sums": {v: found[f"v_{i}"] for i, v in enumerate(vectors)}}


def _seal(data: DataFrame, keys: Sequence[str], vectors: Sequence[str]) -> DataFrame:
    """The digest of each key's rows and of its vectors."""
    rows = sealed_digest(data, keys, sorted(data.columns)).select(*keys, "digest")
    for v in vectors:
        rows = rows.join(sealed_digest(data, keys, [v]).select(*keys, F.col("digest").alias(f"digest_{v}")), list(keys))
    return rows


def stage(df: DataFrame, path: str, keys: Sequence[str], vectors: Sequence[str] = ()) -> str:
    """Writes the table, its digests and its manifest beside ``path``; returns the staged folder, which :func:`publish` makes the table."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}{STAGED}{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{DATA}")
    data = spark.read.schema(df.schema).parquet(f"{folder}/{DATA}")  # what has been written is what is sealed
    _seal(data, keys, vectors).write.parquet(f"{folder}/{SEAL}")
    unsigned = {"keys": list(keys), "vectors": list(vectors), "schema": df.schema.json(), **measure(data, vectors)}
    signed = unsigned | {"manifest_sha256": _hash(json.dumps(unsigned, sort_keys=True))}
    target, files = _files(spark, f"{folder}/{MANIFEST}")
    out = files.create(target, False)
    out.write(bytearray(json.dumps(signed, sort_keys=True).encode()))
    out.close()
    return folder


def publish(spark: SparkSession, folder: str, path: str) -> None:
    """Gives a staged folder its final name. A table that is there already stays as it is."""
    final, files = _files(spark, path)
    staged, _ = _files(spark, folder)
    if not files.exists(_files(spark, f"{folder}/{MANIFEST}")[0]):
        raise SealBroken(f"{folder} was not staged to its end")
    if files.exists(final):
        raise FileExistsError(path)
    if not files.rename(staged, final):
        raise OSError(f"could not rename {folder} to {path}")


def write_sealed(df: DataFrame, path: str, keys: Sequence[str], vectors: Sequence[str] = ()) -> None:
    """Writes a sealed table. Raises FileExistsError, before anything is written, if there is one."""
    final, files = _files(df.sparkSession, path)
    if files.exists(final):
        raise FileExistsError(path)
    publish(df.sparkSession, stage(df, path, keys, vectors), path)


def drop_staged(spark: SparkSession, path: str) -> int:
    """Deletes the staged folders that writers of ``path`` have left, and returns their number. For times when no writer is at work."""
    final, files = _files(spark, path)
    if not files.exists(final.getParent()):
        return 0
    left = [s.getPath() for s in files.listStatus(final.getParent()) if s.getPath().getName().startswith(final.getName() + STAGED)]
    for p in left:
        files.delete(p, True)
    return len(left)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a sealed table, if it has not been changed since it was signed."""
    target, files = _files(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not files.exists(target):
        raise SealBroken(f"{path} has no manifest")
    signed = json.loads("\n".join(r.value for r in spark.read.text(f"{path.rstrip('/')}/{MANIFEST}").collect()))
    said = signed.pop("manifest_sha256", None)
    if said != _hash(json.dumps(signed, sort_keys=True)):
        raise SealBroken(f"the manifest of {path} was changed")
    return signed


def open_sealed(spark: SparkSession, path: str) -> DataFrame:
    """The table, once its rows and vectors have been found to be those of the manifest; else :class:`SealBroken` with what differs."""
    manifest = read_manifest(spark, path)
    try:
        data = spark.read.parquet(f"{path}/{DATA}")
        now = measure(data, [v for v in manifest["vectors"] if v in data.columns])
    except Exception as e:
        raise SealBroken(f"the rows of {path} cannot be read: {type(e).__name__}") from e
    differ = [k for k in ("rows", "columns", "row_sum") if now[k] != manifest[k]] + [f"vectors of {v}" for v, x in manifest["vector_sums"].items() if now["vector_sums"].get(v) != x]
    if differ:
        raise SealBroken(f"{path} differs from its manifest: {', '.join(differ)}")
    return data


def verify_sealed(spark: SparkSession, path: str) -> DataFrame:
    """(keys, status, vectors) of the keys of which the rows are no longer those that were sealed: changed, missing or unknown. vectors: the vector columns that differ."""
    manifest = read_manifest(spark, path)
    keys, vectors = manifest["keys"], manifest["vectors"]
    now = _seal(spark.read.parquet(f"{path}/{DATA}"), keys, vectors)
    fields = ["digest", *[f"digest_{v}" for v in vectors]]
    both = spark.read.parquet(f"{path}/{SEAL}").select(*keys, *fields).join(now.select(*keys, *[F.col(f).alias(f"__{f}") for f in fields]), keys, "full")
    status = F.when(F.col("digest").isNull(), "unknown").when(F.col("__digest").isNull(), "missing").when(F.col("digest") != F.col("__digest"), "changed").otherwise("ok")
    moved = [F.when(F.col(f"digest_{v}") != F.col(f"__digest_{v}"), v) for v in vectors]
    wrong = F.array_join(F.array_compact(F.array(*moved)), ",") if moved else F.lit("")
    return both.select(*keys, status.alias("status"), wrong.alias("vectors")).where("status <> 'ok'")


def bank_status(bank: DataFrame, catalog: DataFrame, key: str, vector: str, size: int, recorded: DataFrame | None = None) -> DataFrame:
    """(key, status) of a catalogue and a bank of vectors: unknown, missing, duplicate, wrong_size, changed or ok.

    recorded: (key, digest), what :func:`vector_digest` gave for each vector when the catalogue was made; by default no hash is checked.
    """
    own = bank.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(F.size(vector)).alias("__least"), F.max(F.size(vector)).alias("__most"), F.min(vector_digest(vector)).alias("__now"))
    both = catalog.select(key).distinct().withColumn("__known", F.lit(True)).join(own, key, "full")
    if recorded is not None:
        both = both.join(recorded.select(key, F.col("digest").alias("__then")), key, "left")
    status = F.when(F.col("__known").isNull(), "unknown").when(F.col("__n").isNull(), "missing").when(F.col("__n") > 1, "duplicate")
    status = status.when(~F.coalesce((F.col("__least") == size) & (F.col("__most") == size), F.lit(False)), "wrong_size")
    if recorded is not None:
        status = status.when(~F.coalesce(F.col("__then") == F.col("__now"), F.lit(False)), "changed")
    return both.select(key, status.otherwise("ok").alias("status"))


def open_bank(spark: SparkSession, path: str, catalog: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """A sealed bank that covers the catalogue exactly, one vector of ``size`` numbers for each entry; else :class:`SealBroken`."""
    bank = open_sealed(spark, path)
    wrong = bank_status(bank, catalog, key, vector, size).where("status <> 'ok'").groupBy("status").count().orderBy("status").collect()
    if wrong:
        raise SealBroken(f"{path} does not cover the catalogue: " + ", ".join(f"{r['count']} {r['status']}" for r in wrong))
    return bank
