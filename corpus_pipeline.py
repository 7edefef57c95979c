"""The corpus pipeline: five stages, each over all documents that the stage before kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; the driver writes it as Parquet and
reads it again as the next stage's ``docs``. All but the last return the columns of ``documents``, further ones included,
whatever their names; the last returns the columns it states.

Defined results of the stages: null and empty texts are texts without words (they go as copies of one another, all but one);
of rows that share an id, a decision on one holds for all, but in the toxicity stage each is judged by its text; rows without
an id are scored for toxicity and kept by the other stages; equal texts are settled by the largest id, near copies by the smallest;
empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.llm import bpe, decontamination, exact_dedup, simhash, toxicity
from partloom.llm.common import shared_folder, stored
from partloom.llm.queries import table, vocabulary_path

#: Ids that are broadcast at most; longer lists are joined by a shuffle.
BROADCAST_IDS = 500_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not listed. Rows without an id cannot be listed, and stay."""
    listed = stored(ids.select(F.col("doc_id").alias("doc_id")).distinct(), shared_folder(docs.sparkSession), "listed")
    few = listed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(listed) if few else listed, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field does not reject. It learns from the rows of ``labels`` that are not held out.

    Null texts stay null; columns of any name stay as they are.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    own = [f"__own_{k}" for k in range(len(docs.columns))]  # no names that the operator gives
    held = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__words"), *[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own, strict=True) if c != "text"], F.col("text").isNull().alias("__none"))
    scored = toxicity.score(held, model, "__id", "__words", carry=[c for c in held.columns if c not in ("__id", "__words")], keep_text=True)
    text = F.when(~F.col("__none"), F.col("__text"))
    return scored.where("predicted = 0").select([(text if c == "text" else F.col(o)).alias(c) for c, o in zip(docs.columns, own, strict=True)])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return _without(docs, exact_dedup.exact_duplicates(docs).where("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts of which five-word shingles are alike by 0.8 or more, the document with the smallest id. Texts without words are alike."""
    return _without(docs, simhash.similar_texts(docs, shingle=5, similarity=0.8).where("doc_id <> component_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return _without(docs, decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (packed little-endian unsigned 32-bit numbers), n_tokens, and whether decoding them gives the text again."""
    hashed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    coded = bpe.encode(hashed, vocabulary_path(), carry=["lang", "source", "text_hash"], decoded="decoded")
    return coded.select("doc_id", "lang", "source", "ids", "n_tokens", (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: The stages hold a fitted model, connected components and tokens, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
