"""Slices of special texts only, lines that very many documents hold, and texts with very many spans."""

import base64
import hashlib
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from partloom.llm import bpe, line_dedup, secret_scan, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.mark.parametrize("texts", [[f"a {SPECIAL} b"], [SPECIAL], [SPECIAL, SPECIAL * 3], [f"words {SPECIAL} " * 120_000], ["", SPECIAL], [""], []], ids=["one", "alone", "two", "long", "empty first", "empty", "none"])
def test_slices_of_special_texts(texts):
    library, automaton = Tokenizer.from_file(PATH), bpe.Automaton(PATH)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in automaton.many(texts)] == want
    assert [int(x[-1]) if len(x) else 0 for x in token_counts.PrefixCounts(PATH).many(texts)] == [len(w) for w in want]


def test_a_table_of_one_special_text(spark):
    df = spark.createDataFrame([(1, f"a {SPECIAL} b")], "doc_id long, text string")
    row = bpe.encode(df, PATH, decoded="decoded").first()
    assert row.decoded == f"a {SPECIAL} b" and row.n_tokens == len(Tokenizer.from_file(PATH).encode(row.decoded, add_special_tokens=False).ids)


def test_a_line_in_a_third_of_all_documents(spark):
    """The hot line's owner join is split, and what a task deals out of it is a row, so no task reads a third of the lines."""
    few = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in few}
    tables = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        n = 9000
        text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("one line of very many\nown line of "), F.col("doc_id"))).otherwise(F.concat(F.lit("just another line "), F.col("doc_id"), F.lit("\nshared by two ... "), F.floor(F.col("doc_id") / 2)))
        df = spark.range(n).select(F.col("id").alias("doc_id")).withColumn("text", text).repartition(8)
        out = line_dedup.dedup_lines(df)
        got = {r.doc_id: (r.n_lines, r.n_dropped) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == n and all(got[i] == (2, int(i > 0)) for i in range(0, n, 3))
    owners = {}
    for i in range(n):
        if i % 3:
            owners.setdefault(i // 2, i)
            assert got[i] == (2, int(owners[i // 2] != i))
    assert "skewed" in plan  # adaptive execution has split the hot line
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} == tables


def test_very_many_spans_in_one_text(spark):
    """60,000 spans and candidates of one text: positions, overlaps and windows take no time that grows with their square."""
    lines = []
    for i in range(30_000):
        h = hashlib.md5(str(i).encode()).hexdigest()
        lines.append(f"é {h}" if i % 2 else f"k{i} {base64.b64encode(hashlib.sha1(str(i).encode()).digest()).decode()[:24]}")
    text = "\n".join(lines) + "\n" + "\n".join(f"token={'ab12' * 3}{i}" for i in range(30_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    secret_scan.scan(df.withColumn("text", F.lit("token=abcdefgh1"))).collect()  # compiles
    began = time.time()
    row = secret_scan.scan(df).select("doc_id", secret_scan.written("spans").alias("spans"), *[secret_scan.number("spans", k).alias(k) for k in secret_scan.KINDS]).first()
    assert time.time() - began < 30
    assert (row.assign, row["hex"]) == (30_000, 15_000)
    assert row.entropy_hex + row.entropy_mixed > 8_000
    spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in row.spans.split(","))]
    base = [(m.start(), m.end()) for m in re.finditer(r"[0-9a-f]{32,}", text)]
    assert [s[:2] for s in spans if s[2] == "hex"] == base
    assert spans == sorted(spans, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))
    held = sorted((a, b) for a, b, k in spans if not k.startswith("entropy"))
    ends = np.maximum.accumulate([b for _, b in held])
    starts = np.array([a for a, _ in held])
    for a, b, k in spans:
        if k.startswith("entropy"):
            at = np.searchsorted(starts, b)
            assert at == 0 or ends[at - 1] <= a
