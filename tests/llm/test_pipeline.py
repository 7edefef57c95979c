"""The pipeline against a plain version of its stages; native operators against their plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from partloom.llm import decontamination, exact_dedup, license_scan, line_dedup, queries, secret_scan, simhash, toxicity
from tests.llm.test_operators import brute_contamination, jaccard, labelled, shingle_sets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    texts, labels = labelled(300, seed=9)
    r = random.Random(0)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts += [texts[i] for i in range(0, 60, 3)]  # exact copies
    texts += [texts[i] + " tail" for i in range(1, 40, 5)]  # near copies
    texts += [f"{texts[i]} {item} end" for i in range(2, 30, 9)]  # leaks
    texts += [None, "", " ", "é\U0001f600 <|endoftext|> x", "word " * 20000]
    rows = [(i, t, r.choice(["en", "fr"]), f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("quality", F.lit(1)).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, {i: t for i, t, *_ in rows}


def test_run_equals_the_plain_stages(spark, folder):
    root, texts = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{root}/labels.parquet"))
    left = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    assert 0 < len(left) < len(texts)
    last = {}
    for i in sorted(left):
        last[texts[i] or ""] = i
    left = set(last.values())
    order = sorted(left)
    sets = dict(zip(order, shingle_sets([texts[i] for i in order]), strict=True))
    parent = {i: i for i in left}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if jaccard(sets[a], sets[b]) >= 0.8:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    left = {top(i) for i in left}
    assert len(left) < len(order)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    order = sorted(left)
    left = {i for i, (_, _, _, hit) in zip(order, brute_contamination([texts[i] for i in order], items), strict=True) if not hit}
    library = Tokenizer.from_file(queries.vocabulary_path())
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, root).collect()}
    assert set(got) == left
    for i, r in got.items():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[i] or "", add_special_tokens=False).ids
        assert r.round_trip


def test_stages_keep_the_columns_of_documents(spark, folder):
    root, texts = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.columns == docs.columns
    clash = "score highest expected n_words n_tokens spans predicted __null __text __id keep_id group_size kept component_id fingerprint blocks probe items id row terms".split()
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in clash}).withColumn("a.b", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, root)
        assert out.columns == more.columns
        kept = {r.doc_id: r for r in out.collect()}
        assert kept and all(r[c] == f"{c}{i}" for i, r in kept.items() for c in clash)
        assert set(kept) == {r.doc_id for r in stage(spark, docs, root).collect()}
    toxic_free = corpus_pipeline.drop_toxic(spark, docs, root).collect()
    assert all(r.text == texts[r.doc_id] for r in toxic_free)


def test_stages_of_an_empty_table(spark, folder):
    root, _ = folder
    docs = spark.read.parquet(f"{root}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, root).count() == 0


def test_native_operators_run_no_python(spark, folder):
    root, _ = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    bench = spark.read.parquet(f"{root}/benchmark.parquet")
    files = docs.select("doc_id", "text", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"))
    for df in (exact_dedup.exact_duplicates(docs), line_dedup.dedup_lines(docs), secret_scan.scan(docs), decontamination.decontaminate(docs, bench), license_scan.scan(files, license_scan.templates(spark), "doc_id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))


def test_queries_of_pairs_join_on_blocks(spark):
    nodes = spark.range(100).select(F.col("id").alias("fp"))
    plan = simhash.links(nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
