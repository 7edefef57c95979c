"""Keys of many pairs, and tables that are dealt once: results are those of the plain way, over partitions that follow the rows and pairs."""

import itertools
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from partloom import registry
from partloom.operators import fusion, joins, spread

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_key_of_many_pairs_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(spread, "TASK_PAIRS", 500)
    l = spark.createDataFrame([(None if i % 50 == 0 else i % 3, i) for i in range(200)], "k int, a long")  # noqa: E741
    r = spark.createDataFrame([(None if i % 60 == 0 else min(i, 2), i) for i in range(120)], "k int, b long")
    got = spread.met(l, r, ["k"])
    want = l.join(r, "k")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.select(F.spark_partition_id()).distinct().count() > 4


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
@pytest.mark.parametrize("name", ["j05_box_overlap", "p05_compatible"])
def test_pairs_have_partitions_of_their_own(spark, name):
    text = plan(registry.queries()[name](spark, SF)).split("== Initial Plan ==")[-1]
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text and text.count("REPARTITION_BY_NUM") >= 2


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
@pytest.mark.parametrize("name,exchanges", [("p09_compact_ranges", 1), ("p09_expand_ranges", 1), ("g10_uv_overlap", 2), ("a07_fuse_palettes", 1), ("a07_painted_split", 1)])
def test_keys_are_dealt_once(spark, name, exchanges):
    """Partitions follow the rows, and nothing but the input is shuffled."""
    text = plan(registry.queries()[name](spark, SF))
    assert text.count("Exchange") == text.count("REPARTITION_BY_NUM") == exchanges and "Broadcast" not in text


def test_treatments_of_null_still_meet(spark):
    from partloom.plans import rules

    l = spark.createDataFrame([(1, [0, 0, 1], None, "x"), (2, [1], 0, "any"), (3, [None], 0, "any")], "id int, substrates array<int>, treatment int, optical string")  # noqa: E741
    r = spark.createDataFrame([(7, 0, None, "x"), (8, 1, None, "y"), (9, 1, 0, "y"), (10, None, 0, "any")], "other int, substrate int, treatment int, optical string")
    assert sorted((x.id, x.other) for x in rules.compatible_pairs(l, r).collect()) == [(1, 7), (2, 9)]


def test_crowded_views_meet_in_cells(spark, monkeypatch):
    """A view of more boxes than are compared with one another gives what a small one gives."""
    rows = [(1, v, p, float(p * 37 % 90 * 3), float(p * 11 % 40), float(p * 37 % 90 * 3 + 20 + p % 9), float(p * 11 % 40 + 15), 0.2 + p % 7 / 10) for v in range(3) for p in range(40) if (p + v) % 4]
    boxes = spark.createDataFrame(rows, "a long, v long, part_id long, x0 double, y0 double, x1 double, y1 double, weight double")
    members = spark.createDataFrame([(1, p % 2, p) for p in range(0, 40, 3)], "a long, component long, part_id long")
    run = lambda: sorted((r.part_id, r.component, round(r.support, 9), r.views) for r in fusion.proximity_support(boxes, members, ["a"], "v").collect())
    plain = run()
    monkeypatch.setattr(fusion, "CROWD", 25)
    assert plain and run() == plain


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
def test_boxes_meet_by_brand(spark):
    """Parts meet the seeds of their brand in a view, not all of them, and seeds of all views are not compared by colour first."""
    text = plan(registry.queries()["x07_extend_beside"](spark, SF))
    met = [line for line in text.splitlines() if "SortMergeJoin" in line and "cx" in line]
    assert met and all("brand" in line for line in met)


def test_assignments_of_many_keys_at_once(spark):
    """All assignments of small keys, ties and path order included; and no round is written or shuffled."""
    r = random.Random(3)
    rows = [(k, v, p, round(r.choice([0.1, 0.2, 0.3, 0.5, -0.1]), 3)) for k in range(40) for v in range(1 + k % 4) for p in (1, 2, 10, 20) if r.random() < 0.7]
    got = {x.k: x for x in joins.assign_one_to_one(spark.createDataFrame(rows, "k long, v long, p long, s double"), ["k"], "v", "p", "s").collect()}
    assert set(got) == {x[0] for x in rows}
    for k, x in got.items():
        own = {(v, p): s for n, v, p, s in rows if n == k}
        views = sorted({v for v, _ in own})
        best = None
        for path in itertools.product([None, 1, 2, 10, 20], repeat=len(views)):
            taken = [p for p in path if p is not None]
            if len(set(taken)) < len(taken) or any((v, p) not in own for v, p in zip(views, path, strict=True) if p is not None):
                continue
            key = (-round(sum(own[v, p] for v, p in zip(views, path, strict=True) if p is not None), 9), -len(taken), ",".join("~" if p is None else str(p) for p in path))
            best = min(best, key) if best else key
        assert (round(x.total, 9), x.matched, ",".join(p or "~" for p in x.path)) == (-best[0], -best[1], best[2] + ",~" * (4 - len(views)))  # all paths are as long as the longest
    rest = plan(joins.assign_one_to_one(spark.createDataFrame(rows, "k long, v long, p long, s double"), ["k"], "v", "p", "s"))
    assert rest.count("Exchange") == 1


def test_robust_fit_of_equal_anchors(spark, monkeypatch):
    """Equal anchors are one point that counts as often: 300 anchors at 24 places give the model of all their pairs, however few residuals are held, in few hypotheses."""
    counted = fusion._medians
    monkeypatch.setattr(fusion, "RESIDUALS", 100)
    rows = [(1, i, float(p * 7 % 50), float(p * 13 % 40), 2.0 * (p * 7 % 50) + 5 + (90 if p % 6 == 0 else 0), 2.0 * (p * 13 % 40) - 3, 30.0, 0.5 + p / 64, 20.0) for i in range(300) for p in (i % 24,)]
    df = spark.createDataFrame(rows, "k long, id long, x double, y double, u double, v double, area double, quality double, diagonal double")
    got = fusion.robust_similarity(df, ["k"]).first()
    assert got.status == "ok" and abs(got.c - 2) < 1e-9 and abs(got.s) < 1e-9 and abs(got.tx - 5) < 1e-6 and abs(got.ty + 3) < 1e-6
    r = np.random.default_rng(2)
    values, counts = r.random((5, 9)), r.integers(0, 4, (5, 9))
    assert np.allclose(counted(values, counts), [np.median(np.repeat(a, n)) for a, n in zip(values, counts, strict=True)])
    h = pd.DataFrame({"k": 1, "a_id": [3, 1], "b_id": [4, 2], "c": 1.0, "s": 0.0, "tx": 0.0, "ty": 0.0, "threshold": 2.0})
    p = pd.DataFrame({"x": [0.0, 1.0], "y": 0.0, "u": [0.0, 1.0], "v": 0.0, "__w": [2.0, 3.0], "__n": [4, 5]})
    best = fusion.count_votes(h, p, ["a_id", "b_id", "__w", "__n", "__mi", "__ma"])
    assert best.to_numpy().tolist() == [[1, 2, 5, 9, 0, 0]]
