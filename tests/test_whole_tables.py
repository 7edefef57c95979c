"""Queries read all rows of their tables, and equal rows are worked on once."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from partloom import registry
from partloom.operators import fusion, joins, spread
from partloom.operators import pixels as pixel_ops

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
def test_every_part_is_an_anchor(spark, monkeypatch):
    seen, fit = [], fusion.robust_similarity
    monkeypatch.setattr(fusion, "robust_similarity", lambda anchors, *a: seen.append(anchors.count()) or fit(anchors, *a))
    registry.queries()["g15_robust_similarity"](spark, SF)
    assert seen == [spark.read.parquet(f"{SF}/part.parquet").count()]


@pytest.mark.skipif(not os.path.exists(LARGER), reason="no tables")
def test_every_part_is_a_place_and_every_lock_stands(spark, monkeypatch):
    given = []
    monkeypatch.setattr(joins, "assign_optimal", lambda *a: given.extend(a))
    registry.queries()["j17_assign_optimal"](spark, LARGER)
    suppliers = spark.read.parquet(f"{LARGER}/supplier.parquet")
    assert given[0].select("pose").distinct().count() == spark.read.parquet(f"{LARGER}/lineitem.parquet").select("l_partkey").distinct().count()
    assert given[5].count() == given[5].select("nation", "pose").distinct().count() == suppliers.where("s_suppkey % 10 = 0").count()


def test_assignments_of_pairs_alone():
    """Where only some pairs are there, and none may cost less: the total of the whole table's solver."""
    r = np.random.default_rng(1)
    for most in [4, 1000] * 40:
        n = r.integers(1, 9)
        m = r.integers(n, 14)
        cost = np.where(r.random((n, m)) < r.random(), -r.integers(1, most, (n, m)), 1)
        whole = np.concatenate([cost, np.zeros((n, n), np.int64)], axis=1)
        i, j = np.nonzero(cost < 0)
        got = joins.least_sparse(np.searchsorted(i, np.arange(n + 1)), j, cost[i, j], m)
        pairs = [(a, b) for a, b in enumerate(got) if b >= 0]
        assert len({b for _, b in pairs}) == len(pairs) and all(cost[p] < 0 for p in pairs)
        assert sum(cost[p] for p in pairs) == whole[np.arange(n), joins.least_cost(whole)].sum()


def test_a_key_of_any_size_is_assigned(spark):
    """2,500 items on both sides, of which each would rather have its neighbour's place: all but the last get it."""
    df = spark.range(5000).select(F.lit(1).alias("k"), F.floor(F.col("id") / 2).alias("l"), F.floor((F.col("id") + 1) / 2).alias("r"), F.when(F.col("id") % 2 == 1, 0.5).otherwise(0.25).alias("s"))
    got = joins.assign_optimal(df, ["k"], "l", "r", "s").collect()
    assert len({x.l for x in got}) == len({x.r for x in got}) == len(got) == 2500 and sum(x.s for x in got) == 1250


def test_equal_rows_are_scored_once(spark, monkeypatch):
    """300 groups of 5 kinds and 200 profiles of 7, unknown channels among them: 35 pairs are scored, and the result is that of all 60,000."""
    met, against = [], joins.against
    monkeypatch.setattr(joins, "against", lambda q, b, key: met.append((q.count(), b.count())) or against(q, b, key))
    value = lambda i, n: None if i % n == 0 else i % n / 10
    g, p = {i: (value(i, 5), 0.5) for i in range(300)}, {199 - i: (value(i, 7), 0.0) for i in range(200)}
    df = lambda rows, n: spark.createDataFrame([(i, *v) for i, v in rows.items()], f"{n} long, rough double, metal double")
    got = {}
    for r in joins.channel_prior(df(g, "g"), df(p, "p"), "g", "p", ["rough", "metal"], 40).collect():
        got.setdefault(r.group, []).append((r.rank, r.profile, r.prior, r.channels))
    assert met == [(5, 7)]
    for i, a in g.items():
        scored = []
        for j, b in p.items():
            terms = [1 - abs(x - y) for x, y in zip(a, b, strict=True) if x is not None and y is not None]
            scored.append((-round(sum(terms) / len(terms), 8), j, len(terms)))
        assert [(-round(x[2], 8), x[1], x[3]) for x in sorted(got[i])] == sorted(scored)[:40]


def test_components_meet_by_colour(spark, monkeypatch):
    """200 parts of 6 colours and 13 seeds of few meet as colours; a part given twice and a component of two seeds count as in all pairs."""
    seen, met = [], fusion.met
    monkeypatch.setattr(fusion, "met", lambda left, right, on: seen.append((left.count(), right.count())) or met(left, right, on))
    lab = lambda c: (float(c), 0.0, 0.0)
    parts = [(i % 199, "b", "s", lab(i % 6 * 20)) for i in range(200)]
    seeds = [(c, "b", "s", lab([0, 20, 41, 60, 300][c % 5 if c < 58 else 4])) for c in (0, 1, 1, 3, 4, *range(54, 60))] + [(7, "b", "s", lab(61)), (3, "b", "s", lab(62))]
    kind = "branch string, surface string, lab struct<l double, a double, b double>"
    got = {x.part_id: x.component for x in fusion.extend_components(spark.createDataFrame(seeds, f"component long, {kind}"), spark.createDataFrame(parts, f"part_id long, {kind}"), [], "branch", "surface", 5.0).collect()}
    want = {}
    for i, _, _, a in parts:
        want.setdefault(i, set()).update(c for c, _, _, b in seeds if abs(a[0] - b[0]) <= 5)
    assert got == {i: min(c) for i, c in want.items() if len(c) == 1} and got
    assert seen == [(6, len({s[3] for s in seeds}))]


def test_vectors_meet_in_packs(spark, monkeypatch):
    """Of 90 vectors in packs of about 20, with equal ones and some without a cosine: ranks and similarities of all pairs. No pair of vectors is a row of a join."""
    monkeypatch.setattr(joins, "PACK_ROWS", 20)
    r = np.random.default_rng(3)
    vectors = [[float(x) for x in np.float32(r.normal(size=6))] for _ in range(60)]
    vectors = [None if i == 7 else vectors[i % 60][:5] if i == 9 else vectors[i % 60] for i in range(90)]
    e = spark.createDataFrame([(i, i % 3, v) for i, v in enumerate(vectors)], "vec_id long, entity long, vec array<float>").cache()
    cosine = lambda a, b: None if a is None or b is None or len(a) != len(b) else round(sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5, 6)
    got = {}
    for k in (5, 89):
        found = joins.knn(e.where("vec_id % 10 = 0 or vec_id in (7, 9)"), e, "vec_id", "vec_id", "vec", k)
        for x in found.collect():
            got.setdefault((k, x.query), []).append((x.rank, x.candidate, x.score))
        for q in [0, 7, 9, *range(10, 90, 10)]:
            s = [(c := cosine(vectors[q], v), i) for i, v in enumerate(vectors)]
            want = sorted(s, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))[:k]
            assert [(i, c) for _, i, c in sorted(got[k, q])] == [(i, c) for c, i in want], (k, q)
    pairs = spark.createDataFrame([(0, 1), (1, 2), (0, 2)], "left long, right long")
    tokens = e.where("vec_id not in (7, 9)").withColumnRenamed("vec_id", "token")
    similar = joins.set_similarity(pairs, tokens)
    assert "t_left" not in similar._jdf.queryExecution().optimizedPlan().toString()
    for x in similar.collect():
        a, b = ([np.array(v) for i, v in enumerate(vectors) if i % 3 == n and i not in (7, 9)] for n in (x.left, x.right))
        cos = lambda p, q: p @ q / (p @ p * (q @ q)) ** 0.5
        table = np.array([[cos(p, q) for q in b] for p in a])
        want = 0.75 * (table.max(1).mean() + table.max(0).mean()) / 2 + 0.25 * cos(np.mean(a, 0), np.mean(b, 0))
        assert abs(x.similarity - want) < 1e-9


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
@pytest.mark.parametrize("name", ["a21_project_groups", "x02_null_control"])
def test_pixels_stay_in_the_partitions_of_their_pictures(spark, name):
    text = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM") > 0


def test_shifted_pictures_equal_all_pairs(spark):
    """Pixels given twice, unknown groups and hits, pictures without a match, in slices of any size."""
    r = random.Random(5)
    pixels = [(k, r.randint(0, 4), r.randint(-2, 3), r.choice(["p", "q", None])) for k in range(12) for _ in range(9)] + [(99, 500, 500, "p")]
    labels = [(k, r.randint(0, 4), r.randint(-2, 3), r.choice(["a", "b", "c", None]), r.choice([1, 0, None])) for k in range(1, 13) for _ in range(14)] + [(99, 0, 0, "a", 1)]
    p, t = spark.createDataFrame(pixels, "k long, x long, y long, part string"), spark.createDataFrame(labels, "k long, x long, y long, g string, h int")
    shifts = [(0, 0), (1, 0), (0, -2)]
    met = [(a[0], a[3], o, b[3], b[4]) for a in pixels for b in labels for o, (i, j) in enumerate(shifts) if a[0] == b[0] and (a[1] + i, a[2] + j) == (b[1], b[2])]
    want = {}
    for k, part in {m[:2] for m in met}:
        tops = {}
        for o in range(3):
            n = Counter(m[3] for m in met if m[:3] == (k, part, o))
            if n:
                tops[o] = min(n, key=lambda g: (-n[g], g is not None, g or ""))
        want[k, part] = (tops.get(0), len({g for g in tops.values() if g is not None}) == 1)
    assert {(x.k, x.part): (x.winner, x.stable) for x in pixel_ops.project_groups(p, t, ["k"], "part", "g", shifts).collect()} == want
    got = {x.k: (x.observed, x.control) for x in pixel_ops.null_control(p, t, ["k"], F.col("t_h") == 1, shifts[1:]).collect()}
    assert got.keys() == {m[0] for m in met}
    for k, (observed, control) in got.items():
        shares = [[m[4] for m in met if m[0] == k and m[2] == o and m[4] is not None] for o in range(3)]
        shares = [float(np.mean(s)) if s else None for s in shares]
        moved = [s for s in shares[1:] if s is not None]
        assert observed == shares[0] and (control is None if not moved else abs(control - np.quantile(moved, 0.75)) < 1e-12)


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
def test_textures_sort_and_shuffle_no_pixel(spark):
    """Pictures are arrays: no window runs over pixels; beside the pictures, each side's histograms are dealt once."""
    text = registry.queries()["a13_texture_score"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and text.count("Exchange hashpartitioning") == 4 and text.count("REPARTITION_BY_NUM") == 2


def test_crowded_keys_are_written_by_the_root_of_their_pairs(spark, monkeypatch):
    """Two keys of 400 rows a side in shares of 100 pairs: all pairs once, and rows are written some 40 times and not 1,600."""
    monkeypatch.setattr(spread, "TASK_PAIRS", 100)
    df = lambda n: spark.range(1210).select(F.least(F.floor(F.col("id") / 400), F.lit(3)).alias("k"), F.col("id").alias(n)).where("k <> 2 or id % 2 = 0")
    pairs = spread.met(df("l"), df("r"), ["k"])
    assert pairs.distinct().count() == pairs.count() == 400 * 400 * 2 + 200 * 200 + 10 * 10
    left, right = spread._dealt(df("l"), df("r"), ["k"], True)
    assert left.count() < 45 * 1010 and right.count() < 45 * 1010
    there = spread.having(df("l").where("l % 3 = 0"), df("r").where("r < 500"), ["k"], F.col("l") == F.col("r"))
    assert there.count() == len([i for i in range(500) if i % 3 == 0])


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
def test_medoids_shuffle_no_pixel(spark):
    text = registry.queries()["x01_registered_score"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and text.count("SortMergeJoin") == 1 and text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM") == 2
