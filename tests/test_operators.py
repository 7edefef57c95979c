"""Operators that SQL does not express, against brute force; rules on explicit rows; streams against their batch form."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import fusion, gates, graph, joins, mesh, pixels, rank, stats
from partloom.plans import rules
from partloom.sources import files
from partloom.streaming import progress

LAB = "struct<l:double,a:double,b:double>"


def test_delta_e2000_of_published_pairs(spark):
    """Pairs of the published test data of the formula."""
    pairs = [((50, 2.6772, -79.7751), (50, 0, -82.7485), 2.0425), ((50, 3.1571, -77.2803), (50, 0, -82.7485), 2.8615), ((50, -1, 2), (50, 0, 0), 2.3669), ((50, 2.49, -0.001), (50, -2.49, 0.0011), 7.2195), ((60.2574, -34.0099, 36.2677), (60.4626, -34.1751, 39.4387), 1.2644)]
    df = spark.createDataFrame([(tuple(map(float, a)), tuple(map(float, b)), d) for a, b, d in pairs], f"x {LAB}, y {LAB}, want double")
    for r in df.select(color.delta_e2000(F.col("x"), F.col("y")).alias("got"), "want").collect():
        assert abs(r.got - r.want) < 1e-4


def test_colour_round_trip_and_labels(spark):
    df = spark.createDataFrame([(255, 255, 255), (0, 0, 0), (255, 0, 0), (0, 255, 0), (128, 128, 128)], "r int, g int, b int")
    out = color.add_colour_features(df, "r", "g", "b").withColumn("back", color.linear_to_srgb(color.srgb_to_linear(F.col("r") / 255.0))).collect()
    assert [r.colour for r in out] == ["white", "black", "red", "green", "grey"]
    assert abs(out[0].lab.l - 100) < 1e-3 and abs(out[0].oklab.l - 1) < 1e-3
    assert all(abs(r.back - r.r / 255) < 1e-6 for r in out)


def test_weighted_median_is_a_step(spark):
    df = spark.createDataFrame([("k", 1.0, 1.0), ("k", 2.0, 1.0), ("k", 9.0, 2.0)], "k string, v double, w double")
    assert stats.weighted_median(df, ["k"], "v", "w").first()[1] == 2.0


def test_uncertain_values_abstain_only_if_another_is_resolved(spark):
    df = spark.createDataFrame([("a", "unknown", 1.0), ("a", "unknown", 1.0), ("a", "steel", 0.1), ("b", "unknown", 0.5)], "k string, v string, c double")
    assert {r.k: r.v for r in stats.categorical_consensus(df, ["k"], "v", "c").collect()} == {"a": "steel", "b": "unknown"}


def test_consensus_gate_rules(spark):
    main = spark.createDataFrame([("promote", "review", "g", 0.5, False), ("conflict", "matched", "g", 0.9, False), ("other", "none", "g", 0.9, False), ("few", "matched", "g", 0.9, False), ("kept", "matched", "g", 0.9, False), ("open", "matched", "g", 0.9, False), ("multi", "matched", "g", 0.9, True)], "k string, status string, g string, c double, multi boolean")
    v = [("promote", "g", 0.9), ("promote", "g", 0.85), ("conflict", "h", 0.7), ("few", "g", 0.9), ("kept", "g", 0.9), ("kept", "g", 0.8), ("kept", "h", 0.5), ("open", None, 0.9), ("open", "g", 0.9), ("open", "g", 0.9)]
    out = {r.k: (r.decision, r.g, r.c) for r in gates.consensus_gate(main, spark.createDataFrame(v, "k string, g string, c double"), ["k"], "g", "c").collect()}
    assert out == {"promote": ("promoted_auto", "g", 0.85), "conflict": ("downgraded_preserve", None, 0.9), "other": ("unchanged", "g", 0.9), "few": ("downgraded_review", "g", 0.9), "kept": ("kept_auto", "g", 0.9), "open": ("downgraded_review", "g", 0.9), "multi": ("downgraded_preserve", None, 0.9)}


def test_winner_needs_the_minimum_gain(spark):
    s = spark.createDataFrame([("a", "base", 0.5), ("a", "x", 0.515), ("b", "base", 0.5), ("b", "x", 0.514), ("c", "x", 0.9)], "k string, id string, s double")
    base = spark.createDataFrame([("a", "base"), ("b", "base"), ("c", "base")], "k string, id string")
    assert {r.k: r.selected for r in rank.select_winner(s, base, ["k"], "id", "s").collect()} == {"a": "x", "b": "base", "c": "base"}


def test_coating_components_against_a_loop(spark):
    r = random.Random(4)
    rows = [(k, i, r.random(), tuple(r.uniform(0, 40) for _ in range(3))) for k in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, f"k string, id long, w double, lab {LAB}")
    got = {(x.k, x.id): x.cluster for x in gates.coating_components(df, ["k"], "id", "w", 20.0).collect()}
    for k in "ab":
        clusters = []
        for _, i, _, lab in sorted((x for x in rows if x[0] == k), key=lambda x: (-x[2], x[1])):
            home = next((c for c in clusters if all(math.dist(lab, m) <= 20 for _, m in c)), None)
            if home is None:
                clusters.append(home := [])
            home.append((i, lab))
        assert {(k, i): n for n, c in enumerate(clusters) for i, _ in c} == {x: v for x, v in got.items() if x[0] == k}
    assert {x.reason for x in gates.coating_components(df, ["k"], "id", "w", 20.0, most=10).collect()} == {"key_too_large"}


def test_coating_components_of_a_large_key(spark):
    r = random.Random(6)
    colours = [tuple(r.uniform(0, 60) for _ in range(3)) for _ in range(25)]
    rows = [("a", i, r.random(), r.choice(colours)) for i in range(2500)]
    got = {x.id: x.cluster for x in gates.coating_components(spark.createDataFrame(rows, f"k string, id long, w double, lab {LAB}"), ["k"], "id", "w", 30.0).collect()}
    clusters, want = [], {}
    for _, i, _, lab in sorted(rows, key=lambda x: (-x[2], x[1])):
        n = next((n for n, c in enumerate(clusters) if all(math.dist(lab, m) <= 30 for m in c)), len(clusters))
        if n == len(clusters):
            clusters.append(set())
        clusters[n].add(lab)
        want[i] = n
    assert got == want and len(clusters) > 1


def test_set_similarity_against_numpy(spark):
    rng = np.random.default_rng(0)
    sets = {n: rng.normal(size=(m, 5)) for n, m in ((1, 3), (2, 4))}
    tokens = spark.createDataFrame([(n, t, v.tolist()) for n, vs in sets.items() for t, v in enumerate(vs)], "entity long, token long, vec array<float>")
    cos = lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    m = np.array([[cos(a, b) for b in sets[2]] for a in sets[1]])
    want = 0.75 * (m.max(1).mean() + m.max(0).mean()) / 2 + 0.25 * cos(sets[1].mean(0), sets[2].mean(0))
    got = joins.set_similarity(spark.createDataFrame([(1, 2)], "left long, right long"), tokens).first().similarity
    assert abs(got - want) < 1e-5


def test_knn_in_blocks_equals_broadcast(spark, monkeypatch):
    r = random.Random(2)
    bank = spark.createDataFrame([(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(60)], "id long, v array<float>")
    whole = sorted(map(tuple, joins.knn(bank.where("id % 10 = 0"), bank, "id", "id", "v", 5).collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 20)
    assert sorted(map(tuple, joins.knn(bank.where("id % 10 = 0"), bank, "id", "id", "v", 5).collect())) == whole


def test_assignment_against_all_permutations(spark):
    r = random.Random(7)
    rows = [(a, v, p, round(r.random(), 3)) for a in range(6) for v in range(3) for p in range(4) if r.random() < 0.7]
    got = {x.k: x.total for x in joins.assign_one_to_one(spark.createDataFrame(rows, "k long, v long, p long, s double"), ["k"], "v", "p", "s").collect()}
    for a in got:
        s = {(v, p): x for k, v, p, x in rows if k == a}
        views = sorted({v for v, _ in s})
        best = max(sum(s[v, p] for v, p in zip(views, q, strict=True) if p is not None) for q in itertools.product([None, 0, 1, 2, 3], repeat=len(views)) if len([p for p in q if p is not None]) == len({p for p in q if p is not None}) and all(p is None or (v, p) in s for v, p in zip(views, q, strict=True)))
        assert abs(got[a] - best) < 1e-9


def test_components_of_long_paths_and_random_graphs(spark):
    r = random.Random(1)
    e = [(i, i + 1) for i in range(150)] + [(r.randint(200, 300), r.randint(200, 300)) for _ in range(50)]
    parent = {i: i for i in range(301)}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in e:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    nodes = spark.range(301).select(F.col("id").alias("node"))
    got = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(e, "a long, b long"), nodes).collect()}
    assert got == {i: root(i) for i in range(301)}


def test_masks_edges_and_blobs(spark):
    r = random.Random(3)
    a = {(x, y) for x in range(9) for y in range(9) if r.random() < 0.5}
    b = {(x, y) for x in range(9) for y in range(9) if r.random() < 0.5}
    df = spark.createDataFrame([("i", x, y, (x, y) in a, (x, y) in b) for x in range(9) for y in range(9)], "k string, x long, y long, a boolean, b boolean")
    edge = lambda m: {(x, y) for x, y in m if any(n not in m for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)))}
    ea, eb = edge(a), edge(b)
    hit = lambda p, q: sum(any(abs(x - u) <= 1 and abs(y - v) <= 1 for u, v in q) for x, y in p) / len(p)
    p, q = hit(ea, eb), hit(eb, ea)
    assert abs(pixels.edge_f1(df, ["k"], "a", "b", 1).first().edge_f1 - 2 * p * q / (p + q)) < 1e-9
    left, sizes = set(a), []
    while left:
        todo, n = [left.pop()], 0
        while todo:
            x, y = todo.pop()
            n += 1
            for m in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if m in left:
                    left.remove(m)
                    todo.append(m)
        sizes.append(n)
    assert sorted(x.pixels for x in pixels.blobs(df.where("a"), "k").collect()) == sorted(sizes)


def test_texture_histogram(spark):
    r = random.Random(3)
    v = {(x, y): r.uniform(0, 255) for x in range(6) for y in range(6)}
    w = {0: 2, 1: 1, -1: 1}
    want = [0] * 8
    for (x, y), c in v.items():
        near = [(v[x + i, y + j], w[i] * w[j]) for i in w for j in w if (x + i, y + j) in v]
        low = sum(a * b for a, b in near) / sum(b for _, b in near)
        want[min(7, int(round(min(1, abs(c - low) / max(16, low)), 9) * 8))] += 1
    df = spark.createDataFrame([("k", x, y, c) for (x, y), c in v.items()], "k string, x long, y long, v double")
    got = {t.bin: t.share for t in pixels.texture_histogram(df, ["k"], "v", 1, 8).collect()}
    assert all(abs(got.get(i, 0) - n / 36) < 1e-9 for i, n in enumerate(want))


def test_regions_of_a_cube_and_a_plane(spark):
    normals = [(0, 0, 1), (0, 0, 1), (0, 0.1, 0.99), (1, 0, 0), (1, 0, 0), (0, 0, 1)]
    faces = spark.createDataFrame([("m", i, *map(float, n)) for i, n in enumerate(normals)], "k string, face long, nx double, ny double, nz double")
    near = spark.createDataFrame([("m", 0, 1), ("m", 1, 2), ("m", 2, 3), ("m", 3, 4), ("m", 4, 5)], "k string, a long, b long")
    assert {x.face: x.region for x in graph.coherent_regions(faces, near, ["k"], 0.9).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}


def test_similarity_fit_ignores_an_outlier(spark):
    turn, scale = math.radians(30), 1.5
    rows = [("v", i, float(x), float(y), scale * (math.cos(turn) * x - math.sin(turn) * y) + 3 + (9 if i == 2 else 0), scale * (math.sin(turn) * x + math.cos(turn) * y) - 1, 1.0) for i, (x, y) in enumerate([(0, 0), (4, 1), (2, 5), (7, 3), (1, 8)])]
    r = fusion.fit_similarity(spark.createDataFrame(rows, "k string, id long, x double, y double, u double, v double, w double"), ["k"], 0.01).first()
    assert (round(r.scale, 6), round(r.angle, 6), r.inliers) == (1.5, 30.0, 4)


def test_uv_overlap(spark):
    t = [("k", 0.0, 0.0, 1.0, 0.0, 0.0, 1.0), ("k", 0.0, 0.0, 0.5, 0.0, 0.0, 0.5), ("k", 0.5, 0.5, 1.5, 0.5, 0.5, 1.5)]

    def inside(p, x, y):
        (a, b), (c, d), (e, f) = p
        s = [(c - a) * (y - b) - (d - b) * (x - a), (e - c) * (y - d) - (f - d) * (x - c), (a - e) * (y - f) - (b - f) * (x - e)]
        return min(s) >= 0 or max(s) <= 0

    n = [sum(inside(((r[1], r[2]), (r[3], r[4]), (r[5], r[6])), (i + 0.5) / 8, (j + 0.5) / 8) for r in t) for i in range(8) for j in range(8)]
    got = mesh.uv_overlap(spark.createDataFrame(t, "k string, u0 double, v0 double, u1 double, v1 double, u2 double, v2 double"), ["k"], 8).first()
    used = sum(x > 0 for x in n)
    assert abs(got.used - used / 64) < 1e-9 and abs(got.overlapping - sum(x > 1 for x in n) / used) < 1e-9 and abs(got.out_of_bounds - 1 / 3) < 1e-9


def test_geometry_digest_does_not_change_when_moved(spark):
    p = [(k, v, x + d, y - d, 1.0) for k, d in (("a", 0.0), ("b", 7.25)) for v, (x, y) in enumerate([(0.0, 0.0), (2.0, 0.0), (0.0, 3.0)])]
    c = [(k, 0, i, i) for k in "ab" for i in range(3)]
    out = mesh.geometry_digest(spark.createDataFrame(p, "k string, vertex int, x double, y double, z double"), spark.createDataFrame(c, "k string, face int, corner int, vertex int"), ["k"])
    assert out.select("digest").distinct().count() == 1


def test_palettes_do_not_depend_on_the_order_of_rows(spark):
    rows = [("a", v, c, f, "matte", f"i{v}") for v, c, f in ((1, "red", "metal"), (2, "red", "metal"), (1, "blue", "wood"), (2, "blue", "paint"), (1, "grey", "x"), (1, "grey", "x"))]
    run = lambda r: sorted(map(tuple, fusion.fuse_palettes(spark.createDataFrame(r, "k string, v int, c string, f string, fin string, i string"), ["k"], "v", "c", "f", "fin", "i").collect()))
    out = run(rows)
    assert out == run(rows[::-1])
    assert ("a", "red", 2, 2, 2, "metal", True) in out and sum(r[1].startswith("blue") for r in out) == 2


def test_contract_faults(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": 1, "z": 2}'), (3, "{}"), (4, "junk"), (5, None)], "id long, j string")
    out = files.read_contract(df, "j", T.StructType([T.StructField("k", T.LongType())]), ["k"])
    assert {r.id: r.reason_codes for r in out.collect()} == {1: "", 2: "unknown_field", 3: "missing_k", 4: "not_json", 5: "not_json"}


def test_ranges_round_trip(spark):
    df = spark.createDataFrame([("a", i) for i in (1, 2, 3, 7, 9, 10, 10)], "k string, v long")
    r = rules.compact_ranges(df, ["k"], "v")
    assert sorted((x.lo, x.hi) for x in r.collect()) == [(1, 3), (7, 7), (9, 10)]
    assert sorted(x.v for x in rules.expand_ranges(r, ["k"], "v").collect()) == [1, 2, 3, 7, 9, 10]


@pytest.fixture
def event_files(spark, tmp_path):
    rows = [(1, 1, "queued"), (1, 2, "running"), (1, 3, "succeeded"), (2, 4, "running"), (2, 5, "failed"), (3, 6, "queued"), (3, 7, "succeeded")]
    path = str(tmp_path / "events")
    spark.createDataFrame(rows, "job long, event_id long, state string").coalesce(1).write.parquet(path)
    return rows, path


def test_lifecycle_stream_equals_batch(spark, event_files, tmp_path):
    rows, path = event_files
    stream = spark.readStream.schema("job long, event_id long, state string").parquet(path)
    q = progress.lifecycle_stream(stream).writeStream.format("memory").queryName("lifecycle").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    end = time.time() + 60  # a query with timeouts in processing time never runs out of batches by itself
    while spark.table("lifecycle").count() < len(rows) and time.time() < end:
        time.sleep(0.5)
    q.stop()
    want = progress.job_lifecycle(spark.read.parquet(path), "job", "state", ["event_id"]).select("job", "event_id", "before", "state", "legal")
    assert sorted(map(tuple, spark.table("lifecycle").collect())) == sorted(map(tuple, want.collect()))


def test_progress_and_state_on_a_stream(spark, tmp_path):
    lines = ["plain", "[x] " + progress.MARK + '{"event_id": 1, "job": 7, "stage": "a", "state": "started"}', progress.MARK + '{"event_id": 2, "job": 7, "stage": "a", "state": "completed", "percent": 100}', progress.MARK + "{bad", progress.MARK + '{"event_id": 3, "job": 7, "stage": "a", "state": "odd"}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log.txt").write_text("\n".join(lines))
    parsed = progress.parse_progress(spark.readStream.text(str(tmp_path / "in")))
    state = progress.stage_state(parsed.where("kind = 'event'"), ["job", "stage"], ["event_id"], ["state", "percent"])
    q = state.writeStream.format("memory").queryName("stage_state").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(90)
    assert [tuple(r) for r in spark.table("stage_state").collect()] == [(7, "a", 2, "completed", 100.0)]
    kinds = [r.kind for r in progress.parse_progress(spark.read.text(str(tmp_path / "in"))).collect()]
    assert sorted(kinds) == ["bad", "bad", "event", "event", "plain"]


def test_an_unseen_view_changes_nothing(spark):
    df = spark.createDataFrame([("a", "g", 1, True), ("a", "g", 2, True)], "k string, g string, v int, ok boolean")
    more = df.unionByName(spark.createDataFrame([("a", "h", 3, False)], df.schema))
    run = lambda d: [tuple(r) for r in stats.multiview_support(d, ["k"], "g", "v", F.col("ok")).collect()]
    assert run(df) == run(more) == [("a", "g", 2)]
