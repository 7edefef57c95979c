"""Operators that work in rounds, keep state or search, against plain versions: one after another, all pairs, all permutations, convolution."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partloom.operators import assembly, fusion, gates, graph, joins, pixels, rank, spatial
from partloom.plans import rules
from partloom.sources import sealed
from partloom.streaming import progress

# --- welding and surfaces


def plain_weld(points, radius):
    reps, out = [], {}
    for i, *p in sorted(points):
        near = [j for j, q in reps if math.dist(p, q) <= radius]
        if not near:
            reps.append((i, p))
        out[i] = min(near, default=i)
    return out


def test_weld_equals_one_point_after_another(spark):
    r = random.Random(3)
    sets = {
        "cloud": [(i, r.random(), r.random(), r.random()) for i in range(250)],
        "border": [(1, 0.1 - 1e-9, 0.0, 0.0), (2, 0.1 + 1e-9, 0.0, 0.0), (3, -1e-9, 0.5, 0.5), (4, 1e-9, 0.5, 0.5)],
        "chain": [(i, 0.07 * i, 0.0, 0.0) for i in range(12)],  # no representative bridges a gap wider than the radius
        "same": [(i, 0.5, 0.5, 0.5) for i in range(300)],
    }
    rows = [(k, *p) for k, ps in sets.items() for p in ps]
    r.shuffle(rows)
    got = defaultdict(dict)
    for x in spatial.weld_points(spark.createDataFrame([*rows, ("none", 1, None, 0.0, 0.0)], "k string, id long, x double, y double, z double"), ["k"], ["x", "y", "z"], 0.1).collect():
        got[x.k][x.id] = x.welded
    assert got.pop("none") == {1: 1}
    for k, ps in sets.items():
        assert got[k] == plain_weld(ps, 0.1), k
    with pytest.raises(ValueError, match="radius"):
        spatial.weld_points(None, ["k"], ["x"], 0.0)


def plain_distance(p, t):
    """By dense search of the triangle, refined around the best place."""
    a, b, c = map(np.array, t)
    at, size = (1 / 3, 1 / 3), 1.0
    best = math.inf
    for _ in range(14):
        for u in np.linspace(max(0, at[0] - size), min(1, at[0] + size), 9):
            for v in np.linspace(max(0, at[1] - size), min(1 - u, at[1] + size), 9):
                d = np.linalg.norm(a + u * (b - a) + v * (c - a) - p)
                if d < best:
                    best, new = d, (u, v)
        at, size = new, size / 2.5
    return best


def test_nearest_surface_equals_all_triangles(spark):
    r = np.random.default_rng(1)
    corners = {"a": r.random((60, 3, 3)) * 0.2 + r.random((60, 1, 3)), "flat": np.array([[[0, 0, 0], [1, 0, 0], [0, 1, 0]], [[5, 0, 0], [5, 0, 0], [5, 0, 0]], [[0, 0, 9], [0, 2, 9], [0, 1, 9]]], float)}
    points = {"a": np.concatenate([r.random((25, 3)), r.random((5, 3)) * 40]), "flat": np.array([[0.2, 0.2, 3], [4, 0, 0], [0, 1.2, 8], [2, 2, 0]], float), "lost": np.zeros((1, 3))}
    tri = spark.createDataFrame([(k, i, *map(float, t.ravel())) for k, ts in corners.items() for i, t in enumerate(ts)], "k string, triangle long, " + ", ".join(f"{c}{x} double" for c in "abc" for x in "xyz"))
    pts = spark.createDataFrame([(k, i, *map(float, p)) for k, ps in points.items() for i, p in enumerate(ps)], "k string, id long, x double, y double, z double")
    for leaf in (2, 1000):
        got = {(x.k, x.id): x for x in spatial.nearest_surface(pts, tri, ["k"], leaf).collect()}
        assert {k for k, _ in got} == {"a", "flat"} and len(got) == 34
        for (k, i), x in got.items():
            each = [plain_distance(points[k][i], t) for t in (corners[k] if leaf == 2 else corners[k][[x.triangle]])]
            assert abs(x.distance - min(each)) < 1e-3, (k, i)
    s = {x.k: x for x in spatial.surface_distances(pts, tri, ["k"]).collect()}
    d = [x.distance for (k, _), x in got.items() if k == "flat"]
    assert s["flat"].samples == 4 and np.allclose([s["flat"].mean, s["flat"].rms, s["flat"].largest], [np.mean(d), np.sqrt(np.mean(np.square(d))), max(d)])


# --- sealed tables


def test_sealed_tables_are_there_whole_or_not_at_all(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1.0, 2.0]), (1, "b", [0.5, 0.5]), (2, "c", [3.0, 4.0])], "k long, v string, vec array<double>")
    path = str(tmp_path / "t")
    left = sealed.stage(df, path, ["k"], ["vec"])  # a writer that dies before the rename
    with pytest.raises(sealed.SealBroken, match="no manifest"):
        sealed.open_sealed(spark, path)
    df.write.parquet(f"{path}{sealed.STAGED}dead/data")  # and one that dies before its manifest
    with pytest.raises(sealed.SealBroken, match="not staged"):
        sealed.publish(spark, f"{path}{sealed.STAGED}dead", path)
    sealed.write_sealed(df, path, ["k"], ["vec"])
    with pytest.raises(FileExistsError):
        sealed.write_sealed(df.limit(1), path, ["k"])
    with pytest.raises(FileExistsError):
        sealed.publish(spark, left, path)
    assert sealed.drop_staged(spark, path) == 2 and sealed.drop_staged(spark, path) == 0
    assert sorted(map(tuple, sealed.open_sealed(spark, path).collect())) == sorted(map(tuple, df.collect()))
    assert sealed.verify_sealed(spark, path).count() == 0


def test_sealed_tables_show_what_was_changed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "b", [0.5, 0.5]), (3, "c", [3.0, 4.0])], "k long, v string, vec array<double>")
    catalog = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    path = str(tmp_path / "bank")
    sealed.write_sealed(df, path, ["k"], ["vec"])
    assert sealed.open_bank(spark, path, catalog, "k", "vec", 2).count() == 3
    with pytest.raises(sealed.SealBroken, match="1 unknown"):
        sealed.open_bank(spark, path, catalog.where("k < 3"), "k", "vec", 2)
    with pytest.raises(sealed.SealBroken, match="3 wrong_size"):
        sealed.open_bank(spark, path, catalog, "k", "vec", 3)
    flipped = df.withColumn("vec", F.when(F.col("k") == 2, F.reverse(F.transform("vec", lambda x: -x))).otherwise(F.col("vec")))
    flipped.where("k < 3").unionByName(spark.createDataFrame([(4, "d", [1.0, 1.0])], df.schema)).write.mode("overwrite").parquet(f"{path}/{sealed.DATA}")
    with pytest.raises(sealed.SealBroken, match="row_sum, vectors of vec"):
        sealed.open_sealed(spark, path)
    assert {x.k: (x.status, x.vectors) for x in sealed.verify_sealed(spark, path).collect()} == {2: ("changed", "vec"), 3: ("missing", ""), 4: ("unknown", "")}
    manifest = tmp_path / "bank" / sealed.MANIFEST
    (tmp_path / "bank" / f".{sealed.MANIFEST}.crc").unlink(missing_ok=True)
    manifest.write_text(manifest.read_text().replace('"rows": 3', '"rows": 4'))
    with pytest.raises(sealed.SealBroken, match="changed"):
        sealed.read_manifest(spark, path)


# --- tails on a stream


def test_log_tail_stream_equals_batch_at_every_trigger(spark, tmp_path):
    r = random.Random(7)
    schema, number = "job long, seq long, line string", 0
    rows, seen = [], []
    (tmp_path / "in").mkdir()
    for k in range(3):
        new = [(r.choice([1, 1, 1, 2]), number + i, f"line {number + i}") for i in range(30)]
        number += 30
        r.shuffle(new)
        rows.append(new)
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = progress.log_tail_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 5, ttl_ms=0)
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        out = spark.read.parquet(str(tmp_path / "out"))
        last = out.join(out.groupBy("job").agg(F.max("seen").alias("seen")), ["job", "seen"])
        so_far = [x for part in rows for x in part]
        want = progress.log_tail(spark.createDataFrame(so_far, schema), "job", ["seq"], 5)
        assert sorted(map(tuple, last.select("job", "seq", "line", "from_end").collect())) == sorted(map(tuple, want.select("job", "seq", "line", "from_end").collect()))
        seen.append({x.job: x.seen for x in last.collect()})
    assert seen[-1] == {j: sum(x[0] == j for part in rows for x in part) for j in (1, 2)}


# --- state from group to group


def test_tournament_equals_a_sequential_loop(spark):
    r = random.Random(9)
    offers = {(a, g, c): (r.choice("rgb"), r.randint(0, 30)) for a in range(25) for g in "xyz" for c in range(4)}
    foot = {(a, g): r.choice([1.0, 2.0, 3.0]) for a in range(25) for g in "xyz"}
    own = spark.createDataFrame([(*k, *v) for k, v in offers.items()], "a long, g string, c long, like string, score long")
    start = spark.createDataFrame([(a, g, 0) for a, g in foot], "a long, g string, c long")
    plan, log = rank.group_tournament(start, own.select("a", "g", "c"), spark.createDataFrame([(*k, v) for k, v in foot.items()], "a long, g string, footprint double"), ["a"], "g", "c", rank.coupled_scorer(own, ["a"], "g", "c", "like", 6), 4, 2)
    want, reasons, changed = {}, {}, 0
    for a in range(25):
        now = dict.fromkeys("xyz", 0)
        for g in sorted("xyz", key=lambda g: (-foot[a, g], g)):
            score = {c: offers[a, g, c][1] + 6 * sum(offers[a, h, now[h]][0] == offers[a, g, c][0] for h in "xyz" if h != g) for c in range(4)}
            first, second = sorted(score, key=lambda c: (-score[c], c))[:2]
            good = first != now[g] and score[first] - score[now[g]] >= 4 and score[first] - score[second] >= 2
            reasons[a, g] = "changed" if good else "kept"
            now[g] = first if good else now[g]
            changed += good
        want |= {(a, g): c for g, c in now.items()}
    assert {(x.a, x.g): x.c for x in plan.collect()} == want and 5 < changed < 70
    assert {(x.a, x.g): "changed" if x.reason == "changed" else "kept" for x in log.collect()} == reasons


def test_tournament_writes_and_shuffles_no_turn(spark, monkeypatch):
    """Many turns plan as many shuffles as few; no table is written; a group of unknown candidates or without a footprint keeps its choice and has no log."""
    written = []
    monkeypatch.setattr(graph.Rounds, "stored", lambda self, df: written.append(df) or df)
    own = spark.createDataFrame([(a, g, c, "rgb"[(a + g + c) % 3], (7 * a + 5 * g + 11 * c) % 30) for a in range(3) for g in range(6) for c in range(3)], "a long, g long, c long, like string, score long")
    start = spark.createDataFrame([(a, g, 0) for a in range(3) for g in range(8)], "a long, g long, c long")
    foot = spark.createDataFrame([(a, g, 1.0 + g) for a in range(3) for g in range(7) if g != 5], "a long, g long, footprint double")
    plan, log = rank.group_tournament(start, own.select("a", "g", "c"), foot, ["a"], "g", "c", rank.coupled_scorer(own, ["a"], "g", "c", "like", 6), 4, 2)
    assert not written and str(plan._jdf.queryExecution().executedPlan()).count("Exchange") < 12
    got = {(x.a, x.g): x.c for x in plan.collect()}
    assert len(got) == 24 and all(got[a, g] == 0 for a in range(3) for g in (5, 6, 7))
    assert {x.g for x in log.collect()} == {0, 1, 2, 3, 4} and any(got.values())


# --- aliases inside texts


def test_aliases_without_spaces_equal_plain_search(spark):
    r = random.Random(2)
    signs = "金木水火土石漆布皮革钢铁"
    aliases = sorted({"".join(r.choice(signs) for _ in range(r.randint(1, 3))) for _ in range(300)} | {"steel", "pvc布", "é", "Ä漆"})
    names = [(a, f"c{i}") for i, a in enumerate(aliases)]
    texts = ["".join(r.choice([*signs, " steel ", "PVC", "x", "é", "ä"]) for _ in range(r.randint(0, 9))) for _ in range(200)] + ["", None, "steely", "Steel"]
    got = {x.i: x.canonical for x in rules.canonicalize_any(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "i", "t", spark.createDataFrame(names, "alias string, canonical string")).collect()}
    for i, t in enumerate(texts):
        low = (t or "").lower()
        words = {x.i: x.canonical for x in ()} or set("".join(c if c.isascii() and c.isalnum() else " " for c in low).split())
        want = {c for a, c in names if (a in words if a.isascii() else a.lower() in low)}
        assert got[i] == ",".join(sorted(want)), t


# --- proximity


def test_proximity_support_equals_all_pairs(spark):
    r = random.Random(4)
    boxes = {(v, p): (x := r.uniform(0, 900), y := r.uniform(0, 900), x + r.uniform(1, 400), y + r.uniform(1, 60), r.choice([0.2, 0.4, 0.9])) for v in range(3) for p in range(40) if r.random() < 0.8}
    members = [(p % 3, p) for p in range(0, 40, 2)]
    got = {(x.part_id, x.component): (x.support, x.views) for x in fusion.proximity_support(spark.createDataFrame([(1, *k, *b) for k, b in boxes.items()], "a long, v long, part_id long, x0 double, y0 double, x1 double, y1 double, weight double"), spark.createDataFrame([(1, *m) for m in members], "a long, component long, part_id long"), ["a"], "v").collect()}
    want = defaultdict(dict)
    for (v, p), a in boxes.items():
        for c, m in members:
            if m != p and (b := boxes.get((v, m))):
                gap = math.hypot(max(0, a[0] - b[2], b[0] - a[2]), max(0, a[1] - b[3], b[1] - a[3]))
                if gap <= max(10, min(36, 0.06 * max(a[2] - a[0], a[3] - a[1], b[2] - b[0], b[3] - b[1]))):
                    want[p, c][v] = max(want[p, c].get(v, 0), min(a[4], b[4]))
    assert got.keys() == want.keys() and all(abs(got[k][0] - sum(x.values())) < 1e-9 and got[k][1] == len(x) for k, x in want.items())


# --- robust fits


def plain_fit(obs):
    """obs: (id, x, y, u, v, area, quality, diagonal). The model and its inliers, or the reason why there is none."""
    area, quality = np.array([o[5] for o in obs]), np.array([o[6] for o in obs])
    floor = np.quantile(area, 0.25) if len(obs) >= 4 else area.min()
    mid = np.median(quality)
    least = max(0.0, mid - 1.4826 * np.median(np.abs(quality - mid)))
    kept = [o for o in obs if o[5] >= floor and o[6] >= least - 1e-12]
    if len(kept) < 3:
        kept = sorted(obs, key=lambda o: (o[6], o[5], o[0]), reverse=True)[: max(3, math.ceil(math.sqrt(len(obs))))]
    if len(kept) < 3:
        return "too_few_anchors"
    x, u, w = np.array([o[1] + 1j * o[2] for o in kept]), np.array([o[3] + 1j * o[4] for o in kept]), np.maximum([o[6] for o in kept], 1e-3)
    limit = max(2.0, 0.15 * np.median([o[7] for o in kept]))
    apart = max(1.0, 0.05 * math.hypot(np.ptp(x.real), np.ptp(x.imag)))
    best = None
    for i, j in itertools.combinations(sorted(range(len(kept)), key=lambda k: kept[k][0]), 2):
        if abs(x[j] - x[i]) < apart or u[i] == u[j]:
            continue
        turn = (u[j] - u[i]) / (x[j] - x[i])
        res = np.abs(turn * x + (u[i] + u[j] - turn * (x[i] + x[j])) / 2 - u)
        inside = res <= limit
        if inside.sum() >= 3:
            key = (round(w[inside].sum(), 9), inside.sum(), -round(np.median(res[inside]), 9), -round(np.median(res), 9))
            if best is None or key > best[0]:
                best = (key, inside)
    if best is None:
        return "no_consensus"
    inside = best[1]
    for _ in range(3):
        m = np.average(x[inside], weights=w[inside]), np.average(u[inside], weights=w[inside])
        turn = np.sum(w[inside] * np.conj(x[inside] - m[0]) * (u[inside] - m[1])) / np.sum(w[inside] * np.abs(x[inside] - m[0]) ** 2)
        inside = np.abs(turn * x + m[1] - turn * m[0] - u) <= limit
    if inside.sum() < max(3, math.ceil(0.5 * len(kept))):
        return "no_majority"
    return turn, m[1] - turn * m[0], int(inside.sum())


def test_robust_fit_equals_a_plain_one(spark):
    r = random.Random(6)
    sets = {}
    for k in range(14):
        n, turn, move, obs = [2, 3, 5, 8, 12][k % 5], complex(r.uniform(-2, 2), r.uniform(0.5, 2)), complex(r.uniform(-50, 50), 9), []
        for i in range(n):
            x = complex(r.uniform(0, 200), r.uniform(0, 200))
            u = turn * x + move + complex(r.gauss(0, 0.4), r.gauss(0, 0.4)) + (complex(r.uniform(-300, 300), 80) if r.random() < 0.07 * (k % 4) else 0)
            obs.append((i, x.real, x.imag, u.real, u.imag, r.uniform(10, 500), r.uniform(0.1, 1), r.uniform(5, 40)))
        sets[k] = obs
    got = {x.k: x for x in fusion.robust_similarity(spark.createDataFrame([(k, *o) for k, obs in sets.items() for o in obs], "k long, id long, x double, y double, u double, v double, area double, quality double, diagonal double"), ["k"]).collect()}
    kinds = set()
    for k, obs in sets.items():
        want = plain_fit(obs)
        kinds.add(want if isinstance(want, str) else "ok")
        if isinstance(want, str):
            assert got[k].status == want
        else:
            assert got[k].status == "ok" and got[k].inliers == want[2]
            assert np.allclose([got[k].c, got[k].s, got[k].tx, got[k].ty], [want[0].real, want[0].imag, want[1].real, want[1].imag], atol=1e-6)
    assert {"ok", "too_few_anchors"} <= kinds


# --- textures


def test_texture_scores_equal_convolution(spark):
    r = np.random.default_rng(5)
    pictures = {k: (r.integers(0, 256, (2, h, w)).astype(float), r.random((h, w)) < share) for k, h, w, share in (("a", 18, 22, 1.1), ("b", 20, 17, 0.995), ("c", 9, 9, 0.5))}
    pictures["a"][0][1] = pictures["a"][0][0] * 0.9
    frames = [spark.createDataFrame([(k, x, y, float(v[t][y, x]), bool(m[y, x])) for k, (v, m) in pictures.items() for y in range(m.shape[0]) for x in range(m.shape[1])], "k string, x int, y int, v double, m boolean") for t in (0, 1)]
    got = {x.k: x for x in pixels.texture_score(*[pixels.detail_histograms(f, ["k"], "v", "m") for f in frames], ["k"]).collect()}

    def square(img, r, f):
        h, w = img.shape
        return np.array([[f(img[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1]) for x in range(w)] for y in range(h)])

    for k, (v, m) in pictures.items():
        inner = next(((e, i) for e in pixels.EROSIONS if (i := square(m, e, np.all)).sum() >= pixels.LEAST_PIXELS), None)
        if inner is None:
            assert (got[k].status, got[k].score) == ("UNSCORABLE", None)
            continue
        scores = []
        for radius in pixels.DETAIL_RADII:
            h = []
            for img in v:
                share = np.minimum(1, np.abs(img - square(img, radius, np.mean)) / np.maximum(24.0, img))[inner[1]]
                h.append(np.bincount(np.minimum(31, np.floor(np.round(share, 9) * 32)).astype(int), minlength=32) / len(share))
            scores.append(np.minimum(*h).sum())
        assert got[k].erosion == inner[0] and abs(got[k].score - np.mean(scores)) < 1e-9
    assert got["c"].status == "UNSCORABLE" and got["a"].status == "PASS"


# --- assignments


def best_total(score, lefts, rights):
    best = (0.0, 0)
    for n in range(min(len(lefts), len(rights)) + 1):
        for a in itertools.combinations(lefts, n):
            for b in itertools.permutations(rights, n):
                if all(p in score for p in zip(a, b, strict=True)):
                    best = max(best, (round(sum(score[p] for p in zip(a, b, strict=True)), 6), n))
    return best


def test_optimal_assignments_with_locks(spark):
    r = random.Random(8)
    tables = {k: {(a, b): r.choice([0.0, 0.25, 0.5, round(r.random(), 3), -0.2]) for a in range(r.randint(1, 4)) for b in range(r.randint(1, 4)) if r.random() < 0.8} for k in range(20)}
    tables = {k: t for k, t in tables.items() if t}
    df = spark.createDataFrame([(k, *p, s) for k, t in tables.items() for p, s in t.items()], "k long, l long, r long, s double")
    locks = {k: (0, 2) for k in tables if k % 2}
    locked = spark.createDataFrame([(k, *p) for k, p in locks.items()], "k long, l long, r long")
    for lock in (None, locked):
        got = defaultdict(list)
        for x in joins.assign_optimal(df, ["k"], "l", "r", "s", lock).collect():
            got[x.k].append(x)
        for k, t in tables.items():
            fixed = locks.get(k) if lock is not None else None
            assert len({x.l for x in got[k]}) == len({x.r for x in got[k]}) == len(got[k])
            assert [(x.l, x.r) for x in got[k] if x.locked] == ([fixed] if fixed else [])
            free = {p: s for p, s in t.items() if not fixed or (p[0] != fixed[0] and p[1] != fixed[1])}
            mine = [x for x in got[k] if not x.locked]
            assert (round(sum(x.s for x in mine), 6), len(mine)) == best_total(free, sorted({p[0] for p in free}), sorted({p[1] for p in free}))
    with pytest.raises(Exception, match="locked twice"):
        joins.assign_optimal(df, ["k"], "l", "r", "s", spark.createDataFrame([(1, 0, 0), (1, 0, 1)], locked.schema)).collect()


def test_margins_of_forbidden_pairs(spark):
    r = random.Random(10)
    score = {(a, b): round(r.random(), 3) for a in range(3) for b in range(4)}
    df = spark.createDataFrame([(1, *p, s) for p, s in score.items()], "k long, l long, r long, s double")
    for lock in (None, (0, 1)):
        free = {p: s for p, s in score.items() if lock is None or (p[0] != lock[0] and p[1] != lock[1])}
        locked = None if lock is None else spark.createDataFrame([(1, *lock)], "k long, l long, r long")
        got = {x.forbidden: x.margin for x in assembly.assignment_margin(df, "k", "l", "r", "s", locked).collect()}
        lefts, rights = sorted({p[0] for p in free}), sorted({p[1] for p in free})
        whole = best_total(free, lefts, rights)[0]
        assert got == {f"{a}>{b}": pytest.approx(whole - best_total({p: s for p, s in free.items() if p != (a, b)}, lefts, rights)[0], abs=1e-6) for a, b in free}


def test_large_assignments_are_optimal():
    """200 by 200, by the dual: prices under which no pair is worth more than it costs and every chosen pair costs what it is worth."""
    r = np.random.default_rng(3)
    diagonal = r.permutation(200)
    u, v = r.integers(0, 1000, 200), r.integers(0, 1000, 200)
    cost = u[:, None] + v[None, :] + r.integers(1, 500, (200, 200))
    cost[np.arange(200), diagonal] = u + v[diagonal]
    assert (joins.least_cost(cost) == diagonal).all()


# --- complete-link clusters


def test_clusters_of_very_many_colours_in_one_key(spark):
    r = np.random.default_rng(4)
    lab = np.round(np.stack([r.uniform(0, 100, 30_000), r.uniform(-90, 90, 30_000), r.uniform(-90, 90, 30_000)], axis=1), 3)
    weight = r.integers(1, 50, len(lab))
    df = spark.createDataFrame([("k", i, float(w), tuple(map(float, p))) for i, (w, p) in enumerate(zip(weight, lab, strict=True))], "k string, part long, w double, lab struct<l:double,a:double,b:double>")
    got = {x.id: x.cluster for x in gates.coating_components(df, ["k"], "part", "w", 12.0).collect()}
    members = defaultdict(list)
    for i in sorted(range(len(lab)), key=lambda i: (-weight[i], i)):
        members[got[i]].append(i)
    assert sorted(members) == list(range(len(members)))
    for c in r.choice(len(members), 40, replace=False):
        own = lab[members[c]]
        assert np.linalg.norm(own[:, None] - own[None], axis=2).max() <= 12.0
    seen = defaultdict(list)
    for i in sorted(range(len(lab)), key=lambda i: (-weight[i], i))[:3000]:  # the fold, as far as it is quick
        first = next((c for c in range(len(seen)) if np.linalg.norm(lab[seen[c]] - lab[i], axis=1).max() <= 12.0), len(seen))
        assert got[i] == first
        seen[first].append(i)


# --- colour that only a rendering has


def test_unreferenced_mass_on_rows_written_out(spark):
    rows = lambda *x: spark.createDataFrame([(v, b, float(n)) for v, b, n in x], "v string, b string, n double")
    reference = rows(*[(v, "grey", 99) for v in "abcde"], *[(v, "red", 1) for v in "abcd"], ("e", "red", 2))
    rendered = rows(*[(v, b, n) for v in "abce" for b, n in (("grey", 80), ("red", 14), ("blue", 6))], ("d", "grey", 95), ("d", "blue", 4), ("d", "red", 1))
    views = spark.createDataFrame([("a", 0.55, False), ("b", 0.54, False), ("c", 0.9, True), ("d", 0.9, False), ("e", 0.9, None), ("f", None, False)], "v string, alignment double, censored boolean")
    trusted = spark.createDataFrame([("e", "blue")], "v string, b string")
    got = {(x.v, x.b): (x.status, x.reason, x.raw_failure, round(x.excess, 6)) for x in fusion.unreferenced_mass(reference, rendered, views, ["v"], "b", "n", ["red", "blue"], trusted).collect()}
    assert len(got) == 12
    assert got["a", "red"] == ("FAIL", "", True, 0.13) and got["a", "blue"] == ("FAIL", "", True, 0.06)
    assert got["b", "red"] == ("PASS", "", False, 0.13)  # not aligned
    assert got["c", "red"] == ("NOT_APPLICABLE", "REFERENCE_MASK_COLOR_CENSORED", True, 0.0)
    assert got["d", "blue"] == ("PASS", "", False, 0.04) and got["d", "red"][0] == "PASS"
    assert got["e", "blue"] == ("PASS", "TRUSTED_COMPATIBLE_COLOR_FAMILY", True, 0.0) and got["e", "red"][:3] == ("PASS", "", False)  # the reference has over a hundredth
    assert got["f", "red"] == ("PASS", "", False, 0.0)
    lost = rows(("a", "grey", 50), ("a", "red", 50))
    hard = lambda v: [x.hard_failure for x in fusion.mass_audit(reference.where("v = 'a'"), lost, ["v"], "b", "n", views=v).collect()]
    seen = lambda a, i: spark.createDataFrame([("a", a, i)], "v string, alignment double, iou double")
    assert (hard(None), hard(seen(0.55, 0.75)), hard(seen(0.54, 0.9)), hard(seen(0.9, 0.74)), hard(seen(0.9, None))) == ([True], [True], [False], [False], [False])
