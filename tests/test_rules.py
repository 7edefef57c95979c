"""The exact rules on rows written out, and operators without SQL against plain versions."""

import colorsys
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partloom.functions import color
from partloom.operators import fusion, gates, graph, joins, mesh, pixels, rank, spatial, stats
from partloom.plans import rules
from partloom.sources import files


def test_quantiles_against_numpy(spark):
    r = random.Random(0)
    rows = [(k, float(r.choice([1, 2, 2.5, 7, r.random()]))) for k in "abc" for _ in range(r.randint(1, 60))] + [("d", None), ("e", 3.0)]
    got = {x.k: x for x in stats.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"q1": 0.25, "m": 0.5, "p9": 0.9}).collect()}
    assert set(got) == {"a", "b", "c", "e"}
    for k, x in got.items():
        v = [b for a, b in rows if a == k]
        assert x.n == len(v) and np.allclose([x.q1, x.m, x.p9], np.quantile(v, [0.25, 0.5, 0.9]))


def test_robust_stats_of_many_equal_values(spark):
    df = spark.createDataFrame([("k", float(v)) for v in [1, 1, 1, 2, 9]], "k string, v double")
    assert tuple(stats.robust_stats(df, ["k"], "v").first()) == ("k", 5, 1.0, 1.0, 2.0, 1.0, 0.0)


def plain_colour_score(a, b):
    def shares(rows, key):
        c = Counter()
        for x in rows:
            c[key(x)] += x["n"]
        return {k: v / sum(c.values()) for k, v in c.items()}

    def median(rows, c):
        total, run = sum(x["n"] for x in rows), 0
        for x in sorted(rows, key=lambda x: x[c]):
            run += x["n"]
            if run >= total / 2:
                return x[c]

    chroma = lambda rows: [x for x in rows if x["s"] >= 0.18 and x["v"] >= 0.12]
    share = lambda rows: sum(x["n"] for x in chroma(rows)) / sum(x["n"] for x in rows)
    sa, sb = shares(a, lambda x: x["c"]), shares(b, lambda x: x["c"])
    recall = [min(1.0, sb.get(k, 0) / min(0.95, max(0.001, v / 2))) for k, v in sa.items()]
    terms = [(0.45, sum(min(v, sb.get(k, 0)) for k, v in sa.items())), (0.12, min(recall)), (0.08, sum(recall) / len(recall))]
    if min(share(a), share(b)) >= 0.02:
        ha, hb = (shares(chroma(x), lambda r: int(r["h"] * 12) % 12) for x in (a, b))
        terms.append((0.25, sum(min(v, hb.get(k, 0)) for k, v in ha.items())))
    terms += [(0.10, 1 - abs(median(a, c) - median(b, c))) for c in "sv"]
    return sum(w * t for w, t in terms) / sum(w for w, _ in terms)


def test_composite_colour_score_against_a_plain_version(spark):
    r = random.Random(1)
    side = lambda k, grey: [{"k": k, "c": r.choice("rgb"), "h": r.random() * 0.99, "s": 0.05 if grey else r.random(), "v": r.random(), "n": r.randint(1, 9)} for _ in range(30)]
    a, b = side("x", False) + side("grey", True), side("x", False) + side("grey", False)
    schema = "k string, c string, h double, s double, v double, n long"
    frame = lambda rows: spark.createDataFrame([tuple(x.values()) for x in rows], schema)
    got = {x.k: x for x in stats.colour_score(frame(a), frame(b), ["k"], "c", "n").collect()}
    assert got["grey"].hue is None and got["x"].hue is not None
    for k in ("x", "grey"):
        assert abs(got[k].score - plain_colour_score([x for x in a if x["k"] == k], [x for x in b if x["k"] == k])) < 1e-9


def test_painted_split_with_one_outlier(spark):
    rows = [("a", v, "red", "paint", f, f"i{v}", False) for v, f in ((1, "matte"), (2, "matte"), (3, "gloss"))]  # one singleton: the others merge
    rows += [("b", v, "red", "paint", f, f"i{v}", False) for v, f in ((1, "matte"), (2, "matte"), (3, "gloss"), (4, "gloss"))]  # two of each: none do
    rows += [("c", v, "red", f, "x", f"i{v}", False) for v, f in ((1, "paint"), (2, "paint"), (3, "metal"))]  # not all painted
    rows += [("d", v, "red", "wood", "x", i, True) for v, i in ((1, "i"), (2, "i"), (3, "j"))] + [("e", v, "red", "wood", "x", f"i{v}", True) for v in (1, 2)]
    df = spark.createDataFrame(rows, "k string, v int, c string, f string, fin string, i string, only boolean")
    out = defaultdict(list)
    for x in fusion.fuse_palettes(df, ["k"], "v", "c", "f", "fin", "i", ["paint"], "only").collect():
        out[x.k].append((x.canonical, x.views, x.supported))
    assert sorted(out["a"]) == [("red", 2, True), ("red:3:paint|gloss", 1, False)]
    assert len(out["b"]) == 4 and len(out["c"]) == 3
    assert out["d"] == [("red", 3, False)] and out["e"] == [("red", 2, True)]


def test_gain_stops(spark):
    h = [("matched", 1, 1.0, 0.5), ("matched", 2, 1.5, 0.01)]
    h += [("stalled", i, 1.0 + i, e) for i, e in enumerate((0.3, 0.2, 0.21, 0.2, 0.22))]
    h += [("converged", 1, 1.0, 0.5), ("converged", 2, 1.001, 0.0201)]
    h += [("measured", 1, 1.0, -0.2), ("measured", 2, 1.125, 0.25), ("measured", 3, 1.0, 0.25)]
    h += [("goes_on", 1, 1.0, 0.4)]
    df = spark.createDataFrame(h, "k string, i int, g double, e double")
    out = {x.k: (x.action, round(x.next_gain, 6)) for x in gates.next_gain(df, ["k"], "i", "g", "e", least_gain=0.01, patience=3, least_step=0.01, known=0.13).collect()}
    assert out["matched"] == ("matched", 1.5)
    assert out["stalled"] == ("stalled", 2.0)  # of equal errors the first
    assert out["converged"] == ("converged", 1.001)
    assert out["measured"] == ("measured", 1.0)
    assert out["goes_on"] == ("damped", 0.8)


def test_appearance_components(spark):
    lab = lambda x: (float(x), 0.0, 0.0)
    parts = [("a", p, f, w, px, lab(p)) for p, f, w, px in ((1, "m", 1.0, 300), (2, "n", 3.0, 300), (3, "m", 2.0, 10), (4, "m", 9.0, 600), (5, "m", 1.0, 100), (6, "m", 1.0, 100))]
    comp = [("a", p, c) for p, c in ((1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5))]
    df = spark.createDataFrame(parts, "k string, p int, f string, w double, px int, lab struct<l:double,a:double,b:double>")
    out = gates.appearance_components(spark.createDataFrame(comp, "k string, p int, component int"), df, ["k"], "p", "f", "w", "px").collect()
    assert [(x.component, x.parts, x.pixels, x.anchor, x.f, x.lab_l) for x in out] == [(1, 3, 610, 2, "n", 2.0)]


def test_rule_parameters(spark):
    rows = [("a/x/1", "cold BOLT", None, None), ("b", "bolt", "ice", None), ("b", "none", None, "steel"), ("a/x/2", "q", "ice", None), ("b", "other", None, None)]
    df = spark.createDataFrame(rows, "path string, name string, mat string, tag string")
    out = rules.rule_parameters(df, "path", "name", "mat", "tag", [{"glob": "a/*", "d": 1.0, "material": "steel"}, {"regex": "^BOLT", "f": 2.0}], {"steel": {"d": 8.0, "f": 0.5}, "ice": {"d": 0.9}}, ["d", "f"]).collect()
    assert [(x.rule, x.d, x.f) for x in out] == [(0, 1.0, 0.5), (1, 0.9, 2.0), (None, 8.0, 0.5), (0, 0.9, 0.5), (None, None, None)]


def test_lane_slots_go_to_every_lane_first(spark):
    df = spark.createDataFrame([("k", f"{lane}{i}", lane, i) for lane, n in (("visual", 1), ("tournament", 4), ("selection", 2)) for i in range(1, n + 1)], "k string, id string, lane string, rank int")
    out = rank.lane_slots(df, ["k"], "id", "lane", 6).orderBy("slot").collect()
    assert [x.id for x in out] == ["selection1", "tournament1", "visual1", "tournament2", "selection2", "tournament3"]


def test_group_round_checks_in_order(spark):
    rows = [("none", "x", 0.9, False, True, True), ("odd", "b", 0.5, True, False, False), ("odd", "x", 0.9, False, True, True), ("best", "b", 0.9, True, True, False), ("best", "x", 0.5, False, True, True), ("all", "b", 0.5, True, True, False), ("all", "x", 0.501, False, True, True)]
    rows += [("small", "b", 0.5, True, True, True), ("small", "x", 0.51, False, True, True), ("near", "b", 0.5, True, True, True), ("near", "x", 0.7, False, True, True), ("near", "y", 0.69, False, True, True), ("won", "b", 0.5, True, True, True), ("won", "x", 0.55, False, True, True)]
    df = spark.createDataFrame(rows, "k string, id string, s double, base boolean, comparable boolean, whole boolean")
    out = {x.k: (x.reason, x.selected) for x in rank.group_round(df, ["k"], "id", "s", "base", "comparable", "whole", 0.05, 0.015).collect()}
    assert out == {"none": ("baseline_not_comparable", None), "odd": ("baseline_not_comparable", "b"), "best": ("baseline_best", "b"), "all": ("all_views_pass", "x"), "small": ("gain_too_small", "b"), "near": ("margin_too_small", "b"), "won": ("improved", "x")}


def test_appearance_links_keep_to_the_gap_of_boxes(spark):
    box = lambda x: (float(x), 0.0, float(x) + 2, 2.0)
    rows = [("k", 1, p, "m", 0.7, (50.0, 0.0, 0.0), box(x)) for p, x in ((1, 0), (2, 3), (3, 20))]
    df = spark.createDataFrame(rows, "k string, v int, p int, f string, w double, lab struct<l:double,a:double,b:double>, box struct<x0:double,y0:double,x1:double,y1:double>")
    pairs = lambda **kw: sorted((x.part_a, x.part_b) for x in joins.appearance_links(df, ["k"], "p", "v", "f", "w", **kw).collect())
    assert pairs() == [(1, 2), (1, 3), (2, 3)] and pairs(box="box", gap=1.0) == [(1, 2)]


def square(image, x0, y0, n, **values):
    return [{"image": image, "x": x, "y": y, **values} for x in range(x0, x0 + n) for y in range(y0, y0 + n)]


def test_silhouette_score_of_shifted_squares(spark):
    cells = [(1, x, y, 2 <= x < 6 and 2 <= y < 6, 3 <= x < 7 and 2 <= y < 6) for x in range(9) for y in range(9)]
    got = pixels.silhouette_score(spark.createDataFrame(cells, "image long, x long, y long, a boolean, b boolean"), ["image"], "a", "b").first()
    assert abs(got.iou - 12 / 20) < 1e-9 and got.edge_f1 == 1.0 and got.aspect == 1.0 and abs(got.profile - (1 + 12 / 16) / 2) < 1e-9
    assert abs(got.score - (0.3 * 0.6 + 0.3 + 0.25 * got.profile + 0.15)) < 1e-9


def test_largest_blobs_and_recovered_regions(spark):
    cells = square(1, 0, 0, 3, kind="rust") + square(1, 8, 8, 2, kind="rust") + square(1, 4, 0, 2, kind="neutral") + square(2, 0, 0, 1, kind="rust") + square(1, 9, 0, 1, kind=None)
    df = spark.createDataFrame([tuple(c.values()) for c in cells], "image long, x long, y long, kind string")
    boxes = spark.createDataFrame([(1, 0, 0, 12, 12), (2, 0, 0, 5, 5)], "image long, x0 long, y0 long, x1 long, y1 long")
    assert sorted(map(tuple, pixels.largest_blobs(boxes, df, "image", F.col("kind") == "rust").collect())) == [(1, 9, 9 / 13), (2, 1, 1.0)]
    known = spark.createDataFrame([(1, 0, 0, 3, 2)], "image long, x0 long, y0 long, x1 long, y1 long")
    assert sorted(map(tuple, pixels.recover_regions(df, known, "image", "kind", 2).collect())) == [(1, "neutral", 4, 4, 0, 5, 1), (1, "rust", 4, 8, 8, 9, 9)]


def test_kinds_of_regions(spark):
    colours = {"accent": (200, 10, 30), "rust": (140, 70, 40), "neutral": (128, 126, 125), None: (120, 150, 110)}
    rows = [(str(k), *colorsys.rgb_to_hsv(*(c / 255 for c in rgb))) for k, rgb in colours.items()]
    out = spark.createDataFrame(rows, "name string, h double, s double, v double").select("name", pixels.region_kind("h", "s", "v").alias("kind")).collect()
    assert all(x.name == str(x.kind) for x in out)


def test_welds_and_distances(spark):
    a = spark.createDataFrame([("k", 1, 0.0, 0.0), ("k", 2, 1.0, 0.0), ("k", 3, 50.0, 0.0)], "k string, id long, x double, y double")
    b = spark.createDataFrame([("k", 9, 0.0, 3.0), ("k", 8, 1.0, 4.0)], "k string, id long, x double, y double")
    got = joins.point_distances(a, b, ["k"], ["x", "y"], 5.0).first()
    assert (got.matched, got.unmatched) == (2, 1) and abs(got.mean - (3 + math.sqrt(10)) / 2) < 1e-6 and abs(got.rms - math.sqrt((9 + 10) / 2)) < 1e-5 and abs(got.largest - math.sqrt(10)) < 1e-6
    p = spark.createDataFrame([("k", i, x, 0.0) for i, x in ((1, 0.0), (2, 0.004), (3, 0.02))], "k string, id long, x double, y double")
    assert {x.id: x.welded for x in spatial.weld_points(p, ["k"], ["x", "y"], 0.01).collect()} == {1: 1, 2: 1, 3: 3}


def test_pieces_and_loose_points(spark):
    corners = [("k", f, c, v) for f, vs in enumerate([(0, 1, 2), (1, 2, 3), (4, 5, 6)]) for c, v in enumerate(vs)]
    points = [("k", v, float(v), 0.0, 0.0) for v in range(9)]
    c, p = spark.createDataFrame(corners, "k string, face int, corner int, vertex int"), spark.createDataFrame(points, "k string, vertex int, x double, y double, z double")
    assert mesh.loose_vertices(c, p, ["k"]).first().loose == 2 and mesh.face_components(c, ["k"]).first().components == 2


def test_propagation_vetoes(spark):
    rows = [("a", 1, "x", "p", False), ("a", 2, None, None, False), ("b", 1, "x", "p", False), ("b", 2, "x", None, False), ("b", 3, None, None, False), ("c", 1, "x", None, True), ("c", 2, None, None, False)]
    out = {(x.k, x.i): (x.v, x.source) for x in graph.propagate(spark.createDataFrame(rows, "k string, i int, v string, params string, faces boolean"), ["k"], "v", "params", "faces").collect()}
    assert out["a", 2] == ("x", "propagated") and out["b", 3] == (None, "parameters_differ") and out["c", 2] == (None, "face_subsets")


def test_digests_tell_rows_apart(spark):
    df = spark.createDataFrame([("x|vy", "z"), ("x", "y|vz"), ("x", None), ("x", ""), ("1:x", "")], "a string, b string")
    assert df.select(files.fingerprint(["a", "b"]).alias("f")).distinct().count() == 5
    one = lambda rows: rules.sealed_digest(spark.createDataFrame(rows, "k int, a string, b string"), ["k"], ["a", "b"]).first().digest
    assert len({one([(1, "x", None)]), one([(1, "x", "")]), one([(1, "x|", "")]), one([(1, "x", "|")])}) == 4
    assert one([(1, "a", "b"), (1, "c", "d")]) == one([(1, "c", "d"), (1, "a", "b")])


def test_files_are_listed_by_suffix_and_name(spark, tmp_path):
    for name in ("a.png", "b_mask.png", "c.JPG", "d.txt", "sub/e.png"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"xyz")
    got = files.file_inventory(spark, str(tmp_path), [".png", ".jpg"])
    assert {x.path.rsplit("/", 1)[1] for x in got.collect()} >= {"a.png", "c.JPG"} and not any("d.txt" in x.path for x in got.collect())


def test_nearest_colours_against_all_pairs(spark, monkeypatch):
    r = random.Random(3)
    lab = lambda: (r.uniform(0, 100), r.uniform(-60, 60), r.uniform(-60, 60))
    obs, bank = [(i, lab()) for i in range(20)], [(i, lab()) for i in range(50)]
    schema = "id long, lab struct<l:double,a:double,b:double>"
    o, b = spark.createDataFrame(obs, schema), spark.createDataFrame(bank, schema.replace("id", "c"))
    run = lambda: {(x.id, x["rank"]): (x.candidate, x.distance) for x in joins.nearest_colour(o, b, ["id"], "c", 3).collect()}
    whole = run()
    pairs = o.withColumnRenamed("lab", "x").join(b.withColumnRenamed("lab", "y")).select("id", "c", F.round(color.delta_e2000(F.col("x"), F.col("y")), 6).alias("d")).collect()
    by = defaultdict(list)
    for x in pairs:
        by[x.id].append((x.d, x.c))
    assert all(whole[i, k + 1] == (c, d) for i, v in by.items() for k, (d, c) in enumerate(sorted(v)[:3]))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 7)  # in blocks
    assert run() == whole


def test_similarity_terms_against_a_plain_version(spark):
    lab = lambda l, a, b: (l, a, b)  # noqa: E731, E741
    e = spark.createDataFrame([(1, lab(0.5, 0.1, 0.0), 0.5, 1.0), (2, lab(0.9, 0.0, 0.0), None, 0.0)], "e long, oklab struct<l:double,a:double,b:double>, rough double, metal double")
    p = spark.createDataFrame([(i, lab(0.5 + i / 10, 0.1, 0.0), i / 10, 1.0 * (i % 2)) for i in range(5)], "p long, oklab struct<l:double,a:double,b:double>, rough double, metal double")
    got = [(x.evidence, x.profile, x.bonus) for x in fusion.similarity_terms(e, p, "e", "p", True, 2).orderBy("evidence", "rank").collect()]
    plain = []
    for i, (el, ea), er, em in ((1, (0.5, 0.1), 0.5, 1.0), (2, (0.9, 0.0), None, 0.0)):
        all_ = [(-round(700 * math.exp(-math.hypot(el - 0.5 - k / 10, ea - 0.1) / 0.1) + (75 * (1 - abs(er - k / 10)) if er is not None else 0) + 100 * (1 - abs(em - k % 2)), 6), k) for k in range(5)]
        plain += [(i, k, -s) for s, k in sorted(all_)[:2]]
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain] and np.allclose([x for *_, x in got], [x for *_, x in plain], atol=1e-5)


def test_registered_score_of_made_up_colours(spark):
    lab = lambda x: (float(x), 0.0, 0.0)
    schema = "k long, at long, lab struct<l:double,a:double,b:double>"
    a, b = ([(1, i, lab(v)) for i in range(10)] + [(2, i, lab(v)) for i in range(3)] for v in (50, 56))
    got = pixels.registered_score(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], "at", 8).collect()
    assert [x.k for x in got] == [1] and abs(got[0].score - (0.8 * math.exp(-6 / 30) + 0.2 * math.exp(-6 / 25))) < 1e-9


@pytest.mark.parametrize("size,distance", [(64, 14), (64, 3)])
def test_hamming_pairs_against_all_pairs(spark, size, distance):
    r = random.Random(distance)
    base = [r.getrandbits(64) for _ in range(8)]
    codes = [b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, distance + 3))) for b in base for _ in range(8)] + base[:2]
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    want = {(i, j, bin(codes[i] ^ codes[j]).count("1")) for j in range(len(codes)) for i in range(j) if bin(codes[i] ^ codes[j]).count("1") <= distance}
    got = joins.hamming_pairs(spark.createDataFrame(list(enumerate(signed)), "id long, c long"), "id", "c", distance)
    assert {tuple(x) for x in got.collect()} == want
    assert got.count() == len(want)


def test_assignments_of_more_items_than_poses(spark):
    r = random.Random(5)
    rows = [(k, v, p, round(r.random(), 3)) for k in range(3) for v in range(6) for p in range(4) if r.random() < 0.8]
    got = {x.k: x.total for x in joins.assign_one_to_one(spark.createDataFrame(rows, "k long, v long, p long, s double"), ["k"], "v", "p", "s").collect()}

    def best(k, v, used):
        if v == 6:
            return 0.0
        options = [best(k, v + 1, used)] + [s + best(k, v + 1, used | {p}) for a, b, p, s in rows if a == k and b == v and p not in used]
        return max(options)

    assert all(abs(got[k] - best(k, 0, frozenset())) < 1e-9 for k in range(3))
