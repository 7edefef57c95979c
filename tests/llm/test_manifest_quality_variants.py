"""Spelling variants, Merkle manifests and quality rules against plain versions, on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from partloom.llm import merkle, quality, variants
from partloom.llm.common import shared_folder

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, n_words string, tree string, word string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, g, None if t is None else len(t), "clash", "clash", "clash", 7) for i, t, s, g in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [(1, "x", "s", "l")]).where("false")


# --- spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(n):
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v)) if near else None
        out[w] = (best if best and n[best] >= 2 * n[w] else None, len(near))
    rows = set()
    for w, (form, size) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n[w], size, n[form] if form else None))
    return rows


def found_groups(df, **more):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variant_groups(df, **more).collect()}


@pytest.mark.parametrize("symbols", [1, 3, 6, 32])
def test_variant_groups_equal_all_pairs(spark, symbols):
    r = random.Random(symbols)
    stems = ["".join(r.choice("abcàÿ×") for _ in range(r.randint(4, 7))) for _ in range(25)]
    words = []
    for s in stems:
        words += [s] * r.choice([3, 6, 12, 25])
        for _ in range(4):
            k = r.randrange(len(s))
            words += [r.choice([s[:k] + s[k + 1 :], s[:k] + r.choice("abd") + s[k + 1 :], s[:k] + "b" + s[k:]])] * r.randint(1, 7)
    r.shuffle(words)
    texts = [" ".join(words[k : k + 40]) for k in range(0, len(words), 40)]
    n = {w: c for w, c in Counter(words).items() if len(w) >= 5 and c >= 3}
    assert found_groups(table(spark, [(i, t, "s", "l") for i, t in enumerate(texts)]), symbols=symbols) == plain_groups(n)


def test_long_chains_of_forms_lead_to_one_root(spark):
    chain = ["z" * k + "abcdefghi"[k:] for k in range(9)]  # each one letter from the next
    text = " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k))
    rows = {r.word: (r.form, r.root) for r in variants.variant_groups(table(spark, [(1, text, "s", "l")])).collect()}
    assert rows[chain[0]] == (chain[1], chain[-1]) and {root for _, root in rows.values()} == {chain[-1]}


def test_mistyped_words_and_defined_results(spark, empty):
    letters = "Straße Hello hello HELLO worlds, world's naïve-naïve É ÉÉÉÉÉ" + " x" * 9
    rows = [(i, letters, "s", "l") for i in range(300)] + [(7, letters, "s", "l"), (None, letters, "s", "l"), (1000, None, "s", "l"), (1001, "", None, None), (1002, "longer " * 20_000, "s", "l")]
    want = Counter()
    for i, text, _, _ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in "".join(c if c in variants.LETTERS else " " for c in low).split():
            h = zlib.crc32(f"{i}:{w}".encode())
            want[w[: h % len(w)] + w[h % len(w) + 1 :] if i is not None and h % 7 == 0 else w] += 1
    assert found_groups(table(spark, rows), mistype_every=7) == plain_groups({w: c for w, c in want.items() if len(w) >= 5 and c >= 3})
    assert found_groups(empty) == set() == found_groups(table(spark, [(1, None, "s", "l")]))
    with pytest.raises(ValueError, match="alphabet"):
        variants.near_words(empty.selectExpr("word", "1L AS n"), "nowhere", symbols=33)


# --- Merkle manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """The root, and of each leaf the siblings of each level with its own place."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[k : k + 3] for k in range(0, len(level), 3)]
        for i, k in enumerate(at):
            run = runs[k // 3]
            paths[i].append((run[: k % 3], run[k % 3 + 1 :]))
            at[i] = k // 3
        level = [h(*r) for r in runs]
    return level[0], paths


def plain_manifest(rows):
    leaf = lambda *x: h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in x])
    trees = defaultdict(list)
    for i, t, s, g in rows:
        other = t if t is None or i is None or zlib.crc32(str(i).encode()) % 2 else t.replace("\n", "")
        n = None if t is None else len(t)
        trees[(s is not None, (s or "").encode())].append(((i is not None, i or 0), leaf(i, s, g, n, t), leaf(i, s, g, n, other), i))
    names = sorted(trees)
    done = {k: (sorted(v, key=lambda x: x[:3]), *plain_tree([x[1] for x in sorted(v, key=lambda x: x[:3])])) for k, v in trees.items()}
    root, tops = plain_tree([done[k][1] for k in names])
    out = []
    for k, above in zip(names, tops, strict=True):
        members, subroot, paths = done[k]
        for (_, own, checked, i), path in zip(members, paths, strict=True):
            at = checked
            for left, right in path + above:
                at = h(*left, at, *right)
            out.append((i, own, subroot, root, h(*[x for left, right in path + above for x in left + right]), at, at == root))
    return sorted(out, key=repr)


def found_manifest(df):
    return sorted(map(tuple, merkle.verify_dataset(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def test_manifest_equals_plain_trees(spark, empty):
    rows = [(i, f"line {i}\nnext", s, "en") for s, n in ((None, 2), ("", 1), ("b", 3), ("é", 4), ("a", 10), ("hot", 2200)) for i in range(n)]
    rows += [(None, "no id\n", "a", None), (None, None, "a", None), (5, "", "b", ""), (5, "", "b", ""), (-3, "x\n" * 50_000, None, "é")]
    random.Random(1).shuffle(rows)
    got = found_manifest(table(spark, rows))
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}
    assert found_manifest(empty) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_blocks_of_any_width_give_one_tree(spark, n):
    leaves = [h(str(i)) for i in range(n)]
    df = spark.createDataFrame([("t", i, n, bytes.fromhex(d)) for i, d in enumerate(leaves)], "tree string, rank long, n long, digest binary")
    root, paths = plain_tree(leaves)
    for levels in (1, 2, 6):
        witnesses, roots = merkle.grown(df, shared_folder(spark), "x", levels)
        assert [r.root.hex() for r in roots.collect()] == [root]
        for r in witnesses.collect():
            assert [[*map(bytes.hex, o)] for _, o in merkle.siblings(r.witness)] == [left + right for left, right in paths[r["rank"]]]
            assert merkle.folded(bytes.fromhex(leaves[r["rank"]]), r.witness).hex() == root


def test_appender_extends_the_witnesses_of_open_subtrees():
    nodes = [bytes([i]) * 32 for i in range(5)]
    a = merkle.Appender(2)
    for d in nodes[:3]:
        a.append(d)
    first = bytes(a.witnesses[0])
    assert [o for _, o in merkle.siblings(first)] == [nodes[1:3]]  # its run is complete, the next level is open
    for d in nodes[3:]:
        a.append(d)
    assert bytes(a.witnesses[0]) == first
    root = a.close()
    assert all(merkle.folded(d, bytes(w)) == root for d, w in zip(nodes, a.witnesses, strict=True))


# --- quality rules


def plain_counts(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n, met = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            met |= {i, i + 1, i + 2}
    full = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len((text or "").split("\n")), len(full) - len(set(full)), len(met)


def test_counts_equal_plain_ones(spark):
    r = random.Random(4)
    texts = ["".join(r.choice(["a", "b", "é", " ", "  ", "\n", "\t", "\xa0", "#", "|", "a b c", "\x0b"]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "\n\n", "a b c a b c", "same\nsame\n same\nsame ", "w " * 100_000]
    got = {x.doc_id: x for x in quality.counted(table(spark, [(i, t, "s", "l") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in quality.COUNTS) == plain_counts(t), t


def test_sketches_merge_and_their_quantiles_are_near(spark):
    r = random.Random(2)
    values = [(g, "m", int(r.lognormvariate(6, 2))) for g in "aab" for _ in range(2000)]
    df = spark.createDataFrame(values, "g string, measure string, value long")
    parts = quality.sketches(df, ["g"])
    whole = {"q1": (1, 4), "half": (1, 2), "q99": (99, 100)}
    for key, found in [(x["g"], x) for x in quality.quantiles(parts, ["g"], whole).collect()] + [(None, quality.quantiles(quality.merged(parts, []), [], whole).first())]:
        own = sorted(v for g, _, v in values if key in (None, g))
        assert found.size == len(own)
        for name, (p, q) in whole.items():
            true = own[-(-len(own) * p // q) - 1]
            assert true - true / 32 <= found[name] <= true
    halves = quality.merged(quality.sketches(df.where("value % 2 = 0"), ["g"]).unionByName(quality.sketches(df.where("value % 2 = 1"), ["g"])), ["g"])
    assert sorted(map(tuple, halves.collect())) == sorted(map(tuple, parts.collect()))


def test_thresholds_adapt_to_sources_and_small_groups_take_merged_ones(spark, empty):
    r = random.Random(3)
    text = lambda mark, n=80: " ".join(r.choice("abcdefgh") + f"word{r.randint(0, 9999)}" + (mark if k % 4 == 0 else "") for k in range(n))
    rows = [(i, text(""), "prose", "en") for i in range(150)] + [(1000 + i, text("##"), "code", "en") for i in range(150)]
    rows += [(2000, text("##"), "prose", "en"), (2001, text(""), "code", "en"), (2002, text(""), "tiny", "en"), (2003, text("#" * 9), "tiny", None), (2004, None, None, None), (2005, "few words", "prose", "en"), (2006, "again and again " * 60, "prose", "en"), (2006, "again and again " * 60, "prose", "en")]
    got = defaultdict(list)
    for x in quality.filtered(table(spark, rows)).collect():
        got[x.doc_id].append((x.base_failed, x.kept, x.beyond))
    assert all(got[i] == [(False, True, [])] for i in [*range(150), *range(1000, 1150), 2001, 2002])  # marks are usual in code
    assert got[2000] == [(False, False, ["symbols"])] and not got[2003][0][1]
    assert got[2004] == [(True, False, [])] and got[2005][0][:2] == (True, False)
    assert [x[:2] for x in got[2006]] == [(True, False)] * 2
    assert quality.filtered(empty).collect() == []
    assert [x.kept for x in quality.filtered(table(spark, [(1, None, None, None), (2, "", "s", "l")])).collect()] == [False, False]
