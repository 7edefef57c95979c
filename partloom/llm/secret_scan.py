"""Secret scans with DataFrame functions only: fixed patterns, and windowed entropy.

Patterns give the base spans (leftmost, non-overlapping, for each kind by itself). Places follow from the text
between the matches: a match starts where the pieces and matches before it end.

Entropy adds spans. Candidates are runs of at least ``WINDOW`` key characters. A window of ``WINDOW`` characters slides over
each; the counts of its characters are kept, and moving by one changes two of them, and with them the sum of n log2 n from which the
entropy follows. A candidate whose highest window reaches the bound of its class (hexadecimal or mixed) is a span, unless the
allow list clears it (words, dotted names, paths and numbers, placeholders) or it overlaps a base span.

Defined results: null and empty texts have no spans; repeated rows are scanned each; extra columns are left out; an empty
table gives an empty table. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import texts

#: The base patterns, and the least length of what they have to find (of group 2 for assign).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA[A-Z0-9]+ of 16 characters and more: a run is taken whole or not at all
HEX = r"[0-9a-f]{32,}"  # [0-9a-f]+ of 32 characters and more, likewise
LEAST_VALUE = 8
#: Kinds in their order.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
#: Characters of keys, the window, and the least entropy (bits a character) of each class.
KEY_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
LEAST_BITS = {"entropy_hex": 3.0, "entropy_mixed": 3.8}
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW
#: Candidates that are no keys: without digits (words, paths, names), numbers, runs of words and short numbers, placeholders.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[0-9_=/+-]*$",
    r"^(?:[A-Za-z]+|[0-9]{1,4})(?:[-_/=+]+(?:[A-Za-z]+|[0-9]{1,4}))*[-_/=+]*$",
    r"(?i:example|sample|dummy|placeholder|changeme|your[-_]?(?:key|token|secret)|x{6,}|0123456789|abcdefgh)",
)
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body``, in which ``name`` stands for a value that is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _running(values: str, step: str, kind: str = "int") -> str:
    """SQL: the running results of ``step`` (over a and b) along an array. Blocks as long as the root of its size are run through by themselves and then joined on, since an array grows by copying."""
    last = lambda x: f"get({x}, size({x}) - 1)"
    grow = lambda items, item: f"aggregate({items}, cast(array() as array<{kind}>), (done, x) -> array_append(done, if(size(done) = 0, {item}, {step.format(a=last('done'), b=item)})))"
    cut = "transform(sequence(0, cast(ceil(size(v) / w) as int) - 1), k -> slice(v, k * w + 1, w))"
    joined = f"flatten(transform(blocks, (block, k) -> if(k = 0, block, {_let('get(ends, k - 1)', 'base', f'transform(block, y -> {step.format(a='base', b='y')})')})))"
    inner = _let(f"transform({cut}, block -> {grow('block', 'x')})", "blocks", _let(grow("blocks", last("x")), "ends", joined))
    return _let(values, "v", f"if(size(v) = 0, v, {_let('cast(ceil(sqrt(size(v))) as int)', 'w', inner)})")


def _placed(found: str, between: str, rank: str, kind: str, wanted: str, values: str = "0") -> Column:
    """Spans of matches ``found`` (array) with the pieces ``between`` them; wanted: SQL condition with the number i, the match m and the array ``values`` as v.

    A column that is named inside a lambda may be worked out for each element, so whole arrays are bound first.
    """
    lengths = f"zip_with({found}, slice({between}, 1, size({found})), (m, p) -> length(m) + length(p))"
    span = f"named_struct('start', get(ends, i) - length(m), 'rank', {rank}, 'end', get(ends, i), 'kind', {kind})"
    spans = f"filter(transform({found}, (m, i) -> if({wanted}, {span}, cast(null as {_SPAN[6:-1]}))), s -> s is not null)"
    bound = _let(values, "v", _let(_running(lengths, "{a} + {b}"), "ends", spans))
    return F.expr(f"if(size({found}) = 0, cast(array() as {_SPAN}), {bound})")


#: Counts are kept in so many bits each, so many to a whole number.
_BITS, _PACK = 5, 12


def _highest(candidate: str) -> str:
    """SQL: the highest entropy of a window of the string. The counts of a window's characters are packed into a few whole numbers, of which one step changes two."""
    n = -(-(len(KEY_CHARACTERS) + 1) // _PACK)
    weigh = lambda x: f"if({x} > 1, {x} * log2({x}), 0D)"
    come, gone = "get(c, i - 1)", f"if(i > {WINDOW}, get(c, i - {WINDOW} - 1), 0)"
    count = lambda ch: f"cast(shiftright(get(s.n, {ch} div {_PACK}), {_BITS} * ({ch} % {_PACK})) & {(1 << _BITS) - 1} as int)"
    one = lambda ch: f"if(k = {ch} div {_PACK}, shiftleft(1L, {_BITS} * ({ch} % {_PACK})), 0L)"
    return f"""aggregate(array(transform(split({candidate}, ''), ch -> instr('{KEY_CHARACTERS}', ch))), 0D, (none, c) ->
        aggregate(sequence(1, size(c)), named_struct('n', array_repeat(0L, {n}), 'f', 0D, 'low', 1e9D), (s, i) ->
            aggregate(array(named_struct('in', {come}, 'out', {gone}, 'a', {count(come)}, 'b', {count(gone)} + if({come} = {gone}, 1, 0))), s, (t, m) ->
                aggregate(array(s.f + {weigh('(m.a + 1)')} - {weigh('m.a')} + if(m.out > 0, {weigh('(m.b - 1)')} - {weigh('m.b')}, 0D)), t, (u, f) ->
                    named_struct('n', transform(s.n, (x, k) -> x + {one('m.in')} - if(m.out > 0, {one('m.out')}, 0L)), 'f', f, 'low', if(i >= {WINDOW}, least(s.low, f), s.low)))),
            s -> {math.log2(WINDOW)!r}D - s.low / {WINDOW}))"""


def _apart(added: str, base: str) -> Column:
    """The spans of ``added`` that overlap none of ``base``. Both are sorted into one list; of each added span, the farthest end of the base spans that start before it and the next start after it tell."""
    far = 2**31 - 1
    both = f"array_sort(concat(transform({base}, s -> named_struct('start', s.start, 'own', 0, 's', s)), transform({added}, s -> named_struct('start', s.start, 'own', 1, 's', s))))"
    upto = _running("transform(e, x -> if(x.own = 0, x.s.end, 0))", "greatest({a}, {b})")
    after = f"reverse({_running(f'transform(reverse(e), x -> if(x.own = 0, x.start, {far}))', 'least({a}, {b})')})"
    kept = "transform(filter(transform(e, (x, i) -> named_struct('s', x.s, 'ok', x.own = 1 AND get(upto, i) <= x.start AND get(later, i) >= x.s.end)), x -> x.ok), x -> x.s)"
    return F.expr(f"if(size({added}) = 0 OR size({base}) = 0, {added}, {_let(both, 'e', _let(upto, 'upto', _let(after, 'later', kept)))})")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Adds ``base`` and ``spans`` (arrays of start, rank, end, kind in order of start, then kind), without the text. No shuffle."""
    rows = texts(df, id_col, text_col, carry)
    keep = [c for c in rows.columns if c != "__text"]
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}
    found = rows.select("*", *[F.regexp_extract_all("__text", F.lit(p), F.lit(0)).alias(f"__{k}") for k, p in patterns.items()])
    between = found.select("*", *[F.when(F.size(f"__{k}") > 0, F.split("__text", p, -1)).alias(f"__{k}_between") for k, p in patterns.items()], F.when(F.size("__assign") > 0, F.regexp_extract_all("__text", F.lit(ASSIGN), F.lit(2))).alias("__value"))
    odd = " AND ".join(f"NOT (m RLIKE r'{p}')" for p in ALLOWED)
    is_hex = "(m RLIKE '^[0-9a-fA-F]+$')"
    bits = f"{_highest('m')} >= if({is_hex}, {LEAST_BITS['entropy_hex']}D, {LEAST_BITS['entropy_mixed']}D)"
    placed = between.select(
        *keep,
        F.array_sort(F.concat(_placed("__assign", "__assign_between", "0", "'assign'", f"length(v[i]) >= {LEAST_VALUE}", "__value"), _placed("__access", "__access_between", "1", "'access'", "true"), _placed("__hex", "__hex_between", "2", "'hex'", "true"))).alias("base"),
        _placed("__candidate", "__candidate_between", f"if({is_hex}, 3, 4)", f"if({is_hex}, 'entropy_hex', 'entropy_mixed')", f"{odd} AND {bits}").alias("__added"),
    )
    return placed.select(*keep, "base", F.array_sort(F.concat("base", _apart("__added", "base"))).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
