"""Main text of web pages by wrappers, union-free regular expressions over the token streams of a host.

1. Every page becomes a stream of structure tokens (block tags with their classes, text slots). Repeats inside a
   stream fold into repeated groups, so that pages of one template have few different streams.
2. The pages of a host are told apart by template: the sectioning elements that are no boilerplate, and whether there is an article or main element.
   The distinct streams of a template are merged into one wrapper, ``FAN`` at a time and then the results again: what
   both sides have stays, what just one has becomes optional, equal neighbours become a repeated group. The wrapper accepts all streams.
3. Each page is matched against the wrapper of its template, which says in which slot each of its texts stands. The content slots are chosen for the wrapper as a whole: those
   inside its article or main elements, or, if it has none, inside the smallest element that holds the most text that varies from page to page. Slots in menus, headers, footers, sidebars, notices, adverts,
   forms and reader comments are no content. A text inside the root that is the same on all pages is kept.
4. A page's text is that of its content slots, and of nothing else.

Pages are parsed once, into the shared folder. Streams and slots are counted before anything is grouped by template, so a host with a third of all pages
is a few rows. Wrappers are broadcast while there are at most ``BROADCAST_HOSTS``; beyond, pages are joined by template, and large ones are split by adaptive execution.

Defined results: a null or empty page has the empty text; pages without a host are taken as one host; repeated rows are read each; extra columns are left
out; an empty table gives an empty table. Markup that is cut off or left open is closed where its parent ends.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import html
import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.llm.common import bounded_batches, replaced, shared_folder, slices, stored, with_fields

#: Wrappers that are broadcast at most.
BROADCAST_HOSTS = 20_000
#: Wrappers that one task merges at a time.
FAN = 32
#: Element names.
RAW = frozenset("script style noscript template svg iframe object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: A new one of these closes an open one of the same group.
CLOSES = {"p": "p", "li": "li", "dd": "dd dt", "dt": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
#: Elements, and words in classes and ids, that are no content.
NO_CONTENT = frozenset("head title nav header footer aside form button select textarea menu dialog".split())
NO_CONTENT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login masthead menu menus modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
CONTENT = frozenset("article main".split())
#: Elements that tell templates apart.
SECTIONING = frozenset("article aside div footer header main nav section table".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)|<[!?][^>]*>?", re.S)
_IN_TAG = re.compile(r"[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


#: Block elements that a path names from the outermost on, and letters of one element's names; what lies deeper or is longer is taken for its parent, or cut. Bounds a page's paths, not its text.
PATH_ELEMENTS, LABEL_LETTERS = 64, 200


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the attributes of a tag end: at the next ">" outside quotes. last: the last place of either quote; a quote that none follows is a letter like others."""
    while (m := _IN_TAG.search(page, at)) is not None:
        at, quote = m.end(), m.group()
        if quote == ">":
            return m.start()
        if m.start() < last[quote]:
            at = page.index(quote, at) + 1
    return len(page)


def blocks(page: str) -> Iterator[tuple[str, str]]:
    """(path, text) of each block in page order; the path names the open block elements with their classes. Text of raw elements is left out. Time and memory grow with the page, however it is nested or cut off."""
    stack: list[tuple[str, str, int]] = []  # name, path, block elements
    opened: dict[str, int] = defaultdict(int)
    path, depth, parts, at, end = "", 0, [], 0, len(page)
    last = {q: page.rfind(q) for q in "\"'"}

    def flush():
        nonlocal parts
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts = []
        return [(path, text)] if text else []

    def pop() -> str:
        nonlocal path, depth
        name = stack.pop()[0]
        opened[name] -= 1
        _, path, depth = stack[-1] if stack else ("", "", 0)
        return name

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        name, inner = m.group(2).lower(), at
        stop = tag_end(page, at, last)
        at = min(stop + 1, end)
        if m.group(1):
            if opened[name]:
                here, left = path, False
                while True:
                    gone = pop()
                    left = left or gone in BLOCK
                    if gone == name:
                        break
                if left:
                    after, path = path, here
                    yield from flush()
                    path = after
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in BLOCK:
            yield from flush()
        if name in VOID:
            continue
        group = CLOSES.get(name, "").split()
        if any(opened[g] for g in group):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in group:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in ("ul", "ol", "table", "article", "main", "section", "div", "dl", "select", "body"):
                    break
        if name in BLOCK and depth < PATH_ELEMENTS:
            names = sorted({w for g in _NAMES.findall(page, inner, stop) for w in "".join(g).lower().split()}) if stop > inner else []
            label = ".".join([name, *names])[:LABEL_LETTERS]
            path, depth = f"{path}/{label}" if path else label, depth + 1
        stack.append((name, path, depth))
        opened[name] += 1
    yield from flush()


def boilerplate(path: str) -> bool:
    """Whether an element on the path is no content by its name, class or id."""
    for label in path.split("/"):
        name, *classes = label.split(".")
        if name in NO_CONTENT and not (name == "header" and "article" in path.split("/header")[0].split("/")):
            return True
        if name not in ("html", "body", "article", "main") and any(w in NO_CONTENT_WORDS for c in classes for w in re.split(r"[-_\d]+", c)):
            return True
    return False


def fold(stream: Sequence) -> tuple:
    """Equal neighbours, also of groups of up to eight tokens, become one repeated group ("+", group)."""
    out = list(stream)
    for size in range(1, 9):
        done, i = [], 0
        while i < len(out):
            group = tuple(out[i : i + size])
            n = 1
            while tuple(out[i + n * size : i + (n + 1) * size]) == group and len(group) == size:
                n += 1
            if n > 1:
                done.append(group[0] if size == 1 and isinstance(group[0], tuple) and group[0][0] == "+" else ("+", group))
                i += n * size
            else:
                done.append(out[i])
                i += 1
        out = done
    return tuple(out)


def _parts(item) -> tuple:
    """(group, optional, repeated) of a wrapper's item."""
    optional = repeated = False
    while isinstance(item, tuple):
        if item[0] == "?":
            optional = True
        else:
            repeated = True
        if len(item[1]) > 1:
            return item[1], optional, repeated
        item = item[1][0]
    return (item,), optional, repeated


def _item(group: tuple, optional: bool, repeated: bool):
    item = ("+", group) if repeated else group[0]
    return ("?", (item,)) if optional else item


def _key(item):
    """What an item holds, whether it is optional or repeated or not."""
    group = _parts(item)[0]
    return group[0] if len(group) == 1 else tuple(_key(g) for g in group)


#: Pairs of items that two streams are aligned by in one go.
ALIGNED_PAIRS = 250_000


def opcodes(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """How to turn ``a`` into ``b``, as difflib has it. Long streams are first cut at the items that both have just once and in the same order; stretches that stay too long have nothing in common."""
    if len(a) * len(b) <= ALIGNED_PAIRS:
        return SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    once = [{x for x, n in Counter(y).items() if n == 1} for y in (a, b)]
    place = {x: k for k, x in enumerate(b)}
    pairs = [(i, place[x]) for i, x in enumerate(a) if x in once[0] and x in once[1]]
    tails, heads, before = [], [], [-1] * len(pairs)  # the longest run of rising places
    for k, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(tails, j)
        before[k] = heads[at - 1] if at else -1
        tails[at:], heads[at:] = [j, *tails[at + 1 :]], [k, *heads[at + 1 :]]
    chain, k = [], heads[-1] if heads else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    out, i, j = [], 0, 0
    for x, y in [*reversed(chain), (len(a), len(b))]:
        if i < x or j < y:
            cut = (x - i) * (y - j) <= ALIGNED_PAIRS
            out += [(op, p + i, q + i, r + j, t + j) for op, p, q, r, t in SequenceMatcher(None, a[i:x], b[j:y], autojunk=False).get_opcodes()] if cut else [("replace", i, x, j, y)]
        if x < len(a):
            out.append(("equal", x, x + 1, y, y + 1))
        i, j = x + 1, y + 1
    return out


def align(wrapper: tuple, other: tuple) -> tuple:
    """A wrapper that accepts all that one of the two accepts: mismatches become optional, equal neighbours a repeated group."""
    out: list = []

    def add(group: tuple, optional: bool, repeated: bool) -> None:
        item = _item(group, optional, repeated)
        if out and _key(out[-1]) == _key(item):
            before, may, _ = _parts(out[-1])
            out[-1] = _item(both(before, group), may and optional, True)
        else:
            out.append(item)

    def both(a: tuple, b: tuple) -> tuple:
        met = []
        for x, y in zip(a, b, strict=True):
            if isinstance(x, str) and isinstance(y, str):
                met.append(x)
            else:
                (g, o, r), (h, p, q) = _parts(x), _parts(y)
                met.append(_item(both(g, h), o or p, r or q))
        return tuple(met)

    def loose(items: Sequence) -> None:
        for item in items:
            group, _, repeated = _parts(item)
            if len(group) > 1 and not repeated:
                loose(group)
            else:
                add(group, True, repeated)

    for op, a, b, c, d in opcodes([_key(w) for w in wrapper], [_key(w) for w in other]):
        if op == "equal":
            for x, y in zip(wrapper[a:b], other[c:d], strict=True):
                (g, o, r), (h, p, q) = _parts(x), _parts(y)
                add(both(g, h), o or p, r or q)
        else:
            loose(wrapper[a:b])
            loose(other[c:d])
    return tuple(out)


def slots(wrapper: Sequence) -> set[str]:
    """Paths of all text slots, in groups too."""
    found: set[str] = set()
    for w in wrapper:
        if isinstance(w, (tuple, list)):
            found |= slots(w[1])
        else:
            found.add(w)
    return found


def _tuples(x):
    return tuple(_tuples(y) for y in x) if isinstance(x, list) else x


class Matcher:
    """A wrapper as an automaton of positions, which are its text slots in order."""

    def __init__(self, wrapper: tuple):
        self.paths: list[str] = []
        self.follow: list[set[int]] = []
        self.first, self.last, self.empty = self._chain(wrapper)
        self.places: dict[str, list[int]] = defaultdict(list)
        for k, path in enumerate(self.paths):
            self.places[path].append(k)

    def _chain(self, items: Sequence) -> tuple[set[int], set[int], bool]:
        first, last, empty = set(), set(), True
        for item in items:
            if isinstance(item, str):
                self.paths.append(item)
                self.follow.append(set())
                f, e, may = {len(self.paths) - 1}, {len(self.paths) - 1}, False
            else:
                f, e, may = self._chain(item[1])
                if item[0] == "+":
                    for k in e:
                        self.follow[k] |= f
                else:
                    may = True
            for k in last:
                self.follow[k] |= f
            first = first | f if empty else first
            last = last | e if may else e
            empty = empty and may
        return first, last, empty

    def match(self, stream: Sequence[str]) -> list[int] | None:
        """The slot of each token; None if the wrapper does not accept the stream."""
        layers: list[dict[int, int]] = []
        for i, path in enumerate(stream):
            places = self.places.get(path, ())
            layer = {k: -1 for k in places if k in self.first} if i == 0 else {k: q for k in places for q in [next((q for q in layers[-1] if k in self.follow[q]), None)] if q is not None}
            if not layer:
                return None
            layers.append(layer)
        at = next((k for k in layers[-1] if k in self.last), None) if layers else None
        if at is None:
            return None
        out = []
        for layer in reversed(layers):
            out.append(at)
            at = layer[at]
        return out[::-1]


@functools.lru_cache(maxsize=256)
def _matcher(wrapper: str) -> Matcher:
    return Matcher(_tuples(json.loads(wrapper)))


@functools.lru_cache(maxsize=4096)
def _matched(wrapper: str, stream: tuple[str, ...]) -> list[int] | None:
    return _matcher(wrapper).match(stream)


def in_content(path: str) -> bool:
    return bool(CONTENT & {x.split(".")[0] for x in path.split("/")})


def heaviest(mass: dict[str, int]) -> str:
    """The element that holds most of the text at these paths."""
    by: dict[str, int] = defaultdict(int)
    for p, n in mass.items():
        by[p.rpartition("/")[0] or p] += n
    return max(sorted(by), key=lambda k: by[k], default="")


def under(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def template(paths: Sequence[str]) -> str:
    """What tells the templates of a host apart: outer sectioning elements that are no boilerplate, and whether an article or main element holds text."""
    free = [p for p in set(paths) if not boilerplate(p)]
    found = set()
    for p in free:
        labels = p.split("/")
        cuts = [k + 1 for k, x in enumerate(labels) if x.split(".")[0] in SECTIONING][:2]
        found |= {"/".join(labels[:k]) for k in cuts}
    return json.dumps([any(map(in_content, free)), *sorted(found)])


def content(paths: Sequence[str], mass: Sequence[int], same: Sequence[bool]) -> list[int]:
    """The numbers of a wrapper's content slots: all that lie in the content root and in nothing that is no content by its name.

    The root is every article or main element that holds free slots; in a template without one, the smallest element that holds the most text of slots that vary from page to page (of all slots, if none does).
    What stands in an article stays, the same on all pages or not: a standing heading is part of it. In other roots a sectioning element of its own whose slots are all the same on different pages is
    the template's and goes; headings and paragraphs that stand in the root itself stay.
    """
    free = [k for k, p in enumerate(paths) if not boilerplate(p)]
    inside = [k for k in free if in_content(paths[k])]
    if inside:
        return inside
    by: dict[str, int] = defaultdict(int)
    for k in [k for k in free if not same[k]] or free:
        by[paths[k]] += mass[k]
    root = heaviest(by)
    within = [k for k in free if under(paths[k], root)]
    inner = {k: sections(paths[k], root) for k in within}
    varied = {x for k in within if not same[k] for x in inner[k]}
    return [k for k in within if all(x in varied for x in inner[k])] if any(not same[k] for k in within) else within


def sections(path: str, root: str) -> list[str]:
    """The sectioning elements below the root that a path lies in."""
    labels, depth = path.split("/"), len(root.split("/"))
    return ["/".join(labels[: k + 1]) for k in range(depth, len(labels)) if labels[k].split(".")[0] in SECTIONING]


def main_text(paths: Sequence[str], texts: Sequence[str], wrapper: str, wanted: frozenset[int]) -> str:
    """The text of the page's blocks that stand in wanted slots of the wrapper, which accepts every page that it was inferred from."""
    at = _matched(wrapper, tuple(paths)) or ()
    return " ".join(t for k, t in zip(at, texts, strict=False) if k in wanted)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def parse(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` without __html and with template, stream (JSON of the folded paths), and the paths and texts of the blocks."""
    strings = T.ArrayType(T.StringType())
    schema = with_fields(rows, ["__html"], [("template", T.StringType()), ("stream", T.StringType()), ("paths", strings), ("texts", strings)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pages = [list(blocks(page)) for page in batch.column("__html").to_pylist()]
            paths = [[p for p, _ in page] for page in pages]
            columns = {"template": [template(p) for p in paths], "stream": [json.dumps(fold(p)) for p in paths]}
            lists = {"paths": paths, "texts": [[t for _, t in page] for page in pages]}
            arrays = {k: pa.array(v, pa.string()) for k, v in columns.items()} | {k: pa.array(v, pa.list_(pa.string())) for k, v in lists.items()}
            yield replaced(batch, schema, arrays)

    return stored(rows.mapInArrow(run, schema), folder, "pages")


def infer(parsed: DataFrame, folder: str, fan: int = FAN) -> DataFrame:
    """(host, template, wrapper): one wrapper from all distinct streams of a template, as JSON."""
    keys = ["host", "template"]

    def wrap(pdf: pd.DataFrame) -> pd.DataFrame:
        merged = functools.reduce(align, (_tuples(json.loads(w)) for w in sorted(pdf["wrapper"])))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "template": [pdf["template"].iloc[0]], "wrapper": [json.dumps(merged)]})

    level, k = stored(parsed.select(*keys, F.col("stream").alias("wrapper")).distinct(), folder, "wrappers-0"), 0
    while True:
        counts = level.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        if not counts.where("n > 1").limit(1).count():
            return level
        k += 1
        dealt = level.join(counts, keys).withColumn("bucket", F.pmod(F.xxhash64("wrapper", F.lit(k)), F.ceil(F.col("n") / fan)))
        level = stored(dealt.groupBy(*keys, "bucket").applyInPandas(wrap, "host string, template string, wrapper string").distinct(), folder, f"wrappers-{k}")


def choose(met: DataFrame, folder: str) -> DataFrame:
    """(host, template, wrapper, wanted): numbers of the content slots. met: parsed pages with their wrappers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {c: [] for c in ("host", "template", "wrapper", "slot", "mass", "lo", "hi", "page")}
            columns = [batch.column(c).to_pylist() for c in ("host", "template", "wrapper", "paths", "texts")]
            for name, kind, wrapper, paths, texts in zip(*columns, strict=True):
                found: dict[int, list[str]] = defaultdict(list)
                for k, t in zip(_matched(wrapper, tuple(paths)) or (), texts, strict=False):
                    found[k].append(t)
                page = zlib.crc32("\n".join(texts).encode())
                for k, held in found.items():
                    # a digest of each text: equal texts have equal ones
                    marks = [hashlib.blake2b(t.encode(), digest_size=8).hexdigest() for t in held]
                    for c, v in zip(out, (name, kind, wrapper, k, sum(map(len, held)), min(marks), max(marks), page), strict=True):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64() if c in ("slot", "mass", "page") else pa.string()) for c in out]))

    seen = met.select("host", "template", "wrapper", "paths", "texts").mapInArrow(read, "host string, template string, wrapper string, slot bigint, mass bigint, lo string, hi string, page bigint")
    stats = seen.groupBy("host", "template", "wrapper", "slot").agg(F.sum("mass").alias("mass"), (F.min("lo") == F.max("hi")).alias("same"), (F.min("page") < F.max("page")).alias("pages"))

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        wrapper = pdf["wrapper"].iloc[0]
        paths = _matcher(wrapper).paths
        mass, alike = [0] * len(paths), [False] * len(paths)
        for k, m, same, pages in zip(pdf["slot"], pdf["mass"], pdf["same"], pdf["pages"], strict=True):
            mass[k], alike[k] = int(m), bool(same and pages)
        out = {"host": pdf["host"].iloc[0], "template": pdf["template"].iloc[0], "wrapper": wrapper, "wanted": content(paths, mass, alike)}
        return pd.DataFrame({c: [v] for c, v in out.items()})

    return stored(stats.groupBy("host", "template").applyInPandas(decide, "host string, template string, wrapper string, wanted array<bigint>"), folder, "chosen")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS else df


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: id, url, ``text``, ``n_chars`` long."""
    bounded_batches(df.sparkSession)
    folder, keys = shared_folder(df.sparkSession), ["host", "template"]
    pages = df.select(F.col(id_col).alias(id_col), F.col(url_col).alias(url_col), host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("__html"))
    parsed = parse(pages, folder)
    chosen = choose(parsed.join(_small(infer(parsed, folder)), keys), folder)
    rows = parsed.join(_small(chosen), keys, "left").select(id_col, url_col, "paths", "texts", "wrapper", "wanted")
    schema = with_fields(rows, ["paths", "texts", "wrapper", "wanted"], [("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("paths", "texts", "wrapper", "wanted")]
            out = [main_text(p, t, w or "[]", frozenset(k or ())) for p, t, w, k in zip(*columns, strict=True)]
            yield replaced(batch, schema, {"text": pa.array(out, pa.string())})

    return rows.mapInArrow(run, schema).withColumn("n_chars", F.char_length("text").cast("long"))
