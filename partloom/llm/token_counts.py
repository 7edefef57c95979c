"""Token counts by prefix dynamic programming.

Byte-pair encoding has this property: of the tokens that end a word's prefix, just
one fits the last token of what stands before it. So the last token of every
prefix, and the number of tokens in it, follow from shorter prefixes. The operator
stores that number for every prefix of the text; questions about truncation and
budgets are then look-ups (:func:`tokens_before`, :func:`chars_within`), with
nothing encoded again.

Defined results: a null or empty text has no prefixes (an empty array, 0 tokens);
repeated rows are counted each; a column of the input that has an output's name is
left behind; an empty table gives an empty table. Very long texts need memory in
proportion to one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.llm.common import bounded_batches, held, replaced, slices, texts, with_fields
from partloom.llm.spelling import LONG, Endings, Table, prefixes, ragged
from partloom.llm.vocabulary import Vocabulary

#: White space of which the split depends on what follows.
PAIR = re.compile(r"\s\s")


#: A rank after all merges.
NEVER = 1 << 60


def special_unit(unit: str) -> bool:
    """Whether prefixes of the unit are split otherwise than the unit: white space with what follows it, contractions."""
    return (unit[:2].isspace() and len(unit) > 1) or (unit[0] == "'" and unit[1:].isalpha())


class PrefixCounts:
    """Counts for each prefix of a word or a text, in code points."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.ids = ids = self.vocab.bytes_to_id
        n = max(ids.values()) + 1
        self.ranks = {a * n + b: k for k, (a, b, _) in enumerate(self.vocab.merges)}
        self.n, self.born, self.left, self.right = n, [-1] * n, [0] * n, [0] * n
        for k, (a, b, c) in enumerate(self.vocab.merges):
            self.born[c], self.left[c], self.right[c] = k, a, b
        self.endings = Endings(self.vocab)
        self.size, self.shorter, self.reach = self.endings.size.tolist(), self.endings.shorter.tolist(), self.endings.reach
        self.table = Table(list(self.ranks), list(self.ranks.values()))
        self.arrays = tuple(np.array(x, np.int64) for x in (self.born, self.left, self.right))

    def fits(self, last: int, token: int) -> bool:
        """Whether no merge crosses from ``last`` into ``token``. Merges are undone from the latest on; what then meets at the border must not have a merge of an earlier rank."""
        ranks, born, n = self.ranks, self.born, self.n
        a, b, before = last, token, NEVER
        while True:
            if ranks.get(a * n + b, NEVER) < before:
                return False
            if born[a] > born[b]:
                before, a = born[a], self.right[a]
            elif born[b] >= 0:
                before, b = born[b] + 1, self.left[b]  # of equal merges, the one at the border comes first
            else:
                return True

    def all_fit(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """:meth:`fits` for arrays."""
        born, left, right = self.arrays
        pairs, where = np.unique(last * self.n + token, return_inverse=True)
        a, b = pairs // self.n, pairs % self.n
        before, ok, todo = np.full(len(pairs), NEVER), np.ones(len(pairs), bool), np.arange(len(pairs))
        while len(todo):
            crossed = self.table.get(a * self.n + b, NEVER) < before
            ok[todo[crossed]] = False
            stay = ~crossed & ((born[a] >= 0) | (born[b] >= 0))
            todo, a, b = todo[stay], a[stay], b[stay]
            first = born[a] > born[b]
            before = np.where(first, born[a], born[b] + 1)
            a, b = np.where(first, right[a], a), np.where(first, b, left[b])
        return ok[where]

    def by_byte(self, word: bytes) -> list[int]:
        """Tokens in each prefix of one word, for 0 bytes and up."""
        last, count = [-1], [0]
        for end in range(1, len(word) + 1):
            start = max(0, end - self.reach.get(word[end - 3 : end], 2)) if end > 2 else 0
            while (token := self.ids.get(word[start:end])) is None:
                start += 1
            while start and not self.fits(last[start], token):  # just one fits, mostly the longest; any may follow the start
                token = self.shorter[token]
                start = end - self.size[token]
            last.append(token)
            count.append(count[start] + 1)
        return count

    def total(self, text: str) -> int:
        return sum(self.by_byte(w.encode())[-1] for w in self.vocab.words(text))

    def steps(self, unit: str) -> list[int]:
        """How the count changes with each code point of a unit: one word, or white space of two characters or more and the word after it."""
        if special_unit(unit):
            at = [self.total(unit[:i]) for i in range(len(unit) + 1)]
        else:
            at = self.by_byte(unit.encode())
            at = [at[e] for e in accumulate((len(c.encode()) for c in unit), initial=0)]
        return list(map(sub, at[1:], at))

    def units(self, text: str) -> list[str]:
        words = self.vocab.words(text)
        if not PAIR.search(text):
            return words
        units: list[str] = []
        for w in words:
            if units and units[-1].isspace() and (w[0].isspace() or len(units[-1]) > 1):
                units[-1] += w
            else:
                units.append(w)
        return units

    def plain(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The count's changes along each of some texts without special tokens."""
        each = [self.units(t) for t in texts]
        met = pa.array([u for units in each for u in units], pa.string()).dictionary_encode()
        words, at = met.dictionary, met.indices.to_numpy()
        alone = {k: self.steps(u) for k, u in enumerate(words.to_pylist()) if special_unit(u) or len(u) * 4 > LONG and len(u.encode()) > LONG}
        plain = pc.if_else(np.isin(np.arange(len(words)), list(alone)), pa.scalar("", pa.string()), words)
        size, start, parts, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        for p in prefixes(plain, self.endings, self.all_fit):
            width = p.letters.shape[1]
            counts = p.count[p.cell[:, 1:]]
            after = np.concatenate([p.letters[:, 1:], np.zeros((len(p.rows), 1), np.int64)], 1)
            ends = (np.arange(1, width + 1) <= p.length[:, None]) & ((after & 0xC0 != 0x80) | (np.arange(1, width + 1) == p.length[:, None]))
            own = ends.sum(1)
            flat = np.diff(counts[ends], prepend=0)
            first = np.cumsum(own) - own
            flat[first] = counts[ends][first]
            size[p.rows], start[p.rows] = own, n + first
            parts.append(flat)
            n += len(flat)
        for k, steps in alone.items():
            size[k], start[k] = len(steps), n
            parts.append(np.array(steps, np.int64))
            n += len(steps)
        changes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        flat = changes[ragged(start[at], size[at])].astype(np.int32)
        return np.split(flat, np.cumsum([len(t) for t in texts])[:-1])

    def many(self, texts: Sequence[str]) -> list[np.ndarray]:
        """:meth:`counts` of some texts, the words of all of them together."""
        special = [self.vocab.has_special(t) for t in texts]
        plain = iter(self.plain([t for t, s in zip(texts, special, strict=True) if not s]))
        return [self.counts(t) if s else np.cumsum(next(plain), dtype=np.int32) for t, s in zip(texts, special, strict=True)]

    def counts(self, text: str) -> np.ndarray:
        """Tokens in text[:1], text[:2] and so on to the whole text."""
        parts, before = [], ""
        for piece, special in self.vocab.segments(text):
            if not special:
                parts.append(np.array([d for u in self.units(piece) for d in self.steps(u)], np.int32))
                before = piece
                continue
            # A prefix that ends inside a special token is ordinary text, joined to the word before it.
            tail = self.vocab.words(before)[-1] if before else ""
            base = self.total(tail)
            inside = [self.total(tail + piece[:i]) - base for i in range(len(piece))] + [1]
            parts.append(np.diff(np.array(inside, np.int32)))
            before = ""
        return np.cumsum(np.concatenate(parts), dtype=np.int32) if parts else np.zeros(0, np.int32)


def prefix_table(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """``prefix_counts`` array<int>: tokens in each prefix of the text by code points; ``n_bytes`` long, ``n_tokens`` long.

    tokenizer: path of a byte-level BPE file, as the executors see it. A narrow
    job: no shuffle; each task keeps a bounded store of the words it has met.
    """
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col, carry).withColumn("n_bytes", F.octet_length("__text").cast("long"))
    schema = with_fields(rows, ["__text"], [("prefix_counts", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = held(("counts", tokenizer), lambda: PrefixCounts(tokenizer))
        for batch in slices(batches, 1024, "__text", 1_500_000):
            each = counter.many(batch.column("__text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
            yield replaced(batch, schema, {"prefix_counts": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(each)))})

    return rows.mapInArrow(run, schema).withColumn("n_tokens", F.coalesce(F.try_element_at("prefix_counts", F.lit(-1)), F.lit(0)).cast("long"))


def tokens_before(counts: Column, n_chars: Column | int) -> Column:
    """Tokens of the text truncated to ``n_chars`` code points: one look-up."""
    at = F.least(n_chars if isinstance(n_chars, Column) else F.lit(n_chars), F.size(counts))
    return F.when(at <= 0, F.lit(0)).otherwise(F.try_element_at(counts, at.cast("int")))


def chars_within(counts: Column, budget: Column | int) -> Column:
    """The longest prefix, in code points, of at most ``budget`` tokens. (A longer prefix can have fewer tokens, so the last one that fits is taken.)"""
    limit = budget if isinstance(budget, Column) else F.lit(budget)
    fitting = F.transform(counts, lambda c, i: F.when(c <= limit, i + 1).otherwise(F.lit(0)))
    whole = F.size(counts)
    return F.when((whole == 0) | ((F.try_element_at(counts, F.lit(-1)) <= limit)), whole).otherwise(F.coalesce(F.array_max(fitting), F.lit(0)))
