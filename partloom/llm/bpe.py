"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens. It starts as one state that every byte leads back to.
Each merge (u, v -> w), in order, adds a gadget:

* arcs labelled u get a state of their own (a copy of the one they led to), so that
  what may follow u can differ from what may follow other tokens;
* that state loses its arc v, as u and v standing together would have been merged;
* every state with an arc u gets an arc w, which leads where v led. For u = v the
  merge takes pairs from the left: the state behind u gets no arc w, and w leads to
  the state behind u as it was before the arc was taken away.

After the last gadget just one path spells each word: its encoding. Arcs of a copied
state are not written out; a state stores its origin, the rule at which it was
split off and the arcs it lost, and a look-up is kept in the transition table once made.
Words are encoded by walking that table over the word's bytes; a sequence of ids is
decoded by emitting the labels of its arcs.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows are encoded each; a column with the name of an output is left behind;
ids that are not in the vocabulary decode to nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.llm.common import bounded_batches, held, replaced, slices, texts, with_fields
from partloom.llm.spelling import LONG, Endings, Table, prefixes, ragged
from partloom.llm.vocabulary import Vocabulary

#: Arcs kept in the transition table once looked up.
ARCS = 700_000
#: Arcs that are looked up one by one rather than as arrays.
FEW = 300


class Automaton:
    """States are numbers; all arcs with one label lead to one state."""

    def __init__(self, path: str):
        vocab = self.vocab = Vocabulary(path)
        n = max(vocab.bytes_to_id.values()) + 1
        target, born, left = [0] * n, [-1] * n, [0] * n  # of each token: where its arcs lead, the rule that made it, its left part
        origin, split, labels = [0], [-2], [257]  # of each state; labels: so many lead there, the start included
        lost: dict[int, int] = {}
        doubled: list[int] = []

        def copy(state: int, rule: int) -> int:
            origin.append(state)
            split.append(rule)
            labels.append(1)
            return len(origin) - 1

        for rule, (u, v, w) in enumerate(vocab.merges):
            behind = target[u]
            if labels[behind] > 1:
                labels[behind] -= 1
                behind = target[u] = copy(behind, rule)
            born[w], left[w] = rule, u
            if u == v:
                target[w] = copy(behind, rule)
                doubled.append(behind << 20 | w)
            else:
                target[w] = target[v]
                labels[target[v]] += 1
            lost[behind << 20 | v] = rule
        vocab.merges.clear()  # all that is needed of them is in the tables
        self.endings = Endings(vocab)
        self.size, self.shorter, self.reach = self.endings.size, self.endings.shorter, self.endings.reach
        self.tables = Table(list(lost), list(lost.values())), Table(doubled, [1] * len(doubled))
        self.lost, self.doubled, self.lists = lost, set(doubled), (born, left, origin, split)
        self.known, self.fresh = Table([], [], ARCS), []
        self.arrays = tuple(np.array(x, np.int64) for x in (target, born, left, origin, split))
        self.target = self.arrays[0]

    def has(self, state: int, token: int, rule: int = 1 << 60) -> bool:
        """Whether the arc is there, or was before a rule: gadgets are undone from the last one on, until the arc is one that stood at the start or was lost."""
        lost, doubled, (born, left, origin, split) = self.lost, self.doubled, self.lists
        while True:
            made, key = born[token], state << 20 | token
            if made >= rule or lost.get(key, rule) < rule:
                return False
            if made < split[state]:
                rule, state = split[state], origin[state]
            elif made < 0:
                return True
            elif key in doubled:
                return False
            else:
                token, rule = left[token], made

    def all_have(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the arcs are there, from the states behind ``last``, through the transition table."""
        keys = self.arrays[0][last] << 20 | token
        ok = self.known.get(keys, -1)
        new = np.flatnonzero(ok < 0)
        if len(new):
            arcs, where = np.unique(keys[new], return_inverse=True)
            found = self.look_up(arcs >> 20, arcs & 0xFFFFF)
            ok[new] = found[where]
            self.fresh.append((arcs, found))
        return ok.astype(bool)

    def keep(self) -> None:
        """Adds the arcs looked up since to the transition table; a full one starts anew."""
        if self.fresh:
            arcs, first = np.unique(np.concatenate([a for a, _ in self.fresh]), return_index=True)
            found = np.concatenate([f for _, f in self.fresh])[first]
            self.fresh.clear()
            if len(self.known) + len(arcs) > ARCS:
                self.known = Table([], [], max(ARCS, len(arcs)))
            self.known.add(arcs, found)

    def look_up(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """:meth:`has` for arrays (1 or 0). The few arcs that take the most steps are ended one by one."""
        _, born, left, origin, split = self.arrays
        lost, doubled = self.tables
        ok, rule, todo = np.zeros(len(state), np.int64), np.full(len(state), 1 << 60), np.arange(len(state))
        while len(todo) > FEW:
            made, key = born[token], state << 20 | token
            gone = (made >= rule) | (lost.get(key, 1 << 60) < rule)
            copied = ~gone & (made < split[state])
            ok[todo[~gone & ~copied & (made < 0)]] = 1
            stay = copied | ~gone & (made >= 0) & (doubled.get(key, 0) == 0)
            todo, state, token, made, copied = todo[stay], state[stay], token[stay], made[stay], copied[stay]
            rule = np.where(copied, split[state], made)
            state, token = np.where(copied, origin[state], state), np.where(copied, token, left[token])
        for i, s, t, r in zip(todo.tolist(), state.tolist(), token.tolist(), rule.tolist(), strict=True):
            ok[i] = self.has(s, t, r)
        return ok

    def encode_word(self, word: bytes) -> list[int]:
        """The path that spells one word. Of each prefix: its last arc."""
        last = [-1]
        for end in range(1, len(word) + 1):
            start = max(0, end - self.reach.get(word[end - 3 : end], 2)) if end > 2 else 0
            while (token := self.vocab.bytes_to_id.get(word[start:end])) is None:
                start += 1
            while start and not self.has(self.target[last[start]], token):  # just one arc is there, mostly the longest; all are at the start
                token = int(self.shorter[token])
                start = end - int(self.size[token])
            last.append(token)
        path, end = [], len(word)
        while end:
            path.append(last[end])
            end -= int(self.size[path[-1]])
        return path[::-1]

    def plain(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each of some texts without special tokens."""
        each = [self.vocab.words(t) for t in texts]
        met = pa.array([w for words in each for w in words], pa.string()).dictionary_encode()
        words, at = met.dictionary, met.indices.to_numpy()
        size, start, parts, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        for p in prefixes(words, self.endings, self.all_have):
            own = p.count[p.cell[np.arange(len(p.rows)), p.length]]
            first = np.cumsum(own) - own
            flat, left, end, to = np.zeros(int(own.sum()), np.uint32), np.arange(len(own)), p.length.copy(), first + own - 1
            while len(left):
                token = p.token[p.cell[left, end[left]]]
                flat[to[left]] = token
                end[left] -= self.endings.size[token]
                to[left] -= 1
                left = left[end[left] > 0]
            size[p.rows], start[p.rows] = own, n + first
            parts.append(flat)
            n += len(flat)
        self.keep()
        for k in np.flatnonzero(pc.binary_length(words).to_numpy() > LONG):
            path = self.encode_word(words[int(k)].as_py().encode())
            size[k], start[k] = len(path), n
            parts.append(np.array(path, np.uint32))
            n += len(path)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        flat = ids[ragged(start[at], size[at])]
        ends = np.concatenate([[0], np.cumsum(size[at])])[np.cumsum([len(w) for w in each], dtype=np.int64)]
        return np.split(flat, ends[:-1])

    def many(self, texts: Sequence[str]) -> list[bytes]:
        """:meth:`encode` of some texts, the words of all of them together."""
        special = [self.vocab.has_special(t) for t in texts]
        plain = iter(self.plain([t for t, s in zip(texts, special, strict=True) if not s]))
        return [self.encode(t) if s else next(plain).astype("<u4").tobytes() for t, s in zip(texts, special, strict=True)]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, packed as little-endian unsigned 32-bit numbers."""
        parts = []
        for piece, special in self.vocab.segments(text):
            ids = [self.vocab.special[piece]] if special else [i for w in self.vocab.words(piece) for i in self.encode_word(w.encode())]
            parts.append(np.array(ids, "<u4").tobytes())
        return b"".join(parts)


class Labels:
    """The bytes of every token, one after another."""

    def __init__(self, vocab: Vocabulary):
        table = [vocab.labels.get(i, b"") for i in range(max(vocab.labels) + 1)]
        self.size = np.array([len(x) for x in table], np.int64)
        self.start, self.letters = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(table), np.uint8)

    def text(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4")
        numbers = numbers[numbers < len(self.size)]
        return self.letters[ragged(self.start[numbers], self.size[numbers])].tobytes().decode("utf-8", "replace")


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), decoded: str = "") -> DataFrame:
    """``ids`` binary (little-endian unsigned 32-bit numbers, the form that training shards store) and ``n_tokens`` long, without the text. No shuffle.

    decoded: the name of a column for the text that the ids decode to, made by the same tasks.
    """
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col, carry)
    schema = with_fields(rows, ["__text"], [("ids", T.BinaryType()), *([(decoded, T.StringType())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = held(("bpe", tokenizer), lambda: Automaton(tokenizer))
        labels = Labels(machine.vocab) if decoded else None
        for batch in slices(batches, 1024, "__text", 1_500_000):
            ids = machine.many(batch.column("__text").to_pylist())
            columns = {"ids": pa.array(ids, pa.binary())}
            if labels:
                columns[decoded] = pa.array(map(labels.text, ids), pa.string())
            yield replaced(batch, schema, columns)

    return rows.mapInArrow(run, schema).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The text of packed ids, special tokens included; bytes that are not UTF-8 become U+FFFD. All columns stay. No shuffle."""
    bounded_batches(df.sparkSession)
    schema = with_fields(df, [], [(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = held(("labels", tokenizer), lambda: Labels(Vocabulary(tokenizer)))
        for batch in slices(batches, 1024, ids_col):
            yield replaced(batch, schema, {out_col: pa.array(map(labels.text, batch.column(ids_col).to_pylist()), pa.string())})

    return df.mapInArrow(run, schema)
