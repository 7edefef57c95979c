"""Toxic spans by a linear-chain conditional random field.

Learning, from a bounded sample of labelled rows (``max_labelled`` ids, those with the
smallest hash; of rows that share an id, the one with the greatest text; an id with several labels has the greatest):

1. Labelled tokens. A document's label holds for the whole document, so the sample's words and word
   beginnings are counted by the different neighbours they have in toxic and in other
   documents (copies of one text count once). Those that stand in toxic documents far more often than chance
   allows mark the toxic tokens there, the ``MAX_MARKS`` farthest from chance at most; all other tokens are clean.
2. The field: two labels, features of the word (itself, its beginnings and end, hashed into
   ``2 ** BITS`` weights), and transitions; fitted by gradient steps on the exact likelihood (forward and
   backward sums) over at most ``MAX_WINDOWS`` windows of labelled tokens.
3. Document scores: a logistic curve over the expected number of toxic tokens and their share of all
   words (in a long clean text a word may look toxic by chance).

Scoring covers every word of every text as one chain: forward-backward marginals of each word,
then the document's score and the offsets of the words of which the marginal is 0.5 or more. A chain is worked on in blocks of
``BLOCK`` words; what a block does to a message is a matrix, and messages are carried over the blocks in both directions, so
the marginals are those of the whole chain. It runs as one narrow job, and keeps nothing from one slice of rows to the next.

Defined results: null and empty texts have no words and get the score of no evidence; repeated rows score alike;
if no labelled row is toxic, or none is clean, all scores are the share of toxic labels (0 without labels); columns
that clash with outputs are left behind; empty tables give empty tables. The inputs of a score are words only.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.llm.common import bounded_batches, dropped, released, replaced, shared_folder, slices, stored, texts, with_fields

#: Labelled rows that learning reads at most; the bound of the sample.
MAX_LABELLED = 5000
#: Windows of labelled tokens, and tokens in a window.
MAX_WINDOWS, WINDOW = 6000, 16
#: Hashed weights: 2 ** BITS.
BITS = 18
#: Words in one block of a chain.
BLOCK = 128
#: Words and beginnings that mark toxic tokens.
MAX_MARKS = 20_000
#: Documents with at least this score are toxic.
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    low = text.lower()
    return _WORD.findall(low) if len(low) == len(text) else [w.lower() for w in _WORD.findall(text)]


def features(words: Sequence[str]) -> np.ndarray:
    """Hashed features of words (none of them empty), one row a word: the word, its end, its beginnings of 3 to 7 letters. A feature that a word lacks is number 2 ** BITS."""
    size = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.cumsum(size) - size
    powers = np.cumprod(np.full(int(size.max()), _ODD), dtype=np.uint64)
    out = [np.add.reduceat(letters * powers[np.arange(len(letters)) - np.repeat(start, size)], start)]
    hashed = np.full(len(size), 11, np.uint64)
    for k in (3, 2, 1):
        hashed = hashed * _ODD + np.where(size >= k, letters[start + np.maximum(size - k, 0)], 0)
    out.append(hashed)
    hashed = np.full(len(size), 7, np.uint64)
    for k in range(7):
        hashed = hashed * _ODD + letters[start + np.minimum(k, size - 1)]
        if k >= 2:
            out.append(np.where(size > k, hashed, 0))
    mixed = [((h ^ (h >> np.uint64(29))) * _ODD + np.uint64(k)) * _ODD >> np.uint64(64 - BITS) for k, h in enumerate(out)]
    has = [True, True, *(size >= k for k in range(3, 8))]
    return np.stack([np.where(ok, m.astype(np.int64), 1 << BITS) for m, ok in zip(mixed, has, strict=True)], 1)


def beginnings(word: str) -> list[str]:
    """The word and its beginnings of four letters and more, as keys of the counts."""
    return [f"w:{word}", *(f"b:{word[:k]}" for k in range(4, min(7, len(word)) + 1))]


@dataclass
class Field:
    """The fitted model; small, and sent with the tasks."""

    weights: np.ndarray
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, ...] = (0.0, 0.0, 0.0)
    constant: float | None = None
    bias: float = 0.0

    def marginals(self, scores: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
        """P(toxic) of each word; scores: of the words of several chains, one chain after another."""
        n = np.array(sizes)
        begin = np.cumsum(n) - n
        blocks = -(-n // BLOCK)
        chain = np.repeat(np.arange(len(n)), blocks)
        number = np.arange(len(chain)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        where = (begin[chain] + number * BLOCK)[:, None] + np.arange(BLOCK)
        real = np.arange(BLOCK) < np.minimum(BLOCK, n[chain] - number * BLOCK)[:, None]
        padded = np.where(real, scores[np.minimum(where, len(scores) - 1)], 0.0)
        # What comes into each block from the left, and from the right: ones at the ends of a chain.
        left, right = np.ones((len(chain), 2)), np.ones((len(chain), 2))
        last = len(chain) - 1
        if (more := np.flatnonzero(number > 0)).size:
            through = np.zeros((len(chain), 2, 2))
            ways = [_forward(padded[more], self.move, real[more], np.tile(unit, (len(more), 1)) @ np.exp(self.move)) for unit in np.eye(2)]
            scale = np.maximum(ways[0][1], ways[1][1])
            for a, (f, log_z) in enumerate(ways):
                through[more, a] = f[-1] * np.exp(log_z - scale)[:, None]
            first = np.flatnonzero(number == 0)
            whole = first[first + 1 <= last]
            whole = whole[number[whole + 1] > 0]
            left_state = np.zeros((len(chain), 2))
            left_state[whole] = _forward(padded[whole], self.move, real[whole], left[whole])[0][-1]
            for k in range(1, int(number.max()) + 1):
                at = np.flatnonzero(number == k)
                left[at] = left_state[at - 1] @ np.exp(self.move)
                state = np.einsum("na,nab->nb", left_state[at - 1], through[at])
                left_state[at] = state / state.sum(1, keepdims=True)
            for k in range(int(number.max()), 0, -1):
                at = np.flatnonzero(number == k)
                state = np.einsum("nab,nb->na", through[at], right[at])
                right[at - 1] = state / state.sum(1, keepdims=True)
        return _sums(padded, self.move, real, left, right)[0][real]

    def document(self, expected: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence(expected, words) @ np.array(self.curve), -30, 30)))


def evidence(expected: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the document's curve is over, one row a document."""
    return np.stack([np.ones_like(expected), np.log1p(expected), np.log((expected + 0.1) / (words + 30))], 1)


def _forward(scores: np.ndarray, move: np.ndarray, real: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised forward messages (tokens, chains, 2) and the log of what they sum to. left: what meets the first token. Tokens that are not real change nothing."""
    n, length = scores.shape
    e, m = np.exp(np.clip(scores, -40, 40)), np.exp(move)
    f, log_z = np.empty((length, n, 2)), np.zeros(n)
    for t in range(length):
        if t:
            clean = f[t - 1, :, 0] * m[0, 0] + f[t - 1, :, 1] * m[1, 0]
            toxic = (f[t - 1, :, 0] * m[0, 1] + f[t - 1, :, 1] * m[1, 1]) * e[:, t]
        else:
            clean, toxic = left[:, 0], left[:, 1] * e[:, 0]
        total = clean + toxic
        f[t, :, 0], f[t, :, 1] = clean / total, toxic / total
        if t and not real[:, t].all():
            off = ~real[:, t]
            f[t, off] = f[t - 1, off]
            total = np.where(off, 1.0, total)
        log_z += np.log(total)
    return f, log_z


def _sums(scores: np.ndarray, move: np.ndarray, real: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward sums: marginals, log partition, and the normalised forward and backward messages. left and right: what meets a chain's first and last token."""
    n, length = scores.shape
    e, m = np.exp(np.clip(scores, -40, 40)), np.exp(move)
    f, log_z = _forward(scores, move, real, left)
    b = np.empty((length, n, 2))
    b[-1] = right
    for t in range(length - 2, -1, -1):
        toxic = b[t + 1, :, 1] * e[:, t + 1]
        b[t, :, 0] = m[0, 0] * b[t + 1, :, 0] + m[0, 1] * toxic
        b[t, :, 1] = m[1, 0] * b[t + 1, :, 0] + m[1, 1] * toxic
        b[t] /= b[t].sum(1, keepdims=True)
        if not real[:, t + 1].all():
            b[t] = np.where(real[:, t + 1, None], b[t], right)
    p = f * b
    return (p[:, :, 1] / p.sum(2)).T, log_z, f, b


def fit_field(windows: list[list[str]], labels: np.ndarray, mask: np.ndarray, rounds: int = 120, rate: float = 0.15, penalty: float = 2e-4) -> Field:
    """Gradient steps (Adam) on the conditional likelihood of the token labels."""
    n, length = labels.shape
    found = features([word for w in windows for word in w])
    has = found < 1 << BITS
    at = np.repeat(np.flatnonzero(mask), has.sum(1))
    ids = found[has]
    used, where = np.unique(ids, return_inverse=True)
    w, move, ends = np.zeros(len(used)), np.zeros((2, 2)), np.ones((n, 2))
    w_bias = -2.0
    first, second = [np.zeros(len(used)), np.zeros((2, 2)), 0.0], [np.zeros(len(used)), np.zeros((2, 2)), 0.0]
    y, real = labels.astype(float), mask.astype(float)
    both = real[:, 1:] * real[:, :-1]
    seen = np.array([[(both * (1 - y[:, :-1] if a == 0 else y[:, :-1]) * (1 - y[:, 1:] if b == 0 else y[:, 1:])).sum() for b in (0, 1)] for a in (0, 1)])
    for k in range(1, rounds + 1):
        scores = np.bincount(at, w[where], n * length).reshape(n, length) + w_bias
        p, _, f, b = _sums(scores, move, mask, ends, ends)
        e, m = np.exp(np.clip(scores, -40, 40)), np.exp(move)
        pairs = np.einsum("tna,ab,tnb->tnab", f[:-1], m, b[1:] * np.stack([np.ones_like(e.T[1:]), e.T[1:]], 2))
        pairs /= pairs.sum((2, 3), keepdims=True)
        expected = np.einsum("tnab,nt->ab", pairs, both)
        off = (p - y) * real
        grads = [np.bincount(where, off.reshape(-1)[at], len(used)) / n + penalty * w, (expected - seen) / n + penalty * move, float(off.sum()) / n]
        values = [w, move, w_bias]
        for j, g in enumerate(grads):
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.99 * second[j] + 0.01 * g * g
            values[j] = values[j] - rate * (first[j] / (1 - 0.9**k)) / (np.sqrt(second[j] / (1 - 0.99**k)) + 1e-8)
        w, move, w_bias = values
    weights = np.zeros((1 << BITS) + 1)  # the last one stays 0, for features that a word lacks
    weights[used] = w
    return Field(weights.astype(np.float32), move, bias=float(w_bias))


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a small penalty on all but the constant."""
    w, keep = np.zeros(x.shape[1]), np.diag([1e-3, *[penalty] * (x.shape[1] - 1)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (p - y) + keep @ w)
        w = w - step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
    return tuple(map(float, w))


def word_marginals(model: Field, many: list[str]) -> tuple[list[int], np.ndarray]:
    """Words in each text, and the marginals of all words one after another."""
    each = [words_of(t) for t in many]
    sizes = [len(w) for w in each]
    met = pa.array([w for words in each for w in words], pa.string()).dictionary_encode()
    if not len(met):
        return sizes, np.zeros(0)
    scores = model.weights[features(met.dictionary.to_pylist())].sum(1) + model.bias
    return sizes, model.marginals(scores[met.indices.to_numpy()].astype(float), sizes)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text leaves 2 modulo 4."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Field:
    """Fits the model. What reaches the driver is bounded by the parameters above."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)").where(~held_out(F.col("__id")))
    known = known.groupBy("__id").agg(F.max("__y").alias("__y"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)
    folder = shared_folder(docs.sparkSession)
    try:
        return _learn(texts(docs, id_col, text_col).withColumnRenamed(id_col, "__id").join(F.broadcast(chosen), "__id"), folder)
    finally:
        dropped(docs.sparkSession, folder)


def _learn(labelled: DataFrame, folder: str) -> Field:
    sample = stored(labelled.groupBy("__id", "__y").agg(F.max("__text").alias("__text")).repartition(8), folder, "sample")
    shares = sample.agg(F.avg("__y").alias("p"), F.count(F.lit(1)).alias("n")).first()
    if not shares["n"] or shares["p"] in (0.0, 1.0):
        return Field(np.zeros(1, np.float32), constant=float(shares["p"] or 0.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            keys, near, toxic = [], [], []
            for text, y in zip(batch.column("__text").to_pylist(), batch.column("__y").to_pylist(), strict=True):
                w = ["", *words_of(text), ""]
                met = {(k, zlib.crc32(f"{a} {c}".encode())) for a, b, c in zip(w, w[1:], w[2:], strict=False) for k in beginnings(b)}
                keys += [k for k, _ in met]
                near += [n for _, n in met]
                toxic += [y] * len(met)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(near, pa.int64()), pa.array(toxic, pa.int32())], names=["key", "near", "y"])

    met = sample.select("__text", "__y").mapInArrow(count, "key string, near long, y int").distinct()
    counts = stored(met.groupBy("key").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")), folder, "counts")
    sums = counts.where("key like 'w:%'").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.count(F.lit(1)).alias("n")).first()
    share = (sums["t"] + 1) / (sums["t"] + sums["c"] + 2)
    # How far the counts are from chance (half of the likelihood ratio statistic), against the number of keys tried.
    bound = math.log(max(2, sums["n"])) + 3
    total, part = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    far = F.col("toxic") * F.log(part / share) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - part) / (1 - share))).otherwise(0)
    marks = {r["key"] for r in counts.where((F.col("toxic") > 0) & (part > 0.8) & (total >= 3)).where(far > bound).orderBy(far.desc(), "key").limit(MAX_MARKS).collect()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: tuple[list, list, list] = [], [], []
            for text, y in zip(batch.column("__text").to_pylist(), batch.column("__y").to_pylist(), strict=True):
                w = words_of(text)
                hit = [int(bool(y) and any(k in marks for k in beginnings(x))) for x in w]
                for at in range(0, len(w), WINDOW):
                    part = hit[at : at + WINDOW]
                    if any(part) or not y:  # unmarked windows of toxic texts tell nothing sure
                        for column, value in zip(out, (zlib.crc32(" ".join(w[at : at + WINDOW]).encode()), w[at : at + WINDOW], part), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.string())), pa.array(out[2], pa.list_(pa.int32()))], names=["h", "words", "hit"])

    windows = sample.select("__text", "__y").mapInArrow(cut, "h long, words array<string>, hit array<int>")
    half = MAX_WINDOWS // 2
    has = F.array_max("hit") == 1
    marked = windows.where(has).orderBy("h", "words").limit(half).collect()
    clean = windows.where(~has).orderBy("h", "words").limit(half).collect()
    got = sorted([*marked, *clean], key=lambda r: (r["h"], r["words"]))
    y = np.zeros((len(got), WINDOW), np.int8)
    mask = np.zeros((len(got), WINDOW), bool)
    for i, r in enumerate(got):
        y[i, : len(r["hit"])] = r["hit"]
        mask[i, : len(r["hit"])] = True
    model = fit_field([r["words"] for r in got], y, mask)
    rows = score(sample.withColumnRenamed("__id", "id"), model, "id", "__text", carry=["__y"]).select("expected", "n_words", "__y").toPandas()  # at most max_labelled rows of three numbers
    model.curve = fit_curve(evidence(rows["expected"].to_numpy(), rows["n_words"].to_numpy(float)), rows["__y"].to_numpy(float))
    return model


def score(df: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), keep_text: bool = False) -> DataFrame:
    """Adds ``score``, ``predicted`` (score >= THRESHOLD), ``highest`` and ``expected`` marginals, ``n_words`` and ``spans`` (start, end in code points of the text, marginal), without the text (``keep_text``: with it, as ``__text``, null as empty)."""
    bounded_batches(df.sparkSession)
    rows = texts(df, id_col, text_col, carry)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("marginal", T.DoubleType())]))
    schema = with_fields(rows, [] if keep_text else ["__text"], [("score", T.DoubleType()), ("highest", T.DoubleType()), ("expected", T.DoubleType()), ("n_words", T.LongType()), ("spans", span)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for batch in slices(batches, by="__text"):
            many = batch.column("__text").to_pylist()
            n, spans = len(many), [[] for _ in many]
            highest, expected, sizes = np.zeros(n), np.zeros(n), [0] * n
            if model.constant is None:
                sizes, p = word_marginals(model, many)
                end = 0
                for i, size in enumerate(sizes):
                    start, end = end, end + size
                    if size:
                        own = p[start:end]
                        highest[i], expected[i] = own.max(), own.sum()
                        if highest[i] >= 0.5:
                            toxic = set(np.flatnonzero(own >= 0.5).tolist())
                            spans[i] = [{"start": m.start(), "end": m.end(), "marginal": float(own[k])} for k, m in enumerate(_WORD.finditer(many[i])) if k in toxic]
                scores = model.document(expected, np.array(sizes, float))
            else:
                scores = np.full(n, model.constant)
            yield replaced(batch, schema, {"score": pa.array(scores), "highest": pa.array(highest), "expected": pa.array(expected), "n_words": pa.array(sizes, pa.int64()), "spans": pa.array(spans, kind)})

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
