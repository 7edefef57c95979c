"""Spelling variants grouped by reduced-alphabet generation, with DataFrame functions only.

1. Words are counted over the whole corpus; those of enough letters and occurrences are the vocabulary.
2. A word is reduced by hashing its letters to a few symbols. Words that differ by one edit reduce to words that differ by one edit or by none.
3. Of each distinct reduced word the full neighbourhood is written out: itself, and every deletion, replacement and insertion of one
   symbol. With few symbols that is a short list, where the letters of the words would give hundreds.
4. The neighbourhoods meet the reduced vocabulary in a join, the met reduced words are joined with their words on both sides, and each pair is
   verified on the words themselves. Neighbourhood is mutual, so of two reduced words just the smaller sends its neighbourhood's part that does not stand
   before it; and no reduced word is in it twice, so every pair comes once and is counted for both of its words.
5. A word's form is its near word with the most occurrences, if they are ``times`` as many as its own; forms lead to roots, found by doubling the
   steps, each round written to the shared folder.

The number of symbols sets the cost and never the result: more symbols make longer neighbourhoods and fewer pairs to verify.

Defined results: null and empty texts have no words; a null id counts like any other, but none of its words is altered; repeated rows count each; ties of occurrences
go to the smallest word in code-point order; extra columns are left out; an empty table, and one without a frequent word, give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import shared_folder, stored, texts
from partloom.llm.decontamination import ascii_lower

#: The letters of words after A-Z are lower-cased, and words.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
WORD = "[a-zÀ-ÿ]+"
#: Symbols of the reduced alphabet.
SYMBOLS = 6
_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): the runs of letters of whole texts, A-Z lower-cased."""
    return texts(df, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col("__text")), F.lit(WORD), F.lit(0))).alias("word"))


def mistyped(words: DataFrame, every: int) -> DataFrame:
    """The words, one letter deleted where ``every`` divides the crc32 h of ``<id>:<word>``: letter h % length. A planted fault, by which groups can be tested on any corpus."""
    hashed = words.select("word", F.crc32(F.encode(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("word")), "utf-8")).alias("h"))
    at = (F.col("h") % F.char_length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.char_length("word")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n). Counts are added up in each task before they are shuffled."""
    return words.where(F.char_length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter hashed to one of ``symbols`` symbols."""
    return F.translate(word, LETTERS, "".join(_ALPHABET[(ord(c) * 40503 >> 4) % symbols] for c in LETTERS))


def neighbourhood(column: str, symbols: int) -> Column:
    """The string itself and all strings one edit from it over the reduced alphabet, each once."""
    before, after, other = f"substring({column}, 1, i)", f"substring({column}, i + 2)", f"substring({column}, i + 1)"
    alphabet = ", ".join(f"'{s}'" for s in _ALPHABET[:symbols])
    places, gaps = f"sequence(0, length({column}) - 1)", f"sequence(0, length({column}))"
    return F.expr(
        f"""array_distinct(concat(
        transform({places}, i -> concat({before}, {after})),
        flatten(transform(array({alphabet}), s -> transform({places}, i -> concat({before}, s, {after})))),
        flatten(transform(array({alphabet}), s -> transform({gaps}, i -> concat({before}, s, {other}))))))"""
    )


def near_words(words: DataFrame, folder: str, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) for each ordered pair of words (word, n) that differ by exactly one inserted, deleted or replaced code point."""
    if not 1 <= symbols <= len(_ALPHABET):
        raise ValueError(f"the reduced alphabet has 1 to {len(_ALPHABET)} symbols")
    keyed = stored(words.select("word", "n", reduced(F.col("word"), symbols).alias("r")), folder, "reduced")
    shapes = stored(keyed.select("r").distinct(), folder, "shapes")
    later = F.filter(neighbourhood("r", symbols), lambda x: x >= F.col("r"))
    met = shapes.select("r", F.explode(later).alias("near_r")).join(shapes.select(F.col("r").alias("near_r")), "near_r", "left_semi")
    side = lambda word, n, r: keyed.select(F.col("word").alias(word), F.col("n").alias(n), F.col("r").alias(r))
    pairs = side("a", "an", "r").join(met, "r").join(side("b", "bn", "near_r"), "near_r").where((F.col("r") < F.col("near_r")) | (F.col("a") < F.col("b")))
    verified = pairs.where(F.levenshtein("a", "b", 1) == 1)
    way = lambda *c: F.struct(*[F.col(x).alias(y) for x, y in zip(c, ("word", "n", "near", "near_n"), strict=True)])
    return verified.select(F.explode(F.array(way("a", "an", "b", "bn"), way("b", "bn", "a", "an"))).alias("p")).select("p.*")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root): the last of each word's forms. Each round doubles the steps, so chains of k forms take log2 k rounds; forms have more occurrences than their words and thus no cycles."""
    current = stored(forms.select("word", F.col("form").alias("root")), folder, "roots-0")
    k = 0
    while True:
        k += 1
        further = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(current.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), folder, f"roots-{k}")
        if not after.where("moved").limit(1).count():
            return after.select("word", "root")
        current = after.select("word", "root")


def variant_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 5, least_count: int = 3, times: int = 2, symbols: int = SYMBOLS, mistype_every: int = 0) -> DataFrame:
    """One row for each frequent word: word, form, root, n, n_near (near words), form_n. ``form`` and ``form_n`` are null and ``root`` is the word itself where no near word has ``times`` its occurrences.

    mistype_every: see :func:`mistyped`; 0 leaves all words as they are.
    """
    folder = shared_folder(df.sparkSession)
    words = runs(df, id_col, text_col)
    vocab = stored(vocabulary(mistyped(words, mistype_every) if mistype_every else words, least_letters, least_count), folder, "vocabulary")
    best = near_words(vocab, folder, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    found = stored(best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.order")).alias("form_n")), folder, "near")
    led = F.col("form_n") >= F.lit(times) * F.col("n")
    each = stored(vocab.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(led, F.col("form")).alias("form"), F.when(led, F.col("form_n")).alias("form_n")), folder, "forms")
    ends = roots(each.where("form is not null").select("word", "form"), folder)
    return each.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
