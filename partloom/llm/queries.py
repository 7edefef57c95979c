"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.llm import bpe, decontamination, exact_dedup, html_wrapper, license_scan, line_dedup, merkle, quality, secret_scan, simhash, token_counts, toxicity, variants

#: The vocabulary of op1, op2 and the pipeline.
VOCABULARY = "byte_bpe_50k.json"
#: Tokens above which a document is over the limit.
TOKEN_LIMIT = 1024
#: Words around a window's rarest term that all its terms stand within in a proximity match: ten words and some put between them.
NEAR = 12


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.prefix_table(docs, vocabulary_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), token_counts.chars_within(F.col("prefix_counts"), TOKEN_LIMIT).cast("long").alias("chars_within_limit"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe.encode(docs, vocabulary_path(), decoded="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


def document_path() -> Column:
    """A directory tree for ``documents``, which have no paths: source, language, thousands and hundreds of the id, and a file each."""
    level = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    return F.concat_ws("/", "source", "lang", level(1000), level(100), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", "text", document_path().alias("path"))
    return license_scan.scan(files, license_scan.templates(spark), "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(o.owner < k.doc_id, false) AS gone FROM k LEFT JOIN o ON k.key = o.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    counts = [secret_scan.number("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secret_scan.written("base"), 256).alias("base_sha256"), secret_scan.written("spans").alias("spans"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=NEAR)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "near_items")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


#: Of the words of op11, one in so many is mistyped by its hash.
MISTYPE_EVERY = 97


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(table(spark, sf_dir, "documents"), mistype_every=MISTYPE_EVERY)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_dataset(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.filtered(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("beyond", ",").alias("beyond"))


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda acc, b:
  list_reduce(list_prepend(xor(acc, b), range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))"""
#: SQL: the unsigned crc32 of a text in UTF-8.
_CRC_OF = lambda text: _CRC.format(bytes=f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)")

_ACCENTS = "".join(map(chr, range(0xC0, 0x100)))
_STAND_INS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"[:64]
OP11_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, c, {_CRC_OF("doc_id || ':' || run")} AS h FROM pairs),
typed AS (SELECT c, CASE WHEN h % {MISTYPE_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
v AS (SELECT word, sum(c)::BIGINT AS n, translate(word, '{_ACCENTS}', '{_STAND_INS}') AS code FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM v a JOIN v b ON length(a.word) BETWEEN length(b.word) - 1 AND length(b.word) + 1 AND a.word <> b.word AND levenshtein(a.code, b.code) = 1),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS top, max(other_n) AS top_n FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 2 * v.n THEN top END AS form, CASE WHEN top_n >= 2 * v.n THEN top_n END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS further FROM f UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN f ON f.word = w.further)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM f JOIN walk ON walk.word = f.word AND walk.further IS NULL
"""

_LEAF = lambda text: "sha256(" + " || ".join(f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c}), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
OP12_SQL = f"""
WITH RECURSIVE d AS (SELECT coalesce('=' || source, '') AS tree, doc_id, {_LEAF("text")} AS leaf, {_LEAF(f"CASE WHEN {_CRC_OF('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS checked FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, checked) - 1 AS rank, count(*) OVER (PARTITION BY tree) AS n FROM d),
t AS (SELECT tree, 0 AS level, rank, leaf AS h, n FROM l
  UNION ALL SELECT tree, level + 1, rank // 3, sha256(string_agg(h, '' ORDER BY rank)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY tree, level, rank // 3, n),
s AS (SELECT tree, level AS depth, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS rank, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, rank, subroot AS h, n FROM s
  UNION ALL SELECT level + 1, rank // 3, sha256(string_agg(h, '' ORDER BY rank)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY level, rank // 3, n),
places AS (SELECT doc_id, l.tree, l.rank, s.depth, s.rank AS top, leaf, checked FROM l JOIN s ON l.tree = s.tree),
steps AS (
  SELECT p.doc_id, p.tree, p.rank AS leaf_rank, t.level AS step, t.rank, t.h, t.rank < p.rank // (3 ** t.level)::BIGINT AS before
  FROM places p JOIN t ON t.tree = p.tree AND t.n > 1 AND t.rank // 3 = p.rank // (3 ** (t.level + 1))::BIGINT AND t.rank <> p.rank // (3 ** t.level)::BIGINT
  UNION ALL SELECT p.doc_id, p.tree, p.rank, p.depth + u.level, u.rank, u.h, u.rank < p.top // (3 ** u.level)::BIGINT
  FROM places p JOIN u ON u.n > 1 AND u.rank // 3 = p.top // (3 ** (u.level + 1))::BIGINT AND u.rank <> p.top // (3 ** u.level)::BIGINT),
proofs AS (SELECT tree, leaf_rank, sha256(string_agg(h, '' ORDER BY step, rank)) AS proof FROM steps GROUP BY tree, leaf_rank),
sides AS (SELECT tree, leaf_rank, step, coalesce(string_agg(h, '' ORDER BY rank) FILTER (WHERE before), '') AS lefts, coalesce(string_agg(h, '' ORDER BY rank) FILTER (WHERE NOT before), '') AS rights FROM steps GROUP BY tree, leaf_rank, step),
height AS (SELECT max(level) AS levels FROM u),
fold AS (SELECT tree, rank, depth + levels AS steps, 0 AS step, checked AS h FROM places, height
  UNION ALL SELECT f.tree, f.rank, f.steps, f.step + 1, sha256(coalesce(lefts, '') || f.h || coalesce(rights, '')) FROM fold f LEFT JOIN sides ON sides.tree = f.tree AND sides.leaf_rank = f.rank AND sides.step = f.step WHERE f.step < f.steps)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM places p JOIN s ON s.tree = p.tree JOIN fold f ON f.tree = p.tree AND f.rank = p.rank AND f.step = f.steps LEFT JOIN proofs ON proofs.tree = p.tree AND proofs.leaf_rank = p.rank JOIN u r ON r.n = 1
"""

_BOUNDS = lambda keys: f"""SELECT {keys}measure, max(size) AS size, min(bucket) FILTER (WHERE upto * 4 >= size) AS q1, min(bucket) FILTER (WHERE upto * 4 >= size * 3) AS q3 FROM (
  SELECT {keys}measure, bucket, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}measure) AS size
  FROM (SELECT {keys}measure, bucket, sum(n) AS n FROM sketch GROUP BY {keys}measure, bucket)) GROUP BY {keys}measure"""  # noqa: E731
OP13_SQL = f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS words, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
win AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, (SELECT unnest(range(3)) AS k) GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(list_aggregate(list_prepend('', words), 'string_agg', ''))::BIGINT AS word_chars, len(lines)::BIGINT AS n_lines,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (len(list_filter(lines, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')) - len(list_distinct(list_filter(lines, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''))))::BIGINT AS n_dup_lines
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM c),
m AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, {k} AS ord, '{m}' AS measure, {sql.replace(' div ', ' // ')} AS value, {least} AS least, {str(low).lower()} AS low_side, {str(high).lower()} AS high_side FROM b WHERE n_words > 0" for k, (m, (sql, least, (low, high))) in enumerate(quality.MEASURES.items()))}),
sketch AS (SELECT lang, source, measure, CASE WHEN value < {quality.EXACT} THEN value ELSE (value >> (length(bin(value)) - 6)::BIGINT) << (length(bin(value)) - 6)::BIGINT END AS bucket, count(*) AS n FROM m WHERE NOT base_failed GROUP BY ALL),
own AS ({_BOUNDS("lang, source, ")}), middle AS ({_BOUNDS("lang, ")}), whole AS ({_BOUNDS("")}),
limits AS (SELECT m.*, CASE WHEN own.size >= {quality.LEAST} THEN own.q1 WHEN middle.size >= {quality.LEAST} THEN middle.q1 ELSE whole.q1 END AS q1,
    CASE WHEN own.size >= {quality.LEAST} THEN own.q3 WHEN middle.size >= {quality.LEAST} THEN middle.q3 ELSE whole.q3 END AS q3
  FROM m LEFT JOIN own ON own.measure = m.measure AND own.lang IS NOT DISTINCT FROM m.lang AND own.source IS NOT DISTINCT FROM m.source LEFT JOIN middle ON middle.measure = m.measure AND middle.lang IS NOT DISTINCT FROM m.lang LEFT JOIN whole ON whole.measure = m.measure),
o AS (SELECT doc_id, string_agg(measure, ',' ORDER BY ord) AS beyond FROM limits
  WHERE (low_side AND value < q1 - {quality.REACH} * greatest(q3 - q1, least)) OR (high_side AND value > q3 + {quality.REACH} * greatest(q3 - q1, least)) GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND beyond IS NULL AS kept, coalesce(beyond, '') AS beyond FROM b LEFT JOIN o ON o.doc_id = b.doc_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_text": op7_html_text,
    "op8_secret_scan": op8_secret_scan,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_quality_rules": op13_quality_rules,
}
ORACLE_SQL: dict[str, str] = {"op4_exact_dedup": OP4_SQL, "op6_line_dedup": OP6_SQL, "op11_spelling_variants": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_quality_rules": OP13_SQL}
