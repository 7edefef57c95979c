"""Row rules, sources and sinks, and progress events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.operators import assembly, gates
from partloom.plans import rules
from partloom.queries.base import OBS, PARTS, observations, parts, query, rounded, table
from partloom.sources import files, sealed
from partloom.streaming import progress


@query(
    "p01_validate",
    """SELECT event_id, concat_ws(',', CASE WHEN value < 5 THEN 'value_too_low' END, CASE WHEN event_type = 'error' THEN 'error_event' END, CASE WHEN user_id % 5 = 0 THEN 'unknown_user' END) AS reason_codes FROM events""",
)
def p01(spark, d):
    e = table(spark, d, "events")
    out = gates.validate(e, [("value_too_low", F.col("value") < 5), ("error_event", F.col("event_type") == "error"), ("unknown_user", F.col("user_id") % 5 == 0)])
    return out.select("event_id", F.array_join("reason_codes", ",").alias("reason_codes"))


@query("p02_normalize_batch", "SELECT conv_id, turn, lower(trim(role)) AS role, TRY_CAST(regexp_extract(text, '([0-9]+)', 1) AS BIGINT) AS number, coalesce(nullif(trim(split_part(text, chr(10), 1)), ''), 'none') AS head FROM conversations")
def p02(spark, d):
    """Loosely typed replies: trimmed roles, the first number if there is one, the first line or a default."""
    got = assembly.normalize_reply(F.col("role"), F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", *[got[c].alias(c) for c in ("role", "number", "head")])


_ALIASES = [("small", "size:s"), ("large", "size:l"), ("cold", "temp:low"), ("hot", "temp:high"), ("widget", "shape:any"), ("bolt", "shape:rod"), ("rod", "shape:rod"), ("blue", "colour:blue"), ("red", "colour:red")]


@query(
    "p03_canonicalize",
    f"""WITH al AS (SELECT * FROM (VALUES {", ".join(str(a) for a in _ALIASES)}) t(alias, canonical)), w AS (SELECT DISTINCT p_partkey AS part_id, unnest(string_split(p_name, ' ')) AS alias FROM part)
SELECT p_partkey AS part_id, coalesce(c, '') AS canonical FROM part LEFT JOIN (SELECT part_id, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS c FROM w JOIN al USING (alias) GROUP BY part_id) x ON x.part_id = p_partkey""",
)
def p03(spark, d):
    p = parts(spark, d)
    return rules.canonicalize(p, "part_id", "name", F.broadcast(spark.createDataFrame(_ALIASES, "alias string, canonical string")))


@query("p04_semantics", f"WITH {PARTS} SELECT part_id, CASE WHEN list_has_any(string_split(name, ' '), ['rod', 'bolt', 'anvil']) THEN 'metal' WHEN list_has_any(string_split(name, ' '), ['ring']) THEN 'jewel' ELSE 'generic' END AS substrate, CASE WHEN type IN ('PROMO', 'ECONOMY') THEN 'painted' ELSE 'bare' END AS treatment FROM parts")
def p04(spark, d):
    p = parts(spark, d).withColumn("t", rules.tokens(F.col("name")))
    has = lambda *w: F.arrays_overlap("t", F.array(*map(F.lit, w)))
    return p.select("part_id", F.when(has("rod", "bolt", "anvil"), "metal").when(has("ring"), "jewel").otherwise("generic").alias("substrate"), F.when(F.col("type").isin("PROMO", "ECONOMY"), "painted").otherwise("bare").alias("treatment"))


@query("p05_compatible", f"""WITH {PARTS} SELECT part_id, s_suppkey AS supplier FROM parts JOIN supplier ON list_contains([size % 3, size % 5], s_suppkey % 4) AND nullif(size % 2, 1) IS NOT DISTINCT FROM nullif(s_suppkey % 2, 1) AND (type = 'PROMO' OR s_suppkey % 3 = 0)""")
def p05(spark, d):
    p = parts(spark, d).select("part_id", F.array(F.col("size") % 3, F.col("size") % 5).alias("substrates"), F.nullif(F.col("size") % 2, F.lit(1)).alias("treatment"), F.when(F.col("type") == "PROMO", "any").otherwise("x").alias("optical"))
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(k.alias("supplier"), (k % 4).alias("substrate"), F.nullif(k % 2, F.lit(1)).alias("treatment"), F.when(k % 3 == 0, "any").otherwise("y").alias("optical"))
    return rules.compatible_pairs(p, s).select("part_id", "supplier")


@query("p06_first_rule", f"WITH {PARTS} SELECT part_id, CASE WHEN regexp_matches(name, 'BOLT|rod$', 'i') THEN 'steel' WHEN regexp_matches(name, '^cold', 'i') THEN 'ice' WHEN regexp_matches(name, 'widget', 'i') THEN 'plastic' ELSE 'default' END AS material FROM parts")
def p06(spark, d):
    p = parts(spark, d)
    return p.select("part_id", rules.first_rule(p, [("BOLT|rod$", "steel"), ("^cold", "ice"), ("widget", "plastic")], "name", "default").alias("material"))


@query("p08_admission", f"WITH {OBS} SELECT asset_id, part_id, view_id, line, price FROM obs WHERE weight >= 10 AND score >= 0.2 AND view_id % 4 <> 3")
def p08(spark, d):
    """Observations with enough pixels and overlap, in views of an accepted tier."""
    o = observations(spark, d)
    return o.where(assembly.admitted(F.col("weight"), F.col("score"), F.col("view_id") % 4, [3])).select("asset_id", "part_id", "view_id", "line", "price")


@query("p09_compact_ranges", "WITH v AS (SELECT DISTINCT l_suppkey AS view_id, l_orderkey AS k FROM lineitem), g AS (SELECT *, k - row_number() OVER (PARTITION BY view_id ORDER BY k) AS g FROM v) SELECT view_id, min(k) AS lo, max(k) AS hi FROM g GROUP BY view_id, g")
def p09(spark, d):
    return rules.compact_ranges(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("view_id"), F.col("l_orderkey").alias("k")), ["view_id"], "k")


@query("p09_expand_ranges", "SELECT DISTINCT l_suppkey AS view_id, l_orderkey AS k FROM lineitem")
def p09b(spark, d):
    return rules.expand_ranges(p09(spark, d), ["view_id"], "k")


@query("p10_descriptor_text", f"WITH {PARTS} SELECT part_id, array_to_string(list_filter([name, type, CASE WHEN brand <> 'Brand#1' THEN brand END], lambda x: x IS NOT NULL), '. ') AS descriptor FROM parts")
def p10(spark, d):
    return parts(spark, d).select("part_id", rules.descriptor_text(F.col("name"), F.col("type"), F.when(F.col("brand") != "Brand#1", F.col("brand")), F.col("name"), F.lit(" ")).alias("descriptor"))


@query("p11_pose_candidates", """WITH v AS (SELECT n_nationkey AS view_id, n_nationkey % 7 AS t FROM nation), p AS (SELECT r_regionkey AS pose FROM region), h AS (SELECT view_id, pose FROM v JOIN p ON t = pose)
SELECT * FROM h UNION ALL SELECT view_id, pose FROM v, p WHERE view_id NOT IN (SELECT view_id FROM h)""")
def p11(spark, d):
    """Poses that share a word with the view's name; views without any take all poses (a fixed, small list)."""
    v = table(spark, d, "nation").select(F.col("n_nationkey").alias("view_id"), F.split(F.concat(F.lit("view_"), (F.col("n_nationkey") % 7).cast("string")), "[^a-z0-9]+").alias("words"))
    p = table(spark, d, "region").select(F.col("r_regionkey").alias("pose"), F.array(F.col("r_regionkey").cast("string")).alias("names"))
    return assembly.pose_candidates(v, "view_id", "words", p, "pose", "names")


@query("p12_assembly_domain", "WITH u AS (SELECT page_id, list_filter(string_split(regexp_replace(url, '^[a-z]+://', ''), '/'), lambda x: x <> '') AS s FROM pages) SELECT page_id, CASE WHEN len(s) > 2 THEN s[2] ELSE 'root' END AS domain FROM u")
def p12(spark, d):
    return table(spark, d, "pages").select("page_id", rules.assembly_domain(F.regexp_replace("url", "^[a-z]+://", ""), 2).alias("domain"))


@query("p13_names_and_ids", f"""WITH {PARTS} SELECT part_id, regexp_replace(regexp_replace(name || '/' || brand, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe, 'P_' || substr(sha256(part_id || '|' || brand), 1, 12) AS id FROM parts""")
def p13(spark, d):
    p = parts(spark, d)
    return p.select("part_id", rules.safe_name(F.concat_ws("/", "name", "brand")).alias("safe"), rules.content_id("P_", F.col("part_id"), F.col("brand")).alias("id"))


@query("p14_choose_result", "SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(nullif(list_position(['2-HIGH', '5-LOW'], o_orderpriority), 0), 3), o_orderkey) AS r FROM orders) WHERE r = 1")
def p14(spark, d):
    return rules.choose_result(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey", ["2-HIGH", "5-LOW"]).select("o_custkey", "o_orderpriority", "o_orderkey")


@query("p15_check_references", f"WITH {OBS} SELECT asset_id, count(*) AS n, CASE WHEN count(*) < 2 THEN 'too_few' WHEN count(*) > 4 THEN 'too_many' WHEN count(DISTINCT line) < count(*) THEN 'duplicate' ELSE 'ok' END AS status FROM obs GROUP BY asset_id")
def p15(spark, d):
    return rules.check_references(observations(spark, d), ["asset_id"], "line")


@query("p16_paint_parameters", f"""WITH {PARTS}, q AS (SELECT part_id, size >= 10 AS ok, r / 255.0::DOUBLE AS c FROM parts) SELECT part_id, CASE WHEN ok THEN round(greatest(0.02, least(0.8, CASE WHEN c <= 0.04045 THEN c / 12.92 ELSE power((c + 0.055) / 1.055, 2.4) END)), 6) END AS base FROM q""")
def p16(spark, d):
    """Verified evidence to a clamped linear colour; parts without it get none."""
    return parts(spark, d).select("part_id", assembly.paint_parameters(F.col("r") / 255.0, F.col("size") >= 10).alias("base"))


@query("s02_fingerprint", "SELECT doc_id, sha256(length(lang) || ':' || lang || length(source) || ':' || source || coalesce(length(text) || ':' || text, '-')) AS fingerprint FROM documents")
def s02(spark, d):
    return table(spark, d, "documents").select("doc_id", files.fingerprint(["text", "lang", "source"]).alias("fingerprint"))


@query("s03_read_contract", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN json_extract(props, '$.k') IS NULL THEN 'missing_k' ELSE '' END AS reason_codes FROM events""")
def s03(spark, d):
    e = table(spark, d, "events").select("event_id", "props")
    return files.read_contract(e, "props", T.StructType([T.StructField("k", T.LongType())]), ["k"]).select("event_id", "k", "reason_codes")


@query("s06_attach_preview", f"""WITH {PARTS}, f AS (SELECT brand || '.' || type AS name, min('img/' || part_id) AS path FROM parts WHERE size % 2 = 0 GROUP BY 1 UNION ALL SELECT brand, min('mod/' || part_id) FROM parts WHERE size > 25 GROUP BY 1)
SELECT part_id, coalesce(a.path, b.path) AS preview FROM parts LEFT JOIN f a ON a.name = brand || '.' || type LEFT JOIN f b ON b.name = brand""")
def s06(spark, d):
    p = parts(spark, d)
    own = p.where("size % 2 = 0").groupBy(F.concat_ws(".", "brand", "type").alias("name")).agg(F.min(F.concat(F.lit("img/"), F.col("part_id").cast("string"))).alias("path"))
    mod = p.where("size > 25").groupBy(F.col("brand").alias("name")).agg(F.min(F.concat(F.lit("mod/"), F.col("part_id").cast("string"))).alias("path"))
    return files.attach_preview(p, own.unionByName(mod), "brand", "type").select("part_id", "preview")


@query(
    "s07_bank_status",
    """WITH c AS (SELECT p_partkey AS vec_id FROM part), v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1000)::BIGINT) AS vec FROM embeddings), b AS (SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN list_prepend(-vec[1], vec[2:]) WHEN vec_id % 51 = 0 THEN vec[2:] ELSE vec END AS vec FROM v UNION ALL SELECT vec_id, vec FROM v WHERE vec_id % 53 = 0)
SELECT coalesce(c.vec_id, x.vec_id) AS vec_id, CASE WHEN c.vec_id IS NULL THEN 'unknown' WHEN x.vec_id IS NULL THEN 'missing' WHEN x.n > 1 THEN 'duplicate' WHEN x.size <> 64 THEN 'wrong_size' WHEN x.vec <> v.vec THEN 'changed' ELSE 'ok' END AS status
FROM c FULL JOIN (SELECT vec_id, count(*) AS n, min(len(vec)) AS size, any_value(vec) AS vec FROM b GROUP BY vec_id) x ON c.vec_id = x.vec_id LEFT JOIN v ON v.vec_id = coalesce(c.vec_id, x.vec_id)""",
)
def s07(spark, d):
    """A bank in which vectors were flipped, cut and doubled, against the catalogue and the hashes recorded before."""
    v = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000)).alias("vec"))
    k, rest = F.col("vec_id"), F.expr("slice(vec, 2, size(vec) - 1)")
    bank = v.select("vec_id", F.when(k % 50 == 0, F.array_prepend(rest, -F.get("vec", F.lit(0)))).when(k % 51 == 0, rest).otherwise(F.col("vec")).alias("vec")).unionByName(v.where("vec_id % 53 = 0"))
    recorded = v.select("vec_id", sealed.vector_digest("vec").alias("digest"))
    return sealed.bank_status(bank, table(spark, d, "part").select(F.col("p_partkey").alias("vec_id")), "vec_id", "vec", 64, recorded)


@query("s09_decode_part_ids", f"WITH {PARTS} SELECT part_id AS pixel, CASE WHEN size % 2 = 0 THEN part_id END AS part_id FROM parts")
def s09(spark, d):
    """Part-coloured pixels back to parts; colours of parts that are not listed stay without one."""
    p = parts(spark, d)
    k = F.col("part_id")
    pixels = p.select(k.alias("pixel"), (F.shiftright(k, 16) % 256).cast("int").alias("r"), (F.shiftright(k, 8) % 256).cast("int").alias("g"), (k % 256).cast("int").alias("b"))
    return files.decode_part_ids(pixels, p.where("size % 2 = 0").select("part_id", F.col("part_id").cast("int").alias("colour"))).select("pixel", "part_id")


@query("s10_build_manifest", """WITH r AS (SELECT l_orderkey AS k, min(l_discount) AS worst_quality, string_agg(DISTINCT CASE WHEN l_tax > 0.06 THEN l_returnflag END, ',' ORDER BY CASE WHEN l_tax > 0.06 THEN l_returnflag END) AS lim FROM lineitem GROUP BY 1)
SELECT o_orderkey AS k, count(*) AS deliveries, min(worst_quality) AS worst_quality, coalesce(min(lim), '') AS limitations FROM orders LEFT JOIN r ON r.k = o_orderkey GROUP BY 1""")
def s10(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_discount").alias("quality"), F.when(F.col("l_tax") > 0.06, F.col("l_returnflag")).alias("limitation"))
    return files.build_manifest(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), li, ["k"])


@query("s11_sealed_digest", """WITH s AS (SELECT p_brand AS brand, sha256(length(CAST(p_partkey AS VARCHAR)) || ':' || p_partkey || length(p_type) || ':' || p_type) AS s FROM part), h AS (SELECT brand, CAST(('0x' || substr(s, 1, 15)) AS BIGINT) AS v, CAST(('0x' || substr(s, 16, 15)) AS BIGINT) AS w FROM s)
SELECT brand, count(*) AS rows, sha256(count(*) || '|' || CAST(sum(v) AS VARCHAR) || '|' || CAST(sum(w) AS VARCHAR)) AS digest FROM h GROUP BY brand""")
def s11(spark, d):
    return rules.sealed_digest(table(spark, d, "part").withColumnRenamed("p_brand", "brand"), ["brand"], ["p_partkey", "p_type"])


@query("s12_export_allowlist", "SELECT p_type, count(*) AS entries FROM part GROUP BY 1")
def s12(spark, d):
    return files.export_allowlist(table(spark, d, "part"), "p_type")


@query("s01_file_inventory")
def s01(spark, d):
    """Files beside the tables, without their contents."""
    return files.file_inventory(spark, d, [".parquet"], exclude="mask").select("name", "size")


def _events(spark, d):
    e = table(spark, d, "events")
    state = F.when(F.col("event_type") == "signup", "queued").when(F.col("event_type") == "view", "running").when(F.col("event_type") == "click", "running").when(F.col("event_type") == "purchase", "succeeded").otherwise("failed")
    return e.withColumn("state", state)


_STATE = "CASE event_type WHEN 'signup' THEN 'queued' WHEN 'view' THEN 'running' WHEN 'click' THEN 'running' WHEN 'purchase' THEN 'succeeded' ELSE 'failed' END"


@query("t01_parse_progress", """SELECT event_id AS line, CASE WHEN event_type = 'view' THEN 'plain' WHEN event_type = 'error' THEN 'bad' ELSE 'event' END AS kind, CASE WHEN event_type NOT IN ('view', 'error') THEN user_id END AS job, CASE WHEN event_type NOT IN ('view', 'error') THEN event_type END AS stage FROM events""")
def t01(spark, d):
    """Events as marked JSON lines, some behind a log prefix, some broken, some plain."""
    e = table(spark, d, "events")
    body = F.to_json(F.struct("event_id", F.col("user_id").alias("job"), F.col("event_type").alias("stage"), F.lit("progress").alias("state"), F.lit(50.0).alias("percent")))
    line = F.when(F.col("event_type") == "view", F.lit("loading")).when(F.col("event_type") == "error", F.concat(F.lit(progress.MARK), F.lit("{broken"))).otherwise(F.concat(F.when(F.col("event_id") % 2 == 0, "[log] ").otherwise(""), F.lit(progress.MARK), body))
    return progress.parse_progress(e.select(F.col("event_id").alias("line"), line.alias("value"))).select("line", "kind", "job", "stage")


@query("t02_stage_state", "SELECT user_id, event_type, count(*) AS events, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def t02(spark, d):
    return progress.stage_state(table(spark, d, "events"), ["user_id", "event_type"], ["event_id"], ["value"])


@query("t03_job_lifecycle", f"""WITH s AS (SELECT user_id, event_id, {_STATE} AS state FROM events), b AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY user_id ORDER BY event_id), '') AS before FROM s)
SELECT user_id, event_id, before, state, (before = '' AND state = 'queued') OR (before = 'queued' AND state IN ('running', 'failed')) OR (before = 'running' AND state IN ('running', 'succeeded', 'failed')) AS legal FROM b""")
def t03(spark, d):
    return progress.job_lifecycle(_events(spark, d), "user_id", "state", ["event_id"]).select("user_id", "event_id", "before", "state", "legal")


@query("t04_log_tail", "SELECT user_id, event_id, from_end FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS from_end FROM events) WHERE from_end <= 20")
def t04(spark, d):
    return progress.log_tail(table(spark, d, "events").select("user_id", "event_id"), "user_id", ["event_id"], 20)


@query("t05_stage_attempts", """WITH a AS (SELECT *, count(*) FILTER (WHERE event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id) AS attempt FROM events)
SELECT user_id, attempt, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS failures, epoch_us(max(ts)) - epoch_us(min(ts)) AS micros FROM a WHERE attempt > 0 GROUP BY ALL""")
def t05(spark, d):
    return progress.stage_attempts(table(spark, d, "events"), "user_id", ["event_id"], F.col("event_type") == "signup", F.col("event_type") == "error")


@query("t06_retry_plan", "SELECT event_id, event_id % 5 + 1 AS attempt, event_type IN ('error', 'view') AND event_id % 5 + 1 < 4 AS retry, CASE WHEN event_type IN ('error', 'view') AND event_id % 5 + 1 < 4 THEN 2 * power(1.5, event_id % 5) END AS delay FROM events")
def t06(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", (F.col("event_id") % 5 + 1).alias("attempt"))
    return rounded(progress.retry_plan(e, "attempt", "event_type", ["error", "view"], 4, 2.0, 1.5).drop("event_type"))


@query("t07_changed_assets", "SELECT doc_id, sha256(text) AS digest FROM documents WHERE doc_id % 3 = 0 OR doc_id % 4 = 1")
def t07(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    done = docs.where("doc_id % 3 <> 0").withColumn("digest", F.when(F.col("doc_id") % 4 == 1, F.lit("old")).otherwise(F.col("digest")))
    return progress.changed_assets(docs, done, "doc_id", "digest")
