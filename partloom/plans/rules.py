"""Row rules and plan tables: aliases, first-match rules, ranges, ids, deltas and reviews."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partloom.operators.spread import met, spread


def tokens(text: Column) -> Column:
    """Lower-case words of a string, also split inside camel case."""
    spaced = F.regexp_replace(text, "([a-z0-9])([A-Z])", "$1 $2")
    return F.filter(F.split(F.lower(spaced), "[^a-z0-9]+"), lambda t: t != "")


def canonicalize(df: DataFrame, id_col: str, text_col: str, aliases: DataFrame) -> DataFrame:
    """(id, canonical): the sorted set of canonical names whose alias is a word of the text. aliases: (alias, canonical)."""
    words = df.select(id_col, F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("alias"))
    found = words.join(aliases, "alias").groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set("canonical")), ",").alias("canonical"))
    return df.select(id_col).distinct().join(found, id_col, "left").select(id_col, F.coalesce("canonical", F.lit("")).alias("canonical"))


def canonicalize_any(df: DataFrame, id_col: str, text_col: str, aliases: DataFrame) -> DataFrame:
    """(id, canonical) as :func:`canonicalize` has it, where aliases that are not ASCII are found anywhere in the lower-cased text: scripts without spaces have no words to compare.

    Such an alias is kept under its rarest pair of neighbouring letters that is not ASCII (a single letter under itself); each pair of a text meets the aliases kept under it, and
    the alias is verified where it would stand. Thousands of aliases cost a text no more than the few it shares a pair with. Empty aliases are never found.
    """
    plain = F.col("alias").rlike(r"^[\x00-\x7F]*$")
    low = aliases.select(F.lower("alias").alias("alias"), "canonical").where("alias <> ''").distinct()
    worded = df.select(id_col, F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("alias")).join(low.where(plain), "alias").select(id_col, "canonical")
    pair = lambda text, at: F.substring(text, at, F.lit(2))
    starts = lambda text: F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(text) - 1))
    odd = lambda c: ~F.col(c).rlike(r"^[\x00-\x7F]*$")
    other = low.where(~plain)
    grams = other.select("alias", F.explode(starts(F.col("alias"))).alias("at")).distinct().select("alias", "at", pair(F.col("alias"), F.col("at")).alias("gram")).where(odd("gram"))
    usual = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    best = grams.join(usual, "gram").groupBy("alias").agg(F.min(F.struct("n", "gram", "at")).alias("m")).select("alias", "m.gram", "m.at")
    kept = best.join(other, "alias")
    text = df.select(id_col, F.lower(text_col).alias("__t")).where(odd("__t"))
    places = F.explode(F.sequence(F.lit(1), F.char_length("__t")))
    ones = text.select(id_col, "__t", places.alias("p"))
    met = ones.select(id_col, "__t", "p", pair(F.col("__t"), F.col("p")).alias("gram")).unionByName(ones.select(id_col, "__t", "p", F.substring(F.col("__t"), F.col("p"), F.lit(1)).alias("gram"))).where(odd("gram"))
    begin = F.col("p") - F.col("at") + 1
    found = met.join(kept, "gram").where((begin >= 1) & (F.substring(F.col("__t"), begin, F.char_length("alias")) == F.col("alias"))).select(id_col, "canonical")
    by = worded.unionByName(found).groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set("canonical")), ",").alias("canonical"))
    return df.select(id_col).distinct().join(by, id_col, "left").select(id_col, F.coalesce("canonical", F.lit("")).alias("canonical"))


def first_rule(df: DataFrame, rules: Sequence[tuple[str, str]], text_col: str, default: str) -> Column:
    """The value of the first regular expression (any case) that the text holds; else the default."""
    out = None
    for pattern, value in rules:
        hit = F.col(text_col).rlike(f"(?i){pattern}")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def rule_parameters(df: DataFrame, path_col: str, name_col: str, material_col: str, tag_col: str, rules: Sequence[dict], presets: dict[str, dict[str, float]], names: Sequence[str]) -> DataFrame:
    """Parameters of the first rule that matches, one column for each of ``names``, and the rule's number (null: none).

    A rule has a ``glob`` for the path (* and ?, the whole path), or else a regular expression ``regex`` for the name in any case, and values, and maybe a ``material``. A glob decides before a
    regular expression of the same rule. A row's own material, if it has a preset, overrides the rule's values; the rule's material, or the row's tag if it has none, only fills what is missing.
    """
    like = lambda g: F.col(path_col).rlike("^" + re.escape(g).replace(r"\*", ".*").replace(r"\?", ".") + "$")
    number = None
    for i, r in enumerate(rules):
        hit = (like(r["glob"]) if r.get("glob") else F.lit(False)) | (F.col(name_col).rlike(f"(?i){r['regex']}") if r.get("regex") else F.lit(False))
        number = F.when(hit, i) if number is None else number.when(hit, i)
    found = df.withColumn("rule", number)
    preset = lambda c, n: F.coalesce(*[F.when(c == m, F.lit(v.get(n)).cast("double")) for m, v in presets.items()])
    rule = lambda f: F.coalesce(*[F.when(F.col("rule") == i, F.lit(f(r))) for i, r in enumerate(rules)])
    tag = F.coalesce(rule(lambda r: r.get("material")).cast("string"), F.col(tag_col))
    return found.withColumns({n: F.coalesce(preset(F.col(material_col), n), rule(lambda r, n=n: r.get(n)).cast("double"), preset(tag, n)) for n in names})


def compatible_pairs(left: DataFrame, right: DataFrame, wildcard: str = "any") -> DataFrame:
    """Rows of ``left`` (array substrates, treatment, optical) with the rows of ``right`` (substrate, treatment, optical) that go with them: substrate in the list, treatments equal
    (null equals null), optics equal or a wildcard. Both meet by substrate and treatment, over as many partitions as the pairs need."""
    l = left.withColumn("__substrate", F.explode(F.array_distinct("substrates"))).withColumn("__treatment", F.struct("treatment")).withColumnRenamed("optical", "__optical").drop("treatment")  # noqa: E741
    r = right.withColumn("__substrate", F.col("substrate")).withColumn("__treatment", F.struct("treatment"))
    optics = F.col("__optical").eqNullSafe(F.col("optical")) | (F.col("__optical") == wildcard) | (F.col("optical") == wildcard)
    return met(l, r, ["__substrate", "__treatment"]).where(optics).drop("__substrate", "__treatment", "__optical")


def compact_ranges(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Inclusive ranges (lo, hi) of neighbouring whole numbers. The rows are dealt by key once, over partitions that follow their number."""
    d = spread(df.select(*keys, value), keys).distinct().withColumn("__g", F.col(value) - F.row_number().over(Window.partitionBy(*keys).orderBy(value)))
    return d.groupBy(*keys, "__g").agg(F.min(value).alias("lo"), F.max(value).alias("hi")).drop("__g")


def expand_ranges(ranges: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return ranges.select(*keys, F.explode(F.sequence("lo", "hi")).alias(value))


def descriptor_text(*fields: Column) -> Column:
    """The fields that are there, each once, as sentences."""
    clean = [F.when(F.trim(f) != "", F.trim(f)) for f in fields]
    return F.array_join(F.array_distinct(F.array_compact(F.array(*clean))), ". ")


def safe_name(text: Column) -> Column:
    """Letters, digits and single underscores; never empty, never a digit first."""
    name = F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(name == "", "unnamed").when(name.rlike("^[0-9]"), F.concat(F.lit("n_"), name)).otherwise(name)


def content_id(prefix: str, *fields: Column) -> Column:
    """Prefix and the first twelve hex digits of the SHA-256 of the fields."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[f.cast("string") for f in fields]), 256), 1, 12))


def choose_result(files: DataFrame, keys: Sequence[str], kind: str, url: str, preferences: Sequence[str]) -> DataFrame:
    """One file for each job: the preferred kind, else the first by name."""
    rank = F.array_position(F.array(*map(F.lit, preferences)), F.col(kind))
    order = F.when(rank > 0, rank).otherwise(len(preferences) + 1)
    return files.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(order, url))).where("__r = 1").drop("__r")


def check_references(refs: DataFrame, keys: Sequence[str], name: str, low: int = 2, high: int = 4) -> DataFrame:
    """References of each asset: their number within bounds, and no name twice."""
    by = refs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(name).alias("names"))
    why = F.when(F.col("n") < low, "too_few").when(F.col("n") > high, "too_many").when(F.col("names") < F.col("n"), "duplicate").otherwise("ok")
    return by.select(*keys, "n", why.alias("status"))


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (with repeats) that just one side has; no rows if both sides are equal."""
    left, right = a.select(*keys), b.select(*keys)
    return left.exceptAll(right).withColumn("side", F.lit("left_only")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right_only")))


def union_views(*dfs: DataFrame) -> DataFrame:
    """All rows of all tables by column name; missing columns are null."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def plan_delta(base: DataFrame, candidate: DataFrame, keys: Sequence[str], fields: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """Rows that differ: added, removed or changed, the changed fields, and whether only permitted fields changed."""
    b = base.select(*keys, *[F.col(f).alias(f"__b_{f}") for f in fields], F.lit(True).alias("__in_b"))
    c = candidate.select(*keys, *[F.col(f).alias(f"__c_{f}") for f in fields], F.lit(True).alias("__in_c"))
    changed = F.array_compact(F.array(*[F.when(~F.col(f"__b_{f}").eqNullSafe(F.col(f"__c_{f}")), F.lit(f)) for f in fields]))
    kind = F.when(F.col("__in_b").isNull(), "added").when(F.col("__in_c").isNull(), "removed").when(F.size(changed) > 0, "changed").otherwise("same")
    both = b.join(c, list(keys), "full").withColumn("kind", kind).withColumn("fields", F.when(F.col("kind") == "changed", F.array_join(changed, ",")).otherwise(""))
    forbidden = F.size(F.array_except(changed, F.array(*map(F.lit, allowed)))) > 0
    return both.withColumn("permitted", (F.col("kind") == "changed") & ~forbidden).where("kind <> 'same'").select(*keys, "kind", "fields", "permitted")


def apply_review(suggestions: DataFrame, decisions: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """approve keeps, replace takes the reviewer's value, reject clears; without a decision the suggestion waits."""
    d = decisions.select(*keys, "decision", F.col(value).alias("__new"))
    out = suggestions.join(d, list(keys), "left")
    new = F.when(F.col("decision") == "approve", F.col(value)).when(F.col("decision") == "replace", F.col("__new"))
    return out.select(*keys, new.alias(value), F.coalesce("decision", F.lit("pending")).alias("state"))


def framed(columns: Sequence[str]) -> Column:
    """The columns' texts one after another, each after its length, so that no two rows of different values give one text; null is no empty text."""
    text = lambda c: F.col(c).cast("string")
    return F.concat(*[F.coalesce(F.concat(F.char_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in columns])


def sealed_digest(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One digest for each key over its rows, whatever their order: their number and two sums of 60 bits of their hashes, hashed. No group is collected."""
    hashed = df.select(*keys, F.sha2(framed(columns), 256).alias("__h"))
    part = lambda at: F.sum(F.conv(F.substring("__h", at, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    by = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), part(1).alias("__s"), part(16).alias("__t"))
    return by.select(*keys, "rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), "__s", "__t"), 256).alias("digest"))


def assembly_domain(path: Column, depth: int) -> Column:
    """The path segment at ``depth`` (from 1) of a path without its last part; shallower paths are the root's."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.when(F.size(parts) > depth, F.get(parts, F.lit(depth - 1))).otherwise("root")


def candidate_plans(parts: DataFrame, group: str, candidates: Sequence) -> DataFrame:
    """The changes of one plan for each group and candidate, with the plan's id: the parts of the group; all others stay as they are. candidates: a short list."""
    chosen = F.explode(F.array(*[F.lit(c) for c in candidates]))
    return parts.withColumn("candidate", chosen).withColumn("candidate_id", content_id("C_", F.col(group), F.col("candidate")))
