"""Operators that put the others together for an assembly: admission, choices, plans and checks of what was delivered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partloom.functions.color import srgb_to_linear
from partloom.operators import gates, joins, rank


def normalize_reply(role: Column, text: Column, default: str = "none") -> dict[str, Column]:
    """Loosely typed replies: the role in lower case, the first whole number (null: none), the first line that says something, and the confidence: a number, or the mean of a list of them, from 0 to 1."""
    numbers = F.transform(F.regexp_extract_all(F.regexp_extract(text, r"(?i)confidence\W*\[?([0-9.,\s]*)", 1), F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0)), lambda x: x.try_cast("double"))
    mean = F.when(F.size(numbers) > 0, F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x) / F.size(numbers))
    return {
        "role": F.lower(F.trim(role)),
        "number": F.regexp_extract(text, "([0-9]+)", 1).try_cast("long"),
        "head": F.coalesce(F.nullif(F.trim(F.split_part(text, F.lit("\n"), F.lit(1))), F.lit("")), F.lit(default)),
        "confidence": F.when(mean.between(0, 1), mean),
    }


def admitted(pixels: Column, overlap: Column, tier: Column, barred: Sequence[int], min_pixels: float = 10, min_overlap: float = 0.2) -> Column:
    """Whether an observation counts as evidence: pixels and overlap enough, in a view of an accepted tier."""
    return (pixels >= min_pixels) & (overlap >= min_overlap) & ~tier.isin(*barred)


#: Poses of a list.
MOST_POSES = 1000


def pose_candidates(views: DataFrame, view: str, words: str, poses: DataFrame, pose: str, names: str) -> DataFrame:
    """(view, pose): the poses of which a name is among the view's words; a view without any takes all. poses: a fixed, short list, of which the names are read once; more than ``MOST_POSES`` are an error."""
    listed = [(r[0], list(r[1])) for r in poses.select(pose, names).orderBy(pose).limit(MOST_POSES + 1).collect()]
    if len(listed) > MOST_POSES:
        raise ValueError(f"more than {MOST_POSES} poses")
    hits = F.array_compact(F.array(*[F.when(F.arrays_overlap(words, F.array(*map(F.lit, n))), F.lit(p)) for p, n in listed]))
    return views.select(view, F.explode(F.when(F.size(hits) > 0, hits).otherwise(F.array(*[F.lit(p) for p, _ in listed]))).alias(pose))


def paint_parameters(colour: Column, verified: Column, low: float = 0.02, high: float = 0.8) -> Column:
    """Linear value of an sRGB channel from verified evidence, between ``low`` and ``high``; null without it."""
    return F.when(verified, F.round(F.greatest(F.lit(low), F.least(F.lit(high), srgb_to_linear(colour))), 6))


def default_choice(parts: DataFrame, alternatives: DataFrame, module: str, id_col: str, tone: str, words: str, k: int = 2) -> DataFrame:
    """The best alternative of a part's module: 80 for an equal tone, else -35; 4 for each of the first ``k`` words that is equal; 45 for the part itself. None if the best score is not above 0."""
    side = lambda d, n: d.select(F.col(module).alias("__m"), *[F.col(c).alias(f"{n}_{c}") for c in (id_col, tone, words)])
    kind = lambda n: F.struct(F.col(f"{n}_{tone}").alias("tone"), *[F.get(f"{n}_{words}", F.lit(i)).alias(f"word{i}") for i in range(k)])
    x, y = (side(d, n).withColumn(f"__{n}", kind(n)) for d, n in ((parts, "x"), (alternatives, "y")))
    score = F.when(F.col("__x.tone") == F.col("__y.tone"), 80).otherwise(-35)
    for i in range(k):
        score = score + F.when(F.col(f"__x.word{i}") == F.col(f"__y.word{i}"), 4).otherwise(0)
    # only the kinds of a module (its tones and first words) meet one another, each with its first alternative; then every part meets itself
    first = y.groupBy("__m", "__y").agg(F.min(f"y_{id_col}").alias("candidate"))
    met = x.select("__m", "__x").distinct().join(first, "__m").groupBy("__m", "__x").agg(F.min(F.struct((-score.cast("long")).alias("s"), "candidate")).alias("b"))
    of_kind = x.withColumnRenamed("__m", "__n").withColumnRenamed("__x", "__k").join(met, F.col("__n").eqNullSafe(F.col("__m")) & F.col("__k").eqNullSafe(F.col("__x")))
    itself = x.join(y, (x["__m"] == y["__m"]) & (F.col(f"x_{id_col}") == F.col(f"y_{id_col}")))
    scored = of_kind.select(F.col(f"x_{id_col}").alias(id_col), "b").unionByName(itself.select(F.col(f"x_{id_col}").alias(id_col), F.struct((-(score + 45).cast("long")).alias("s"), F.col(f"y_{id_col}").alias("candidate")).alias("b")))
    best = scored.groupBy(id_col).agg(F.min("b").alias("b"))
    return best.where(F.col("b.s") < 0).select(id_col, F.col("b.candidate").alias("candidate"), (-F.col("b.s")).alias("score"))


def match_by_digest(assets: DataFrame, projects: DataFrame, key: str, digest: str) -> DataFrame:
    """(asset, project): the first project with an asset's digest; null: none has it."""
    first = projects.groupBy(digest).agg(F.min(key).alias("project"))
    return assets.join(first, digest, "left").select(F.col(key).alias("asset"), "project")


def geometry_risk(counts: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, Column]], hard: Sequence[str]) -> DataFrame:
    """Reasons from the counts of a mesh, in order, and whether one of them is ``hard``."""
    why = gates.reasons(rules)
    return counts.select(*keys, F.array_join(why, ",").alias("reasons"), F.arrays_overlap(why, F.array(*map(F.lit, hard))).alias("hard"))


def faceted_search(df: DataFrame, id_col: str, facets: Column, fields: Sequence[tuple[Column, int]], words: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the highest score: hard facets first, then the weights of the words that their fields hold. fields: (array of words in lower case, weight)."""
    weighed = lambda f, n: F.transform(f, lambda w: F.struct(w.alias("w"), F.lit(n).alias("n")))
    held = F.concat(*[weighed(f, n) for f, n in fields])
    hits = df.where(facets).select(id_col, F.explode(held).alias("f")).where(F.col("f.w").isin(*words))
    return hits.groupBy(id_col).agg(F.sum("f.n").alias("score")).orderBy(F.desc("score"), id_col).limit(k)


def resolve_limitations(failures: DataFrame, keys: Sequence[str], explanations: Sequence[tuple[str, DataFrame, Sequence[str]]], default: str = "unresolved") -> DataFrame:
    """Each failure with the first explanation that holds. explanations: (name, table, the columns it is looked up by), in order; an alignment limit is one of them like the others."""
    out, reason = failures, None
    for i, (name, found, on) in enumerate(explanations):
        out = out.join(found.select(*on).distinct().withColumn(f"__e{i}", F.lit(True)), list(on), "left")
        reason = F.when(F.col(f"__e{i}"), name) if reason is None else reason.when(F.col(f"__e{i}"), name)
    return out.select(*keys, (F.lit(default) if reason is None else reason.otherwise(default)).alias("resolution"))


def agreed_winner(first: DataFrame, second: DataFrame, views: DataFrame, keys: Sequence[str], value: str, amount: str, view: str, min_views: int = 2) -> DataFrame:
    """(keys, value, views): where both sources have one winner by amount, then value, and enough views were seen."""
    win = lambda d: rank.rank_scores(d, keys, amount, value, 1).select(*keys, value)
    seen = views.groupBy(*keys).agg(F.count_distinct(view).alias("views"))
    return win(first).join(win(second), [*keys, value]).join(seen, list(keys)).where(F.col("views") >= min_views)


def assignment_margin(scores: DataFrame, key: str, left: str, right: str, score: str, locked: DataFrame | None = None) -> DataFrame:
    """(key, forbidden, margin): how much a key's best one-to-one total falls when a pair ("left>right") is forbidden. Pairs that the best assignment does not use cost nothing.

    locked: pairs (key, left, right) that stand in every assignment. They are not forbidden, and scores that share an item with one are left out.
    """
    if locked is not None:
        scores = scores.join(locked.select(key, left), [key, left], "left_anti").join(locked.select(key, right), [key, right], "left_anti")
    pair = F.concat_ws(">", F.col(left).cast("string"), F.col(right).cast("string"))
    total = lambda df, keys: joins.assign_optimal(df, keys, left, right, score).groupBy(*keys).agg(F.sum(score).alias("total"))
    best = joins.assign_optimal(scores, [key], left, right, score).select(key, pair.alias("forbidden"), score)
    whole = best.groupBy(key).agg(F.sum(score).alias("__best"))
    less = scores.join(best.select(key, "forbidden"), key).where(pair != F.col("forbidden"))
    other = total(less, [key, "forbidden"]).withColumnRenamed("total", "__without")
    pairs = scores.select(key, pair.alias("forbidden")).distinct()
    used = best.select(key, "forbidden", F.lit(True).alias("__used"))
    out = pairs.join(whole, key).join(used, [key, "forbidden"], "left").join(other, [key, "forbidden"], "left")
    return out.select(key, "forbidden", F.round(F.when(F.col("__used"), F.col("__best") - F.coalesce("__without", F.lit(0.0))).otherwise(0.0), 6).alias("margin"))


def delivery_check(planned: DataFrame, delivered: DataFrame, key: str, value: str) -> DataFrame:
    """Bindings of a delivered copy against the plan: ok, changed or missing."""
    out = joins.verify_dependencies(planned, delivered, key, value)
    return out.select(key, F.when(F.col("status") == "missing", "missing").when(F.col("status") == "stale", "changed").otherwise("ok").alias("status"))


def part_evidence(pixels: DataFrame, keys: Sequence[str], trusted: Column, chromatic: Column) -> DataFrame:
    """Projected, trusted and chromatic pixels of each key."""
    return pixels.groupBy(*keys).agg(F.count(F.lit(1)).alias("projected"), F.count_if(trusted).alias("trusted"), F.count_if(trusted & chromatic).alias("chromatic"))


def part_plan(candidates: DataFrame, registry: DataFrame, key: str, id_col: str, weights: dict[str, float]) -> DataFrame:
    """One material for each registered part: ranked by each lane (a score column), lanes fused, the first taken; parts without candidates are missing."""
    lanes = rank.rank_lanes(candidates, [key], id_col, list(weights))
    fused = rank.rrf(lanes, [key], id_col, "lane", weights).where("rank = 1")
    cover = joins.reconcile(registry, fused.select(key), [key])
    return cover.join(fused.select(key, F.col(id_col).alias("material")), key, "left").select(key, "material", "status")


def colour_plan(candidates: DataFrame, baseline: DataFrame, key: str, id_col: str, score: str, barred: Column, min_gain: float) -> DataFrame:
    """recolour, keep or not_allowed: parts that may be recoloured and have a candidate better than their baseline by ``min_gain``."""
    win = rank.select_winner(candidates, baseline, [key], id_col, score, min_gain)
    return win.select(key, F.when(barred, "not_allowed").when(F.col("changed"), "recolour").otherwise("keep").alias("action"))
