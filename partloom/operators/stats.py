"""Robust statistics, voting and shares. Every operator is one or two grouped aggregations on its keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partloom.operators.spread import merged


def quantiles(df: DataFrame, keys: Sequence[str], value: str | Column, points: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of each key, by name, and ``n``. Equal values are counted before the shuffle and the counts run up in order, so no key's values are held in one buffer."""
    v = F.col(value) if isinstance(value, str) else value
    k = list(keys)
    by = df.select(*k, v.cast("double").alias("__v")).where(F.col("__v").isNotNull()).groupBy(*k, "__v").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*k)
    run = by.withColumn("__hi", F.sum("__c").over(w.orderBy("__v"))).withColumn("n", F.sum("__c").over(w))

    def at(q: float) -> tuple[Column, Column]:
        place = (F.col("n") - 1) * q
        holds = lambda i: (i < F.col("__hi")) & (i >= F.col("__hi") - F.col("__c"))
        return F.max(F.when(holds(F.floor(place)), F.col("__v"))), F.max(F.when(holds(F.ceil(place)), F.col("__v")))

    by_key = run.groupBy(*k, "n").agg(*[x.alias(f"__{side}_{name}") for name, q in points.items() for side, x in zip(("lo", "hi"), at(q), strict=True)])
    part = lambda q: (F.col("n") - 1) * q - F.floor((F.col("n") - 1) * q)
    return by_key.select(*k, "n", *[(F.col(f"__lo_{name}") + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * part(q)).alias(name) for name, q in points.items()])


def robust_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, median, quartiles, their distance, and the median absolute deviation (quantiles are interpolated)."""
    q = quantiles(df, keys, value, {"median": 0.5, "q1": 0.25, "q3": 0.75})
    off = quantiles(df.join(q.select(*keys, "median"), list(keys)), keys, F.abs(F.col(value) - F.col("median")), {"mad": 0.5})
    return q.join(off.drop("n"), list(keys)).select(*keys, "n", "median", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "mad")


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """The first value, in ascending order, at which half of the weight is reached (a step, not interpolated)."""
    by_value = df.where(F.col(weight) > 0).groupBy(*keys, value).agg(F.sum(weight).alias("__w"))
    w = Window.partitionBy(*keys)
    run = by_value.withColumn("__run", F.sum("__w").over(w.orderBy(value))).withColumn("__all", F.sum("__w").over(w))
    return run.where(F.col("__run") >= F.col("__all") / 2).groupBy(*keys).agg(F.min(value).alias("weighted_median"))


def weighted_scores(df: DataFrame, keys: Sequence[str], scores: Sequence[str], weight: str) -> DataFrame:
    """Weighted mean of each score over its rows that are not null."""
    return df.groupBy(*keys).agg(*[(F.sum(F.col(s) * F.col(weight)) / F.sum(F.when(F.col(s).isNotNull(), F.col(weight)))).alias(s) for s in scores])


def observation_weight(pixels: Column, tier: Column) -> Column:
    """Tier factor times min(1, log2(pixels) / 12); no pixels weigh nothing."""
    return F.when(pixels >= 1, tier * F.least(F.lit(1.0), F.log2(pixels) / 12)).otherwise(0.0)


def categorical_consensus(df: DataFrame, keys: Sequence[str], value: str, confidence: str, uncertain: Sequence[str] = ("unknown",)) -> DataFrame:
    """The winning value of each key: resolved before uncertain, then count, sum of confidence, value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("votes"), F.sum(confidence).alias("confidence"))
    order = [F.col(value).isin(*uncertain).asc(), F.desc("votes"), F.round("confidence", 8).desc(), F.asc(value)]
    return counts.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").select(*keys, value, "votes", "confidence")


def share_winner(counts: DataFrame, keys: Sequence[str], value: str, amount: str, min_share: float, min_margin: float) -> DataFrame:
    """The value with the largest share, if share and lead over the next reach their floors; else null with the reason."""
    by = counts.groupBy(*keys, value).agg(F.sum(amount).alias("__n"))
    w = Window.partitionBy(*keys)
    shares = by.withColumn("share", F.round(F.col("__n") / F.sum("__n").over(w), 8))
    order = w.orderBy(F.desc("share"), value)
    top = shares.withColumn("__r", F.row_number().over(order)).withColumn("margin", F.round(F.col("share") - F.coalesce(F.lead("share").over(order), F.lit(0.0)), 8)).where("__r = 1")
    reason = F.when(F.col("share") < min_share, "share_below_floor").when(F.col("margin") < min_margin, "margin_below_floor")
    return top.select(*keys, F.when(reason.isNull(), F.col(value)).alias("winner"), "share", "margin", reason.alias("reason"))


def multiview_support(df: DataFrame, keys: Sequence[str], group: str, view: str, resolved: Column, min_views: int = 2) -> DataFrame:
    """The one group with enough distinct views, where no other group is resolved in any view."""
    by = df.where(resolved).groupBy(*keys, group).agg(F.count_distinct(view).alias("views"))
    w = Window.partitionBy(*keys)
    alone = by.withColumn("__groups", F.count(F.lit(1)).over(w))
    return alone.where((F.col("__groups") == 1) & (F.col("views") >= min_views)).select(*keys, group, "views")


def collapse(df: DataFrame, keys: Sequence[str], value: str, colour: str, max_share: float) -> DataFrame:
    """Whether one value took more than ``max_share`` of a key, and how many values stand for several colours."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), F.count_distinct(colour).alias("__c"))
    out = counts.groupBy(*keys).agg((F.max("__n") / F.sum("__n")).alias("dominant_share"), F.count(F.lit(1)).alias("values"), F.sum((F.col("__c") > 1).cast("long")).alias("collisions"))
    return out.withColumn("collapsed", F.col("dominant_share") > max_share)


def medoid_colour(df: DataFrame, keys: Sequence[str], order: str, max_distance: float = 20.0) -> DataFrame:
    """The sample nearest to the median Lab of its key, the share of samples within ``max_distance`` of it, and the 0.9 quantile. ``df`` has a struct ``lab``."""
    k = list(keys)
    medians = None
    for c in "lab":
        one = quantiles(df, k, F.col(f"lab.{c}"), {f"__{c}": 0.5}).drop("n")
        medians = one if medians is None else medians.join(merged(one), k)
    far = lambda a: F.sqrt(sum((F.pow(F.col(f"lab.{c}") - F.col(f"{a}{c}"), F.lit(2)) for c in "ab"), F.pow(F.col("lab.l") - F.col(f"{a}l"), F.lit(2))))
    near = df.join(merged(medians), k).groupBy(*k).agg(F.min(F.struct(F.round(far("__"), 8).alias("d"), F.col(order).alias("o"), *[F.col(f"lab.{c}").alias(c) for c in "lab"])).alias("m"))
    around = df.join(merged(near.select(*k, F.col("m.o").alias("medoid"), *[F.col(f"m.{c}").alias(f"__m{c}") for c in "lab"])), k).withColumn("__d", far("__m"))
    inside = around.groupBy(*k, "medoid").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("__d") <= max_distance).cast("double")).alias("inliers"))
    return inside.join(merged(quantiles(around, k, "__d", {"p90": 0.9}).drop("n")), k).select(*k, "medoid", "n", "inliers", "p90")


def median_of_medians(df: DataFrame, keys: Sequence[str], view: str, values: Sequence[str], least: int = 6) -> DataFrame:
    """Median over views of each view's median, of views with at least ``least`` samples."""
    k = list(keys)
    enough = df.groupBy(*k, view).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least)
    out = enough.groupBy(*k).agg(F.count(F.lit(1)).alias("views"))
    for v in values:
        per = quantiles(df, [*k, view], v, {v: 0.5}).drop("n").join(enough, [*k, view], "left_semi")
        out = out.join(quantiles(per, k, v, {v: 0.5}).drop("n"), k, "left")
    return out


def histogram_score(a: DataFrame, b: DataFrame, keys: Sequence[str], bin_col: str, amount: str) -> DataFrame:
    """Sum over bins of the smaller share of two tables, by key. Amounts are brought to the product of both totals and divided once, so that sums of whole amounts are exact in any order."""
    total = lambda d, n: d.groupBy(*keys, bin_col).agg(F.sum(amount).alias(n)).withColumn(f"{n}_all", F.sum(n).over(Window.partitionBy(*keys)))
    both = total(a, "__a").join(merged(total(b, "__b")), [*keys, bin_col], "full")
    by_key = both.withColumn("__p", F.coalesce("__a_all", F.max("__a_all").over(Window.partitionBy(*keys)))).withColumn("__q", F.coalesce("__b_all", F.max("__b_all").over(Window.partitionBy(*keys))))
    common = F.least(F.coalesce("__a", F.lit(0)) * F.col("__q"), F.coalesce("__b", F.lit(0)) * F.col("__p"))
    return by_key.groupBy(*keys).agg(F.coalesce(F.sum(common) / F.max(F.col("__p") * F.col("__q")), F.lit(0.0)).alias("intersection"))


def group_recall(a: DataFrame, b: DataFrame, keys: Sequence[str], bin_col: str, amount: str, evidence: DataFrame | None = None) -> DataFrame:
    """How much of each bin's required share is present in ``b``: mean and minimum over bins. Required is half of the bin's share in ``a``, or in ``evidence`` (like ``a``) if it is smaller there, from 0.001 to 0.95."""
    share = lambda d, n: d.groupBy(*keys, bin_col).agg(F.sum(amount).alias("__n")).withColumn(n, F.col("__n") / F.sum("__n").over(Window.partitionBy(*keys))).drop("__n")
    both = share(a, "__a").join(share(b, "__b"), [*keys, bin_col], "left")
    if evidence is not None:
        both = both.join(share(evidence, "__e"), [*keys, bin_col], "left").withColumn("__a", F.least("__a", F.coalesce("__e", F.lit(0.0))))
    required = F.least(F.lit(0.95), F.greatest(F.lit(0.001), 0.5 * F.col("__a")))
    return both.withColumn("__r", F.least(F.lit(1.0), F.coalesce("__b", F.lit(0.0)) / required)).groupBy(*keys).agg(F.count(F.lit(1)).alias("bins"), F.avg("__r").alias("macro"), F.min("__r").alias("minimum"))


#: Bins of the hue histogram, least saturation and value of a chromatic pixel, least chromatic share of both sides, weights of the composite score.
HUE_BINS, LEAST_SATURATION, LEAST_VALUE, LEAST_CHROMATIC = 12, 0.18, 0.12, 0.02
COLOUR_WEIGHTS = {"category": 0.45, "hue": 0.25, "recall": 0.12, "macro": 0.08, "saturation": 0.10, "value": 0.10}


def chromatic() -> Column:
    return (F.col("s") >= LEAST_SATURATION) & (F.col("v") >= LEAST_VALUE)


def hue_bins(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """(keys, bin, amount): how much of each of twelve hues the chromatic rows hold. ``df`` has h, s and v from 0 to 1."""
    at = (F.floor(F.col("h") * HUE_BINS) % HUE_BINS).cast("long")
    return df.where(chromatic()).groupBy(*keys, at.alias("bin")).agg(F.sum(amount).alias(amount))


def colour_distribution(df: DataFrame, keys: Sequence[str], category: str, amount: str, top: int = 4) -> DataFrame:
    """Of each key: its chromatic share, the medians of saturation and value by amount, and its ``top`` categories with their shares, best first."""
    k = list(keys)
    share = df.groupBy(*k).agg((F.sum(F.when(chromatic(), F.col(amount)).otherwise(0)) / F.sum(amount)).alias("chromatic"))
    medians = [weighted_median(df, k, c, amount).withColumnRenamed("weighted_median", n) for c, n in (("s", "saturation"), ("v", "value"))]
    by = df.groupBy(*k, category).agg(F.sum(amount).alias("__n"))
    w = Window.partitionBy(*k)
    best = by.withColumn("share", F.col("__n") / F.sum("__n").over(w)).withColumn("__r", F.row_number().over(w.orderBy(F.desc("__n"), category))).where(F.col("__r") <= top)
    named = best.groupBy(*k).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", category, "share"))), lambda x: F.struct(x[category].alias("name"), x["share"].alias("share"))).alias("top"))
    return share.join(medians[0], k).join(medians[1], k).join(named, k)


def colour_score(a: DataFrame, b: DataFrame, keys: Sequence[str], category: str, amount: str) -> DataFrame:
    """How alike the colours of two tables are, by key: the weighted mean of the terms that are there.

    Terms: intersection of the category shares; intersection of the hues, if both sides have enough chromatic rows; least and mean recall of
    the categories; closeness of the medians of saturation and of value. Both tables have h, s and v.
    """
    k = list(keys)
    recall = group_recall(a, b, k, category, amount).select(*k, F.col("minimum").alias("recall"), "macro")
    sides = [colour_distribution(d, k, category, amount).select(*k, *[F.col(c).alias(f"{c}_{n}") for c in ("chromatic", "saturation", "value")]) for d, n in ((a, "a"), (b, "b"))]
    hue = histogram_score(hue_bins(a, k, amount), hue_bins(b, k, amount), k, "bin", amount).withColumnRenamed("intersection", "hue")
    out = histogram_score(a, b, k, category, amount).withColumnRenamed("intersection", "category").join(recall, k, "left").join(sides[0], k).join(sides[1], k).join(hue, k, "left")
    enough = (F.col("chromatic_a") >= LEAST_CHROMATIC) & (F.col("chromatic_b") >= LEAST_CHROMATIC)
    near = lambda c: 1 - F.abs(F.col(f"{c}_a") - F.col(f"{c}_b"))
    terms = {"category": F.col("category"), "hue": F.when(enough, F.coalesce("hue", F.lit(0.0))), "recall": F.col("recall"), "macro": F.col("macro"), "saturation": near("saturation"), "value": near("value")}
    return out.select(*k, *[t.alias(n) for n, t in terms.items()], mean_of_present([(terms[n], w) for n, w in COLOUR_WEIGHTS.items()]).alias("score"))


def mean_of_present(pairs: Sequence[tuple[Column, Column | float]]) -> Column:
    """Weighted mean over the terms that are not null; null if there is none."""
    total = sum((F.when(t.isNotNull(), F.lit(w)).otherwise(0.0) for t, w in pairs[1:]), F.when(pairs[0][0].isNotNull(), F.lit(pairs[0][1])).otherwise(0.0))
    value = sum((F.coalesce(t * w, F.lit(0.0)) for t, w in pairs[1:]), F.coalesce(pairs[0][0] * pairs[0][1], F.lit(0.0)))
    return F.when(total > 0, value / total)
