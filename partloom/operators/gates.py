"""Decisions with reasons: vote gates, quality gates, publication gates and repairs. Reasons are arrays in the order of the rules."""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partloom.operators.stats import quantiles, weighted_median


def reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """The codes whose condition holds, in order; a null condition does not hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in rules]))


def validate(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds ``reason_codes``: the rules (code, condition of a fault) that a row breaks. Accepted rows have none."""
    return df.withColumn("reason_codes", reasons(rules))


def consensus_gate(main: DataFrame, votes: DataFrame, keys: Sequence[str], group: str, confidence: str, min_views: int = 2, auto: float = 0.8, against: float = 0.6) -> DataFrame:
    """Main mappings (status, group, confidence, multi) against the votes of other views: promoted, kept or downgraded; the first rule that fits decides."""
    m = main.select(*keys, "status", F.col(group).alias("__g"), F.col(confidence).alias("__c"), "multi")
    v = votes.select(*keys, F.col(group).alias("__vg"), F.col(confidence).alias("__vc"))
    met = m.join(v, list(keys), "left")
    agree = (F.col("__vg") == F.col("__g")) & (F.col("__vc") >= auto)
    conflict = F.col("__vg").isNotNull() & (F.col("__vg") != F.col("__g")) & (F.col("__vc") >= against)
    unresolved = F.col("__vg").isNull() & (F.col("__vc") >= against)
    by = met.groupBy(*keys, "status", "__g", "__c", "multi").agg(F.count_if(agree).alias("agreeing"), F.count_if(conflict).alias("conflicting"), F.count_if(unresolved).alias("unresolved"), F.min(F.when(agree, F.col("__vc"))).alias("__low"))
    matched, a, c, u = F.col("status").isin("matched", "review"), F.col("agreeing"), F.col("conflicting"), F.col("unresolved")
    decision = (
        F.when((F.col("status") == "review") & ~F.col("multi") & (c == 0) & (u == 0) & (a >= min_views), "promoted_auto")
        .when(matched & (F.col("multi") | (c > 0)), "downgraded_preserve")
        .when(F.col("status") != "matched", "unchanged")
        .when(u > 0, "downgraded_review")
        .when(a < min_views, "downgraded_review")
        .otherwise("kept_auto")
    )
    return by.select(
        *keys, decision.alias("decision"), F.when(decision != "downgraded_preserve", F.col("__g")).alias(group), F.when(decision == "promoted_auto", F.col("__low")).otherwise(F.col("__c")).alias(confidence), "agreeing", "conflicting", "unresolved"
    )


def fuse_evidence(samples: DataFrame, keys: Sequence[str], channels: Sequence[str], kind: str, view: str, max_iqr: float, min_views: int = 2, conductive: Column | None = None) -> DataFrame:
    """Per-view medians fused over views: median and quartile distance of each channel, class agreement, and auto or preserve with reasons.

    conductive: condition on the class ``kind``; with it a column ``metallic`` suggests 1 for conductive classes and 0 for others, never what was measured, and null where classes conflict.
    """
    k = list(keys)
    by = samples.groupBy(*k).agg(F.count_distinct(view).alias("views"), F.min(kind).alias("__lo"), F.max(kind).alias("__hi"))
    for c in channels:
        per = quantiles(samples, [*k, view], c, {c: 0.5}).drop("n")
        by = by.join(quantiles(per, k, c, {c: 0.5, f"__lo_{c}": 0.25, f"__hi_{c}": 0.75}).drop("n"), k, "left")
    spread = [(f"{c}_dispersion", F.col(f"__hi_{c}") - F.col(f"__lo_{c}") > max_iqr) for c in channels]
    why = reasons([("too_few_views", F.col("views") < min_views), ("class_conflict", F.col("__lo") != F.col("__hi")), *spread])
    more = [] if conductive is None else [F.when(F.col("__lo") == F.col("__hi"), F.when(conductive, 1.0).otherwise(0.0)).alias("metallic")]
    named = by.withColumn(kind, F.col("__lo")) if conductive is not None else by
    return named.select(*k, "views", *[F.round(F.col(c), 6).alias(c) for c in channels], *more, F.when(F.size(why) == 0, "auto").otherwise("preserve").alias("mode"), F.array_join(why, ",").alias("reasons"))


def confidence_gate(df: DataFrame, confidences: Sequence[str], margin: str, visible: str, risk: str, auto: float = 0.8, review: float = 0.5, min_margin: float = 0.05, min_visible: float = 0.1) -> DataFrame:
    """auto, review or preserve by the most severe reason (preserve before review); all reasons are kept in order."""
    low = F.least(*confidences) if len(confidences) > 1 else F.col(confidences[0])
    severe = [("risk", F.col(risk)), ("confidence_too_low", low < review), ("not_visible", F.col(visible) <= 0)]
    mild = [("confidence_below_auto", (low < auto) & (low >= review)), ("margin_missing", F.col(margin).isNull()), ("margin_too_small", F.col(margin) < min_margin), ("hardly_visible", (F.col(visible) > 0) & (F.col(visible) < min_visible))]
    s, m = reasons(severe), reasons(mild)
    return df.withColumn("mode", F.when(F.size(s) > 0, "preserve").when(F.size(m) > 0, "review").otherwise("auto")).withColumn("reasons", F.array_join(F.concat(s, m), ","))


def quality_gate(views: DataFrame, keys: Sequence[str], score: str, enforced: str, min_mean: float, min_view: float, min_views: int = 1) -> DataFrame:
    """Passes if no reason holds. Where a view is enforced, only enforced views count."""
    scoped = views.withColumn("__any", F.max(F.col(enforced).cast("int")).over(Window.partitionBy(*keys))).where((F.col("__any") == 0) | F.col(enforced))
    by = scoped.groupBy(*keys).agg(F.count(F.lit(1)).alias("views"), F.avg(score).alias("mean"), F.min(score).alias("least"), F.count_if(F.col(score) < min_view).alias("failing"))
    why = reasons([("too_few_views", F.col("views") < min_views), ("mean_too_low", F.round("mean", 8) < min_mean), ("view_too_low", F.col("failing") > 0)])
    return by.select(*keys, "views", "mean", "least", "failing", (F.size(why) == 0).alias("passed"), F.array_join(why, ",").alias("reasons"))


def publish_gate(plan: DataFrame, keys: Sequence[str], kind: str, pixels: str, limits: dict[str, float]) -> DataFrame:
    """Fractions of fallback, neutral and unresolved parts, and of visible pixels on fallbacks, against their limits."""
    share = lambda k: F.avg((F.col(kind) == k).cast("double"))
    by = plan.groupBy(*keys).agg(*[share(k).alias(k) for k in ("fallback", "neutral", "unresolved")], (F.sum(F.when(F.col(kind) == "fallback", F.col(pixels)).otherwise(0)) / F.sum(pixels)).alias("visible_fallback"))
    why = reasons([(f"{k}_over_limit", F.round(F.col(k), 8) > v) for k, v in limits.items()])
    return by.withColumn("published", F.size(why) == 0).withColumn("reasons", F.array_join(why, ","))


def photometric_cohort(views: DataFrame, keys: Sequence[str], complete: str, review: str, value: str, max_span: float) -> DataFrame:
    """Promotes the views of an asset together if all are complete, all need review, and their values span little."""
    by = views.groupBy(*keys).agg(F.min(F.col(complete).cast("int")).alias("__c"), F.min(F.col(review).cast("int")).alias("__r"), (F.max(value) - F.min(value)).alias("span"), F.count(F.lit(1)).alias("views"))
    return by.select(*keys, "views", "span", ((F.col("__c") == 1) & (F.col("__r") == 1) & (F.round("span", 8) <= max_span)).alias("promoted"))


def aggregate_status(views: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """FAIL if a view fails, REVIEW if one needs review, PASS if one passes, else INSUFFICIENT."""
    n = lambda s: F.count_if(F.col(status) == s)
    by = views.groupBy(*keys).agg(n("PASS").alias("passed"), n("REVIEW").alias("review"), n("FAIL").alias("failed"))
    return by.withColumn("status", F.when(F.col("failed") > 0, "FAIL").when(F.col("review") > 0, "REVIEW").when(F.col("passed") > 0, "PASS").otherwise("INSUFFICIENT"))


def qc_rollup(metrics: DataFrame, keys: Sequence[str], thresholds: dict[str, tuple[float, float]]) -> DataFrame:
    """Metrics (columns) against (warning, error) thresholds; the most severe check decides."""
    long = metrics.unpivot(list(keys), list(thresholds), "metric", "value")
    bound = lambda i: F.coalesce(*[F.when(F.col("metric") == m, F.lit(float(t[i]))) for m, t in thresholds.items()])
    level = F.when(F.col("value") > bound(1), 2).when(F.col("value") > bound(0), 1).otherwise(0)
    by = long.withColumn("__l", level).groupBy(*keys).agg(F.max("__l").alias("__l"), F.count_if(F.col("__l") > 0).alias("findings"))
    return by.select(*keys, "findings", F.get(F.array(F.lit("pass"), F.lit("warning"), F.lit("error")), "__l").alias("status"))


def component_consensus(members: DataFrame, rankings: DataFrame, component: Sequence[str], member: str, choice: str, confidence: str, locked: str) -> DataFrame:
    """One choice for each component: a single locked choice wins; several locked choices keep all as they are; else a strict majority; else the candidate that
    all members rank, by sum of places, worst place, id. rankings: (component, member, candidate, rank)."""
    c = list(component)
    size = members.groupBy(*c).agg(F.count_distinct(member).alias("members"), F.count_distinct(F.when(F.col(locked), F.col(choice))).alias("__locks"), F.min(F.when(F.col(locked), F.col(choice))).alias("__lock"))
    votes = members.where(F.col(choice).isNotNull()).groupBy(*c, choice).agg(F.count(F.lit(1)).alias("__n"), F.sum(confidence).alias("__s"))
    top = votes.withColumn("__r", F.row_number().over(Window.partitionBy(*c).orderBy(F.desc("__n"), F.round("__s", 8).desc(), choice))).where("__r = 1").select(*c, F.col(choice).alias("__top"), "__n")
    shared = rankings.groupBy(*c, "candidate").agg(F.count_distinct(member).alias("__m"), F.sum("rank").alias("__sum"), F.max("rank").alias("__max")).join(size.select(*c, "members"), c).where("__m = members")
    fall = shared.withColumn("__r", F.row_number().over(Window.partitionBy(*c).orderBy("__sum", "__max", "candidate"))).where("__r = 1").select(*c, F.col("candidate").alias("__fall"))
    out = size.join(top, c, "left").join(fall, c, "left")
    route = F.when(F.col("__locks") == 1, "locked").when(F.col("__locks") > 1, "keep").when(F.col("__n") * 2 > F.col("members"), "majority").when(F.col("__fall").isNotNull(), "ranking").otherwise("none")
    return out.select(*c, "members", route.alias("route"), F.when(route == "locked", F.col("__lock")).when(route == "majority", F.col("__top")).when(route == "ranking", F.col("__fall")).alias("choice"))


class CompleteLink:
    """Clusters of points taken one after another: a point joins the first cluster of which all members are within ``radius``, else it begins one.

    Only clusters whose first member lies in the cells around a point can take it. The box of a cluster's members mostly settles it: a side too far away refuses, a farthest
    corner near enough accepts; only between the two are members looked at.
    """

    def __init__(self, radius: float):
        self._radius, self._cells, self._boxes, self._members = radius, defaultdict(list), [], []

    def place(self, point: tuple[float, ...] | None) -> int:
        """The number of the point's cluster; a point without a place is near to none."""
        r, cell = self._radius, None
        if point is not None:
            cell = tuple(math.floor(x / r) if r > 0 else x for x in point)
            around = itertools.product(*[(x - 1, x, x + 1) for x in cell]) if r > 0 else [cell]
            for c in sorted(n for x in around for n in self._cells.get(x, ())):
                if self._takes(c, point):
                    self._members[c].append(point)
                    self._boxes[c] = [(min(lo, x), max(hi, x)) for (lo, hi), x in zip(self._boxes[c], point, strict=True)]
                    return c
        self._members.append([point])
        self._boxes.append([(x, x) for x in point or ()])
        if cell is not None:
            self._cells[cell].append(len(self._members) - 1)
        return len(self._members) - 1

    def _takes(self, c: int, point: tuple[float, ...]) -> bool:
        r, ends = self._radius, [(x - lo, hi - x) for (lo, hi), x in zip(self._boxes[c], point, strict=True)]
        if any(a > r or b > r for a, b in ends):
            return False
        if math.sqrt(sum(max(a, b) ** 2 for a, b in ends)) <= r:
            return True
        return all(math.sqrt(sum((x - y) * (x - y) for x, y in zip(m, point, strict=True))) <= r for m in self._members[c])


def coating_components(parts: DataFrame, keys: Sequence[str], id_col: str, weight: str, max_distance: float, most: int | None = None) -> DataFrame:
    """Greedy complete-link clusters inside a key: in order of weight, a part joins the first cluster whose members are all within ``max_distance`` in Lab.

    Parts of one colour always share a cluster: the later ones meet the same distances as the first. So just the first part of each colour is clustered, in order, as the rows of a key stream through
    a task that holds its different colours (:class:`CompleteLink`); the others follow by a join. Keys lie on as many tasks. If the caller sets ``most``, parts of keys with more parts come out with cluster null and a reason.
    """
    sized = parts.select(*keys, F.col(id_col).alias("id"), F.col(weight).alias("w"), "lab").withColumn("__n", F.lit(0) if most is None else F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    large = sized.where(F.col("__n") > (most or 0)).select(*keys, "id", F.lit(None).cast("long").alias("cluster"), F.lit("key_too_large").alias("reason"))
    typed = sized.where(F.col("__n") <= (most or 0)).select(*keys, F.col("w").cast("double").alias("w"), F.col("id").cast("long").alias("id"), *[F.col(f"lab.{c}").cast("double").alias(f"__{c}") for c in "lab"])
    # a part without a colour is near to none
    typed = typed.withColumn("__own", F.when(F.col("__l").isNull() | F.col("__a").isNull() | F.col("__b").isNull(), F.col("id")))
    colour = [*[f"__{c}" for c in "lab"], "__own"]
    firsts = typed.groupBy(*keys, *colour).agg(F.min(F.struct((-F.col("w")).alias("o"), "id")).alias("first")).select(*keys, *colour, "first.o", "first.id")
    ordered = firsts.repartition(*keys).sortWithinPartitions(*keys, "o", "id")
    schema = T.StructType([*[ordered.schema[c] for c in (*keys, *colour)], T.StructField("cluster", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, clusters = None, None
        for batch in batches:
            names = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)) if keys else [()] * batch.num_rows
            out = []
            for own, lone, *point in zip(names, batch.column("__own").to_pylist(), *[batch.column(f"__{c}").to_pylist() for c in "lab"], strict=True):
                if clusters is None or own != key:
                    key, clusters = own, CompleteLink(max_distance)
                out.append(clusters.place(None if lone is not None else tuple(point)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*keys, *colour)], pa.array(out, pa.int64())], names=[*keys, *colour, "cluster"])

    led = ordered.mapInArrow(run, schema).select(*[F.col(c).alias(f"__k_{c}") for c in keys], *[F.col(c).alias(f"{c}_") for c in colour], "cluster")
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in colour]
    return typed.join(led, same).select(*keys, "id", "cluster", F.lit(None).cast("string").alias("reason")).unionByName(large)


def next_gain(history: DataFrame, keys: Sequence[str], step: str, gain: str, error: str, match: float = 0.02, damping: float = 0.5, low: float = 0.25, high: float = 4.0, least_gain: float = 0.0, patience: int = 0, least_step: float = 0.0, known: float = 0.0) -> DataFrame:
    """The next gain from the measured history: matched, or a log-secant step from the last two, or a damped ratio step; bounded to [low, high] times the last gain.

    Stops, of which the first that fits holds: ``matched``; ``stalled`` if the best error of the last ``patience`` measures is not better by ``least_gain`` than the best before them;
    ``converged`` if the step is at most ``least_step`` of the last gain; ``measured`` if a gain within ``known`` of the proposal has been measured. A stopped key gets the gain with the
    least error of its history (the earliest of equal ones). Stops with a limit of 0 do not hold.
    """
    k = list(keys)
    w = Window.partitionBy(*k).orderBy(F.desc(step))
    g, e = F.col(gain), F.col(error)
    placed = history.withColumn("__r", F.row_number().over(w)).withColumn("__g0", F.lead(gain).over(w)).withColumn("__e0", F.lead(error).over(w))
    ranked = F.struct(F.abs(e).alias("e"), F.col(step).alias("s"), g.alias("g"))
    old = F.col("__r") > patience
    best = placed.groupBy(*k).agg(F.min(ranked).alias("__best"), F.min(F.when(old, F.abs(e))).alias("__before"), F.min(F.when(~old, F.abs(e))).alias("__lately"))
    last = placed.where("__r = 1").join(best, k)
    slope = (F.log(g) - F.log("__g0")) / (e - F.col("__e0"))
    secant = F.exp(F.log(g) - e * slope)
    damped = g * (1 - damping * e)
    ok = F.col("__g0").isNotNull() & (F.abs(e - F.col("__e0")) > 1e-9) & (F.abs(F.log(g) - F.log("__g0")) > 1e-9)
    proposed = last.withColumn("__next", F.greatest(g * low, F.least(g * high, F.when(ok, secant).otherwise(damped)))).withColumn("__way", F.when(ok, "secant").otherwise("damped")).withColumn("__last", g)
    met = proposed.select(*k, "__next").join(history.select(*k, F.col(gain).alias("__old")), k).groupBy(*k).agg(F.max((F.abs(F.col("__old") - F.col("__next")) <= known).cast("int")).alias("__met"))
    stop = F.when(F.abs(e) <= match, "matched")
    if patience:
        stop = stop.when(F.col("__before").isNotNull() & (F.round(F.col("__before") - F.col("__lately"), 12) < least_gain), "stalled")
    if least_step:
        stop = stop.when(F.abs(F.col("__next") - F.col("__last")) <= least_step * F.col("__last"), "converged")
    if known:
        stop = stop.when(F.col("__met") == 1, "measured")
    out = proposed.join(met, k).withColumn("__stop", stop)
    kept = F.when(F.col("__stop") == "matched", g).when(F.col("__stop").isNotNull(), F.col("__best.g")).otherwise(F.col("__next"))
    return out.select(*k, F.coalesce("__stop", "__way").alias("action"), kept.alias("next_gain"))


def repair_plan(missing: DataFrame, support: DataFrame, vetoes: DataFrame, keys: Sequence[str], part: str, group: str, views: str, min_views: int, most: int) -> DataFrame:
    """Changes for missing groups: supporting parts seen in enough views and not vetoed, best supported first, at most ``most`` for each key."""
    found = missing.join(support, [*keys, group]).where(F.col(views) >= min_views).join(vetoes, [*keys, part], "left_anti")
    return found.withColumn("order", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(views), group, part))).where(F.col("order") <= most)


#: Parts and pixels that an appearance component has.
COMPONENT_PARTS, COMPONENT_PIXELS = (2, 96), 512


def appearance_components(components: DataFrame, parts: DataFrame, keys: Sequence[str], part: str, family: str, weight: str, pixels: str) -> DataFrame:
    """Components of linked parts that are of use: 2 to 96 parts and 512 pixels at least. Each has its anchor (the part with the most weight, then the smallest), the family with
    the most weight (of equal ones the greatest name), and the median by weight of each channel of Lab. components: (keys, part, component); parts: rows of parts with a struct ``lab``."""
    k = [*keys, "component"]
    met = parts.join(components, [*keys, part])
    size = met.groupBy(*k).agg(F.count_distinct(part).alias("parts"), F.sum(pixels).alias("pixels"))
    size = size.where(F.col("parts").between(*COMPONENT_PARTS) & (F.col("pixels") >= COMPONENT_PIXELS))
    kept = met.join(size.select(*k), k, "left_semi")
    anchor = kept.groupBy(*k, part).agg(F.sum(weight).alias("__w")).groupBy(*k).agg(F.min(F.struct((-F.round("__w", 8)).alias("w"), F.col(part).alias("p"))).alias("a"))
    main = kept.groupBy(*k, family).agg(F.sum(weight).alias("__w")).groupBy(*k).agg(F.max(F.struct(F.round("__w", 8).alias("w"), F.col(family).alias("f"))).alias("f"))
    out = size.join(anchor, k).join(main, k).select(*k, "parts", "pixels", F.col("a.p").alias("anchor"), F.col("f.f").alias(family))
    for c in "lab":
        colour = kept.withColumn("__c", F.col(f"lab.{c}"))
        out = out.join(weighted_median(colour, k, "__c", weight).withColumnRenamed("weighted_median", f"lab_{c}"), k, "left")
    return out
