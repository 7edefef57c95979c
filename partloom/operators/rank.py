"""Ranking and selection. Every rank ends in an id, so that results do not depend on the order of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partloom.operators.spread import merged


def rank_scores(df: DataFrame, keys: Sequence[str], score: str, id_col: str, k: int | None = None) -> DataFrame:
    """Adds ``rank`` from 1: higher scores first, then the id; nulls are left out."""
    ranked = df.where(F.col(score).isNotNull()).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), id_col)))
    return ranked.where(F.col("rank") <= k) if k else ranked


def rank_lanes(df: DataFrame, keys: Sequence[str], id_col: str, lanes: Sequence[str]) -> DataFrame:
    """(keys, id, lane, rank): the rows ranked by each of several scores, in one pass over the keys; nulls are left out."""
    place = lambda c: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(c), id_col))
    ranked = df.select(*keys, id_col, *[F.when(F.col(c).isNotNull(), place(c)).alias(c) for c in lanes])
    places = F.explode(F.array(*[F.struct(F.lit(c).alias("lane"), F.col(c).alias("rank")) for c in lanes]))  # unlike unpivot, keeps the partitions of the keys
    return ranked.select(*keys, id_col, places.alias("__place")).select(*keys, id_col, "__place.*").where(F.col("rank").isNotNull())


def rrf(rankings: DataFrame, keys: Sequence[str], id_col: str, lane: str, weights: dict[str, float], k: int = 60) -> DataFrame:
    """Weighted reciprocal rank fusion of long rankings (keys, lane, id, rank); lanes that lack an id add nothing."""
    w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    fused = rankings.groupBy(*keys, id_col).agg(F.round(F.sum(F.coalesce(w[F.col(lane)], F.lit(0.0)) / (k + F.col("rank"))), 10).alias("fused"))
    return rank_scores(fused, keys, "fused", id_col)


def merge_rankings(a: DataFrame, b: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """One ranking of two: the better rank first, then the one of ``a``, then the id."""
    both = a.select(*keys, id_col, F.col("rank").alias("__a")).join(b.select(*keys, id_col, F.col("rank").alias("__b")), [*keys, id_col], "full")
    far = F.lit(1 << 30)
    order = [F.least(F.coalesce("__a", far), F.coalesce("__b", far)), F.coalesce("__a", far), F.asc(id_col)]
    return both.select(*keys, id_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("rank"))


def margin(df: DataFrame, keys: Sequence[str], score: str, id_col: str) -> DataFrame:
    """Winner, runner-up and the lead between them (null without a runner-up)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), id_col)
    top = df.select(*keys, F.col(id_col).alias("winner"), F.col(score).alias("score"), F.lead(id_col).over(w).alias("alternative"), (F.col(score) - F.lead(score).over(w)).alias("margin"), F.row_number().over(w).alias("__r"))
    return top.where("__r = 1").drop("__r")


def select_winner(scores: DataFrame, baseline: DataFrame, keys: Sequence[str], id_col: str, score: str, min_gain: float = 0.015) -> DataFrame:
    """The best candidate if it beats the baseline's score by ``min_gain``, else the baseline. baseline: (keys, id)."""
    base = baseline.select(*keys, F.col(id_col).alias("__base")).join(scores.select(*keys, F.col(id_col).alias("__base"), F.col(score).alias("base_score")), [*keys, "__base"], "left")
    best = rank_scores(scores, keys, score, id_col, 1).select(*keys, F.col(id_col).alias("__best"), F.col(score).alias("best_score"))
    both = base.join(best, list(keys), "left")
    gain = F.round(F.col("best_score") - F.col("base_score"), 8)
    change = F.col("base_score").isNotNull() & (gain >= min_gain) & (F.col("__best") != F.col("__base"))
    return both.select(*keys, F.when(change, F.col("__best")).otherwise(F.col("__base")).alias("selected"), F.coalesce(change, F.lit(False)).alias("changed"), gain.alias("gain"))


def tiered_winner(df: DataFrame, keys: Sequence[str], eligible: Column, order: Sequence[Column], id_col: str) -> DataFrame:
    """The first eligible candidate in lexicographic order; keys with none get null and a reason."""
    ranked = df.where(eligible).withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.asc(id_col)))).where("__r = 1").select(*keys, F.col(id_col).alias("winner"))
    out = df.select(*keys).distinct().join(ranked, list(keys), "left")
    return out.withColumn("reason", F.when(F.col("winner").isNull(), "no_eligible_candidate"))


def lane_order(df: DataFrame, keys: Sequence[str], id_col: str, lane: str, lanes: Sequence[str], limit: int) -> DataFrame:
    """Union of ranked lanes in order of lane, then rank; the first place of an id counts; at most ``limit`` for each key."""
    number = F.array_position(F.array(*map(F.lit, lanes)), F.col(lane))
    first = df.groupBy(*keys, id_col).agg(F.min(F.struct(number.alias("lane_no"), F.col("rank").alias("lane_rank"))).alias("__o"))
    placed = first.select(*keys, id_col, "__o.*").withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("lane_no", "lane_rank", id_col)))
    return placed.where(F.col("rank") <= limit)


def lane_quota(df: DataFrame, keys: Sequence[str], id_col: str, lane: str, lanes: Sequence[str], budget: int) -> DataFrame:
    """Round-robin over lanes: the first of each lane, then the second of each, up to ``budget`` rows for each key."""
    number = F.array_position(F.array(*map(F.lit, lanes)), F.col(lane))
    turn = df.withColumn("round", F.row_number().over(Window.partitionBy(*keys, lane).orderBy("rank", id_col))).withColumn("__n", number)
    return turn.withColumn("slot", F.row_number().over(Window.partitionBy(*keys).orderBy("round", "__n", id_col))).where(F.col("slot") <= budget).drop("__n")


#: The orders in which lanes get their first slot, and in which they get further ones.
FIRST_SLOTS, FURTHER_SLOTS = ("selection", "tournament", "visual"), ("tournament", "selection", "visual")


def lane_slots(df: DataFrame, keys: Sequence[str], id_col: str, lane: str, budget: int, first: Sequence[str] = FIRST_SLOTS, further: Sequence[str] = FURTHER_SLOTS) -> DataFrame:
    """Slots of a budget: one for each lane in the order ``first``, then further ones in turn in the order ``further``. A lane without more rows passes its turn; each lane's rows come by rank."""
    at = lambda names: F.array_position(F.array(*map(F.lit, names)), F.col(lane))
    turn = df.withColumn("round", F.row_number().over(Window.partitionBy(*keys, lane).orderBy("rank", id_col))).withColumn("__n", F.when(F.col("round") == 1, at(first)).otherwise(at(further)))
    return turn.withColumn("slot", F.row_number().over(Window.partitionBy(*keys).orderBy("round", "__n", id_col))).where(F.col("slot") <= budget).drop("__n")


def _even(i: Column, n: int, count: Column) -> Column:
    """Whether a 0-based place is one of ``n`` evenly spaced places of ``count``."""
    picks = [F.floor(F.lit(k) * (count - 1) / (n - 1)) if n > 1 else F.lit(0) for k in range(n)]
    return (count <= n) | F.array_contains(F.array(*picks), i.cast("bigint"))


def systematic_sample(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """At most ``n`` evenly spaced rows of each key: the first, the last and steps between."""
    w = Window.partitionBy(*keys)
    return df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__c", F.count(F.lit(1)).over(w)).where(_even(F.col("__i"), n, F.col("__c"))).drop("__i", "__c")


def stratified_order(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Evenly spaced ranks (head, middle, tail) of a ranking."""
    return df.withColumn("__c", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(_even(F.col("rank") - 1, n, F.col("__c"))).drop("__c")


def _step(base: Column, winner: Column, score: Column, base_score: Column, lead: Column, min_gain: float, min_margin: float) -> Column:
    """The reason of a round's outcome: ``changed``, or why the baseline stays."""
    return (
        F.when(base.isNull(), "no_baseline")
        .when(winner == base, "baseline_best")
        .when(F.round(score - base_score, 8) < min_gain, "gain_too_small")
        .when(lead.isNotNull() & (F.round(lead, 8) < min_margin), "margin_too_small")
        .otherwise("changed")
    )


def group_step(df: DataFrame, keys: Sequence[str], id_col: str, score: str, baseline: str, min_gain: float, min_margin: float) -> DataFrame:
    """Winner of a round: enough gain over the baseline's score and enough lead over the runner-up; else the baseline, with the reason."""
    top = margin(df, keys, score, id_col).join(df.groupBy(*keys).agg(F.max(F.when(F.col(baseline), F.col(id_col))).alias("base"), F.max(F.when(F.col(baseline), F.col(score))).alias("base_score")), list(keys))
    reason = _step(*[F.col(c) for c in ("base", "winner", "score", "base_score", "margin")], min_gain, min_margin)
    return top.select(*keys, reason.alias("reason"), F.when(reason == "changed", F.col("winner")).otherwise(F.col("base")).alias("selected"))


def group_round(df: DataFrame, keys: Sequence[str], id_col: str, score: str, baseline: str, comparable: str, all_pass: str, min_gain: float, min_margin: float, tolerance: float = 1e-12) -> DataFrame:
    """One round of a group: the candidate that is promoted or the baseline, with the reason, by the first check that decides.

    A baseline that is missing or not ``comparable`` stays, and so does one that is the best itself. The best candidate that passes in all views (``all_pass``), while the baseline
    does not, is promoted at once; else it needs ``min_gain`` over the baseline and ``min_margin`` over the next candidate, both up to ``tolerance``.
    """
    k = list(keys)
    base = df.where(F.col(baseline)).groupBy(*k).agg(F.min(F.struct(F.col(id_col).alias("id"), F.col(score).alias("score"), F.col(comparable).alias("comparable"), F.col(all_pass).alias("whole"))).alias("b"))
    w = Window.partitionBy(*k).orderBy(F.desc(score), id_col)
    top = df.withColumn("__next", F.lead(score).over(w)).withColumn("__r", F.row_number().over(w)).where("__r = 1")
    met = top.join(base, k, "left")
    reason = (
        F.when(F.col("b").isNull() | ~F.coalesce(F.col("b.comparable"), F.lit(False)), "baseline_not_comparable")
        .when(F.col(id_col) == F.col("b.id"), "baseline_best")
        .when(F.col(all_pass) & ~F.col("b.whole"), "all_views_pass")
        .when(F.col(score) - F.col("b.score") < min_gain - tolerance, "gain_too_small")
        .when(F.col("__next").isNotNull() & (F.col(score) - F.col("__next") < min_margin - tolerance), "margin_too_small")
        .otherwise("improved")
    )
    return met.select(*k, reason.alias("reason"), F.when(reason.isin("all_views_pass", "improved"), F.col(id_col)).otherwise(F.col("b.id")).alias("selected"))


def best_observation(df: DataFrame, keys: Sequence[str], view: str, pixels: str, purity: str, colourful: str, enough: float = 512, share: float = 0.75) -> DataFrame:
    """The view to show: most pixels; if even that has few, purity first; else the most colourful of those with nearly as many."""
    most = df.withColumn("__max", F.max(pixels).over(Window.partitionBy(*keys)))
    poor = F.col("__max") < enough
    kept = most.where(poor | (F.col(pixels) >= share * F.col("__max")))
    order = [F.when(poor, F.col(purity)).otherwise(F.col(colourful)).desc(), F.desc(pixels), F.desc(view)]
    return kept.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r", "__max")


def order_agreement(forward: DataFrame, reverse: DataFrame, keys: Sequence[str], choice: str) -> DataFrame:
    """Keys where both orders chose alike keep the choice; the others go to the queue."""
    both = forward.select(*keys, F.col(choice).alias("__f")).join(reverse.select(*keys, F.col(choice).alias("__r")), list(keys), "full")
    same = F.col("__f").eqNullSafe(F.col("__r")) & F.col("__f").isNotNull()
    return both.select(*keys, F.when(same, F.col("__f")).alias("choice"), F.when(same, "agreed").otherwise("tournament").alias("route"))


def nonregression(base: DataFrame, final: DataFrame, keys: Sequence[str], metrics: Sequence[str], tolerance: float) -> DataFrame:
    """(keys, metric, delta, status) for each metric: regressed, improved, same or missing."""
    melt = lambda d, n: d.unpivot(list(keys), list(metrics), "metric", n)
    both = melt(base, "__b").join(melt(final, "__f"), [*keys, "metric"], "full")
    delta = F.round(F.col("__f") - F.col("__b"), 6)
    status = F.when(delta.isNull(), "missing").when(delta < -tolerance, "regressed").when(delta > tolerance, "improved").otherwise("same")
    return both.select(*keys, "metric", delta.alias("delta"), status.alias("status"))


#: Parts of the compatibility score, what each mismatch costs, and what a missing signal counts.
COMPATIBILITY, MISSING = {"retrieval": 0.25, "colour": 0.5, "texture": 0.25}, 0.5
PENALTIES = {"transmission": 0.40, "texture_mismatch": 0.20, "colour_gate": 0.50}


def compatibility(signals: dict[str, Column], faults: dict[str, Column]) -> Column:
    """A quarter retrieval, half colour, a quarter texture, less the penalties of the faults that hold (transmission on an opaque part, texture mismatch, colour gate)."""
    score = sum((w * F.coalesce(signals[n], F.lit(MISSING)) for n, w in list(COMPATIBILITY.items())[1:]), COMPATIBILITY["retrieval"] * F.coalesce(signals["retrieval"], F.lit(MISSING)))
    for n, c in faults.items():
        score = score - F.when(c, PENALTIES[n]).otherwise(0.0)
    return score


def guard_choice(choices: DataFrame, scores: DataFrame, keys: Sequence[str], id_col: str, score: str, limit: Column) -> DataFrame:
    """A choice stays unless its score is below the best candidate's by more than ``limit``; then the best takes its place. choices: (keys, choice)."""
    k = list(keys)
    best = rank_scores(scores, k, score, id_col, 1).select(*k, F.col(id_col).alias("__best"), F.col(score).alias("__top"))
    own = choices.join(scores.select(*k, F.col(id_col).alias("choice"), F.col(score).alias("__own")), [*k, "choice"])
    return own.join(best, k).select(*k, F.when(F.round(F.col("__top") - F.col("__own"), 8) > limit, F.col("__best")).otherwise(F.col("choice")).alias("choice"))


def select_membership(views: DataFrame, keys: Sequence[str], expanded: str, base: str, better: float = 0.05, worse: float = 0.3, min_gain: float = 0.015, min_views: int = 2) -> DataFrame:
    """Expanded (M1) or base (M0) membership: enough mean gain, ``min_views`` views better and none much worse; missing evidence keeps M0. views: one row for each view."""
    delta = F.round(F.col(expanded) - F.col(base), 8)
    g = views.groupBy(*keys).agg(F.count_if(delta > better).alias("improved"), F.count_if(delta < -worse).alias("regressed"), F.round(F.avg(expanded) - F.avg(base), 8).alias("gain"))
    won = (F.coalesce("gain", F.lit(-1.0)) >= min_gain) & (F.col("improved") >= min_views) & (F.col("regressed") == 0)
    return g.select(*keys, "improved", "regressed", F.when(won, "M1").otherwise("M0").alias("mode"))


@dataclass(frozen=True)
class Scorer:
    """own: (keys, group, id, further columns), one row for each candidate that is known; score: a candidate's score, from its row (a struct of ``own``'s further columns) and an array of the rows of what the plan has for the asset's other groups."""

    own: DataFrame
    score: Callable[[Column, Column], Column]


def coupled_scorer(own: DataFrame, keys: Sequence[str], group: str, id_col: str, like: str, bonus: float) -> Scorer:
    """A candidate's own score, and ``bonus`` for each other group of the asset whose choice in the plan has the same value of ``like``. own: (keys, group, id, like, score)."""
    same = lambda c, others: F.size(F.filter(others, lambda o: o[like] == c[like])).cast("long")
    return Scorer(own.select(*keys, group, id_col, like, "score"), lambda c, others: c["score"] + F.lit(bonus) * same(c, others))


def group_tournament(plan: DataFrame, candidates: DataFrame, footprints: DataFrame, keys: Sequence[str], group: str, id_col: str, scorer: Scorer, min_gain: float, min_margin: float) -> tuple[DataFrame, DataFrame]:
    """The plan after every group has had its round, and the log of rounds (keys, group, id: what was there, selected, reason, turn).

    plan: (keys, group, id), one choice a group; candidates: the same columns; footprints: (keys, group, footprint). The groups of an asset take turns by falling footprint, then name. In a turn the plan's
    choice and the group's candidates are scored with the plan as it is by then, so what a turn selects is the baseline of those that follow. Groups without a choice in the plan stay without one.

    Tables are dealt by the keys, those that are already are not dealt again, and an asset takes its turns in one row, as arrays: no turn is written or shuffled. So an asset's candidates are one task's.
    """
    k = list(keys)
    dealt = lambda d, *cols: d.select(*k, group, *cols)
    queue = dealt(footprints, F.row_number().over(Window.partitionBy(*k).orderBy(F.desc("footprint"), group)).alias("turn"))
    info = [c for c in scorer.own.columns if c not in (*k, group, id_col)]
    known = scorer.own.groupBy(*k, group).agg(F.collect_list(F.struct(F.col(id_col).alias("__id"), *info)).alias("__own"))
    offered = candidates.groupBy(*k, group).agg(F.collect_set(id_col).alias("__ids"))
    met = dealt(plan, F.col(id_col).alias("__held"))
    for side in (queue, known, offered):
        met = met.join(merged(side), [*k, group], "left")
    own = F.coalesce("__own", F.array().cast(met.schema["__own"].dataType))
    offers = F.filter(own, lambda w: (w["__id"] == F.col("__held")) | F.coalesce(F.array_contains("__ids", w["__id"]), F.lit(False)))
    row = F.struct(F.col("turn").isNull().alias("idle"), "turn", F.col(group).alias("group"), F.col("__held").alias("held"), F.get(F.filter(own, lambda w: w["__id"] == F.col("__held")), F.lit(0)).alias("own"), offers.alias("offers"))
    assets = met.groupBy(*k).agg(F.array_sort(F.collect_list(row)).alias("__groups"))

    def decided(now: Column, i: Column, held: Column, choices: Column) -> Column:
        others = F.transform(F.filter(now, lambda x, j: (j != i) & x["own"].isNotNull()), lambda x: x["own"])
        rated = F.transform(choices, lambda c: F.struct(scorer.score(c, others).alias("score"), c.alias("own")))
        place = lambda x: F.struct(x["score"].isNull().alias("none"), (~F.isnan(x["score"].cast("double"))).alias("number"), (-x["score"]).alias("less"), x["own"]["__id"].alias("id"), x["score"].alias("score"), x["own"].alias("own"))
        return F.get(F.transform(F.array(F.array_sort(F.transform(rated, place))), lambda ranked: outcome(ranked, held)), F.lit(0))

    def outcome(ranked: Column, held: Column) -> Column:
        top, base = F.get(ranked, F.lit(0)), F.get(F.filter(ranked, lambda x: x["id"] == held), F.lit(0))
        reason = F.when(F.size(ranked) > 0, _step(base["id"], top["id"], top["score"], base["score"], top["score"] - F.get(ranked, F.lit(1))["score"], min_gain, min_margin))
        return F.struct(F.when(reason == "changed", top["own"]).otherwise(base["own"]).alias("own"), F.when(reason == "changed", top["id"]).otherwise(base["id"]).alias("id"), reason.alias("reason"))

    start = F.transform("__groups", lambda g: F.struct(g["own"].alias("own"), g["held"].alias("id"), F.lit(None).cast("string").alias("reason")))
    places = F.transform(F.filter("__groups", lambda g: ~g["idle"]), lambda g, i: i)
    own_turn = lambda now, i: decided(now, i, F.get("__groups", i)["held"], F.get("__groups", i)["offers"])
    turn = lambda now, i: F.transform(now, lambda x, j: F.when(j == i, own_turn(now, i)).otherwise(x))
    ended = assets.select(*k, "__groups", F.aggregate(places, start, turn).alias("__end"))
    both = F.transform("__groups", lambda g, i: F.struct(g["group"].alias(group), g["held"].alias("__held"), F.get("__end", i)["id"].alias("selected"), F.get("__end", i)["reason"].alias("reason"), g["turn"].cast("long").alias("turn")))
    rows = ended.select(*k, F.explode(both).alias("__row")).select(*k, "__row.*")
    log = rows.where("reason is not null").select(*k, group, F.col("__held").alias(id_col), "selected", "reason", "turn")
    return rows.select(*k, group, F.coalesce("selected", "__held").alias(id_col)), log
