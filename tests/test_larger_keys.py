"""Keys that grow with the table: choices by kinds, long assignments, and ranks that stay in their partitions."""

import os

import pytest
from pyspark.sql import functions as F

from partloom import registry
from partloom.operators import assembly, joins

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_side_of_an_assignment(spark):
    """2,500 items for two places are solved, best score each."""
    df = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") % 2500).alias("l"), F.floor(F.col("id") / 2500).alias("r"), ((F.col("id") * 7919) % 4999 / 5000).alias("s"))
    got = joins.assign_optimal(df, ["k"], "l", "r", "s").collect()
    best = {r: sorted(((i * 7919) % 4999 / 5000, i % 2500) for i in range(r * 2500, r * 2500 + 2500))[-2:] for r in (0, 1)}
    total = max(a[0] + b[0] for a in best[0] for b in best[1] if a[1] != b[1])
    assert len(got) == 2 and abs(sum(x.s for x in got) - total) < 1e-9


def test_choices_meet_by_kind(spark):
    """Rows that meet are kinds of a module, not parts; the result is that of all pairs, unknown tones and short names included."""
    rows = [(i % 2, i, None if i % 7 == 0 else i % 3, ["a", "b", "c"][: i % 4]) for i in range(60)]
    parts = spark.createDataFrame(rows, "m int, id int, tone int, words array<string>")
    got = {r.id: (r.candidate, r.score) for r in assembly.default_choice(parts, parts.where("id % 3 <> 0"), "m", "id", "tone", "words").collect()}
    word = lambda w, i: w[i] if i < len(w) else None
    want = {}
    for m, i, t, w in rows:
        scored = []
        for n, j, u, v in rows:
            if m == n and j % 3:
                scored.append((-((80 if t is not None and t == u else -35) + (45 if i == j else 0) + sum(4 for q in (0, 1) if word(w, q) is not None and word(w, q) == word(v, q))), j))
        if scored and min(scored)[0] < 0:
            want[i] = (min(scored)[1], -min(scored)[0])
    assert got == want


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
@pytest.mark.parametrize("name", ["w02_rrf", "w06_lane_order", "w07_lane_quota", "w07_lane_slots", "w07_stratified"])
def test_ranks_stay_in_the_partitions_of_their_keys(spark, name):
    """One exchange, dealt by part over as many partitions as the rows need."""
    text = plan(registry.queries()[name](spark, SF))
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text
