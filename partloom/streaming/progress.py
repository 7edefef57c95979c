"""Progress events: parsing, state, lifecycle, log tails, attempts and retries. Each works on a table and, where noted, on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The mark of an event line, its fields and states.
MARK = "@@progress "
EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("job", T.LongType()), T.StructField("stage", T.StringType()), T.StructField("state", T.StringType()), T.StructField("percent", T.DoubleType())])
STATES = ("queued", "started", "progress", "completed", "failed")
#: The lifecycle's permitted steps.
STEPS = {"": ("queued",), "queued": ("running", "failed"), "running": ("running", "succeeded", "failed")}


def parse_progress(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Adds ``kind`` (event, plain or bad) and the event's fields. The mark may stand behind a log prefix. Works on streams."""
    body = F.when(F.col(text_col).contains(MARK), F.substring_index(text_col, MARK, -1))
    parsed = lines.withColumn("__e", F.from_json(body, EVENT, {"mode": "PERMISSIVE"}))
    e = F.col("__e")
    good = e.isNotNull() & e["event_id"].isNotNull() & e["job"].isNotNull() & e["state"].isin(*STATES) & (e["percent"].isNull() | e["percent"].between(0, 100))
    kind = F.when(body.isNull(), "plain").when(good, "event").otherwise("bad")
    return parsed.select(*lines.columns, kind.alias("kind"), *[F.when(kind == "event", e[f.name]).alias(f.name) for f in EVENT.fields])


def stage_state(events: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The latest event of each key. On a stream: update mode."""
    last = F.max_by(F.struct(*fields), F.struct(*order))
    return events.groupBy(*keys).agg(last.alias("__l"), F.count(F.lit(1)).alias("events")).select(*keys, "events", *[F.col(f"__l.{f}").alias(f) for f in fields])


def _allowed(before: Column, now: Column) -> Column:
    ok = F.lit(False)
    for b, nexts in STEPS.items():
        ok = ok | ((before == b) & now.isin(*nexts))
    return ok


def job_lifecycle(events: DataFrame, job: str, state: str, order: Sequence[str]) -> DataFrame:
    """Adds the state before and whether the step is permitted."""
    before = F.coalesce(F.lag(state).over(Window.partitionBy(job).orderBy(*order)), F.lit(""))
    return events.withColumn("before", before).withColumn("legal", _allowed(F.col("before"), F.col(state)))


def log_tail(lines: DataFrame, job: str, order: Sequence[str], n: int = 2000) -> DataFrame:
    """The last ``n`` lines of each job. The rank is cut on each task before the shuffle."""
    return lines.withColumn("from_end", F.row_number().over(Window.partitionBy(job).orderBy(*[F.desc(c) for c in order]))).where(F.col("from_end") <= n)


def stage_attempts(events: DataFrame, job: str, order: Sequence[str], start: Column, failure: Column) -> DataFrame:
    """Numbers the attempts (an attempt begins with a start event) and gives each one's length and failures."""
    w = Window.partitionBy(job).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = events.withColumn("attempt", F.count_if(start).over(w)).where("attempt > 0")
    return numbered.groupBy(job, "attempt").agg(F.count(F.lit(1)).alias("events"), F.count_if(failure).alias("failures"), (F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))).alias("micros"))


def retry_plan(outcomes: DataFrame, attempt: str, code: str, retryable: Sequence[str], most: int, base_seconds: float, backoff: float) -> DataFrame:
    """Whether an outcome is tried again, and after how many seconds."""
    again = F.col(code).isin(*retryable) & (F.col(attempt) < most)
    return outcomes.withColumn("retry", again).withColumn("delay", F.when(again, base_seconds * F.pow(F.lit(backoff), F.col(attempt) - 1)))


def changed_assets(current: DataFrame, done: DataFrame, key: str, digest: str) -> DataFrame:
    """Assets that are new, or whose digest is not the one they were done with."""
    return current.join(done, [key, digest], "left_anti")


def lifecycle_stream(events: DataFrame, ttl_ms: int = 3_600_000) -> DataFrame:
    """The lifecycle machine on a stream of (job, event_id, state): one state row a job, deleted at a final state or after ``ttl_ms`` without events."""

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = state.get[0] if state.exists else ""
        out = []
        for row in sorted((r for f in frames for r in f.itertuples(index=False)), key=lambda r: r.event_id):
            out.append((key[0], row.event_id, before, row.state, row.state in STEPS.get(before, ())))
            before = row.state
        if before in ("succeeded", "failed"):
            if state.exists:
                state.remove()
        else:
            state.update((before,))
            state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame(out, columns=["job", "event_id", "before", "state", "legal"])

    return events.groupBy("job").applyInPandasWithState(step, "job long, event_id long, before string, state string, legal boolean", "state string", "append", "ProcessingTimeTimeout")


class Tail(StatefulProcessor):
    """The last ``n`` lines of a job as a list in keyed state: lines are appended, and once the list has twice as many it is cut to its last ``n``, so a line is rewritten once on average."""

    def __init__(self, n: int, ttl_ms: int):
        self._n, self._ttl = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        kept = {"ttlDurationMs": self._ttl} if self._ttl else {}
        self._lines = handle.getListState("lines", "seq long, line string", **kept)
        self._size = handle.getValueState("size", "size long, seen long", **kept)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(seq), line) for frame in rows for seq, line in zip(frame["seq"], frame["line"], strict=True)]
        held = list(self._lines.get()) if self._lines.exists() else []
        size, seen = self._size.get() if self._size.exists() else (0, 0)
        seen += len(new)
        last = sorted([*held, *new], key=lambda x: x[0])[-self._n :]
        if size + len(new) > 2 * self._n:
            self._lines.put(last)
            self._size.update((len(last), seen))
        else:
            self._lines.appendList(new)
            self._size.update((size + len(new), seen))
        yield pd.DataFrame({"job": [key[0]] * len(last), "seq": [x[0] for x in last], "line": [x[1] for x in last], "from_end": list(range(len(last), 0, -1)), "seen": [seen] * len(last)})

    def close(self) -> None:
        pass


#: The store that lists in keyed state need.
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def log_tail_stream(lines: DataFrame, n: int = 2000, ttl_ms: int = 86_400_000) -> DataFrame:
    """The whole tail of each job that a trigger has lines of: (job, seq, line, from_end, seen: the job's lines so far), as :func:`log_tail` has it over all lines so far. lines: a stream of (job long, seq long, line string).

    State is at most two tails a job, and goes ``ttl_ms`` after a job's lines were written (0: never; a query with a time to live makes batches until it is stopped, so a run over what is available now takes 0). For append mode, so that any sink takes it; a job's newest tail is the one with most ``seen``. The session gets the RocksDB state store if it has Spark's default.
    """
    conf, name = lines.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in conf.get(name, ""):
        conf.set(name, _ROCKS)
    keyed = lines.select("job", "seq", "line").groupBy("job")
    return keyed.transformWithStateInPandas(Tail(n, ttl_ms), "job long, seq long, line string, from_end long, seen long", "append", "ProcessingTime" if ttl_ms else "None")
