"""Line deduplication over levelled sorted runs of line hashes.

Documents are taken in batches by ascending id. A run holds the hash of each line key and the smallest id that
has it. Runs are tables in ``buckets`` buckets of the hash, sorted inside each bucket, so that a new batch, once dealt
into the same buckets, meets them without shuffling them again: its lines are anti-joined with all runs by sort-merge joins, and those that are new
become a run of level 0. When a level has ``fan`` runs they are merged bucket by bucket into one of the next level, so that a batch
meets few runs. As batches come in order of id, the first run that has a key has its smallest id. Then a line is dropped if
the owner of its key is another, smaller id. Runs lie below the shared folder: nothing is kept in one task, and a lost executor costs the tasks it ran. Lines are counted down to a row
for each key in each task before they are dealt, and the last join, by line, can be split; at the end no table is left in the catalogue.

Keys are compared by 128 bits of two differently seeded hashes. A row is told from others of its id by a hash of its text.

Defined results: null and empty texts are one empty line; only lines with keys of at least ``least`` code points are ever dropped; rows
that repeat one id own lines together, and each of them keeps or loses lines of its own text; ids are whole numbers, and rows without an id are left as they are and own no line; extra columns
are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.llm.common import shared_folder, stored, texts
from partloom.llm.decontamination import ascii_lower

#: What is stripped at both ends of a line.
_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(_SPACE)))


@dataclass
class Runs:
    """Levelled runs (h1, h2, owner): tables in buckets below a folder."""

    folder: str
    spark: SparkSession
    buckets: int
    fan: int = 2
    levels: dict[int, list[str]] = field(default_factory=dict)
    number: int = 0

    def all(self) -> list[DataFrame]:
        return [self.spark.table(r) for level in sorted(self.levels, reverse=True) for r in self.levels[level]]

    def _write(self, run: DataFrame, level: int) -> None:
        self.number += 1
        name = f"{self.folder.rpartition('/')[2].replace('-', '_')}_run_{level}_{self.number}"
        run.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        self.levels.setdefault(level, []).append(name)

    def new_keys(self, lines: DataFrame) -> DataFrame:
        """The keys of a batch (h1, h2, id) that no run has. Only the batch is shuffled, a row for each key and task: as many parts as a run has buckets, so runs stay where they are."""
        own = lines.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
        for run in self.all():
            own = own.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return own

    def add(self, lines: DataFrame) -> None:
        """The new keys of a batch become a run; full levels are merged."""
        self._write(self.new_keys(lines), 0)
        level = 0
        while len(self.levels[level]) >= self.fan and level < 30:
            full, self.levels[level] = self.levels[level], []
            self._write(self.merged([self.spark.table(r) for r in full]), level + 1)
            for r in full:
                self.spark.sql(f"DROP TABLE {r}")
            level += 1

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """Runs share no key, so that a full join by key puts their rows together, bucket by bucket."""
        out = runs[0]
        for r in runs[1:]:
            out = out.hint("merge").join(r.withColumnRenamed("owner", "other"), ["h1", "h2"], "full").select("h1", "h2", F.coalesce("owner", "other").alias("owner"))
        return out

    def owners(self) -> DataFrame:
        """All keys with their owners, as a plain table: a join with it shuffles both sides, so that adaptive execution can split a line that very many documents hold. The runs are dropped."""
        out = stored(self.merged(self.all()), self.folder, "owners")
        for level in self.levels.values():
            for r in level:
                self.spark.sql(f"DROP TABLE {r}")
        self.levels.clear()
        return out


#: Rows of one batch, and the fewest batches. A batch should be a small part of a large corpus, and few enough rows for its lines to be sorted in one go.
BATCH_ROWS, LEAST_BATCHES = 20_000_000, 4


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10, batches: int | None = None, fan: int = 2) -> DataFrame:
    """One row for each row of ``df``: id, ``n_lines`` long, ``n_dropped`` long, ``kept`` (the other lines, joined by newlines).

    batches: by default one for each ``BATCH_ROWS`` rows, ``LEAST_BATCHES`` at least.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    rows = texts(df, id_col, text_col).select(F.col(id_col).alias("id"), "__text", F.xxhash64("__text").alias("own"))
    if batches is None:
        batches = max(LEAST_BATCHES, -(-df.count() // BATCH_ROWS))
    cuts = rows.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)], 10_000).alias("c")).first()["c"] or []
    batch = sum((F.when(F.col("id") > F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    each = rows.where("id is not null").select("id", "own", batch.alias("batch"), F.posexplode(F.split("__text", "\n")).alias("pos", "line"))
    keyed = each.select("id", "own", "batch", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least)
    lines = stored(keyed.select("id", "own", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "batch"), folder, "lines", ["batch"])
    runs = Runs(folder, spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fan)
    for k in range(len(set(cuts)) + 1):
        runs.add(lines.where(F.col("batch") == k).select("h1", "h2", "id"))
    gone = lines.join(runs.owners(), ["h1", "h2"]).where("owner < id").groupBy("id", "own").agg(F.collect_set("pos").alias("__gone"))
    cut = F.split("__text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone")
    kept = F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n"))
    joined = rows.join(gone, ["id", "own"], "left").select("id", "__text", "__gone", cut.alias("__lines"))
    return joined.select(F.col("id").alias(id_col), F.size("__lines").cast("long").alias("n_lines"), F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("n_dropped"), kept.alias("kept"))
