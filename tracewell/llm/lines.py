"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, discard, lower_ascii, materialize, scratch_path


def split_lines(text: Column) -> Column:
    """Lines of a text, cut at each newline; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def key_hash(key: Column) -> Column:
    """128 bits of a line's key, as two independent 64-bit hashes."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


class LineRuns:
    """Runs of (h1, h2, n): in how many documents of its batches each line hash was found.

    A run is a table of a fixed number of buckets by (h1, h2), a sorted file each, in the shared
    folder. As all runs have the same buckets, a batch is dealt to them once and merge-anti-joins
    the runs bucket by bucket, and runs are merged the same way: no run shuffles again. ``add``
    leaves out lines that a run has already found often enough and adds what is left as a run of
    level 0. When a level holds ``fanout`` runs they are merged into one run of the next level, so
    each line hash is rewritten once a level and few runs are open at a time.

    After each change a manifest names the live runs, so that ``LineRuns.open`` goes on where an
    application ended.
    """

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 2, buckets: int = 64, path: str | None = None):
        self.spark, self.min_docs, self.fanout, self.buckets = spark, min_docs, fanout, buckets
        self.path = path or scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.commits = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineRuns:
        """The runs that the newest manifest under a path names."""
        newest = max(spark.read.text(f"{path}/manifest-*").collect(), key=lambda r: json.loads(r[0])["commits"])
        state = json.loads(newest[0])
        runs = cls(spark, state["min_docs"], state["fanout"], state["buckets"], path)
        runs.levels, runs.commits = state["levels"], state["commits"]
        for name in (n for level in runs.levels for n in level):
            if not spark.catalog.tableExists(name):
                spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {runs.buckets} BUCKETS LOCATION '{path}/{name}'")
        return runs

    def _commit(self, *gone: str) -> None:
        """Name the live runs, then delete those that are none any more."""
        state = {"min_docs": self.min_docs, "fanout": self.fanout, "buckets": self.buckets, "commits": self.commits + 1, "levels": self.levels}
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(f"{self.path}/manifest-{self.commits + 1}")
        self.commits += 1
        for name in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, f"{self.path}/manifest-{self.commits - 1}", *(f"{self.path}/{name}" for name in gone))

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet").option("path", f"{self.path}/{name}").saveAsTable(name)
        self.levels[level].append(name)

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """Rows of a batch, which is dealt to the buckets, whose hashes no single run holds often enough: the others need no more counting."""
        fresh = batch
        for run in self.tables():
            fresh = fresh.hint("merge").join(run.where(F.col("n") >= self.min_docs).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return fresh

    @staticmethod
    def merged(a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one: a merge join of their buckets."""
        other = b.toDF("h1", "h2", "_n")
        return a.hint("merge").join(other.hint("merge"), ["h1", "h2"], "full_outer").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"))

    def add(self, batch: DataFrame) -> None:
        """batch: (h1, h2, n), a row for each hash, dealt to the buckets."""
        self._write(self.unsettled(batch).select("h1", "h2", "n"), 0)
        self._commit()
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._write(reduce(self.merged, [self.spark.table(name) for name in old]), level + 1)
            self._commit(*old)
            level += 1

    def dealt(self, hashes: DataFrame) -> DataFrame:
        """(h1, h2, n) from (h1, h2), counted where they are first; the one shuffle deals them to the runs' buckets if there are as many as shuffle partitions."""
        return hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"))

    def frequent(self) -> DataFrame:
        """Hashes found in ``min_docs`` documents or more, over all runs."""
        return reduce(self.merged, self.tables()).where(F.col("n") >= self.min_docs).select("h1", "h2")

    def discard(self) -> None:
        """Delete all runs."""
        for name in (n for level in self.levels for n in level):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, self.path)


def without(lines: Column, dropped: Column) -> Column:
    """The lines but for those at the places in dropped (from 0, in order): what stands between one and the next, so that long texts take no longer than their lines."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """(id, n_lines, n_dropped, text) for each row: the text without its frequent lines.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of
    ``min_chars`` code points or more, found in ``min_docs`` rows or more, lose all their lines
    everywhere; other lines stay as they are, in order. Each row counts as a document, so repeated
    rows count as often as they stand there. A null or empty text has one empty line, which stays
    when ``min_chars`` is 1 or more; a text that loses every line becomes empty. A null id is an
    id like any other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("of", F.xxhash64("text"))
    keys = F.transform(split_lines(F.col("text")), line_key)
    hashes = F.transform(keys, lambda key: F.when(F.char_length(key) >= min_chars, key_hash(key)))
    hashed, hashed_path = materialize(rows.select("id", "of", hashes.alias("hashes"), F.pmod(F.xxhash64("id", "of"), F.lit(batches)).cast("int").alias("batch")), "line-hashes")
    runs = LineRuns(spark, min_docs, fanout, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for b in range(batches):
        one = hashed.where(F.col("batch") == b).select(F.inline(F.array_compact(F.array_distinct("hashes"))))
        runs.add(runs.dealt(one))
    # a table of its own, so that adaptive execution can split the join where a line is in a great many documents
    frequent, frequent_path = materialize(runs.frequent(), "frequent-lines")
    runs.discard()
    places = hashed.select("id", "of", F.posexplode("hashes").alias("at", "h")).where("h is not null").select("id", "of", "at", "h.h1", "h.h2")
    # rows of one id and text lose the same lines
    drops = places.join(frequent, ["h1", "h2"]).groupBy("id", "of").agg(F.array_sort(F.collect_set("at")).alias("dropped"))
    drops, _ = materialize(drops.toDF("_id", "_of", "dropped"), "dropped-lines")
    discard(spark, hashed_path, frequent_path)
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(without(lines, F.col("dropped")), "\n"))
    return rows.join(drops, F.expr("id <=> _id and of = _of"), "left").select(
        F.col("id").alias(id_col), F.size(lines).cast("long").alias("n_lines"), F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"), kept.alias("text")
    )
