"""Sinks: what detection and scoring write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stored import StoredTable

#: Columns that scoring fills; null for hits of patterns that aren't scored.
STATISTICS = ("null_model", "observed", "expected", "p_value", "z_score", "n_perm")


def with_statistics(hits: DataFrame, scores: DataFrame) -> DataFrame:
    """Hits with the statistics of their pattern and member, so that nothing is stored before it is scored."""
    return hits.drop(*STATISTICS).join(scores.select("pattern", "member_id", *STATISTICS), ["pattern", "member_id"], "left")


def stored_hits(spark, path: str, schema: str, buckets: int = 64) -> StoredTable:
    """The table of hits, in buckets of pattern and member."""
    return StoredTable(spark, path, schema, ["pattern", "member_id"], buckets)


def write_hits(hits: DataFrame, scopes: DataFrame, path: str, buckets: int = 64) -> int:
    """Replace the stored hits of the scopes (pattern, member_id) that ran by those that they found, scored already. Returns the version.

    A scope that found nothing is cleared; other members' hits of a pattern stay, and so do patterns
    that didn't run. Only the buckets of the scopes are written anew.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hits.schema)
    return stored_hits(hits.sparkSession, path, schema, buckets).replace_scope(hits, scopes)


def read_hits(spark, path: str, schema: str, buckets: int = 64) -> DataFrame:
    """The stored hits."""
    return stored_hits(spark, path, schema, buckets).read()


def encoded(hits: DataFrame) -> DataFrame:
    """Hits with what they cite and their dates as JSON texts, citing_json and dates_json, in place of the arrays."""
    return hits.withColumn("citing_json", F.to_json("citing")).withColumn("dates_json", F.to_json(F.transform("dates", lambda d: d.cast("string")))).drop("citing", "dates")


def write_receipts(receipts: DataFrame, path: str, files: int | None = None) -> None:
    """One JSON document a member and line, with the receipts in their order as an array; ranges of members make few files."""
    whole = ["member_id", "trade_count", "band"]
    rest = [c for c in receipts.columns if c not in (*whole, "place")]
    docs = receipts.groupBy(*whole).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", *rest))), lambda r: F.struct(*(r[c].alias(c) for c in rest))).alias("receipts"))
    ranged = docs.repartitionByRange(files, "member_id") if files else docs.repartitionByRange("member_id")
    ranged.sortWithinPartitions("member_id").write.mode("overwrite").json(path)


def manifest(counts: DataFrame, through: DataFrame, key: str = "member_id") -> DataFrame:
    """Counts per member with the latest date of its data."""
    return counts.join(through, key, "left")


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.withColumn("data_through", F.col("data_through").cast("string")).write.mode("overwrite").json(path)
