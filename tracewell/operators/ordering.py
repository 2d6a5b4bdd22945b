"""Total orders with nulls last, whatever the direction, and top rows by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.scratch import staged


def up(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def down(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def top_rows(df: DataFrame, by: list[str], order: list[Column], k: int, place: str | None = None) -> DataFrame:
    """The first k rows of each group, by a total order, with their place if it is named. Spark limits groups before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    found = df.withColumn(place or "_nth", nth).where(F.col(place or "_nth") <= k)
    return found if place else found.drop("_nth")


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str, unit: str | None = None) -> DataFrame:
    """df with the place of each row in its group, from 0, by a total order, in two levels, so that a large group isn't gathered in one task.

    Rows are dealt to bins that follow each other: by 256 equal parts of ``unit``, a column of numbers in [0, 1) that leads the
    order, or else by the range of the order. Bins are counted and their sums taken, then rows are numbered within their bin.
    """
    if unit is None:
        ranged = df.repartitionByRange(*[F.col(c) for c in by], *order)
        # written once: ranges are found from samples, so that they may differ when they are found again
        bins = staged(ranged.withColumn("_bin", F.spark_partition_id()), "ranges")
    else:
        # never null, or Spark would ask so in a filter, which takes a long expression of the unit apart anew for each row
        bins = df.withColumn("_bin", F.coalesce(F.floor(F.col(unit) * 256).cast("int"), F.lit(0)))
    counts = bins.groupBy(*by, "_bin").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("_bin").alias("_of"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"))
    same = F.col("_bin") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    nth = F.row_number().over(Window.partitionBy(*by, "_bin").orderBy(*order)) - 1
    return bins.join(starts, same).withColumn(name, F.col("_start") + nth).select(*df.columns, name)


def first_rows(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows of all, by a total order."""
    return df.orderBy(*order).limit(k)


def per_group_then_all(df: DataFrame, by: list[str], order: list[Column], k: int, total: int) -> DataFrame:
    """The first k of each group, and of those the first ``total``."""
    return first_rows(top_rows(df, by, order, k), order, total)
