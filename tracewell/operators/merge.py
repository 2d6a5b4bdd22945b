"""Loads as operators on tables: old and new rows in, merged rows out. Nothing is changed in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_in_batch(new: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Of the rows of a key the one with the largest ordinal."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ordinal).desc_nulls_last()))
    return new.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def upsert_replace(old: DataFrame, new: DataFrame, keys: list[str], ordinal: str | None = None) -> DataFrame:
    """New rows replace old ones of their key as a whole."""
    batch = last_in_batch(new, keys, ordinal).drop(ordinal) if ordinal else new
    return old.join(batch.select(keys), keys, "left_anti").unionByName(batch.select(old.columns))


def upsert_update(old: DataFrame, new: DataFrame, keys: list[str], set_cols: list[str], coalesce_cols: list[str] = ()) -> DataFrame:
    """Columns of set_cols take the new value, those of coalesce_cols only if it isn't null; others stay. New keys are added."""
    n = new.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in [*set_cols, *coalesce_cols]), F.lit(True).alias("_given"))
    joined = old.withColumn("_had", F.lit(True)).join(n, keys, "full_outer")
    out = []
    for c in old.columns:
        if c in set_cols:
            out.append(F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in coalesce_cols:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(out)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows of keys that old doesn't have are added."""
    return old.unionByName(new.join(old.select(keys), keys, "left_anti").select(old.columns))


def replace_scope(old: DataFrame, new: DataFrame, scopes: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows of the given scopes go, all new rows come. Scopes without a new row are cleared."""
    return old.join(scopes.select(keys).distinct(), keys, "left_anti").unionByName(new.select(old.columns))


def keep_linkage(new: DataFrame, old: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Where the new rows' column is null, what the old rows had."""
    known = old.select(*keys, F.col(column).alias("_known"))
    return new.join(known, keys, "left").select(*(F.coalesce(c, "_known").alias(c) if c == column else F.col(c) for c in new.columns))


def delete_where_not(df: DataFrame, column: str, value, scopes: DataFrame | None = None, key: str = "member_id") -> DataFrame:
    """Of the scopes' rows (all rows without scopes) those whose column equals the value stay; all others go, nulls too. Rows of other scopes stay."""
    keep = F.col(column).eqNullSafe(F.lit(value))
    if scopes is None:
        return df.where(keep)
    inside = scopes.select(F.col(key).alias("_scope")).distinct()
    return df.join(inside, F.col(key) == F.col("_scope"), "left").where(F.col("_scope").isNull() | keep).select(df.columns)


def work_list(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Distinct keys that aren't done yet; nulls are no work."""
    return wanted.select(key).where(F.col(key).isNotNull()).distinct().join(done.select(key), key, "left_anti")


def rederive(df: DataFrame, column: str, new_value) -> tuple[DataFrame, DataFrame]:
    """The table with the column derived anew, and one row: rows and how many of them changed."""
    both = df.withColumn("_new", new_value)
    report = both.agg(F.count("*").alias("rows"), F.count_if(~F.col("_new").eqNullSafe(F.col(column))).alias("changed"))
    return both.withColumn(column, F.col("_new")).drop("_new"), report
