"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """A document's quality: halved for a mean word length outside 3 to 10 code points, halved for fewer than 20 words.

    The mean counts the white space between words, so its bounds are 4 and 11 code points a word.
    """
    mean = F.char_length(F.coalesce(text, F.lit(""))) / F.greatest(size, F.lit(1))
    return F.when((mean >= 4) & (mean <= 11), 1.0).otherwise(0.5) * F.when(size >= 20, 1.0).otherwise(0.5)


def unit_draw(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, most_epochs: float = 3.0) -> DataFrame:
    """(source, source_size, target) of one row for each source.

    Sources by code point, null last, take the weights in turn. All targets together are ``share``
    of all sizes; none exceeds ``most_epochs`` times its source's size. Sources ordered by size
    over weight reach that limit in this order, so the level that the others share is the one at
    the first source that stays below it.
    """
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    level = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(most_epochs))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("left_weight"))
        .withColumn("place", F.row_number().over(level))
        .withColumn("below", F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level")))
        .withColumn("at", F.min("below").over(everything)["level"])
    )
    target = F.least(F.col("limit"), F.coalesce(F.col("at") * F.col("weight"), F.col("limit")))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.0,
    most_epochs: int = 3,
    seed: int = 17,
    bin_rows: int = 1 << 21,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, taken, copies[, row].

    A source's target first takes complete epochs of all its documents. What is left is a budget
    for a part of one more epoch: each document draws an exponential key, divided by its quality
    weight; documents in the order of their keys are taken until the budget is spent, the last one
    if at least half of it fits. So a source's words differ from its target by half a document at
    most. ``copies`` is how often a document is taken and ``taken`` its words times that.

    Draws depend on id and seed alone: reruns agree, and ties (repeated ids) are broken by size,
    then by ``row_col`` if it is given: a column that tells rows apart, which is returned too.
    Null texts have size 0; a null source is a source, the last; a null id draws like the text
    "null". A source with no words has target 0. Running sums over a large source are taken in
    two levels: over ranges of the keys, then within each, so no source meets in one task. Ranges
    are equal parts of the keys' logarithms, which spread alike whatever the weight: with 64 parts
    to a doubling a range holds 0.4 % of a source at most. From 64 times ``bin_rows`` rows on their
    number grows with the rows.
    """
    text, size = F.col("text"), word_count(F.col("text"))
    row = [] if row_col is None else ["_row_key"]
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).cast("string").alias("text"), *(F.col(row_col).alias(c) for c in row)
    )
    u = unit_draw(F.col("id"), seed)
    sized = rows.withColumn("size", size).select(*row, "id", "source", "size", (-F.log(u) / quality_weight(text, F.col("size"))).alias("key"))
    drawn, _ = materialize(sized, "mix-keys")
    parts = max(64, drawn.count() // bin_rows)
    keyed = drawn.withColumn("bin", F.floor(F.log2("key") * parts).cast("int"))
    by_bin = keyed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bin.select("source", "bin", F.coalesce(F.sum("bin_size").over(upto), F.lit(0)).alias("bin_start"))
    targets = source_targets(by_bin.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, share, float(most_epochs))
    plan = starts.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source")).select("s.source", "s.bin", "bin_start", "source_size", "target")
    within = Window.partitionBy("k.source", "k.bin").orderBy("key", "id", "size", *row).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.col("bin_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    joined = keyed.alias("k").join(plan.alias("p"), F.expr("k.source <=> p.source and k.bin = p.bin"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    fits = (F.col("spent") + F.col("size") / 2 <= budget) & (F.col("epochs") < most_epochs) & (F.col("source_size") > 0)
    return (
        joined.select(*row, "id", F.col("k.source").alias("source"), "size", "source_size", "target", spent.alias("spent"))
        .withColumn("epochs", epochs)
        .withColumn("copies", F.col("epochs") + fits.cast("long"))
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", *(F.col(c).alias(row_col) for c in row))
    )
