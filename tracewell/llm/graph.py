"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, str]:
    """(node, root) for each node that has an edge; root is the smallest node it can reach.

    Each round moves every node nearer to the smallest node of its component and writes the
    edges to the shared folder; the rounds end when they change no edge. A node with a great
    many edges is never gathered: minima are pre-aggregated and joined back, and adaptive
    execution may split such a join. Loops, repeated edges and null ends are left out.
    Returns the table and its scratch path.
    """
    spark = edges.sparkSession
    cur, path = materialize(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        both = cur.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionAll(
            cur.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        low = both.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("r"))
        large = (
            both.where("m > n").join(low, "n").where("m != r").select(F.col("m").alias("hi"), F.col("r").alias("lo")).distinct()
        )
        low = large.groupBy("hi").agg(F.min("lo").alias("r"))
        pairs = F.array(F.struct(F.col("hi"), F.col("r").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("r").alias("lo")))
        small = large.join(low, "hi").select(F.inline(pairs)).where("hi != lo").distinct()
        new, new_path = materialize(small, "edges")
        discard(spark, path)
        path, cur = new_path, new
        got = cur.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if got == seen or not got[0]:
            break
        seen = got
    roots = cur.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots), path
