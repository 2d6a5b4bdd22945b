"""Edges between entities that share something."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.scratch import staged

from .ordering import top_rows


def drop_hubs(rows: DataFrame, shared: str, most: int | None) -> DataFrame:
    """Rows whose shared value has at most ``most`` of them; the pairs of a value grow with its square. None keeps all."""
    if most is None:
        return rows
    small = rows.groupBy(shared).count().where(F.col("count") <= most).select(shared)
    return rows.join(small, shared, "left_semi")


#: An item of more rows than this is heavy, or of more than a hundred-thousandth of all rows if that is more: so there are 100,000 heavy items at most.
HEAVY, HEAVY_ITEMS = 4_096, 100_000


def _blocks(rows: DataFrame, item: str, heavy: int | None) -> DataFrame:
    """rows with ``_b``, the number of blocks that their item's rows are dealt to on each side: 1 but for heavy items. These are broadcast; their number is bounded."""
    most = heavy or max(HEAVY, rows.count() // HEAVY_ITEMS)
    sizes = rows.groupBy(item).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(item, F.ceil(F.col("_n") / most).cast("int").alias("_b"))
    return rows.where(F.col(item).isNotNull()).join(F.broadcast(sizes), item, "left").withColumn("_b", F.coalesce("_b", F.lit(1)))


def _meet(rows: DataFrame, entity: str, item: str, left: list[Column], right: list[Column], heavy: int | None) -> DataFrame:
    """Pairs of rows of one item, with the left columns of one and the right columns of the other row, each pair both ways.

    The rows of a heavy item are dealt to a grid: a row stands in one line of blocks as the left and
    in one column as the right, and pairs meet in their block alone, about the square of ``heavy`` in each.
    """
    dealt = _blocks(rows, item, heavy)
    at = lambda k: F.pmod(F.xxhash64(F.lit(k), F.col(entity)), F.col("_b")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_b") - 1))
    a = dealt.select(item, at(1).alias("_i"), every.alias("_j"), *left)
    b = dealt.select(item, every.alias("_i"), at(2).alias("_j"), *right)
    return a.join(b, [item, "_i", "_j"]).drop("_i", "_j")


#: Pairs that one task makes, and the tasks there are at most (more pairs make longer tasks). Heavy items are split so that there are about so many blocks.
PAIRS_A_TASK, PAIR_TASKS, PAIR_BLOCKS = 1 << 24, 4_096, 512


def pair_tasks(rows: DataFrame, work: float | None) -> int:
    """How many tasks make so many pairs. The bytes of the rows don't tell it, so the number is given and adaptive execution leaves it."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, min(PAIR_TASKS, int((work or 0) // PAIRS_A_TASK)))


def shared_pairs(rows: DataFrame, entity: str, shared: str, carry: list[str], max_degree: int | None = None, heavy: int | None = None) -> DataFrame:
    """(subject, peer, shared, subject_* and peer_* of what is carried): each pair both ways, none with itself.

    Null values are shared with nobody. A value that many share is spread over a grid of blocks as in ``_meet``; the peers
    of a block are one array, and pairs become rows where it is spread to a subject, with no shuffle after.
    """
    kept = drop_hubs(rows, shared, max_degree).where(F.col(shared).isNotNull())
    sizes = kept.groupBy(shared).agg(F.count("*").cast("double").alias("n"))
    n, work = sizes.agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
    most = heavy or max(min(HEAVY, max(256, int(((work or 0) / PAIR_BLOCKS) ** 0.5))), int((n or 0) // HEAVY_ITEMS))
    dealt = _blocks(kept, shared, most)
    key, tasks = [shared, "_i", "_j"], pair_tasks(rows, work)
    at = lambda k: F.pmod(F.xxhash64(F.lit(k), F.col(entity)), F.col("_b")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_b") - 1))
    side = lambda name: [F.col(entity).alias(f"{name}_id"), *(F.col(c).alias(f"{name}_{c}") for c in carry)]
    subjects = dealt.select(shared, at(1).alias("_i"), every.alias("_j"), *side("subject")).repartition(tasks, *key)
    peers = dealt.select(shared, every.alias("_i"), at(2).alias("_j"), F.struct(*side("peer")).alias("_peer")).repartition(tasks, *key)
    # Spark takes the rows for as small as their compressed file; they aren't to be broadcast
    met = subjects.hint("merge").join(peers.groupBy(*key).agg(F.collect_list("_peer").alias("_peers")), key)
    return met.select("subject_id", shared, *(f"subject_{c}" for c in carry), F.inline("_peers")).where("subject_id <> peer_id")


def shared_classes(rows: DataFrame, entity: str, shared: str, carry: list[str], heavy: int | None = None) -> DataFrame:
    """The links of ``shared_pairs`` between classes of entities, and which class each entity is of; no link is lost.

    Entities with the same rows are one class, known by its smallest entity. kind link: subject_id and peer_id are classes (perhaps
    the same), with the shared value, what is carried and n, how many pairs of entities it stands for. kind member: subject_id is an
    entity, peer_id its class and n how many links it has, each with one peer. Rows without a value take no part.
    """
    held = rows.where(F.col(shared).isNotNull()).groupBy(entity).agg(F.array_sort(F.collect_list(F.struct(shared, *carry))).alias("_held"))
    classes = held.groupBy("_held").agg(F.min(entity).alias("_class"), F.count("*").alias("_size"))
    spread = classes.select("_class", "_size", F.inline("_held"))
    side = lambda name: [F.col("_class").alias(f"{name}_id"), F.col("_size").alias(f"_{name}s"), *(F.col(c).alias(f"{name}_{c}") for c in carry)]
    met = _meet(spread, "_class", shared, side("subject"), side("peer"), heavy)
    others = F.col("_peers") - F.when(F.col("subject_id") == F.col("peer_id"), 1).otherwise(0)
    values = [shared, *(f"subject_{c}" for c in carry), *(f"peer_{c}" for c in carry)]
    links = met.groupBy("subject_id", "peer_id", *values).agg(F.sum(others).alias("_each"), F.sum(F.col("_subjects") * others).alias("n")).where("n > 0")
    each = links.groupBy(F.col("subject_id").alias("_class")).agg(F.sum("_each").alias("n"))
    # Spark takes the entities for as small as their compressed file; they aren't to be broadcast
    members = held.hint("merge").join(classes.join(each, "_class", "left"), "_held")
    none = [F.lit(None).cast(links.schema[c].dataType).alias(c) for c in values]
    return links.select(F.lit("link").alias("kind"), "subject_id", "peer_id", *values, "n").unionByName(
        members.select(F.lit("member").alias("kind"), F.col(entity).alias("subject_id"), F.col("_class").alias("peer_id"), *none, F.coalesce("n", F.lit(0)).alias("n"))
    )


def peers_of(rows: DataFrame, entity: str, shared: str, amount: str, subject: Column | None = None, heavy: int | None = None) -> DataFrame:
    """(subject_id, peer_id, shared_count, combined_amount, shared values by combined amount, largest first).

    A subject filter is applied before the join. Sums are made in the blocks first.
    """
    marked = rows.withColumn("_asked", F.lit(True) if subject is None else F.coalesce(subject, F.lit(False)))
    left = [F.when(F.col("_asked"), F.col(entity)).alias("subject_id"), F.col(amount).alias("_a"), F.col("_asked").alias("_own")]
    pairs = _meet(marked, entity, shared, left, [F.col(entity).alias("peer_id"), F.col(amount).alias("_b2")], heavy)
    pairs = pairs.where("_own and subject_id <> peer_id").withColumn("_sum", F.col("_a") + F.col("_b2"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("_sum")).alias("order"), F.col(shared).alias("value"))))
    return pairs.groupBy("subject_id", "peer_id").agg(
        F.count("*").alias("shared_count"), F.sum("_sum").alias("combined_amount"), F.transform(ordered, lambda x: x["value"]).alias("shared_values")
    )


def co_participation(rows: DataFrame, entity: str, item: str, title: str, heavy: int | None = None) -> DataFrame:
    """Undirected edges, smaller entity first: shared_items, item_ids and titles in the order of the ids.

    An entity's rows of a heavy item stand in one of its parts; two parts meet in one block, so each pair is made once.
    """
    dealt = _blocks(rows, item, heavy).withColumn("_p", F.pmod(F.xxhash64(F.col(entity)), F.col("_b")).cast("int"))
    a = dealt.select(F.col(entity).alias("_x"), item, F.coalesce(title, F.lit("")).alias("_tx"), F.col("_p").alias("_i"), F.explode(F.sequence(F.col("_p"), F.col("_b") - 1)).alias("_j"))
    b = dealt.select(F.col(entity).alias("_y"), item, F.coalesce(title, F.lit("")).alias("_ty"), F.explode(F.sequence(F.lit(0), F.col("_p"))).alias("_i"), F.col("_p").alias("_j"))
    met = a.join(b, [item, "_i", "_j"]).where("_x < _y or (_i < _j and _x > _y)")
    # the title is that of the smaller entity's row
    edges = met.select(F.least("_x", "_y").alias("source_id"), F.greatest("_x", "_y").alias("target_id"), item, F.when(F.col("_x") < F.col("_y"), F.col("_tx")).otherwise(F.col("_ty")).alias("_title"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(item).alias("id"), F.col("_title").alias("title"))))
    return (
        edges.groupBy("source_id", "target_id")
        .agg(F.count("*").alias("shared_items"), ordered.alias("_items"))
        .select("source_id", "target_id", "shared_items", F.col("_items.id").alias("item_ids"), F.col("_items.title").alias("titles"))
    )


#: Ranges of items in which an edge's items are counted, to find those that hold its first ones.
ITEM_BINS = 64


def first_shared(rows: DataFrame, entity: str, item: str, k: int, heavy: int | None = None) -> DataFrame:
    """The edges of ``co_participation`` with the first k of their items: (source_id, target_id, shared_items, item_ids).

    No edge's items are gathered, since few entities may share very many. Items are dealt to ranges, edges are counted by range where their
    pairs are made, and only pairs in the ranges that hold an edge's first k items are made once more as rows.
    """
    kept = rows.select(entity, item).where(F.col(item).isNotNull())
    # written once: ranges are found from samples, so that they may differ when they are found again
    binned = staged(kept.repartitionByRange(ITEM_BINS, item).withColumn("_bin", F.spark_partition_id()), "items")

    def met(some: DataFrame) -> DataFrame:
        dealt = _blocks(some, item, heavy).withColumn("_p", F.pmod(F.xxhash64(F.col(entity)), F.col("_b")).cast("int"))
        a = dealt.select(F.col(entity).alias("_x"), item, "_bin", F.col("_p").alias("_i"), F.explode(F.sequence(F.col("_p"), F.col("_b") - 1)).alias("_j"))
        b = dealt.select(F.col(entity).alias("_y"), item, F.explode(F.sequence(F.lit(0), F.col("_p"))).alias("_i"), F.col("_p").alias("_j"))
        found = a.join(b, [item, "_i", "_j"]).where("_x < _y or (_i < _j and _x > _y)")
        return found.select(F.least("_x", "_y").alias("source_id"), F.greatest("_x", "_y").alias("target_id"), "_bin", item)

    edge = ["source_id", "target_id"]
    counts = staged(met(binned).groupBy(*edge, "_bin").agg(F.count("*").alias("_n")), "edge-counts")
    so_far = F.coalesce(F.sum("_n").over(Window.partitionBy(*edge).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asked = staged(counts.withColumn("_before", so_far).where(F.col("_before") < k).select(*edge, "_bin"), "edge-ranges")
    ends = asked.select(F.col("source_id").alias(entity), "_bin").unionAll(asked.select(F.col("target_id").alias(entity), "_bin")).distinct()
    near = met(binned.join(ends, [entity, "_bin"], "left_semi")).join(asked, [*edge, "_bin"])
    first = top_rows(near, edge, [F.col(item)], k).groupBy(*edge).agg(F.array_sort(F.collect_list(item)).alias("item_ids"))
    return counts.groupBy(*edge).agg(F.sum("_n").alias("shared_items")).join(first, edge)


def both_ways(edges: DataFrame, weight: str) -> DataFrame:
    """(member_id, peer_id, weight) from undirected edges."""
    return edges.select(F.col("source_id").alias("member_id"), F.col("target_id").alias("peer_id"), weight).unionAll(
        edges.select(F.col("target_id").alias("member_id"), F.col("source_id").alias("peer_id"), weight)
    )


def nodes(rows: DataFrame, entity: str, item: str) -> DataFrame:
    """Entities that share an item with another one: the ends of all edges, found without making any."""
    shared = rows.groupBy(item).agg(F.count_distinct(entity).alias("n")).where("n > 1").select(item)
    return rows.join(shared, item, "left_semi").select(F.col(entity).alias("node")).distinct()
