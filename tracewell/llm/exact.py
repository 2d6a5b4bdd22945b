"""Exact dedup: two passes over a Bloom filter, so that only rows that may repeat shuffle."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_groups, materialize, scratch_path, tidy
from .stores import open_store

#: Bits of a block of the filter, which one row carries.
BLOCK = 1 << 16


def filter_size(rows: int, most: int = 1 << 30) -> tuple[int, int]:
    """(shards, bits of each): 16 bits a row. A shard never has more than ``most`` bits, 128 MB, which is what a task holds; more rows take more shards."""
    bits = min(most, max(BLOCK, 1 << (16 * max(rows, 1) - 1).bit_length()))
    return max(1, -(-16 * rows // bits)), bits


def _set_bits(hashed: DataFrame) -> DataFrame:
    """(shard, block, once, twice) for each block that a task's rows (shard, p0, p1) touch: places in the block, two bytes each, that they set, and those set by two of them or more.

    Combined where the rows are: what shuffles is at most two bytes for each bit set, a row for each task and block.
    """

    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            shard, p0, p1 = (batch.column(i).to_numpy() for i in range(3))
            for s in np.unique(shard):
                own = shard == s
                # a row whose two positions are equal counts them once
                held.setdefault(int(s), []).extend([p0[own], p1[own & (p0 != p1)]])
        for s, parts in held.items():
            at, times = np.unique(np.concatenate(parts), return_counts=True)
            block, place, again = at // BLOCK, (at % BLOCK).astype("<u2"), times > 1
            cut = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(at))
            for lo in range(0, len(cut) - 1, 4096):
                spans = list(zip(cut[lo : lo + 4096].tolist(), cut[lo + 1 : lo + 4097].tolist()))
                once, twice = [place[i:j].tobytes() for i, j in spans], [place[i:j][again[i:j]].tobytes() for i, j in spans]
                yield pa.record_batch([pa.array([s] * len(spans), pa.int32()), pa.array([int(block[i]) for i, _ in spans], pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["shard", "block", "once", "twice"])

    return hashed.select("shard", "p0", "p1").mapInArrow(tidy(run), "shard int, block int, once binary, twice binary")


def _merge_block(key, pdf):
    """The bits of a block that two rows or more set, over all tasks; no row if there are none."""
    times = np.zeros(BLOCK, np.uint8)
    for column in ("once", "twice"):
        for places in pdf[column]:
            at = np.frombuffer(places, "<u2")
            times[at] = np.minimum(times[at] + 1, 2)
    bits = np.packbits(times > 1, bitorder="little").tobytes()
    return pd.DataFrame({"shard": [key[0]], "block": [key[1]], "bits": [bits]} if (times > 1).any() else {"shard": [], "block": [], "bits": []})


def _load_shard(path: str, shard: int, bits: int) -> np.ndarray:
    """A shard's bits, read from the shared folder by the task that needs them."""
    store, at = open_store(f"{path}/shard={shard}")
    held = np.zeros(bits // 8, np.uint8)
    if store.get_file_info(at).type.name == "Directory":
        for part in pq.ParquetDataset(at, filesystem=store, partitioning=None).read(columns=["block", "bits"]).to_batches():
            for block, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(own, np.uint8)
    return held


def maybe_repeated(rows: DataFrame, hash_col: str, size: tuple[int, int] | None = None) -> tuple[DataFrame, list[str]]:
    """rows with a column ``maybe``, false only if no other row has the same hash; and the scratch paths that it reads.

    Rows are dealt to shards of the filter by their hash, each with a bitmap of its own; they are
    written by shard where they stand, without a shuffle. Pass one sets two bits for each row and
    keeps those that several rows set. Pass two asks for each row whether both of its bits stayed;
    a task reads the bitmaps of the shards that its rows are of. A hash that repeats sets its bits
    twice, so no repeated row is missed.
    """
    shards, bits = size or filter_size(rows.count())
    spark, dealt_path, filter_path = rows.sparkSession, scratch_path(rows.sparkSession, "sharded-hashes"), scratch_path(rows.sparkSession, "filter")
    at = lambda i: F.pmod(F.xxhash64(F.lit(i), F.col(hash_col)), F.lit(bits)).cast("int").alias(f"p{i}")
    dealt = rows.select("*", at(0), at(1), F.pmod(F.xxhash64(F.lit(2), F.col(hash_col)), F.lit(shards)).cast("int").alias("shard"))
    dealt.write.partitionBy("shard").parquet(dealt_path)
    dealt = spark.read.schema(dealt.schema).parquet(dealt_path)
    twice = _set_bits(dealt).groupBy("shard", "block").applyInPandas(_merge_block, "shard int, block int, bits binary")
    twice.write.partitionBy("shard").parquet(filter_path)

    def test(batches):
        known, held = None, None
        for batch in batches:
            p0, p1, shard = (batch.column(batch.num_columns - k).to_numpy() for k in (3, 2, 1))
            ok = np.zeros(batch.num_rows, bool)
            for s in np.unique(shard).tolist():
                if s != known:
                    known, held = s, _load_shard(filter_path, s, bits)
                own = np.flatnonzero(shard == s)
                both = np.ones(len(own), bool)
                for p in (p0[own], p1[own]):
                    both &= (held[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
                ok[own] = both
            yield pa.record_batch([*batch.columns[:-3], pa.array(ok)], [*batch.schema.names[:-3], "maybe"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInArrow(tidy(test), f"{schema}, maybe boolean"), [dealt_path, filter_path]


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; null counts as empty. Of equal texts the row with the
    largest id stays, a null id being smaller than any; of repeated rows with that id one stays.
    keep_id is null where all ids of a group are. Rows that the filter clears are groups of their
    own and never shuffle; the others shuffle as (id, hash), without texts, and those of a hot
    text only to be counted. Other columns are not read.
    """
    spark = docs.sparkSession
    hashed = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("h"))
    marked, paths = maybe_repeated(hashed, "h", filter_size(docs.count()))
    tested, _ = materialize(marked, "tested-hashes")
    discard(spark, *paths)
    alone = tested.where("not maybe").select("id", "h", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    # rows of one id and text are one row until the end, so that of several one stays
    own, _ = materialize(tested.where("maybe").groupBy("h", "id").agg(F.count("*").alias("rows")), "repeated-hashes")
    groups = own.groupBy("h").agg(F.max("id").alias("keep_id"), F.sum("rows").alias("group_size"), F.count("*").alias("ids"))
    groups, _ = materialize(groups, "groups")
    nth = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("nth")
    joined = join_groups(own, groups, "h", "ids", own.count()).select("id", "h", "keep_id", "group_size", nth)
    rest = joined.select("id", "h", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"))
    return alone.unionAll(rest).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("h")).alias("text_sha256"))
