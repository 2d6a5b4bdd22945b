"""Helpers that the operators of this subpackage share.

Scratch tables live under the folder that ``spark.checkpoint.dir`` names, which every
executor can reach, so that a lost executor never loses a step that is already done.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The white space that separates words, as code points 0x20 and 0x09 to 0x0D.
WHITE = " \t\n\x0b\x0c\r"
#: The same as a regular expression for one word.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task works on at once: arrays over them stay in a core's cache, and little memory is taken at a time.
SLICE = 1 << 18

_LOCAL_BASE: list[str] = []


def scratch_base(spark: SparkSession) -> str:
    """The shared folder of the cluster; on a local master without one, a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_BASE:
        _LOCAL_BASE.append("file://" + tempfile.mkdtemp(prefix="tracewell-"))
    return _LOCAL_BASE[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of its own under the shared folder."""
    return f"{scratch_base(spark)}/tracewell/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: cuts its lineage, survives lost executors. codec: another than the session's."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def sweep(spark: SparkSession) -> None:
    """Let the driver drop plans that nothing holds any more: Spark then deletes their shuffle files, which else lie on the executors' disks for long."""
    gc.collect()
    _release()
    spark._jvm.System.gc()


#: Groups of more rows than this, and than a hundred-thousandth of all, are hot: of these there are 100,000 at most.
HOT_ROWS, HOT_GROUPS = 1_000, 100_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows joined to groups, a row for each key, whose column ``size`` tells how many rows have the key; total: all rows.

    Hot groups are broadcast, so that the rows of one stay where they are instead of meeting in a
    task; their number is bounded, as each has more than a hundred-thousandth of all rows. rows
    are read twice: pass a table that is written.
    """
    hot_from = max(HOT_ROWS, total // HOT_GROUPS)
    hot = F.broadcast(groups.where(F.col(size) > hot_from))
    rest = rows.join(hot.select(key), key, "left_anti").join(groups.where(F.col(size) <= hot_from), key)
    return rows.join(hot, key).unionByName(rest)


def top_k(rows: DataFrame, keys: list[str], k: int, bins: int = 1024, small: int = 20_000) -> DataFrame:
    """The k rows with the largest first key, then the smallest of the other keys, exactly, without a global sort. Nulls are last.

    Counts by bins of a key's range find the bin in which the k-th row lies; it is cut again until
    it holds ``small`` rows at most, or rows that are alike in the key: these are cut by the next
    key. Rows alike in all keys, more than ``small``, are dealt by a number of their own. Keys are
    numbers, or texts, which are cut by ranges instead. rows are read several times.
    """
    n, left, sure, inside = rows.count(), k, [], rows
    if k >= n or k <= 0:
        return rows if k > 0 else rows.limit(0)
    for nth, name in enumerate(keys):
        if dict(rows.dtypes)[name] == "string":
            if n > small:
                passed, inside, n, left = _cut_by_text(inside, name, left, nth == 0)
                sure += passed
            if n <= small:
                break
            continue
        value = F.col(name).cast("double") if nth == 0 else -F.col(name).cast("double")
        value = F.coalesce(value, F.lit(float("-inf")))
        lo, hi = inside.agg(F.min(value), F.max(value)).first()
        while n > small and lo < hi:
            width = max((hi - max(lo, -1e300)) / bins, 1e-300)
            at = F.when(value <= lo, 0).otherwise(F.least(F.floor((value - max(lo, -1e300)) / width), F.lit(bins - 1)) + 1).cast("int")
            found = inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()
            for r in sorted(found, key=lambda r: -r["bin"]):
                if r["n"] >= left:
                    break
                left -= r["n"]
            sure.append(inside.where(value > r["hi"]))
            inside, n, lo, hi = inside.where((value >= r["lo"]) & (value <= r["hi"])), r["n"], r["lo"], r["hi"]
        if n <= small:
            break
    if n > small:
        numbered, _ = materialize(inside.withColumn("_own", F.monotonically_increasing_id()), "ties")
        edge = top_k(numbered, ["_own"], left, bins, small).drop("_own")
    else:
        order = Window.partitionBy(F.lit(0)).orderBy(F.col(keys[0]).desc_nulls_last(), *(F.col(name).asc_nulls_last() for name in keys[1:]))
        edge = inside.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= left).drop("_nth")
    return reduce(DataFrame.unionAll, [*sure, edge])


def _cut_by_text(rows: DataFrame, name: str, left: int, falling: bool) -> tuple[list[DataFrame], DataFrame, int, int]:
    """Rows sure to be among the first ``left`` in the order of a text, the rows of one range, or of one text, that the last of these is in, their number, and how many of them."""
    # only the first key falls
    order = F.col(name).desc_nulls_last() if falling else F.col(name).asc_nulls_last()
    dealt, _ = materialize(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "text-ranges")
    sure: list[DataFrame] = []
    for column in ("_range", name):
        groups = dealt.groupBy(column).agg(F.count("*").alias("n"))
        if column == name:
            place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order))  # the texts of one range
            groups = groups.select(F.col(name).alias("_text"), "n").withColumnRenamed("_text", name).withColumn("_place", place)
        else:
            groups = groups.withColumn("_place", F.col("_range"))
        upto = groups.withColumn("_before", F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_place")) - F.col("n"))
        edge = upto.where((F.col("_before") < left) & (F.col("_before") + F.col("n") >= left)).first()
        before = upto.where(F.col("_place") < edge["_place"]).select(F.col(column).alias("_group"))
        sure.append(dealt.join(before, dealt[column].eqNullSafe(F.col("_group")), "left_semi").select(rows.columns))
        dealt = dealt.where(F.col(column).eqNullSafe(F.lit(edge[column])))
        left -= edge["_before"]
    return sure, dealt.select(rows.columns), edge["n"], left


def _release() -> None:
    """Give memory that is free back to the system: workers live on after their tasks, beside the JVM and other workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # other C libraries do so by themselves


def tidy(run):
    """A function over Arrow batches that gives free memory back every few batches and when it ends."""

    def wrapped(batches):
        try:
            for n, batch in enumerate(run(batches), 1):
                yield batch
                if n % 32 == 0:
                    _release()
        finally:
            _release()

    return wrapped


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else untouched; texts of ASCII alone take the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def text_slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22):
    """Slices of a batch whose texts hold about ``most`` bytes at most, or one row."""
    _, off = utf8_parts(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        end = max(start + 1, int(np.searchsorted(off, off[start] + most, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, over whole arrays."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BASE, _BASE_INV = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a difference of prefix polynomials, moved to the origin."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * _powers(_BASE_INV, n + 1)[starts]
    return mix64(raw ^ (ends - starts).astype(np.uint64))


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[ord(c) for c in WHITE]] = True


def word_spans(data: np.ndarray, off: np.ndarray, is_white: np.ndarray = _IS_WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words of all rows, and the number of words before each row."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = is_white[data]
    inside = ~gap
    start = inside[1:-1] & gap[:-2]
    end = inside[1:-1] & gap[2:]
    # a row's end cuts a word
    edges = off[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    start[edges] |= inside[1:-1][edges]
    end[edges - 1] |= inside[1:-1][edges - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, off)
