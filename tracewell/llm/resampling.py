"""Quality classifier: importance resampling with hashed n-gram models, sampled by Gumbel top-k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, materialize, mix64, span_hashes, text_slices, tidy, top_k, utf8_parts, word_spans

#: Words and word pairs are hashed to this many buckets.
BUCKETS = 1 << 18


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word and each pair of words that follow each other in a row, repeats included."""
    starts, ends, first = word_spans(data, off)
    words = span_hashes(data, starts, ends)
    rows = np.repeat(np.arange(len(off) - 1), np.diff(first))
    pairs = mix64(words[:-1] * np.uint64(3) + words[1:])
    same = rows[:-1] == rows[1:]
    shift = np.uint64(64 - 18)
    return np.concatenate([rows, rows[:-1][same]]), np.concatenate([words >> shift, pairs[same] >> shift]).astype(np.int64)


def log_ratios(docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str, smooth: float) -> np.ndarray:
    """Log of target over raw probability, by bucket; one pass over all texts."""
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(target_ids), "id", "left")

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text", 4 * SLICE):
                rows, buckets = features(*utf8_parts(part.column(0)))
                target = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                counts[0] += np.bincount(buckets, minlength=BUCKETS)
                counts[1] += np.bincount(buckets[target[rows]], minlength=BUCKETS)
        some = np.flatnonzero(counts[0])
        for at in np.array_split(some, max(1, len(some) // 50_000)):
            yield pa.record_batch([pa.array(at), pa.array(counts[0, at]), pa.array(counts[1, at])], ["bucket", "raw", "target"])

    texts = marked.select("text", F.coalesce("target", F.lit(False)).alias("target"))
    summed = texts.mapInArrow(tidy(run), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    got = summed.toArrow()  # a row for each bucket at most, whatever the corpus
    at = got["bucket"].to_numpy()
    raw[at], target[at] = got["raw"].to_numpy(), got["target"].to_numpy()
    raw += smooth
    target += smooth
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def log_weights(docs: DataFrame, ratios: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, log_weight): the sum of a text's log ratios; 0 for null and empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                rows, buckets = features(*utf8_parts(part.column(1)))
                yield pa.record_batch([part.column(0), pa.array(np.bincount(rows, own[buckets], minlength=part.num_rows))], ["id", "log_weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, log_weight double")


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    share: float | None = None,
    max_target: int = 20_000,
    smooth: float = 1.0,
    seed: int = 23,
) -> DataFrame:
    """(id, log_weight, gumbel_key, kept) of the rows that the sample takes.

    The raw model counts the words and word pairs of all rows, the target model those of rows
    labelled 1 (about ``max_target`` of them at most, chosen by their ids' hash). A row's weight is
    target over raw probability of its whole text; adding Gumbel noise to its logarithm and taking
    the k largest draws k rows without replacement, with chances after their weights. k is
    ``share`` of the rows; by default, the share of 1 among labelled rows (1 without labels). Noise
    depends on id and seed alone: reruns agree. Ties go to the smaller id. Null and empty texts
    have weight 1; null ids are ids; repeated rows draw alike.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = known.groupBy(F.col(id_col).alias("id")).agg((F.max(F.col(label_col).cast("int")) > 0).alias("target"))
    n, good = marks.agg(F.count("*"), F.count_if("target")).first()
    rate = min(1.0, max_target / max(1, good))
    draw = F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.lit(1 << 20)) / float(1 << 20)
    # about max_target ids at most, so their size is bounded
    ratios = log_ratios(docs, marks.where(F.col("target") & (draw < rate)), id_col, text_col, smooth)
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = log_weights(docs, ratios, id_col, text_col).withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u)))
    scored, _ = materialize(noisy, "log-weights")
    share = (good / n if n else 1.0) if share is None else share
    took = top_k(scored, ["gumbel_key", "id"], round(share * scored.count()))
    return took.select(F.col("id").alias(id_col), "log_weight", "gumbel_key", F.lit(True).alias("kept"))
