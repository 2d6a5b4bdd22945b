"""Toxicity: a linear classifier over character n-grams, features scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, discard, materialize, mix64, text_slices, tidy, top_k, utf8_parts

#: n-grams are hashed to this many features.
DIMS = 1 << 20
#: Lengths of the n-grams, in bytes of the UTF-8 text with A-Z in lower case.
SIZES = (4, 6, 8)

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_FACTOR = 0xD6E8FEB86659FD93


def grams(data: np.ndarray, off: np.ndarray):
    """For each n: the feature at each byte and whether the n bytes lie within one row."""
    codes = _FOLD[data] + np.uint64(1)
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(data))  # bytes up to the row's end
    rolled = np.zeros(len(data), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(data) >= n:
            rolled[: len(data) - n + 1] += codes[n - 1 :] * np.uint64(pow(_FACTOR, n - 1, 1 << 64))
        if n in SIZES:
            hashed = mix64(rolled ^ np.uint64(n)) >> np.uint64(44)
            yield hashed.astype(np.int32), left >= n


def present(data: np.ndarray, off: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the chosen features that rows hold, each pair once. chosen: -1 or the new number, by feature."""
    rows, found = [], []
    for feature, whole in grams(data, off):
        own = chosen[feature]
        at = np.flatnonzero((own >= 0) & whole)
        rows.append(np.searchsorted(off, at, side="right") - 1)
        found.append(own[at])
    width = int(chosen.max(initial=0)) + 1
    pairs = np.unique(np.concatenate(rows).astype(np.int64) * width + np.concatenate(found)) if rows else np.zeros(0, np.int64)
    return pairs // width, pairs % width


@dataclass
class Model:
    """weights: by feature of DIMS, 0 for those that are not used; every text adds up those it holds, once each."""

    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        chosen = np.where(self.weights != 0, np.arange(DIMS, dtype=np.int32), np.int32(-1))
        return self._scores(*utf8_parts(column), chosen)

    def _scores(self, data, off, chosen) -> np.ndarray:
        rows, found = present(data, off, chosen)
        z = np.bincount(rows, self.weights[found], minlength=len(off) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _counts(sample: DataFrame) -> DataFrame:
    """(feature, pos, neg): in how many rows of each class a feature stands."""

    def run(batches):
        counts = np.zeros((2, DIMS), np.int32)
        everything = np.arange(DIMS, dtype=np.int32)
        for batch in batches:
            for part in text_slices(batch, "text", 4 * SLICE):
                rows, found = present(*utf8_parts(part.column(0)), everything)
                label = np.asarray(part.column(1).to_numpy(zero_copy_only=False), bool)[rows]
                for k in range(2):
                    counts[k] += np.bincount(found[label == bool(k)], minlength=DIMS).astype(np.int32)
        some = np.flatnonzero(counts.any(0))
        for at in np.array_split(some, max(1, len(some) // 50_000)):
            yield pa.record_batch([pa.array(at), pa.array(counts[1, at]), pa.array(counts[0, at])], ["feature", "pos", "neg"])

    parts = sample.select("text", "label").mapInArrow(tidy(run), "feature long, pos int, neg int")
    return parts.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_per_class: int) -> DataFrame:
    """(text, label) of labelled rows with an id and a label: all of a class, or about ``max_per_class`` chosen by their ids' hash."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int") > 0).alias("label"))
    n = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    rate = {k: min(1.0, max_per_class / max(1, n.get(k, 0))) for k in (True, False)}
    draw = F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.lit(1 << 20)) / float(1 << 20)
    some = marks.where(draw < F.when(F.col("label"), rate[True]).otherwise(rate[False]))
    # at most about 2 * max_per_class ids, so their size is bounded
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(some), "id").select("text", "label")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_per_class: int = 4_000,
    max_features: int = 8_192,  # 32,767 at most
    min_rows: int = 3,
    smooth: float = 0.5,
    l2: float = 1.0,
    rounds: int = 300,
) -> Model:
    """Fit on at most about ``max_per_class`` labelled rows of each class, whole texts.

    Counts of all features come from one Spark job. The log-count ratio of a feature is
    ``log((pos + a) / (P + 2a)) - log((neg + a) / (N + 2a))``; the ``max_features`` features whose
    ratio is surest (ratio over its standard error) and which at least ``min_rows`` rows hold stay.
    Each is scaled by its ratio, and a logistic regression with an L2 penalty is fitted to the
    rows' (row, feature) pairs, two bytes each: at most 8,000 rows of 8,192 pairs, 131 MB,
    whatever the corpus and however long its texts. Without labels of both
    classes the model scores every text at the share of label 1 (0.5 without any label).
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, max_per_class).persist()
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_pos, n_neg = n.get(True, 0), n.get(False, 0)
    if not n_pos or not n_neg:
        sample.unpersist()
        share = 0.5 if n_pos == n_neg else min(max(n_pos / (n_pos + n_neg), 0.01), 0.99)
        return Model(np.zeros(DIMS, np.float32), math.log(share / (1 - share)))
    ratio = F.log((F.col("pos") + smooth) / (n_pos + 2 * smooth)) - F.log((F.col("neg") + smooth) / (n_neg + 2 * smooth))
    error = F.sqrt(1 / (F.col("pos") + smooth) + 1 / (F.col("neg") + smooth))
    rated = _counts(sample).where(F.col("pos") + F.col("neg") >= min_rows).select("feature", ratio.alias("ratio"), F.abs(ratio / error).alias("sure"))
    rated, rated_path = materialize(rated, "features")
    best = top_k(rated, ["sure", "feature"], max_features).toArrow().sort_by([("sure", "descending"), ("feature", "ascending")])
    discard(spark, rated_path)
    ratios, features = best["ratio"].to_numpy(), best["feature"].to_numpy()
    chosen = np.full(DIMS, -1, np.int32)
    chosen[features] = np.arange(len(features), dtype=np.int32)
    shared = spark.sparkContext.broadcast(chosen)

    def pairs(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                rows, found = present(*utf8_parts(part.column(0)), shared.value)
                cut = np.searchsorted(rows, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found, pa.int16()))
                yield pa.record_batch([lists, part.column(1)], ["found", "label"])

    got = sample.select("text", "label").mapInArrow(tidy(pairs), "found array<short>, label boolean").toArrow()
    sample.unpersist()
    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(got["found"]).to_numpy())])
    cols = pc.list_flatten(got["found"]).to_numpy().astype(np.uint16)
    labels_ = got["label"].to_numpy().astype(float)
    del got
    weights, bias = _logistic(cuts, cols, labels_, ratios, l2, rounds)
    out = np.zeros(DIMS, np.float32)
    out[features] = weights * ratios
    return Model(out, bias)


def _logistic(cuts: np.ndarray, cols: np.ndarray, y: np.ndarray, scale: np.ndarray, l2: float, rounds: int, block: int = 1 << 18) -> tuple[np.ndarray, float]:
    """Weights of scaled presence features, by gradient steps with momentum; classes count alike.

    Row i holds the features cols[cuts[i] : cuts[i + 1]]. Rows are taken in blocks of about
    ``block`` pairs, so that little more than the pairs themselves is in memory.
    """
    n = len(y)
    own = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * n
    ends = np.unique(np.append(np.searchsorted(cuts, np.arange(block, cuts[-1], block)), n))
    parts = [(i, j) for i, j in zip(np.append(0, ends[:-1]), ends) if i < j]

    def sums(i: int, j: int, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(values[cols[cuts[i] : cuts[j]]])])
        return np.diff(total[cuts[i : j + 1] - cuts[i]])

    # the curvature is at most a quarter of the mean squared length of a row
    length = sum(sums(i, j, scale**2).sum() for i, j in parts) / n
    step = 1.0 / (0.25 * max(1.0, length) + l2 / n)
    w, bias, v, vb = np.zeros(len(scale)), 0.0, np.zeros(len(scale)), 0.0
    for _ in range(rounds):
        gw, gb, scaled = l2 / n * w, 0.0, w * scale
        for i, j in parts:
            z = sums(i, j, scaled) + bias
            g = own[i:j] * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[i:j]) / n
            gw = gw + np.bincount(cols[cuts[i] : cuts[j]], np.repeat(g, np.diff(cuts[i : j + 1])), minlength=len(scale)) * scale
            gb += g.sum()
        v, vb = 0.9 * v - step * 0.5 * gw, 0.9 * vb - step * 0.5 * gb
        w, bias = w + v, bias + vb
    return w, float(bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, from its whole text alone; null and empty texts get the bias's score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches):
        own = Model(*shared.value)
        chosen = np.where(own.weights != 0, np.arange(DIMS, dtype=np.int32), np.int32(-1))
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                yield pa.record_batch([part.column(0), pa.array(own._scores(*utf8_parts(part.column(1)), chosen))], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"`{id_col}` {kind}, score double")
