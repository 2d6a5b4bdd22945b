"""Embedding whitening against numpy's own eigenvectors, and its edges."""

import math

import numpy as np
import pytest

from tracewell.llm import qdwh, queries, whitening

SF = "/root/testdata/sf0.01"


def fixed(rows):
    return np.floor(1024 * np.array(rows, np.float64)).astype(np.int64) + 100_000


def brute(x, k=8):
    """n, deviations, components, whitened and explained of whole-number vectors."""
    n, s = len(x), [sum(col) for col in x.T.tolist()]
    deviations = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x.tolist()]
    y = (x - x.mean(0)).astype(float)
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, deviations, y @ vectors / np.sqrt(values), values / np.trace(cov)


def same_as_brute(spark, found, held):
    n, deviations, whitened, explained = brute(fixed([v for _, v in held]))
    k = len(explained)
    got = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert set(got) == {(i, c) for i, _ in held for c in range(1, k + 1)}
    ours = np.array([[got[i, c]["whitened"] for c in range(1, k + 1)] for i, _ in held])
    signs = np.sign((ours * whitened).sum(0))
    assert np.abs(ours * signs - whitened).max() < 1e-7
    for (i, _), d in zip(held, deviations):
        assert all(int(got[i, c]["deviation"]) == d and got[i, c]["n"] == n for c in range(1, k + 1))
    assert all(abs(got[i, c]["explained"] / explained[c - 1] - 1) < 1e-9 for i, _ in held[:5] for c in range(1, k + 1))
    assert len({r["identity_error"] for r in got.values()}) == 1 and next(iter(got.values()))["identity_error"] < 1e-9


def test_query_equals_numpy_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    held = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    same_as_brute(spark, queries.queries()["op11_embedding_whitening"](spark, SF), held)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id int, embedding array<{kind}>, component string, n int")


def test_bad_vectors_go_and_other_columns_do_not_clash(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(c) for c in rng.standard_normal(5).astype(np.float32)], "x", 1) for i in range(60)]
    bad = [(100, None, "x", 1), (101, [], "x", 1), (102, [None, 1.0, 1.0, 1.0, 1.0], "x", 1), (103, [float("nan")] * 5, "x", 1), (104, [1.0, 2.0, 3.0, 4.0, float("inf")], "x", 1), (105, [1.0, 2.0], "x", 1)]
    same_as_brute(spark, whitening.whiten(vectors(spark, rows + bad)), [(i, v) for i, v, _, _ in rows])


def test_repeated_rows_and_null_ids_stay(spark):
    rows = [(None, [1.0, 2.0], "x", 1), (7, [3.0, 1.0], "x", 1), (7, [3.0, 1.0], "x", 1), (8, [0.0, 0.5], "x", 1)]
    found = whitening.whiten(vectors(spark, rows, "double")).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == [(False, 7, 1), (False, 7, 1), (False, 7, 2), (False, 7, 2), (False, 8, 1), (False, 8, 2), (True, 0, 1), (True, 0, 2)]


@pytest.mark.parametrize("rows", [[], [(1, None, "x", 1)], [(1, [1.0, 2.0], "x", 1)], [(i, [1.0, 2.0], "x", 1) for i in range(5)]])
def test_nothing_to_scale_gives_no_row(spark, rows):
    assert whitening.whiten(vectors(spark, rows)).count() == 0


def test_huge_entries_and_exact_deviation_beyond_64_bits(spark):
    rows = [(1, [1e300, 0.0], "x", 1), (2, [-1e300, 1.0], "x", 1), (3, [0.0, 2.0], "x", 1)]
    x = np.array([[whitening.EDGE + 100_000, 100_000], [-whitening.EDGE + 100_000, 101_024], [100_000, 102_048]], dtype=object)
    n, s = 3, [sum(c) for c in x.T.tolist()]
    want = {i + 1: sum((n * a - b) ** 2 for a, b in zip(row, s)) for i, row in enumerate(x.tolist())}
    assert {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(vectors(spark, rows, "double")).collect()} == want


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_spectral_divide_and_conquer(d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d))
    q = np.linalg.qr(a)[0]
    for m in (a @ a.T, np.eye(d), q @ np.diag([5.0] * (d // 2) + [0.0] * (d - d // 2)) @ q.T, q @ np.diag(10.0 ** -np.arange(d).clip(0, 17)) @ q.T):
        m = (m + m.T) / 2
        values, basis = qdwh.eigen(m)
        assert np.abs(values - np.linalg.eigvalsh(m)[::-1]).max() <= 1e-13 * max(1, np.abs(m).max() * d)
        assert np.abs(m @ basis - basis * values).max() <= 1e-13 * max(1, np.abs(m).max() * d) and np.abs(basis.T @ basis - np.eye(d)).max() < 1e-13
    u = qdwh.polar(a)
    left, _, right = np.linalg.svd(a)
    assert np.abs(u - left @ right).max() < 1e-11
