"""Near duplicates by tensored banding against all pairs of full sets."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tracewell.llm import minhash, queries

SF = "/root/testdata/sf0.01"
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def shingles(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in _WHITE:
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def brute(rows, percent=85):
    """{row number: (n_shingles, component_id)} of rows (id, text), by an inverted index over all shingles."""
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    first, places = {}, defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            k = frozenset(s)
            if k in first:
                group[root(i)] = root(first[k])
            else:
                first[k] = i
                shared = defaultdict(int)
                for x in s:
                    for j in places[x]:
                        shared[j] += 1
                    places[x].append(i)
                for j, m in shared.items():
                    if 100 * m >= percent * (len(s) + len(sets[j]) - m):
                        group[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    return {i: (len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None)) for i in range(len(rows))}


def compare(spark, rows, found):
    want = sorted(((d, *brute_row) for (d, _), brute_row in zip(rows, [v for _, v in sorted(brute(rows).items())])), key=str)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str)
    assert got == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_query_equals_all_pairs_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    compare(spark, rows, queries.queries()["op13_minhash_near_dedup"](spark, SF).collect())


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", b"y", 1) for i, t in rows], "doc_id int, text string, held string, sketch binary, component_id int")
    return minhash.near_duplicates(frame).collect()


def word(rng):
    return "".join(rng.choices("abcdefghij", k=6))


def test_families_about_the_threshold(spark):
    rng, rows = random.Random(4), []
    for edits in (1, 2, 3, 4, 5, 6):
        base = [word(rng) for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for at in rng.sample(range(120), edits):
                copy[at] = word(rng)
            rows.append((len(rows), " ".join(copy)))
    compare(spark, rows, run(spark, rows))


def test_exactly_at_and_just_below(spark):
    # sets of 17 and 20 shingles, the smaller inside the larger: 85 %; 16 of 19: less
    rng, rows = random.Random(5), []
    for _ in range(30):
        words = [word(rng) for _ in range(22)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:19]))]
        words = [word(rng) for _ in range(21)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:18]))]
    found = {r["doc_id"]: r["component_id"] for r in run(spark, rows)}
    assert found == {i: i - (i % 4 == 1) for i in range(len(rows))}


def test_empty_short_null_and_repeated_rows(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One  two"), (3, "one\ttwo"), (9, "one two three"), (4, "ONE TWO\x0bthree"), (4, "one two three"), (None, "one"), (None, "one"), (2, "Äb c d"), (1, "äb c d"), (0, "x" * 300_000 + " y z w")]
    found = run(spark, rows)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found), key=str)
    want = [(5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 3, False), (3, 1, 3, True), (9, 1, 4, False), (4, 1, 4, True), (4, 1, 4, True)]
    want += [(None, 1, None, True), (None, 1, None, True), (2, 1, 2, True), (1, 1, 1, True), (0, 2, 0, True)]
    assert got == sorted(want, key=str)


def test_no_rows(spark):
    assert run(spark, []) == []


def test_keys_pair_every_left_with_every_right_band():
    sketches = np.random.default_rng(1).integers(0, 1 << 32, (2, minhash.FUNCTIONS), np.uint32)
    sketches[1, : minhash.SIDE * minhash.LEFT] = sketches[0, : minhash.SIDE * minhash.LEFT]
    assert not (minhash.tensored_keys(sketches)[0] == minhash.tensored_keys(sketches)[1]).any()
    at = minhash.SIDE * minhash.LEFT + 4 * minhash.RIGHT
    sketches[1, at : at + minhash.RIGHT] = sketches[0, at : at + minhash.RIGHT]
    same = (minhash.tensored_keys(sketches)[0] == minhash.tensored_keys(sketches)[1]).reshape(minhash.SIDE, minhash.SIDE)
    assert same[:, 4].all() and same.sum() == minhash.SIDE


@pytest.mark.parametrize("similarity", [0.85, 0.9])
def test_minima_estimate_the_similarity(similarity):
    rng, estimates = np.random.default_rng(3), []
    for _ in range(60):
        shared, own = rng.integers(0, 1 << 63, round(400 * similarity), np.uint64), rng.integers(0, 1 << 63, 400 - round(400 * similarity), np.uint64)
        a, b = minhash.minima(np.concatenate([shared, own[::2]])), minhash.minima(np.concatenate([shared, own[1::2]]))
        estimates.append((a == b).mean())
    assert abs(np.mean(estimates) - similarity) < 0.02


def test_sets_are_those_of_the_definition():
    rng = random.Random(2)
    texts = ["", "a", "a b", "a b c", "a b c a b c"] + [" ".join(rng.choices(["x", "Y", "zé", "w"], k=rng.randrange(30))) for _ in range(50)]
    sets = minhash.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(shingles(a) & shingles(b))
