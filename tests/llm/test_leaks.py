"""Leaked items are found at every length and number of edits that is allowed, and repeated words stay cheap."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tracewell.llm import decontaminate
from tracewell.llm.common import utf8_parts


def edited(words, edits, rng, vocabulary):
    """The words with so many of them replaced, dropped or preceded by another one."""
    out = list(words)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(vocabulary)
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice(vocabulary))
    return out


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


CELLS = [(n, edits) for n in (3, 4, 5, 6, 8, 9, 10, 12, 13, 14, 15, 16, 18, 20, 22, 25, 28, 32, 40, 50, 64, 100) for edits in range(int(n * 0.2 + 1e-9) + 1)]


@pytest.mark.parametrize("n,edits", CELLS)
def test_recall(n, edits):
    rng = random.Random(n * 100 + edits)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i in range(120)]
    texts = [" ".join(rng.choices(vocabulary, k=40) + edited(t.split(), edits, rng, vocabulary) + rng.choices(vocabulary, k=40)) for _, t in items]
    index = decontaminate.Index(items, decontaminate.Params())
    got = {(row, item): d for row, item, d in index.matches(*utf8_parts(pa.array(texts)))}
    assert sum((i, i) in got for i in range(120)) >= (120 if n < decontaminate.Params().shortest else 0.9 * 120)
    for (row, item), d in list(got.items())[:10]:
        assert plain_distance(items[item][1].split(), texts[row].split()) == d <= int(n * 0.2 + 1e-9)


def test_all_pairs_of_few_words():
    """Against all pairs by brute force, where windows repeat within items and texts."""
    rng = random.Random(7)
    items = [(i, " ".join(rng.choices("abc", k=rng.randint(1, 26)))) for i in range(25)]
    texts = [" ".join(rng.choices("abc", k=rng.randint(0, 60))) for _ in range(40)]
    index = decontaminate.Index(items, decontaminate.Params())
    got = {(row, item): d for row, item, d in index.matches(*utf8_parts(pa.array(texts)))}
    want = {(r, i): d for r, t in enumerate(texts) for i, (_, w) in enumerate(items) if (d := plain_distance(w.split(), t.split())) <= int(len(w.split()) * 0.2 + 1e-9)}
    assert got.items() <= want.items() and len(got) >= 0.9 * len(want)
    assert {k for k in want if len(items[k[1]][1].split()) < decontaminate.Params().shortest} <= set(got)


def test_a_text_of_one_word_is_one_candidate_an_item():
    items = [(i, " ".join(["again"] * (20 + i))) for i in range(40)]
    index = decontaminate.Index(items, decontaminate.Params())
    words, first = decontaminate.words_of(*utf8_parts(pa.array([" ".join(["again"] * 50_000)])))
    assert len(index.candidates(words, first)) == len(items)
    began = time.time()
    assert len(index.matches(*utf8_parts(pa.array([" ".join(["again"] * 50_000)])))) == 40
    assert time.time() - began < 20


def test_spans():
    group, low, high = (np.array(x) for x in ([0, 0, 0, 1, 1, 2], [0, 5, 30, 0, 200, -50], [10, 6, 31, 3, 201, 90]))
    assert decontaminate._spans_of(group, low, high, 5).tolist() == [True, False, True, True, True, True]
