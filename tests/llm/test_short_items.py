"""Short items are found wherever they stand, with words after them and as many edits as are allowed."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tracewell.llm import decontaminate
from tracewell.llm.common import utf8_parts


@pytest.mark.parametrize("n", [*range(1, 20), 22, 25, 28, 31])
def test_recall_by_length(n):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(rng.sample(vocabulary, n))) for i in range(20)]
    texts, want = [], set()
    for i, text in items:
        for edits in range(int(n * 0.2 + 1e-9) + 1):
            words = text.split()
            for _ in range(edits):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            want.add((len(texts), i))
            texts.append(" ".join(rng.choices(vocabulary, k=40) + words + rng.choices(vocabulary, k=40)))
    index = decontaminate.Index(items, decontaminate.Params())
    got = {(row, item): d for row, item, d in index.matches(*utf8_parts(pa.array(texts)))}
    assert want <= set(got)
    for (row, item), d in got.items():
        pattern, _ = decontaminate.words_of(*utf8_parts(pa.array([items[item][1]])))
        text, _ = decontaminate.words_of(*utf8_parts(pa.array([texts[row]])))
        assert decontaminate.substring_distance(np.array(pattern), np.array(text)) <= n * 0.2


def test_runs_do_not_cross_rows():
    index = decontaminate.Index([(1, "a b c")], decontaminate.Params())
    assert index.matches(*utf8_parts(pa.array(["x a b", "c a", "b c", "", "a b c"]))) == [(4, 0, 0)]
