"""Phrase collocations against SQL and brute force; the index against counting."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tracewell.llm import collocations, queries

SF = "/root/testdata/sf0.01"


def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, least=30, most=4, share=80, top=2000, scale=2_000_000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces(text):
            n[lang or "und"] += len(ws)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = set()
    for lang, counts in f.items():
        held = [p for p, c in counts.items() if 2 <= len(p) and c >= least]
        inside = defaultdict(int)
        for p in held:
            for w in range(2, len(p)):
                for i in range(len(p) - w + 1):
                    inside[p[i : i + w]] = max(inside[p[i : i + w]], counts[p])
        scored = []
        for p in held:
            score, k = min((scale * counts[p] // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside[p] < share * counts[p]:
                scored.append((-score, -counts[p], " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out |= {(lang, i, s[2].decode(), -s[1], s[3], s[4], n[lang], -s[0]) for i, s in enumerate(sorted(scored)[:top], 1)}
    return out


def rows_of(frame):
    return [(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in frame.collect()]


def test_query_equals_sql_and_brute_force_on_the_whole_table(spark):
    got = rows_of(queries.queries()["op12_phrase_collocations"](spark, SF))
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.sql(queries.oracle_sql()["op12_phrase_collocations"])
    at = [found.columns.index(c) for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    assert {tuple(r[i] for i in at) for r in found.fetchall()} == set(got)


def made(spark, rows):
    return spark.createDataFrame([(i, lang, t, "x", 1, 2) for i, (lang, t) in enumerate(rows)], "doc_id int, lang string, text string, gram string, shard int, f int")


@pytest.mark.parametrize("size", [40, 1000, collocations.SHARD])
def test_shards_of_any_size_give_brute_force(spark, size):
    rng = random.Random(size)
    words = ["a", "b", "A", "c", "été", "日本", "x-y", "d\x00", " "]
    gaps = [" ", " ", " ", " ", "\t", ", ", ".", "\n", "  "]
    rows = [(rng.choice(["en", None, "und", "de", "en"]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60)))) for _ in range(120)]
    rows += [("en", None), ("fr", ""), ("fr", " .,\n"), (None, "a"), ("en", "q r s t u " * 40), ("en", "one two three " * 3000), ("en", "one two three " * 3000)]
    for how in ({"least": 2, "top": 7, "share": 50}, {"least": 3, "most_words": 3}, {"least": 5, "most_words": 2})[size % 3 :][:2]:
        got = rows_of(collocations.collocations(made(spark, rows), size=size, **how))
        keys = {"least": how["least"], "most": how.get("most_words", 4), "share": how.get("share", 80), "top": how.get("top", 2000)}
        assert len(got) == len(set(got)) and set(got) == brute(rows, **keys)


def test_products_beyond_64_bits_are_exact(spark):
    rows = [("en", "p q. p q. p z")] * 7
    scale = 10**16 + 1
    assert set(rows_of(collocations.collocations(made(spark, rows), least=2, scale=scale))) == brute(rows, least=2, scale=scale)


def test_no_rows_and_no_words(spark):
    assert rows_of(collocations.collocations(made(spark, []))) == []
    assert rows_of(collocations.collocations(made(spark, [("en", None), ("en", "!?")]))) == []


def test_sequences_pack_and_unpack():
    rng = np.random.default_rng(3)
    for n, m in ((0, 0), (1, 0), (7, 3), (1000, 400)):
        ids, numbers = rng.integers(0, 1 << 31, n).astype(np.int32), rng.integers(-1, 1 << 62, m)
        got = collocations._unpack(collocations._pack(ids, numbers))
        assert (got[0] == ids).all() and (got[1] == numbers).all() and len(got[0]) == n and len(got[1]) == m


def test_both_sides_of_an_index_extend_alike():
    rng = np.random.default_rng(2)
    ids = np.concatenate([[0], *[np.append(rng.integers(1, 6, rng.integers(1, 30)), 0) for _ in range(40)]]).astype(np.int32)
    index = collocations.WordIndex(ids, 4)

    def counted(k):
        return Counter(tuple(ids[i : i + k].tolist()) for i in range(len(ids) - k + 1) if (ids[i : i + k] > 0).all())

    low, back, n, _ = index.phrases(np.flatnonzero(ids), 1)
    for k in (2, 3, 4):
        right, left = index.extend_right(low, back, n), index.extend_left(low, back, n)
        for new in (right, left):
            begin = index.forward.order[new[0]]
            assert dict(zip([tuple(ids[b : b + k].tolist()) for b in begin], new[2].tolist())) == counted(k)
            # the backward interval holds the same phrases, from their ends
            ends = len(ids) - 1 - index.back.order[new[1]]
            assert [tuple(ids[e - k + 1 : e + 1].tolist()) for e in ends] == [tuple(ids[b : b + k].tolist()) for b in begin]
        low, back, n = (right if k % 2 else left)[:3]
