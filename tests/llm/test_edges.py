"""Every operator and stage over nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tracewell.llm import decontaminate, exact, lines, mixing, pii, resampling, simhash, tokens, toxicity, warc
from tracewell.llm.common import scratch_path
from tracewell.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, fp long, n_lines long, id long, batch int, maybe boolean, label boolean, _count int"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "same text here for all", "en", "a"),
    (2, "same text here for all", "en", "a"),
    (2, "same text here for all", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "   \n\t ", "en", "b"),
    (None, "text without an id", "en", "b"),
    (None, None, "en", None),
    (6, LONG, "en", "c"),
    (7, LONG, "en", "c"),
    (8, "né à Łódź 😀\nline\nLINE \n", "fr", "é"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), *[None] * 8) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (6, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def ids(df, col="doc_id"):
    return sorted(str(r[col]) for r in df.collect())


ALL = sorted(str(r[0]) for r in ROWS)


def test_lines(docs, none):
    got = lines.dedup_lines(docs, min_docs=3)
    assert ids(got) == ALL and lines.dedup_lines(none).count() == 0
    by = {(r["doc_id"], r["n_lines"]): r for r in got.collect()}
    assert by[(1, 1)]["n_dropped"] == 1 and by[(1, 1)]["text"] == ""
    assert by[(3, 1)]["n_dropped"] == 0 and by[(5, 2)]["text"] == "   \n\t "
    assert by[(8, 4)]["text"] == ROWS[-1][1]
    assert {r["n_dropped"] for r in lines.dedup_lines(docs, min_docs=1).where("doc_id = 8").collect()} == {3}


def test_line_runs_merge_without_a_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        runs = lines.LineRuns(spark, min_docs=3, fanout=2, buckets=4)
        batch = lambda *counts: runs.dealt(spark.createDataFrame([(h, -h) for h, n in counts for _ in range(n)], "h1 long, h2 long"))
        runs.add(batch((1, 3), (2, 1), (3, 2)))
        fresh = runs.unsettled(batch((1, 5), (2, 2), (4, 1)))
        assert sorted(tuple(r) for r in fresh.collect()) == [(2, -2, 2), (4, -4, 1)]
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        # the batch is dealt once; the run is read in its buckets
        assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 1
        runs.add(batch((1, 5), (2, 2), (4, 1)))
        a, b = (lines.LineRuns(spark, 3, 9, 4) for _ in range(2))
        a.add(batch((7, 1)))
        b.add(batch((7, 2), (8, 1)))
        both = lines.LineRuns.merged(a.tables()[0], b.tables()[0])
        assert sorted(tuple(r) for r in both.collect()) == [(7, -7, 3), (8, -8, 1)] and "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        assert [len(level) for level in runs.levels] == [0, 1]
        assert sorted(r["h1"] for r in runs.frequent().collect()) == [1, 2]
        again = lines.LineRuns.open(spark, runs.path)
        again.add(batch((4, 2)))
        assert sorted(r["h1"] for r in again.frequent().collect()) == [1, 2, 4]
        for r in (again, a, b):
            r.discard()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("dropped", [[], [0], [4], [0, 1, 2, 3, 4], [1, 3], [2]])
def test_lines_without_some(spark, dropped):
    df = spark.createDataFrame([(list("abcde"), dropped)], "lines array<string>, dropped array<int>")
    assert df.select(lines.without(F.col("lines"), F.col("dropped")).alias("x")).first()["x"] == [c for i, c in enumerate("abcde") if i not in dropped]


def test_simhash(docs, none):
    got = {}
    for r in simhash.near_duplicates(docs).collect():
        got.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert got[1] == got[2] and {c for _, c in got[1]} == {1}
    assert got[3] == got[4] == got[5] == {(0, 3)} and (0, 3) in got[None]
    assert {c for _, c in got[7]} == {6}
    assert simhash.near_duplicates(none).count() == 0 and simhash.near_duplicates(docs).count() == len(ROWS)


def test_mixing(docs, none):
    got = mixing.mix(docs)
    assert ids(got) == ALL and mixing.mix(none).count() == 0
    for r in got.collect():
        assert 0 <= r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-9
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(docs.where("source is null")).count() == 2


def test_resampling(docs, none, labels):
    got = resampling.resample(docs, labels, share=1.0)
    assert ids(got) == ALL
    assert resampling.resample(docs, labels, share=0.5).count() == round(0.5 * len(ROWS))
    assert resampling.resample(docs, labels.limit(0)).count() == len(ROWS)
    assert resampling.resample(none, labels).count() == 0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, "same text here for all"), (2, None), (3, ""), (4, "!!!"), (5, "Same  TEXT, here for all")], "item_id int, text string")
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.contaminated(docs, items).collect())
    assert got == sorted([(d, i, 0) for d in (1, 2, 2) for i in (1, 5)])
    assert decontaminate.contaminated(none, items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0
    parted = decontaminate.contaminated(docs, items, part_items=1)
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in parted.collect()) == got


def test_pii(docs, none):
    got = pii.span_digests(pii.find_spans(docs))
    assert ids(got) == ALL and {r["spans"] for r in got.collect()} == {""}
    assert {r["base_sha256"] for r in got.collect()} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find_spans(none).count() == 0


def test_exact(docs, none):
    got = exact.exact_duplicates(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ALL and exact.exact_duplicates(none).count() == 0
    groups = {}
    for r in got:
        groups.setdefault(r["text_sha256"], []).append(r)
    for group in groups.values():
        assert sum(r["kept"] for r in group) == 1 and {r["group_size"] for r in group} == {len(group)}
        known = [r["doc_id"] for r in group if r["doc_id"] is not None]
        assert {r["keep_id"] for r in group} == {max(known, default=None)}
    assert len(groups) == 6


def test_bloom_lets_every_repeat_through(spark):
    rows = spark.range(4000).select(F.col("id"), F.sha2((F.col("id") % 3000).cast("string"), 256).alias("h"))
    assert exact.filter_size(4000) == (1, 1 << 16) and exact.filter_size(10**9, 1 << 30) == (15, 1 << 30) and exact.filter_size(0)[0] == 1
    sizes = {}
    for size in (None, (1, exact.BLOCK), (3, exact.BLOCK), (1, exact.BLOCK * 4)):
        found = exact.maybe_repeated(rows, "h", size)[0].cache()
        maybe = {r["id"] for r in found.where("maybe").collect()}
        assert set(range(1000)) | set(range(3000, 4000)) <= maybe and found.count() == 4000
        sizes[size] = len(maybe)
    assert sizes[(1, exact.BLOCK * 4)] < 2050 and sizes[(3, exact.BLOCK)] < 2100 and sizes[None] < 2300


def test_hot_texts_are_joined_where_they_are(spark, monkeypatch):
    from tracewell.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 50)
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 200)).alias("text"))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(docs).collect()}
    assert len(got) == 600 and all(got[i] == (299, 300, i == 299) for i in range(300))
    same = lambda i: [j for j in range(300, 600) if j % 200 == i % 200]
    assert all(got[i] == (max(same(i)), len(same(i)), i == max(same(i))) for i in range(300, 600))


def test_tokens(spark, docs, none):
    path = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(docs, path, tokenizer_file(), shards=3)
    keys = tokens.keys_of(docs)
    got = sorted((r.asDict() for r in tokens.read_tokens(tokens.locate(keys, path), path, digest_only=False).collect()), key=lambda r: r["start"])
    assert [str(r["id"]) for r in got] == ["None", "None", "1", "2", "2", *map(str, range(3, 9))]
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    assert at == sum(s["ids"] for s in manifest["shards"])
    assert [r["n_tokens"] for r in got if r["id"] in (3, 4)] == [1, 1]
    foreign = spark.createDataFrame([(99, 0), (1, 5)], "id long, repetition long")
    assert tokens.locate(foreign, path).count() == 0
    empty = scratch_path(spark, "tokens")
    tokens.write_tokens(none, empty, tokenizer_file())
    assert tokens.read_tokens(tokens.locate(keys, empty), empty).count() == 0


def test_warc(spark):
    schema = "page_id long, url string, html string, id long, kind int, h string"
    pages = spark.createDataFrame([(1, "http://a/é b", "same", 0, 0, ""), (2, None, "same", 0, 0, ""), (2, "u", "same", 0, 0, ""), (3, "u", None, 0, 0, ""), (4, "u", "", 0, 0, ""), (None, "u", "née 😀", 0, 0, ""), (5, "u", "x" * 300_000, 0, 0, "")], schema)
    path = scratch_path(spark, "warc")
    files = warc.write_warc(pages, path, roll_bytes=600, shards=2)
    got = sorted(((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_warc(spark, path).collect()))
    assert got == [("1", "revisit", 2, 4), ("2", "response", None, 4), ("2", "revisit", 2, 4), ("3", "revisit", 4, 0), ("4", "response", None, 0), ("5", "response", None, 300_000), ("None", "response", None, 9)]
    assert len(files) > 2 and sum(f["records"] for f in files) == 7
    again = scratch_path(spark, "warc")
    assert warc.write_warc(pages.repartition(3), again, roll_bytes=600, shards=2) == files
    texts = {r["payload"] for r in warc.read_warc(spark, path, payload=True).collect()}
    assert texts == {None, "same", "", "née 😀", "x" * 300_000}
    large = scratch_path(spark, "warc")
    warc.write_warc(pages, large, min_revisit_bytes=5)
    assert {r["record_type"] for r in warc.read_warc(spark, large).collect()} == {"response"}
    empty = scratch_path(spark, "warc")
    assert warc.write_warc(pages.limit(0), empty) == [] and warc.read_warc(spark, empty).count() == 0


def test_toxicity(docs, none, labels):
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model)
    assert ids(got) == ALL and all(0 <= r["score"] <= 1 for r in got.collect())
    assert toxicity.score(none, model).count() == 0
    flat = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, flat).collect()} == {0.5}


def test_pipeline_over_edge_rows(spark, docs, none, labels, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, table in (("full", plain), ("empty", plain.limit(0))):
        sf = tmp_path / name
        table.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, "né à Łódź line line")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        current = spark.read.parquet(f"{sf}/documents.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1]:
            f(spark, current, str(sf)).write.parquet(f"{sf}/{stage}")
            current = spark.read.parquet(f"{sf}/{stage}")
            assert current.columns == plain.columns
            if stage == "benchmark_decontamination":
                left = [str(r["doc_id"]) for r in current.collect()]
        out = corpus_pipeline.STAGES[-1][1](spark, current, str(sf))
        assert out.count() == current.count()
        if name == "full":
            assert "8" not in left and "1" in left and "2" not in left
