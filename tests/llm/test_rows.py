"""The pipeline's decisions hold for each row, whatever its id."""

from collections import Counter

import corpus_pipeline
from tracewell.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FILL = "plain words that fill the text of this document up to more than twenty words so that no weight is halved here at all today"


def frame(spark, rows, path):
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], SCHEMA).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_mix_decides_row_by_row(spark, tmp_path):
    rows = [(None, f"null{k} {FILL}", "a") for k in range(4)] + [(7, f"seven{k} {FILL}", "a") for k in range(3)] + [(k, f"b{k} {FILL}", "b") for k in range(20, 40)]
    docs = frame(spark, rows, tmp_path / "documents.parquet")
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"]] += r["copies"]
    got = corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in got) == +want and want[None] > 0 and want[7] > 0
    each = Counter(r["text"] for r in got)
    # epochs of all rows of source a, and one more for some of them
    assert all(each[t] in (2, 3) for i, t, _ in rows if i in (None, 7))


def test_repeated_and_null_ids_drop_row_by_row(spark, tmp_path):
    same, other = f"one {FILL}", " ".join(f"other{k}" for k in range(40))
    leak = " ".join(f"leak{k}" for k in range(30))
    docs = frame(spark, [(1, same, "a"), (1, same, "a"), (None, same, "a"), (None, other, "a"), (None, other, "a"), (1, " ".join(f"third{k}" for k in range(40)), "a")], tmp_path / "documents.parquet")
    left = sorted((str(r["doc_id"]), r["text"][:5]) for r in corpus_pipeline.remove_near_duplicates(spark, docs, str(tmp_path)).collect())
    assert left == [("1", "one p"), ("1", "third"), ("None", "other")]
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, [(None, leak, "a"), (None, other, "a"), (1, leak, "a"), (1, same, "a")], tmp_path / "more.parquet")
    assert sorted(r["text"] for r in corpus_pipeline.remove_leaks(spark, docs, str(tmp_path)).collect()) == sorted([other, same])


def test_clashing_names_and_interleaved_calls(spark, tmp_path):
    leak = " ".join(f"leak{k}" for k in range(30))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    tables = []
    for n in range(2):
        held = [(k, f"t{n} {k} {FILL}", "en", "a", 1, f"r{k}", f"c{k}", k) for k in range(5)] + [(9, leak, "en", "a", 1, "r", "c", 9)]
        spark.createDataFrame(held, f"{SCHEMA}, _row string, _copies string, item_id long").write.parquet(str(tmp_path / f"d{n}.parquet"))
        tables.append(spark.read.parquet(str(tmp_path / f"d{n}.parquet")))
    # results of one table are read after the stage has run on another
    first, second = (corpus_pipeline.remove_leaks(spark, docs, str(tmp_path)) for docs in tables)
    for n, left in enumerate((first, second)):
        assert left.columns == tables[n].columns
        assert sorted((r["doc_id"], r["_row"], r["_copies"], r["item_id"], r["text"][:2]) for r in left.collect()) == [(k, f"r{k}", f"c{k}", k, f"t{n}") for k in range(5)]
    mixed = corpus_pipeline.mix_sources(spark, tables[0], str(tmp_path))
    assert mixed.columns == tables[0].columns and {r["_copies"] for r in mixed.collect()} <= {f"c{k}" for k in range(5)} | {"c"}
    left = corpus_pipeline.remove_near_duplicates(spark, tables[0], str(tmp_path))
    assert left.columns == tables[0].columns and "r" in {r["_row"] for r in left.collect()}
