"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, mixing, token ids.

Each stage gets what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import decontaminate, mixing, simhash, tokens, toxicity
from tracewell.llm.common import discard, materialize, scratch_path, sweep
from tracewell.llm.queries import END_ID, TOXIC, held_out, table, tokenizer_file


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key of each row, the same in every later read; and the key's name. Ids may be null or repeated.

    A row read from files is known by its file's name and its place in it, so nothing is copied; other tables are written once.
    """
    row = _free(docs, "_row")
    try:
        place = F.concat_ws("#", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))
        return docs.select(place.alias(row), "*"), row
    except AnalysisException:
        rows, _ = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        return rows, row


#: At most so many keys, of some 80 bytes each, are sent to where the rows are; more are joined by a shuffle.
SENT_KEYS = 200_000


def _keep(rows: DataFrame, drop: DataFrame, row: str) -> DataFrame:
    """rows without those whose key drop has, and without the key; drop, a written table, may hold keys more than once.

    Few keys go to the rows, so that no text moves because of them.
    """
    keys = drop.select(row).distinct()
    return rows.join(F.broadcast(keys) if drop.count() <= SENT_KEYS else keys, row, "left_anti").select([F.col(f"`{c}`") for c in rows.columns if c != row])


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    rows, row = _rows(docs)
    model = toxicity.train(rows, table(spark, sf_dir, "labels").where(~held_out()))
    bad, _ = materialize(toxicity.score(rows, model, id_col=row).where(F.col("score") >= TOXIC), "toxic")
    del model
    sweep(spark)
    return _keep(rows, bad, row)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, null ids being the last.

    Shingles take five words. Links are those of fingerprints at 3 or fewer differing bits, and of
    sets of shingles with a similarity of 0.8 or more. Of rows with one id one stays.
    """
    rows, row = _rows(docs)
    found, found_path = materialize(simhash.near_duplicates(rows, id_col=row, n=5, most_bits=3, similarity=0.8), "groups")
    sweep(spark)
    known = found.join(rows.select(row, "doc_id"), row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row")))["row"]
    kept, _ = materialize(known.groupBy("component_id").agg(first.alias(row)).select(row), "kept")
    discard(spark, found_path)
    return rows.join(kept, row, "left_semi").select([F.col(f"`{c}`") for c in docs.columns])


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    rows, row = _rows(docs)
    found, _ = materialize(decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col=row), "leaks")
    return _keep(rows, found, row)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated for repeated epochs, gone if not taken."""
    rows, row = _rows(docs)
    sweep(spark)
    took, _ = materialize(mixing.mix(rows, row_col=row).where("copies > 0").select(row, "copies"), "mix")
    copies = _free(rows, "_copies")
    often = rows.join(took.withColumnRenamed("copies", copies), row)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return often.select(*columns, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(copies)).select(columns)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, written and read back: doc_id, repetition, start, n_tokens, ids_crc32."""
    sweep(spark)
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, tokenizer_file(), END_ID)
    return tokens.read_tokens(tokens.locate(tokens.keys_of(docs), path), path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", remove_near_duplicates),
    ("benchmark_decontamination", remove_leaks),
    ("source_mixing", mix_sources),
    ("token_output", write_ids),
]

#: SQL can express neither the model nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, new = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, *([path] if path else []))  # what the stage before wrote is read no more
        sweep(spark)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)
