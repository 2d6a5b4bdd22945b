"""The registered queries of this subpackage and the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, exact, lines, minhash, mixing, pii, resampling, simhash, tokens, toxicity, warc, whitening
from .common import scratch_path

#: Keys in at least this many documents lose their lines.
LINE_DOCS = 10
#: The end id of each document's token ids.
END_ID = 2
#: A score from which on a text is predicted toxic.
TOXIC = 0.7
#: Labels are learned from rows whose CRC-32 of the id leaves another remainder than 1.
FOLDS = 3
#: Phrases that occur at least so often are candidates; so many of each language are reported.
PHRASE_COUNT, PHRASES = 30, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 1


def op1_line_dedup(spark, sf_dir):
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"), min_docs=LINE_DOCS, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), n=3, most_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii_spans(spark, sf_dir):
    return pii.span_digests(pii.find_spans(table(spark, sf_dir, "documents")))


def op7_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_token_output(spark, sf_dir):
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, tokenizer_file(), END_ID)
    found = tokens.read_tokens(tokens.locate(tokens.keys_of(docs), path), path)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_warc_archive(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    return warc.read_warc(spark, path)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op11_embedding_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), k=8)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), least=PHRASE_COUNT, top=PHRASES)


def op13_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=3, similarity=0.85)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_source_mixing": op3_source_mixing,
        "op4_quality_resampling": op4_quality_resampling,
        "op5_benchmark_decontamination": op5_benchmark_decontamination,
        "op6_pii_spans": op6_pii_spans,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_token_output": op8_token_output,
        "op9_warc_archive": op9_warc_archive,
        "op10_toxicity": op10_toxicity,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_minhash_near_dedup": op13_minhash_near_dedup,
        "pipeline": pipeline,
    }


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = f"translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = f"""
WITH rows AS (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
parts AS (SELECT doc_id, row, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM rows),
keyed AS (SELECT *, {_KEY} AS key FROM parts),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= {LINE_DOCS}),
marked AS (SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row
"""

_OP3 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, coalesce(text, '') AS text
  FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / ((CASE WHEN length(text) / greatest(size, 1) BETWEEN 4 AND 11 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)
            * (CASE WHEN size >= 20 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM k GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place,
         sum(source_size) OVER ()
            - coalesce(sum(3.0 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER ()
            - coalesce(sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_weight
  FROM s),
l AS (SELECT arg_min(rest::DOUBLE / rest_weight, place) FILTER (rest::DOUBLE / rest_weight * weight <= 3.0 * source_size) AS level FROM r),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, level * weight) AS target FROM s, l),
o AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 1 END AS epochs
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN spent + size / 2 <= target - epochs * source_size AND epochs < 3 AND source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""

_OP7 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

_OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h
"""

_OP12 = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
        FROM w, (VALUES (1), (2), (3), (4)) lengths(k) WHERE len(ws) >= k)
  GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
t AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM g WHERE f >= {PHRASE_COUNT}),
c AS (
  SELECT t.lang, t.phrase, t.f AS a, cut.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * t.f) // (x.f::HUGEINT + y.f) AS score
  FROM t, (VALUES (1), (2), (3)) cut(cut), t x, t y
  WHERE cut.cut < t.k AND x.lang = t.lang AND y.lang = t.lang
    AND x.phrase = array_to_string(t.ws[:cut.cut], ' ') AND y.phrase = array_to_string(t.ws[cut.cut + 1:], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
s AS (
  SELECT t.lang, array_to_string(t.ws[i.i:i.i + w.w - 1], ' ') AS phrase, max(t.f) AS longer
  FROM t, (VALUES (2), (3)) w(w), (VALUES (1), (2), (3)) i(i) WHERE w.w < t.k AND i.i + w.w - 1 <= t.k GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n.n, score::BIGINT AS score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN s ON s.lang = b.lang AND s.phrase = b.phrase
WHERE s.longer IS NULL OR 100 * s.longer::HUGEINT < 80 * a::HUGEINT
QUALIFY rank <= {PHRASES}
"""


def oracle_sql():
    return {"op1_line_dedup": _OP1, "op3_source_mixing": _OP3, "op7_exact_dedup": _OP7, "op9_warc_archive": _OP9, "op12_phrase_collocations": _OP12}
