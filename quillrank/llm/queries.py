"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import decontamination, divergence, filter_audit, gated_lm, golay_simhash, licenses, ngram_join, packing, pii, quality_rules, token_counts, toxicity, warc_zip
from quillrank.llm.common import table

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"
#: For the registered query only; a user passes a key of their own, from a secret store.
PII_KEY = "example-key"


def op1_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Documents that contain a test item, each with its item, best passage, score and overlaps."""
    return decontamination.find_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op2_pii_surrogates(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text with its mentions replaced, and their number."""
    return pii.replace_pii(table(spark, d, "documents").select("doc_id", "text"), PII_KEY)


def op3_concatenate_and_cut(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, d, "documents"), public_tokenizers.path(WORD_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_warc_zip(spark: SparkSession, d: str) -> DataFrame:
    """All pages written as WARC records in ZIP packages and read back by range."""
    return warc_zip.read_packages(warc_zip.write_packages(table(spark, d, "pages")))


def op8_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard of at least 0.85."""
    return ngram_join.ngram_components(table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_toxicity_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity score of every document, with the examples it comes from."""
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_gated_language_model(spark: SparkSession, d: str) -> DataFrame:
    """Log10 probability of every document by the unigram base and by the gated model."""
    return gated_lm.document_scores(table(spark, d, "documents"))


def op7_license_minhash(spark: SparkSession, d: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan_licenses(table(spark, d, "documents"))


def op9_quality_isolation_forest(spark: SparkSession, d: str) -> DataFrame:
    """Base rules and the isolation forest's verdict on every document."""
    return quality_rules.quality_rules(table(spark, d, "documents"), table(spark, d, "labels"))


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every document by the 32k piece model."""
    return token_counts.token_counts(table(spark, d, "documents"), public_tokenizers.path(PIECE_BPE))


def op11_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    """Each source's divergence from its language's other sources, and its leading terms."""
    return divergence.source_divergence(table(spark, d, "documents"))


def op12_golay_simhash(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in four bits at most."""
    return golay_simhash.simhash_components(table(spark, d, "documents"))


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    """What each of the 120 orders of five filters removes, per language and step."""
    return filter_audit.filter_audit(table(spark, d, "documents"), table(spark, d, "labels"))


QUERIES = {f.__name__: f for f in [op1_benchmark_decontamination, op2_pii_surrogates, op3_concatenate_and_cut, op4_warc_zip, op5_toxicity_neighbours,
                                   op6_gated_language_model,                                   op7_license_minhash, op8_ngram_jaccard_join,
                                   op9_quality_isolation_forest, op10_token_counts, op11_source_divergence, op12_golay_simhash, op13_filter_audit]}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"


def jaccard_sql(docs: str, k: int, num: int, den: int) -> str:
    """CTEs ``comp(doc_id, n, component_id)``: the n-gram join over ``docs(doc_id, text)``."""
    return f"""
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM {docs}),
grams AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) END AS g FROM words),
sizes AS (SELECT doc_id, len(g) AS n FROM grams),
sets AS (SELECT g, min(doc_id) AS rep, len(g) AS n FROM (SELECT doc_id, list_sort(g) AS g FROM grams) WHERE len(g) > 0 GROUP BY g),
item AS (SELECT rep, n, unnest(g) AS h FROM sets),
common AS (SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS c FROM item a JOIN item b ON a.h = b.h AND a.rep < b.rep
    AND {den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n) GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE {den} * c >= {num} * (na + nb - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT rep AS a, rep AS b FROM sets UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
root AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a),
member AS (SELECT d.doc_id, s.rep FROM (SELECT doc_id, list_sort(g) AS g FROM grams) d JOIN sets s ON d.g = s.g),
comp AS (SELECT s.doc_id, s.n, coalesce(r.component_id, s.doc_id) AS component_id
    FROM sizes s LEFT JOIN member m ON s.doc_id = m.doc_id LEFT JOIN root r ON m.rep = r.rep)"""


SQL = {
    "op11_source_divergence": divergence.divergence_sql(),
    "op13_filter_audit": filter_audit.audit_sql(),
    "op7_license_minhash": licenses.scan_sql(),
    "op8_ngram_jaccard_join": f"WITH RECURSIVE {jaccard_sql('documents', 4, 85, 100)} SELECT doc_id, n::BIGINT AS n_shingles, component_id FROM comp",
    "op4_warc_zip": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS hex FROM pages),
best AS (SELECT hex, max(page_id) AS best FROM p GROUP BY hex)
SELECT p.page_id, octet_length(b)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(p.hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest,
    CASE WHEN p.page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN p.page_id < best THEN best END AS refers_to
FROM p JOIN best USING (hex)""",
}
