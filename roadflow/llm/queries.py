"""The registered queries of this subpackage: each applies one operator to its whole table.

A query derives the digest columns that are compared; the operators keep their own outputs (texts, spans,
files).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm import alignment, contamination, licenses, line_quality, mixing, ngram_lm, order_minhash, pii, recompression, simhash, toxicity, warc, whitening
from roadflow.llm.common import table


def op1_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by pattern, and the terms near it that disclose it."""
    return pii.span_report(table(spark, sf_dir, "documents"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness."""
    return order_minhash.edited_likeness(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the pattern grammar, learned from the labels that are not held out."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 3-word shingles, linked at 2 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, and the output shards that its slots were drawn to."""
    taken = mixing.taken_words(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", "n_slots", "first_shard", "last_shard")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, paragraphs and lines that are a known licence."""
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op7_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows of 50 words that also start in a document with a smaller id."""
    return recompression.removal_report(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 10 item words found in documents."""
    found = contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean log score of every document's words."""
    found = ngram_lm.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_unigram", F.round("score", 6).alias("score"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to a content-addressed archive and read back."""
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the labels a random field gives its lines."""
    return line_quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers, weighed by how many documents hold them."""
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on their leading principal components, each of variance one."""
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_sanitisation,
        op2_order_minhash,
        op3_toxicity,
        op4_simhash_near_dedup,
        op5_source_mixing,
        op6_license_scan,
        op7_recompression_dedup,
        op8_benchmark_decontamination,
        op9_stupid_backoff,
        op10_warc,
        op11_line_quality,
        op12_cross_tokenizer_alignment,
        op13_embedding_whitening,
        pipeline,
    )
}
