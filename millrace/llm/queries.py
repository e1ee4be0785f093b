"""Registered queries of this subpackage: the whole table, the fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.archive import archive
from millrace.llm.common import read_table
from millrace.llm.decontamination import find_contamination
from millrace.llm.html_extraction import extract_pages
from millrace.llm.language import identify, train
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.neighbours import nearest
from millrace.llm.packing import pack
from millrace.llm.quality_rules import judge
from millrace.llm.repeated_passages import remove_repeated
from millrace.llm.resampling import resample
from millrace.llm.simhash import near_duplicates
from millrace.llm.toxicity import rate, train as train_toxicity
from millrace.llm.whitening import whiten


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each document and the verdict of the learned rules."""
    judged = judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id", "n_links"
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by a model of those not held out."""
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(docs), with_spans=False)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark in each document."""
    found = find_contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a content-addressed archive."""
    return archive(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document in strings that occur elsewhere."""
    return remove_repeated(read_table(spark, sf_dir, "documents")).drop("spans")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of each document."""
    docs = read_table(spark, sf_dir, "documents")
    return rate(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as power-of-two pieces."""
    return pack(read_table(spark, sf_dir, "documents"), with_ids=False)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, and its text without later copies."""
    found = dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector, among all vectors."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A draw of a tenth of the documents, by likeness to the benchmark."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every vector."""
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_html_extraction": op5_html_extraction,
    "op6_warc": op6_warc,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_nearest": op11_nearest,
    "op12_resampling": op12_resampling,
    "op13_whitening": op13_whitening,
}
