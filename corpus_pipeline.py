"""Corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import kept_in_files, read_table, small_batches
from millrace.llm.decontamination import remove_contaminated
from millrace.llm.line_dedup import remove_repeated_lines
from millrace.llm.packing import pack, write_buckets
from millrace.llm.quality_rules import remove_rejected
from millrace.llm.simhash import keep_one_of_each
from millrace.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    return remove_rejected(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated lines."""
    small_batches(spark)
    return remove_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold benchmark passages."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, each a sequence with its ids, in order of length
    in each partition."""
    small_batches(spark)
    return pack(docs).sortWithinPartitions("length")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", apply_quality_rules),
    ("line dedup", dedup_lines),
    ("near-dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: SQL cannot express learned rules, and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again; the
    sequences in a folder for each length."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_in_files(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    packed, path = STAGES[-1][1](spark, docs, sf_dir), work_path(spark, "sequences")
    write_buckets(packed, path)
    return spark.read.schema(packed.schema).parquet(path)
