"""Corpus pipeline: documents in a known language, one of each group of near copies, no benchmark leaks, personal data masked, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plotwise.llm.common import stored
from plotwise.llm.decontaminate import without_leaks
from plotwise.llm.language import fit, in_known_language
from plotwise.llm.packing import pack
from plotwise.llm.pii import without_personal_data
from plotwise.llm.queries import BYTE_BPE, PIECES
from plotwise.llm.simhash import one_of_each
from plotwise.sources.readers import table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_known_language(docs, fit(docs, PIECES))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, BYTE_BPE, end_id=0)


STAGES = [
    ("language", known_language),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Language models, fingerprints and packing are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
