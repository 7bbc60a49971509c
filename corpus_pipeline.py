"""A corpus through five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.decontaminate import contamination
from palaver.llm.mixing import mix_sources
from palaver.llm.near import near_duplicates
from palaver.llm.queries import SURROGATE_KEY
from palaver.llm.rules import keep_good
from palaver.llm.surrogates import pseudonymise
from palaver.llm.tables import maybe_broadcast, table, written

#: Weak supervision and similarity sketches are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return keep_good(docs)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; documents without an id stay."""
    return _without(docs, near_duplicates(docs).filter("not kept"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    return _without(docs, contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; n_chars follows the text."""
    replaced = pseudonymise(docs, key=SURROGATE_KEY)
    chars = F.when(F.col("n_replaced") > 0, F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", chars).select(*docs.columns)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them, with pass, slot and n_tokens."""
    return mix_sources(docs)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    gone = written(dropped.select("doc_id").distinct(), "dropped")
    return docs.join(maybe_broadcast(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicate_groups),
    ("decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("source mixture", source_mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
