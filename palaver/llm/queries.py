"""The registered queries: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import language, quality_model, toxicity
from palaver.llm.decontaminate import contamination
from palaver.llm.mixing import mix_sources
from palaver.llm.near import near_duplicates
from palaver.llm.negatives import hard_negatives, whole
from palaver.llm.repeats import remove_repeats
from palaver.llm.rules import quality_rules
from palaver.llm.spelling import NOISE, spelling_groups
from palaver.llm.surrogates import pseudonymise
from palaver.llm.tables import crc_fold, maybe_broadcast, table
from palaver.llm.warc import read_archives, write_archives
from palaver.llm.wrappers import main_text


#: Of the registered query; a real corpus takes a secret one.
SURROGATE_KEY = "example key"


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages"))
    records = read_archives(spark, files)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.filter(crc_fold() != 0).select("doc_id", "quality")
    model = quality_model.learn(docs.select("doc_id", "text").join(maybe_broadcast(known), "doc_id"))
    scored = quality_model.score(docs, model)
    return scored.select("doc_id", (crc_fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.filter(crc_fold() != 0))
    return language.identify(docs, model).select("doc_id", (crc_fold() == 0).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, key=SURROGATE_KEY)


def op5_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.filter(crc_fold() != 0))
    return toxicity.severity(docs, model).withColumn("held_out", crc_fold() == 0)


def op6_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    return quality_rules(table(spark, sf_dir, "documents")).select(*columns)


def op9_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), keep=("doc_id", "source"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), whole(F.col("embedding")).alias("vector")
    )
    mined = hard_negatives(vectors, F.col("vec_id") % 100 == 0)
    return mined.withColumn("rank", F.col("rank").cast("int"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), noise=NOISE)


def op13_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_salvage, op2_quality_discriminant, op3_language_spans, op4_surrogates, op5_toxicity_severity,
        op6_repeated_windows, op7_near_duplicates, op8_weak_supervision, op9_source_mixture, op10_decontamination,
        op11_hard_negatives, op12_spelling_variants, op13_wrapper_induction,
    )
}
