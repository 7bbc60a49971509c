"""Written intermediate tables and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.session import scratch_dir

#: A side of a join is broadcast only if it was counted at no more rows than this; the rows are ids, hashes and numbers.
MAX_BROADCAST_ROWS = 500_000


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again: the lineage ends there."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows, marked for broadcast if they are few; else a join with them shuffles."""
    rows = df.limit(MAX_BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(doc_id: str = "doc_id"):
    """The remainder that parts training rows (not 0) from held-out ones (0)."""
    return F.crc32(F.col(doc_id).cast("string")) % 5
