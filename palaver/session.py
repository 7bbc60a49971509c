"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


def recommended_conf(input_bytes: int = 0, cores: int = 8) -> dict[str, str]:
    """Settings for a job that shuffles about ``input_bytes``.

    The shuffle starts with enough partitions for ~128 MB each (at least two per core) and AQE
    merges what turns out small and splits what turns out skewed. Generated methods are kept below
    8,000 bytes of bytecode: the JVM never compiles longer ones, and wide message rows reach that.
    """
    partitions = max(2 * cores, math.ceil(input_bytes / TARGET_SHUFFLE_BYTES))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_SHUFFLE_BYTES),
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.shuffle.partitions": str(partitions),
    }


def configure(builder: SparkSession.Builder, input_bytes: int = 0, cores: int = 8) -> SparkSession.Builder:
    for key, value in recommended_conf(input_bytes, cores).items():
        builder = builder.config(key, value)
    return builder


def path_missing(error: AnalysisException) -> bool:
    """Whether a read failed because its folder does not exist."""
    return error.getCondition() == "PATH_NOT_FOUND"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir`` or, where the session names none, below the warehouse. On a
    cluster a warehouse on the driver's own disk is refused: each executor would write to its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = warehouse.startswith(("file:", "/"))
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{warehouse.rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
