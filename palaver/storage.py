"""Folders of tables: what is there, what a reader may take, and removal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palaver.session import path_missing


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*columns)


def read_if_there(spark: SparkSession, path: str, source: str, schema: StructType) -> DataFrame:
    """Rows below ``path``; none where the folder does not exist yet."""
    try:
        return spark.read.format(source).schema(schema).load(path)
    except AnalysisException as error:
        if path_missing(error):
            return no_rows(spark, schema)
        raise


def _folder(spark: SparkSession, path: str):
    # Hadoop's file systems, as Spark's readers see them; Spark itself has no call that lists or removes.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none where it does not exist."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(found.getPath().getName() for found in files.listStatus(folder) if found.isDirectory())


def is_there(spark: SparkSession, path: str) -> bool:
    files, found = _folder(spark, path)
    return files.exists(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def newest_generation(spark: SparkSession, snapshots: str) -> int | None:
    """The highest ``generation=<n>`` of a folder of snapshots that was written to its end."""
    numbers = sorted((int(name.partition("=")[2]) for name in subfolders(spark, snapshots)), reverse=True)
    return next((n for n in numbers if is_there(spark, f"{snapshots}/generation={n}/_SUCCESS")), None)


class GenerationLog:
    """A small table of JSON rows as a snapshot and appended changes; folding makes the next generation.

    A generation counts once its snapshot is complete, so one that broke off leaves the old one in force. The last two
    generations stay: readers that have begun with the old one can end.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def snapshot(self, generation: int) -> str:
        return f"{self.path}/snapshots/generation={generation}"

    def changes(self, generation: int) -> str:
        return f"{self.path}/changes/generation={generation}"

    def generation(self) -> int | None:
        return newest_generation(self.spark, f"{self.path}/snapshots")

    def start(self, generation: int, rows: DataFrame) -> None:
        rows.limit(0).write.mode("overwrite").json(self.changes(generation))
        rows.coalesce(1).write.mode("overwrite").json(self.snapshot(generation))

    def append(self, rows: DataFrame) -> None:
        """One file, so that readers see all of the rows or none."""
        rows.coalesce(1).write.mode("append").json(self.changes(self.generation()))

    def fold(self, every: int, rows: Callable[[], DataFrame]) -> None:
        """Start a generation with ``rows`` if there were so many changes since the last one."""
        generation = self.generation()
        if len(self.spark.read.schema("_ string").json(self.changes(generation)).inputFiles()) < every:
            return
        self.start(generation + 1, rows())
        for old in (self.snapshot(generation - 1), self.changes(generation - 1)):
            remove_folder(self.spark, old)
