"""The views as landed rows and stored tables of the library."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.archive import Archive, ArchiveConfig
from palaver.session import scratch_dir
from palaver.sources.landed import read_lines
from palaver.streaming.live import start_feed
from workbench.views import MESSAGE_COLUMNS, spark_views

REDELIVERED_FROM = 1_000_000_000_000_000


@lru_cache(maxsize=64)
def _view(spark: SparkSession, sql: str) -> DataFrame:
    """The analyzed plan of a view is kept, its rows are not."""
    return spark.sql(sql)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        # The given event times have no zone and mean UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def view(self, name: str, columns: str = "*") -> DataFrame:
        return _view(self.spark, f"{spark_views(self.sf_dir, name)}select {columns} from {name}")

    def messages(self) -> DataFrame:
        """Landed messages as the parser would deliver them."""
        return self.view("wire").select(
            F.col("id").cast("string").alias("id"),
            F.col("guild_id").cast("string").alias("guild_id"),
            F.col("channel_id").cast("string").alias("channel_id"),
            F.col("author_id").cast("string").alias("author_id"),
            F.col("webhook_id").cast("string").alias("webhook_id"),
            F.timestamp_millis("edited_raw_ms").alias("edited_timestamp"),
            F.col("flags").cast("bigint").alias("flags"),
            *"username global_name discriminator avatar bot author_json content tts pinned kind "
            "mentions attachments embeds components reactions message_reference arrival_seq "
            "raw_json".split(),
        )

    def guilds(self) -> DataFrame:
        return self.view("guild_wire").select(
            F.col("id").cast("string").alias("id"),
            "name",
            F.col("owner_id").cast("string").alias("owner_id"),
            *"icon features arrival_seq raw_json".split(),
        )

    def channels(self) -> DataFrame:
        return self.view("channel_wire").select(
            F.col("id").cast("string").alias("id"),
            F.col("guild_id").cast("string").alias("guild_id"),
            F.col("parent_id").cast("string").alias("parent_id"),
            *"name kind topic nsfw position arrival_seq raw_json".split(),
        )

    def archive(self) -> DataFrame:
        """The messages that a pass finds stored."""
        return self.view("archive", MESSAGE_COLUMNS)

    def all_messages(self) -> DataFrame:
        return self.view("all_messages", MESSAGE_COLUMNS)

    def spoken(self) -> DataFrame:
        """Landed messages from real prose."""
        return self.view("spoken").withColumn("webhook_id", F.lit(None).cast("string"))

    def land(self, lines: DataFrame, folder: str) -> str:
        """Write ``lines`` (one text column) as landed files below ``folder``."""
        lines.toDF("value").write.mode("append").text(folder)
        return folder

    def lines(self, view: str, column: str) -> DataFrame:
        """Lines of a view, landed as files and read back."""
        folder = self.land(self.view(view, column), scratch_dir(self.spark, view))
        return read_lines(self.spark, folder)

    def spoken_lines(self) -> DataFrame:
        record = F.struct(
            F.col("id").cast("string").alias("id"),
            F.col("channel_id").cast("string").alias("channel_id"),
            F.struct(F.col("channel_id").cast("string").alias("id"), "bot").alias("author"),
            "content",
            "arrival_seq",
        )
        folder = scratch_dir(self.spark, "spoken")
        self.land(self.view("spoken").select(F.to_json(record)), folder)
        return read_lines(self.spark, folder)

    def seed(self, archive: Archive) -> Archive:
        archive.upsert_guilds(self.view("guild_stored"))
        archive.upsert_channels(self.view("channel_stored"))
        archive.upsert_users(self.view("users_target"))
        archive.messages.append(self.archive())
        return archive

    def compacted(self) -> Archive:
        """All messages, stored in three batches with days compacted along the way."""
        archive = Archive(self.spark, scratch_dir(self.spark, "archive")).bootstrap()
        archive.messages.fan_in = 2
        rows = self.all_messages().withColumn("arrival_seq", F.lit(0).cast("bigint"))
        for batch in range(3):
            archive.insert_messages(rows.where(F.pmod(F.xxhash64("id"), F.lit(3)) <= batch))
        return archive

    def streamed(self, seeded: bool) -> Archive:
        """The message feed in two waves, each a run that continues from the checkpoint."""
        root = scratch_dir(self.spark, "archive")
        config = ArchiveConfig(landing=f"{root}/landing", root=f"{root}/tables", max_files_per_trigger=4)
        archive = Archive(self.spark, config.root).bootstrap()
        if seeded:
            self.seed(archive)
        lines = self.view("dirty", "line, arrival_seq")
        for wave in (F.col("arrival_seq") < REDELIVERED_FROM, F.col("arrival_seq") >= REDELIVERED_FROM):
            # A wave holds each id at most once, so the way it splits into batches cannot matter.
            self.land(lines.where(wave).select("line"), f"{config.landing}/messages")
            start_feed(archive, config, "messages", once=True).awaitTermination()
        return archive
