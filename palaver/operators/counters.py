"""Counters of a sync pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.kinds import MESSAGE_BEARING_KINDS
from palaver.functions.scalars import signed_id
from palaver.operators.bounds import channel_bounds
from palaver.operators.filters import is_human
from palaver.operators.joins import lookup_join
from palaver.operators.paging import MESSAGE_PAGE
from palaver.session import scratch_dir


# SQL over a row placed between the bounds of its channel.
BELOW = "lo is null or id < lo"
ABOVE = "id > hi"


def processed_counts(source: DataFrame, archive: DataFrame) -> DataFrame:
    """Per channel: human rows touched by each phase, their sum, and rows really inserted.

    The sweep touches every row again, so ``processed`` counts a row twice when two phases read it.
    ``source`` has one row per message with ``id, channel_id, is_human`` and is read once.
    """
    stored = archive.select("id", F.lit(True).alias("stored"))
    human = source.where("is_human").join(stored, "id", "left")
    counts = lookup_join(human, channel_bounds(archive), "channel_id", "id").groupBy("channel_id").agg(
        F.count_if(F.expr(BELOW)).alias("backfill_processed"),
        F.count_if(F.expr(ABOVE)).alias("catch_up_processed"),
        F.count(F.lit(1)).alias("sweep_processed"),
        F.count_if(F.col("stored").isNull()).alias("inserted"),
    )
    total = F.col("backfill_processed") + F.col("catch_up_processed") + F.col("sweep_processed")
    return counts.withColumn("processed", total)


def page_counts(source: DataFrame, archive: DataFrame, page: int = MESSAGE_PAGE) -> DataFrame:
    """Per channel: non-empty pages each phase reads. Pages hold bot rows too.

    Backfill fills an empty channel first, so its catch-up starts at the newest human row of the source. The source, which is
    needed twice, is read once: its three columns are written to the shared scratch folder.
    """
    path = scratch_dir(source.sparkSession, "flagged")
    flagged = source.select("id", "channel_id", "is_human")
    flagged.write.parquet(path)
    flagged = source.sparkSession.read.schema(flagged.schema).parquet(path)
    newest = flagged.where("is_human").groupBy("channel_id").agg(F.max("id").alias("newest"))
    stored = channel_bounds(archive)
    bounds = stored.join(newest, "channel_id", "full").select("channel_id", "lo", F.coalesce("hi", "newest").alias("hi"))
    rows = lookup_join(flagged, bounds, "channel_id", "id")
    counts = rows.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(F.expr(BELOW)).alias("backfill_rows"),
        F.count_if(F.expr(ABOVE)).alias("catch_up_rows"),
    )
    return counts.select(
        "channel_id",
        "source_rows",
        F.expr(f"(backfill_rows + {page - 1}) div {page}").alias("backfill_pages"),
        F.expr(f"(catch_up_rows + {page - 1}) div {page}").alias("catch_up_pages"),
        F.expr(f"(source_rows + {page - 1}) div {page}").alias("sweep_pages"),
    )


def channel_counts(channels: DataFrame) -> DataFrame:
    """Per guild: channels in all and those that carry messages (projected, one row per id)."""
    return channels.groupBy("guild_id").agg(
        F.count(F.lit(1)).alias("channels"),
        F.count_if(F.col("kind").isin(*MESSAGE_BEARING_KINDS)).alias("message_bearing"),
    )


def guild_counts(guilds: DataFrame, channels: DataFrame) -> DataFrame:
    """Guilds listed, and those whose own record and channel list could be used.

    ``guilds`` holds usable records; ``channels`` the parsed channel records with their ``reject_reason``. A bad channel
    is passed over; a list of which nothing could be used makes the pass over its guild fail.
    """
    listed = guilds.select(F.col("id").try_cast("bigint").alias("id")).distinct()
    failed = (
        channels.groupBy(F.col("guild_id").try_cast("bigint").alias("id"))
        .agg(F.count_if(F.col("reject_reason").isNull()).alias("usable"))
        .where("usable = 0")
    )
    return listed.join(failed, "id", "left").agg(
        F.count(F.lit(1)).alias("guilds_listed"),
        F.count_if(F.col("usable").isNull()).alias("guilds_processed"),
    )


def human_flag(landed: DataFrame) -> DataFrame:
    """``id, channel_id, is_human`` of landed messages."""
    return landed.select(
        signed_id(F.col("id")).alias("id"),
        signed_id(F.col("channel_id")).alias("channel_id"),
        is_human().alias("is_human"),
    )
