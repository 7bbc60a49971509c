"""Keyset pages, for one channel or for all channels in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.operators.joins import SALTS, lookup_join

MESSAGE_PAGE = 100
GUILD_PAGE = 200


def page_latest(messages: DataFrame, channel_id: int, limit: int = MESSAGE_PAGE) -> DataFrame:
    """The newest messages of a channel."""
    return _channel(messages, channel_id).orderBy(F.col("id").desc()).limit(limit)


def page_before(
    messages: DataFrame, channel_id: int, before: int, limit: int = MESSAGE_PAGE
) -> DataFrame:
    """The newest messages older than an id."""
    return page_latest(messages.where(F.col("id") < F.lit(before)), channel_id, limit)


def page_after(
    messages: DataFrame, channel_id: int, after: int, limit: int = MESSAGE_PAGE
) -> DataFrame:
    """The oldest messages newer than an id: the page nearest to the cursor."""
    newer = _channel(messages, channel_id).where(F.col("id") > F.lit(after))
    return newer.orderBy("id").limit(limit)


def guild_page_after(
    guilds: DataFrame, after: int | None = None, limit: int = GUILD_PAGE
) -> DataFrame:
    """The guilds that follow an id, in id order; the first page where there is no cursor."""
    rest = guilds if after is None else guilds.where(F.col("id") > F.lit(after))
    return rest.orderBy("id").limit(limit)


def pages_latest(messages: DataFrame, limit: int = MESSAGE_PAGE) -> DataFrame:
    """The newest page of every channel."""
    return _top_per_channel(messages, F.col("id").desc(), limit)


def pages_before(messages: DataFrame, bounds: DataFrame, limit: int = MESSAGE_PAGE) -> DataFrame:
    """The page before ``lo`` of every channel; the newest page where a channel has no bounds."""
    older = lookup_join(messages, bounds.select("channel_id", "lo"), "channel_id", "id")
    older = older.where(F.col("lo").isNull() | (F.col("id") < F.col("lo"))).drop("lo")
    return _top_per_channel(older, F.col("id").desc(), limit)


def pages_after(messages: DataFrame, bounds: DataFrame, limit: int = MESSAGE_PAGE) -> DataFrame:
    """The page after ``hi`` of every channel that has bounds."""
    newer = lookup_join(messages, bounds.select("channel_id", "hi"), "channel_id", "id", "inner")
    newer = newer.where(F.col("id") > F.col("hi")).drop("hi")
    return _top_per_channel(newer, F.col("id").asc(), limit)


def _channel(messages: DataFrame, channel_id: int) -> DataFrame:
    return messages.where(F.col("channel_id") == F.lit(channel_id))


def _top_per_channel(messages: DataFrame, order: Column, limit: int) -> DataFrame:
    """First ``limit`` rows of each channel.

    Ranked within shares of a channel first: with many tasks even ``limit`` rows of a hot channel
    from each of them are too much for one. The second ranking sees ``limit`` rows per share. Both
    limits are also applied before their shuffle (WindowGroupLimit). A share is that of whole input
    partitions, so a task passes on ``limit`` rows of a channel, and the page is the same for any split.
    """
    share = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    in_share = Window.partitionBy("channel_id", "_share").orderBy(order)
    in_channel = Window.partitionBy("channel_id").orderBy(order)
    return (
        messages.withColumn("_share", share)
        .withColumn("_rank", F.row_number().over(in_share))
        .where(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(in_channel))
        .where(F.col("_rank") <= limit)
        .drop("_share", "_rank")
    )
