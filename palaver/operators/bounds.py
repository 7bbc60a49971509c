"""Lowest and highest stored id per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def channel_bounds(messages: DataFrame) -> DataFrame:
    """``channel_id, lo, hi`` of every channel in one pass over two columns.

    Partial aggregation leaves one row per channel and task before the shuffle.
    """
    return messages.groupBy("channel_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))


def _bound_of(messages: DataFrame, channel_id: int, side: str) -> int | None:
    bounds = channel_bounds(messages.where(F.col("channel_id") == F.lit(channel_id)))
    row = bounds.select(side).first()
    return None if row is None else row[0]


def max_message_id_in_channel(messages: DataFrame, channel_id: int) -> int | None:
    return _bound_of(messages, channel_id, "hi")


def min_message_id_in_channel(messages: DataFrame, channel_id: int) -> int | None:
    return _bound_of(messages, channel_id, "lo")
