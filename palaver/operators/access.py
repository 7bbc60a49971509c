"""Reads of the archive: timelines, one author, nested JSON, replies, search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.schemas import JSON_LIST_COLUMNS


def channel_timeline(messages: DataFrame, channel_id: int | None = None) -> DataFrame:
    """Messages in the order written, per channel; ids settle equal milliseconds.

    The sort is by ranges of all three columns, so a hot channel is spread over many ranges.
    """
    rows = messages if channel_id is None else messages.where(F.col("channel_id") == F.lit(channel_id))
    return rows.orderBy("channel_id", "created_at_ms", "id")


def author_history(messages: DataFrame, author_id: int | None = None) -> DataFrame:
    """Messages of one author, or of each author, in the order written."""
    rows = messages if author_id is None else messages.where(F.col("author_id") == F.lit(author_id))
    return rows.orderBy("author_id", "created_at_ms", "id")


def json_elements(messages: DataFrame, column: str) -> DataFrame:
    """One row per element of a JSON list column; the element keeps its JSON text."""
    if column not in JSON_LIST_COLUMNS:
        raise ValueError(f"{column} is not a JSON list column")
    elements = F.from_json(column, "array<string>")
    return messages.select(
        F.col("id").alias("message_id"), "channel_id", F.posexplode(elements).alias("position", "element")
    )


def replies(messages: DataFrame) -> DataFrame:
    """Messages that refer to another one."""
    return messages.where(F.col("message_reference").isNotNull())


def content_search(messages: DataFrame, text: str | None = None, pattern: str | None = None) -> DataFrame:
    """Messages whose content contains ``text`` and matches the regular expression ``pattern``."""
    if text is not None:
        messages = messages.where(F.col("content").contains(text))
    if pattern is not None:
        messages = messages.where(F.col("content").rlike(pattern))
    return messages
