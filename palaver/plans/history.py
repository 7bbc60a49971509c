"""What the archive lacks of a source: backfill, catch-up and interior gaps.

All three are one anti-join on the message id. The bounds of a channel only tell which phase of a
pass a missing row belongs to. They are computed on the archive, so bot rows in the source cannot
hold a cursor in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.operators.bounds import channel_bounds
from palaver.operators.joins import absent_rows, lookup_join


def _placed(source: DataFrame, archive: DataFrame) -> DataFrame:
    return lookup_join(source, channel_bounds(archive), "channel_id", "id")


def backfill_rows(source: DataFrame, archive: DataFrame) -> DataFrame:
    """Rows older than all stored rows of their channel; all rows of a channel not stored yet."""
    placed = _placed(source, archive).where(F.col("lo").isNull() | (F.col("id") < F.col("lo")))
    return placed.drop("lo", "hi")


def catch_up_rows(source: DataFrame, archive: DataFrame) -> DataFrame:
    """Rows newer than all stored rows of their channel."""
    return _placed(source, archive).where(F.col("id") > F.col("hi")).drop("lo", "hi")


def interior_gap_rows(source: DataFrame, archive: DataFrame) -> DataFrame:
    """Rows between the bounds of their channel that are not stored."""
    inside = (F.col("id") > F.col("lo")) & (F.col("id") < F.col("hi"))
    return absent_rows(_placed(source, archive).where(inside).drop("lo", "hi"), archive)


def missing_messages(source: DataFrame, archive: DataFrame) -> DataFrame:
    """All rows of ``source`` (one per id) that are not stored."""
    return absent_rows(source, archive)


def missing_messages_labelled(source: DataFrame, archive: DataFrame) -> DataFrame:
    """The same with ``phase``: backfill, catch_up or interior."""
    phase = (
        F.when(F.col("lo").isNull() | (F.col("id") < F.col("lo")), "backfill")
        .when(F.col("id") > F.col("hi"), "catch_up")
        .otherwise("interior")
    )
    return _placed(missing_messages(source, archive), archive).withColumn("phase", phase).drop("lo", "hi")
