"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.kinds import CHANNEL_KINDS, MESSAGE_BEARING_KINDS, kind_name
from palaver.functions.scalars import flag


def is_human() -> Column:
    """Author not a bot (unknown counts as not a bot) and not sent by a webhook."""
    return ~flag(F.col("bot")) & F.col("webhook_id").isNull()


def human_authors(landed: DataFrame) -> DataFrame:
    """Messages written by people."""
    return landed.where(is_human())


def _bears_messages() -> Column:
    return F.coalesce(kind_name(F.col("kind"), CHANNEL_KINDS).isin(*MESSAGE_BEARING_KINDS), F.lit(False))


def message_bearing(channels: DataFrame) -> DataFrame:
    """Channels that can hold messages; others are not stored."""
    return channels.where(_bears_messages())


def not_message_bearing(channels: DataFrame) -> DataFrame:
    """The others."""
    return channels.where(~_bears_messages())
