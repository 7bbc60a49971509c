"""Landed record -> stored row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.kinds import CHANNEL_KINDS, MESSAGE_KINDS, kind_name
from palaver.functions.scalars import (
    content_or_null,
    created_at_ms,
    discriminator_text,
    edited_at_ms,
    flag,
    json_list,
    signed_id,
)
from palaver.schemas import JSON_LIST_COLUMNS

# Order of the rows of one key. The second column settles equal arrival numbers the same way each
# time, also when a task is run again.
MESSAGE_ORDER = ("arrival_seq", "raw_json")
USER_ORDER = ("arrival_seq", "message_id")


def project_guilds(landed: DataFrame) -> DataFrame:
    return landed.select(
        signed_id(F.col("id")).alias("id"),
        "name",
        signed_id(F.col("owner_id")).alias("owner_id"),
        "icon",
        json_list(F.col("features")).alias("features"),
        "raw_json",
        "arrival_seq",
    )


def project_channels(landed: DataFrame) -> DataFrame:
    return landed.select(
        signed_id(F.col("id")).alias("id"),
        signed_id(F.col("guild_id")).alias("guild_id"),
        "name",
        kind_name(F.col("kind"), CHANNEL_KINDS).alias("kind"),
        "topic",
        flag(F.col("nsfw")).alias("nsfw"),
        signed_id(F.col("parent_id")).alias("parent_id"),
        "position",
        "raw_json",
        "arrival_seq",
    )


def project_users(landed: DataFrame, *kept: str) -> DataFrame:
    """One row per message: its author, ``message_id`` for breaking ties, and columns ``kept``."""
    return landed.select(
        signed_id(F.col("author_id")).alias("id"),
        "username",
        "global_name",
        discriminator_text(F.col("discriminator")).alias("discriminator"),
        "avatar",
        flag(F.col("bot")).alias("bot"),
        F.col("author_json").alias("raw_json"),
        "arrival_seq",
        signed_id(F.col("id")).alias("message_id"),
        *kept,
    )


def project_messages(landed: DataFrame, guild_id: Column | None = None) -> DataFrame:
    """Stored message row plus ``arrival_seq``, which picks the first of several deliveries.

    Live messages carry their own optional guild; on the poll path pass the guild being walked.
    """
    guild = signed_id(F.col("guild_id")) if guild_id is None else guild_id
    return landed.select(
        signed_id(F.col("id")).alias("id"),
        guild.alias("guild_id"),
        signed_id(F.col("channel_id")).alias("channel_id"),
        signed_id(F.col("author_id")).alias("author_id"),
        created_at_ms(signed_id(F.col("id"))).alias("created_at_ms"),
        edited_at_ms(F.col("edited_timestamp")).alias("edited_at_ms"),
        content_or_null(F.col("content")).alias("content"),
        flag(F.col("tts")).alias("tts"),
        flag(F.col("pinned")).alias("pinned"),
        kind_name(F.col("kind"), MESSAGE_KINDS).alias("kind"),
        F.col("flags").cast("bigint").alias("flags"),
        *[json_list(F.col(name)).alias(name) for name in JSON_LIST_COLUMNS],
        "message_reference",
        "raw_json",
        "arrival_seq",
    )
