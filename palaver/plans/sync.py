"""A full pass over polled records: each table after the pass, as one plan.

The walk of a pass is guild -> its message-bearing channels -> their messages, so polled messages
of other channels are not taken and the guild of a message is the guild of the walk.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.scalars import signed_id
from palaver.operators.dedup import first_wins, last_wins
from palaver.operators.filters import human_authors, message_bearing
from palaver.operators.joins import absent_rows, lookup_join
from palaver.operators.merge import upsert_last
from palaver.operators.projections import (
    MESSAGE_ORDER,
    USER_ORDER,
    project_channels,
    project_guilds,
    project_messages,
    project_users,
)
from palaver.sources.landed import parse_channels, parse_guilds, parse_messages, rejected, usable

if TYPE_CHECKING:
    from palaver.archive import Archive


def guilds_after(target: DataFrame, landed_guilds: DataFrame) -> DataFrame:
    return upsert_last(target, project_guilds(landed_guilds))


def channels_after(target: DataFrame, landed_channels: DataFrame) -> DataFrame:
    return upsert_last(target, project_channels(message_bearing(landed_channels)))


def walk(landed_channels: DataFrame) -> DataFrame:
    """``channel_id, walk_guild_id`` of the channels a pass goes through."""
    channels = last_wins(project_channels(message_bearing(landed_channels)))
    return channels.select(
        F.col("id").alias("channel_id"), F.col("guild_id").alias("walk_guild_id")
    )


def users_met(
    landed_messages: DataFrame, walk: DataFrame, walk_rows: int | None = None
) -> DataFrame:
    """The newest version of each author met on the walk.

    Authors are first reduced to one row per channel, before any shuffle, so the join with the walk
    moves (author, channel) pairs and not messages.
    """
    human = human_authors(landed_messages)
    authors = project_users(human.withColumn("channel_id", signed_id(F.col("channel_id"))), "channel_id")
    per_channel = last_wins(authors, ("id", "channel_id"), USER_ORDER)
    met = lookup_join(per_channel, walk, "channel_id", "id", "left_semi", walk_rows)
    return last_wins(met.drop("channel_id"), order=USER_ORDER)


def with_walk_guild(rows: DataFrame, walk: DataFrame, walk_rows: int | None = None) -> DataFrame:
    """Message rows of the channels walked, with the guild of the walk as theirs."""
    met = lookup_join(rows, walk, "channel_id", "id", "inner", walk_rows)
    return met.withColumn("guild_id", F.col("walk_guild_id")).drop("walk_guild_id")


def users_after(target: DataFrame, landed_messages: DataFrame, walk: DataFrame) -> DataFrame:
    """``target`` and the authors met on the walk."""
    return upsert_last(target, users_met(landed_messages, walk))


def messages_after(archive: DataFrame, landed_messages: DataFrame, walk: DataFrame) -> DataFrame:
    """``archive`` and the first delivery of each human message of the walk that it lacks.

    The walk is joined last, when only missing rows are left.
    """
    first = first_wins(project_messages(human_authors(landed_messages)), order=MESSAGE_ORDER)
    rows = with_walk_guild(absent_rows(first, archive), walk)
    return archive.unionByName(rows.select(*archive.columns))


def run_pass(
    archive: Archive,
    guild_lines: DataFrame,
    channel_lines: DataFrame,
    message_lines: DataFrame,
    pass_id: int = 0,
) -> None:
    """Write a polled pass: guilds, channels, then the authors and messages of the walk.

    A pass reads channels from end to end, so its messages are compared with the table by digests of channel days. Lines
    are parsed by each step that needs them, with the columns that it needs: nothing of the landing folder is kept. Lines that
    can't be used are quarantined as those of ``polled_<feed>``; the same ``pass_id`` replaces them.
    """
    guilds = parse_guilds(guild_lines)
    archive.write_quarantine("polled_guilds", pass_id, rejected(guilds))
    archive.upsert_guilds(project_guilds(usable(guilds)))
    parsed = parse_channels(channel_lines)
    archive.write_quarantine("polled_channels", pass_id, rejected(parsed))
    channels = usable(parsed)
    archive.upsert_channels(project_channels(message_bearing(channels)))
    walked = walk(channels)
    walk_rows = walked.count()
    parsed = parse_messages(message_lines)
    archive.write_quarantine("polled_messages", pass_id, rejected(parsed))
    messages = usable(parsed)
    archive.upsert_users(users_met(messages, walked, walk_rows))
    met = with_walk_guild(project_messages(human_authors(messages)), walked, walk_rows)
    archive.messages.append(archive.messages.absent_by_digest(met))
