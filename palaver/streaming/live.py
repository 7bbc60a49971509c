"""Micro-batches into the archive.

No watermark and no streaming state: late rows are history, and the tables themselves tell what is
known. Writes are idempotent, so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palaver.functions.scalars import signed_id
from palaver.operators.dedup import last_wins
from palaver.operators.filters import human_authors, message_bearing, not_message_bearing
from palaver.operators.joins import MAX_BROADCAST_ROWS, lookup_join
from palaver.operators.projections import (
    USER_ORDER,
    project_channels,
    project_guilds,
    project_messages,
    project_users,
)
from palaver.plans.sync import users_met, with_walk_guild
from palaver.sources.landed import (
    MEMORY_DAYS,
    landed_files,
    parse_channels,
    parse_guilds,
    parse_messages,
    read_lines,
    rejected,
    stream_lines,
    usable,
    with_author_json,
)

if TYPE_CHECKING:
    from palaver.archive import Archive, ArchiveConfig

log = logging.getLogger(__name__)

Batch = Callable[[DataFrame, int], None]


def guild_batch(archive: Archive) -> Batch:
    def apply(lines: DataFrame, batch_id: int) -> None:
        parsed = parse_guilds(lines)
        archive.write_quarantine("guilds", batch_id, rejected(parsed))
        archive.upsert_guilds(project_guilds(usable(parsed)))

    return apply


def channel_batch(archive: Archive) -> Batch:
    def apply(lines: DataFrame, batch_id: int) -> None:
        parsed = parse_channels(lines)
        archive.write_quarantine("channels", batch_id, rejected(parsed))
        channels = usable(parsed)
        archive.upsert_channels(project_channels(message_bearing(channels)))
        archive.other_channels.append(project_channels(not_message_bearing(channels)))

    return apply


#: Columns of parsed messages that some steps read without the others.
READ_ALONE = ("id", "channel_id", "author_id", "guild_id", "webhook_id", "bot", "arrival_seq", "reject_reason")


def _kept(lines: DataFrame) -> DataFrame:
    """Parsed messages of a batch, kept for its steps: wide columns as one, which costs less to keep than an encoding of each.

    The JSON of authors is cut out where it is wanted, as few are.
    """
    parsed = parse_messages(lines).drop("author_json")
    others = F.struct(*(name for name in parsed.columns if name not in READ_ALONE)).alias("others")
    return parsed.select(*READ_ALONE, others).persist(StorageLevel.MEMORY_AND_DISK)


def _parsed(kept: DataFrame) -> DataFrame:
    return kept.select(*READ_ALONE, "others.*")


def _newest_arrivals(human: DataFrame) -> DataFrame:
    """``author, newest_seq, n`` of each author: the last arrival and the number of messages."""
    return human.groupBy(signed_id(F.col("author_id")).alias("author")).agg(F.max("arrival_seq").alias("newest_seq"), F.count(F.lit(1)).alias("n"))


def _users_of(human: DataFrame, newest: DataFrame, authors: int) -> DataFrame:
    """The newest version of each author. Where authors were measured few, other rows than their last arrivals fall away
    before any JSON is cut out and rows are ranked."""
    if authors <= MAX_BROADCAST_ROWS:
        last = F.broadcast(newest.select("author", "newest_seq"))
        human = human.join(last, signed_id(F.col("author_id")) == F.col("author")).where("arrival_seq = newest_seq")
    return last_wins(project_users(with_author_json(human)), order=USER_ORDER)


def message_batch(archive: Archive) -> Batch:
    """Authors first, then messages: a message in the archive always has its user."""

    def apply(lines: DataFrame, batch_id: int) -> None:
        kept = _kept(lines)
        parsed = _parsed(kept)
        newest = _newest_arrivals(human_authors(usable(parsed))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            archive.write_quarantine("messages", batch_id, rejected(parsed))
            human = human_authors(usable(parsed))
            rows = project_messages(human)
            processed = rows.groupBy("channel_id").agg(F.count(F.lit(1)).alias("processed"))
            archive.write_progress(batch_id, processed)
            total, authors = newest.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
            archive.upsert_users(_users_of(human, newest, authors))
            archive.insert_messages(rows, batch_rows=total)
            log.info("batch %d: %d messages processed", batch_id, total)
        finally:
            newest.unpersist()
            kept.unpersist()

    return apply


def _walk(archive: Archive) -> DataFrame:
    """``channel_id, walk_guild_id`` of the channels that a polled pass goes through: those whose newest record carries messages."""
    channels = archive.channels.read().select(F.col("id").alias("channel_id"), F.col("guild_id").alias("walk_guild_id"), "arrival_seq")
    others = archive.other_channels.read().select(F.col("id").alias("channel_id"), F.col("arrival_seq").alias("other_seq"))
    newest = channels.join(others, "channel_id", "left").where("other_seq is null or other_seq < arrival_seq")
    return newest.select("channel_id", "walk_guild_id")


def _take_polled(archive: Archive, messages: DataFrame, walk: DataFrame) -> DataFrame:
    """Store the authors and messages of the walk; the messages processed per channel."""
    walk_rows = walk.count()
    rows = with_walk_guild(project_messages(human_authors(messages)), walk, walk_rows)
    archive.upsert_users(users_met(messages, walk, walk_rows))
    archive.insert_messages(rows)
    return rows.groupBy("channel_id").agg(F.count(F.lit(1)).alias("processed"))


def polled_batch(archive: Archive) -> Batch:
    """A polled pass over new lines: the walk is the table of channels, and the guild of a message is that of its channel there.

    Messages of channels that carry none are passed over. Those of channels not known yet are held, and each batch takes
    up what the one before has held, so the order in which records land does not matter.
    """

    def apply(lines: DataFrame, batch_id: int) -> None:
        kept = _kept(lines.unionByName(archive.held(batch_id - 1)))
        parsed = _parsed(kept)
        try:
            archive.write_quarantine("polled", batch_id, rejected(parsed))
            walk = _walk(archive)
            others = archive.other_channels.read().select(F.col("id").alias("channel_id"))
            known = archive.channels.read().select(F.col("id").alias("channel_id")).unionByName(others).distinct()
            waiting = parsed.where("reject_reason is null").withColumn("channel_id", signed_id(F.col("channel_id")))
            archive.write_held(batch_id, lookup_join(human_authors(waiting), known, "channel_id", "id", "left_anti", known.count()))
            archive.write_progress(batch_id, _take_polled(archive, with_author_json(usable(parsed)), walk), "polled")
        finally:
            kept.unpersist()

    return apply


def release_held(archive: Archive) -> None:
    """Store held messages whose channel has come since, also where no new message starts a batch.

    They stay held until the next batch, which finds them stored.
    """
    lines = archive.last_held()
    if lines is None:
        return
    walk = _walk(archive)
    messages = usable(parse_messages(lines)).withColumn("channel_id", signed_id(F.col("channel_id")))
    if not lookup_join(messages, walk.select("channel_id"), "channel_id", "id", "left_semi", walk.count()).isEmpty():
        _take_polled(archive, messages.withColumn("channel_id", F.col("channel_id").cast("string")), walk)


# In the order a pass takes them.
FEEDS: dict[str, Callable[[Archive], Batch]] = {
    "guilds": guild_batch,
    "channels": channel_batch,
    "messages": message_batch,
}


POLLED_FEEDS: dict[str, Callable[[Archive], Batch]] = {
    "guilds": guild_batch,
    "channels": channel_batch,
    "polled": polled_batch,
}


def compacting(archive: Archive, feed: str, every: int) -> Batch:
    """The batch function of a feed, with a compaction of its keyed tables every so many batches."""
    apply = (FEEDS | POLLED_FEEDS)[feed](archive)
    tables = {"guilds": [archive.guilds], "channels": [archive.channels, archive.other_channels]}.get(feed, [archive.users])

    def apply_and_compact(lines: DataFrame, batch_id: int) -> None:
        apply(lines, batch_id)
        if (batch_id + 1) % every == 0:
            for table in tables:
                table.compact()

    return apply_and_compact


def sweep(archive: Archive, config: ArchiveConfig, feed: str, files_at_once: int) -> int:
    """Take landed files that are older than the stream of a feed remembers and that no sweep has taken; the number of them.

    A file is taken when its number is in the ledger, which is written after its rows, so a sweep that broke off is repeated
    under the same number and replaces its rejects. Rows that the stream has stored already are found stored.
    """
    folder, taken = f"{config.landing.rstrip('/')}/{feed}", 0
    while True:
        ledger = archive.swept(feed)
        number = 1 + (ledger.agg(F.max("sweep")).first()[0] or 0)
        old = landed_files(archive.spark, folder).where(F.col("modified") < F.current_timestamp() - F.expr(f"interval {MEMORY_DAYS} days"))
        found = old.join(ledger, ["path", "modified"], "left_anti").orderBy("path").limit(files_at_once).collect()
        if not found:
            return taken
        # Batches of a stream count from 0 up, those of sweeps from -1 down.
        FEEDS[feed](archive)(read_lines(archive.spark, [row["path"] for row in found]), -number)
        archive.write_swept(feed, number, found)
        taken += len(found)


def start_feed(archive: Archive, config: ArchiveConfig, feed: str, once: bool) -> StreamingQuery:
    """Start the query of one feed: up to what has landed, or at each poll interval."""
    lines = stream_lines(
        archive.spark,
        f"{config.landing.rstrip('/')}/{'messages' if feed == 'polled' else feed}",
        config.max_bytes_per_trigger,
        config.max_files_per_trigger,
        config.finished and f"{config.finished.rstrip('/')}/{feed}",
    )
    writer = (
        lines.writeStream.queryName(f"archive-{feed}")
        .option("checkpointLocation", archive.checkpoint(feed))
        .foreachBatch(compacting(archive, feed, config.compact_every))
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{config.poll_interval_secs} seconds").start()
