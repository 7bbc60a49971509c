"""The four tables on shared storage, and the archiver that keeps them up to date.

One writer per archive: Parquet has no unique key, so both feeds land in one place and one
``Archiver`` writes. Readers may come at any time.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from palaver.messages import MessageTable
from palaver.operators import access, paging
from palaver.operators.dedup import last_wins
from palaver.plans.sync import run_pass
from palaver.schemas import CHANNELS, GUILDS, HELD, PROGRESS, QUARANTINE, SWEPT, USERS
from palaver.sources.landed import MAX_BYTES_PER_TRIGGER, ensure_folder, read_lines
from palaver.storage import is_there, newest_generation, no_rows, read_if_there, remove_folder, subfolders
from palaver.streaming.live import FEEDS, POLLED_FEEDS, release_held, start_feed, sweep

log = logging.getLogger(__name__)

class KeyedTable:
    """Last-write-wins table: a snapshot plus appended changes, merged by ``arrival_seq`` on read.

    A write costs as much as its batch, not as the table. Appending a batch again is harmless, as
    equal rows merge into one. ``compact`` folds the changes into the next snapshot; a generation
    counts only once its snapshot is complete, so a broken compaction leaves the old one in force. The generation
    before stays for readers that have begun with it; older ones are removed.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path
        self.schema = schema

    def create(self) -> None:
        """Start an empty table where there is none."""
        if self.generation() is None:
            self._start(0, no_rows(self.spark, self.schema))

    def generation(self) -> int | None:
        return newest_generation(self.spark, f"{self.path}/snapshots")

    def read(self) -> DataFrame:
        generation = self.generation()
        snapshot, changes = self._snapshot(generation), self._changes(generation)
        if changes.isEmpty():
            return snapshot
        return last_wins(snapshot.unionByName(changes))

    def append(self, rows: DataFrame) -> None:
        """Upsert ``rows``; there may be several per key."""
        target = f"{self.path}/changes/generation={self.generation()}"
        rows.select(*self.schema.fieldNames()).write.mode("append").parquet(target)

    def compact(self) -> None:
        generation = self.generation()
        self._start(generation + 1, self.read())
        for folder in ("snapshots", "changes"):
            for name in subfolders(self.spark, f"{self.path}/{folder}"):
                if int(name.partition("=")[2]) < generation:
                    remove_folder(self.spark, f"{self.path}/{folder}/{name}")

    def _start(self, generation: int, snapshot: DataFrame) -> None:
        no_changes = no_rows(self.spark, self.schema)
        no_changes.write.mode("overwrite").parquet(f"{self.path}/changes/generation={generation}")
        snapshot.write.mode("overwrite").parquet(f"{self.path}/snapshots/generation={generation}")

    def _snapshot(self, generation: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(
            f"{self.path}/snapshots/generation={generation}"
        )

    def _changes(self, generation: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(
            f"{self.path}/changes/generation={generation}"
        )


class Archive:
    """Tables below one root folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.guilds = KeyedTable(spark, f"{self.root}/guilds", GUILDS)
        self.channels = KeyedTable(spark, f"{self.root}/channels", CHANNELS)
        self.users = KeyedTable(spark, f"{self.root}/users", USERS)
        self.messages = MessageTable(spark, f"{self.root}/messages")
        #: Channels that carry no messages: those of polled messages are passed over, those of unknown channels wait.
        self.other_channels = KeyedTable(spark, f"{self.root}/other_channels", CHANNELS)

    def bootstrap(self) -> Archive:
        """Create what is absent; existing tables stay as they are."""
        for table in (self.guilds, self.channels, self.users, self.messages, self.other_channels):
            table.create()
        return self

    def checkpoint(self, feed: str) -> str:
        return f"{self.root}/checkpoints/{feed}"

    def create_views(self) -> None:
        """Temporary views ``guilds``, ``channels``, ``users`` and ``messages`` for SQL."""
        self.guilds.read().createOrReplaceTempView("guilds")
        self.channels.read().createOrReplaceTempView("channels")
        self.users.read().createOrReplaceTempView("users")
        self.messages.read().createOrReplaceTempView("messages")

    def progress(self, feed: str = "messages") -> DataFrame:
        """Messages processed per batch and channel; ``processed`` counts known ones again."""
        return read_if_there(self.spark, self._progress(feed), "parquet", PROGRESS)

    def write_progress(self, batch_id: int, processed: DataFrame, feed: str = "messages") -> None:
        """A replayed batch replaces its own counts."""
        processed.write.mode("overwrite").parquet(f"{self._progress(feed)}/batch_id={batch_id}")

    def _progress(self, feed: str) -> str:
        return f"{self.root}/progress" if feed == "messages" else f"{self.root}/progress_{feed}"

    def swept(self, feed: str) -> DataFrame:
        """The ledger of landed files that sweeps have taken."""
        return read_if_there(self.spark, f"{self.root}/swept/{feed}", "parquet", SWEPT)

    def write_swept(self, feed: str, number: int, files: list) -> None:
        rows = self.spark.createDataFrame([(*file, number) for file in files], SWEPT)
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/swept/{feed}")

    def held(self, batch_id: int) -> DataFrame:
        """Polled lines that waited for their channel after a batch, as the readers deliver lines."""
        rows = read_if_there(self.spark, f"{self.root}/held/batch_id={batch_id}", "parquet", HELD)
        return rows.select(F.col("raw_json").alias("value"), "source_file")

    def last_held(self) -> DataFrame | None:
        """What waits after the last batch."""
        batches = [int(name.partition("=")[2]) for name in subfolders(self.spark, f"{self.root}/held")]
        return self.held(max(batches)) if batches else None

    def write_held(self, batch_id: int, rows: DataFrame) -> None:
        """What waits after a batch; what waited before the last one is no longer needed."""
        rows.select(*HELD.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/held/batch_id={batch_id}")
        for old in subfolders(self.spark, f"{self.root}/held"):
            if int(old.partition("=")[2]) < batch_id - 1:
                remove_folder(self.spark, f"{self.root}/held/{old}")

    def quarantine(self, feed: str) -> DataFrame:
        """Rejected lines of a feed with the reason."""
        path = f"{self.root}/quarantine/{feed}"
        return read_if_there(self.spark, path, "parquet", QUARANTINE)

    def write_quarantine(self, feed: str, batch_id: int, rows: DataFrame) -> None:
        """A replayed batch replaces its own lines."""
        target = f"{self.root}/quarantine/{feed}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(target)

    def insert_messages(self, batch: DataFrame, batch_rows: int | None = None) -> None:
        """Store what is absent; ``batch_rows`` is the size of the batch where it was counted."""
        self.messages.append(self.messages.absent(batch, batch_rows))

    def upsert_guilds(self, rows: DataFrame) -> None:
        self.guilds.append(rows)

    def upsert_channels(self, rows: DataFrame) -> None:
        self.channels.append(rows)

    def upsert_users(self, rows: DataFrame) -> None:
        self.users.append(rows)

    def max_message_id_in_channel(self, channel_id: int) -> int | None:
        found = self.messages.bounds_of(channel_id)
        return found and found[1]

    def min_message_id_in_channel(self, channel_id: int) -> int | None:
        found = self.messages.bounds_of(channel_id)
        return found and found[0]

    def page_latest(self, channel_id: int, limit: int = paging.MESSAGE_PAGE) -> DataFrame:
        return self.messages.page(channel_id, limit)

    def page_before(self, channel_id: int, before: int, limit: int = paging.MESSAGE_PAGE) -> DataFrame:
        return self.messages.page(channel_id, limit, before=before)

    def page_after(self, channel_id: int, after: int, limit: int = paging.MESSAGE_PAGE) -> DataFrame:
        return self.messages.page(channel_id, limit, after=after)

    def timeline(self, channel_id: int) -> DataFrame:
        return access.channel_timeline(self.messages.channel(channel_id), channel_id)

    def author_history(self, author_id: int) -> DataFrame:
        """Row groups without the author are passed over by their Bloom filters or dictionaries."""
        return access.author_history(self.messages.read(), author_id)

    def search(self, text: str | None = None, pattern: str | None = None) -> DataFrame:
        return access.content_search(self.messages.read(), text, pattern)

    def elements(self, column: str) -> DataFrame:
        return access.json_elements(self.messages.read(), column)

    def replies(self) -> DataFrame:
        return access.replies(self.messages.read())


@dataclass(frozen=True)
class ArchiveConfig:
    """Where records land, where the archive lives, and how often to look for new files.

    ``landing`` holds the folders ``guilds``, ``channels`` and ``messages`` with JSON lines.
    Changes of a keyed table are folded into its snapshot every ``compact_every`` batches. A file
    is taken whatever its modification time. With ``finished``, a folder in the file system of ``landing`` but outside of it, files that were
    taken move there, so that neither the listing nor what the streams remember grows with the archive; files with
    times older than the streams remember are then taken by a sweep, of ``sweep_files`` at once.
    """

    landing: str
    root: str
    poll_interval_secs: int = 300
    max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER
    max_files_per_trigger: int | None = None
    finished: str | None = None
    sweep_files: int = 10_000
    compact_every: int = 100


class Archiver:
    """Takes what has landed into the archive, once or for ever."""

    def __init__(self, spark: SparkSession, config: ArchiveConfig):
        self.spark = spark
        self.config = config
        self.archive = Archive(spark, config.root).bootstrap()
        for feed in FEEDS:
            ensure_folder(spark, f"{config.landing.rstrip('/')}/{feed}")

    def run_once(self) -> None:
        """Everything landed so far: guilds, then channels, then messages with their authors."""
        for feed in FEEDS:
            start_feed(self.archive, self.config, feed, once=True).awaitTermination()
            if self.config.finished is not None:
                self.sweep(feed)

    def sweep(self, feed: str) -> int:
        """Take landed files that are too old for the stream of a feed; the number of them."""
        return sweep(self.archive, self.config, feed, self.config.sweep_files)

    def run_polled(self, pass_id: int = 0) -> None:
        """A full pass over all landed files: messages of the channels walked, with the guild of the walk."""
        lines = [read_lines(self.spark, f"{self.config.landing.rstrip('/')}/{feed}") for feed in FEEDS]
        for k, feed in enumerate(FEEDS):
            folder = f"{(self.config.finished or '').rstrip('/')}/{feed}"
            if self.config.finished is not None and is_there(self.spark, folder):
                lines[k] = lines[k].unionByName(read_lines(self.spark, folder))
        run_pass(self.archive, *lines, pass_id=pass_id)

    def run_polled_once(self) -> None:
        """The same over the files that landed since the last time. Messages that landed before their channel wait for it."""
        for feed in POLLED_FEEDS:
            start_feed(self.archive, self.config, feed, once=True).awaitTermination()
        release_held(self.archive)

    def poll_forever(self, stopped: Callable[[], bool] = lambda: False) -> None:
        """An incremental pass at each poll interval; one that fails is logged and what it lacked is taken by the next."""
        while not stopped():
            try:
                self.run_polled_once()
            except StreamingQueryException:
                log.exception("a polled pass failed")
            time.sleep(self.config.poll_interval_secs)

    def run_forever(self) -> list[StreamingQuery]:
        """Start one query per feed that looks for new files at the poll interval."""
        return [start_feed(self.archive, self.config, feed, once=False) for feed in FEEDS]

    def restarted(self, running: list[StreamingQuery]) -> list[StreamingQuery]:
        """The queries of ``run_forever``, those that have ended started again; the others go on."""
        queries = []
        for feed, query in zip(FEEDS, running, strict=True):
            if not query.isActive:
                log.error("feed %s ended and starts again: %s", feed, query.exception())
                query = start_feed(self.archive, self.config, feed, once=False)
            queries.append(query)
        return queries
