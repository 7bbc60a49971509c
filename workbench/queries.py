"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.archive import Archive, ArchiveConfig, Archiver
from palaver.functions import scalars
from palaver.functions.kinds import MESSAGE_KINDS, kind_name
from palaver.operators import access, counters, paging
from palaver.operators.bounds import (
    channel_bounds,
    max_message_id_in_channel,
    min_message_id_in_channel,
)
from palaver.operators.dedup import first_wins, last_wins
from palaver.operators.filters import human_authors, message_bearing
from palaver.operators.merge import insert_first, upsert_last
from palaver.operators.projections import (
    USER_ORDER,
    project_channels,
    project_guilds,
    project_messages,
    project_users,
)
from palaver.plans import history, sync
from palaver.schemas import MESSAGES
from palaver.session import scratch_dir
from palaver.sources.landed import (
    parse_channels,
    parse_guilds,
    parse_messages,
    rejected,
    stream_lines,
    usable,
)
from workbench.inputs import REDELIVERED_FROM, Inputs

Query = Callable[[SparkSession, str], DataFrame]

PAGED_CHANNEL = 103
GUILD_CURSOR = 1
SEARCH_TEXT = "purchase"
SEARCH_PATTERN = r"\"k\": 7[0-9]?\}"
SPOKEN_TEXT = "tion"

REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        return build

    return register


# Landed files


@query("scan_guilds")
def scan_guilds(given: Inputs) -> DataFrame:
    return usable(parse_guilds(given.lines("guild_wire", "raw_json")))


@query("scan_channels")
def scan_channels(given: Inputs) -> DataFrame:
    return usable(parse_channels(given.lines("channel_lines", "line")))


def _scanned(messages: DataFrame) -> DataFrame:
    edited = F.unix_millis("edited_timestamp").alias("edited_raw_ms")
    return messages.select(*(c for c in messages.columns if c != "edited_timestamp"), edited)


@query("scan_messages")
def scan_messages(given: Inputs) -> DataFrame:
    return _scanned(usable(parse_messages(given.lines("dirty", "line"))))


@query("scan_conversations")
def scan_conversations(given: Inputs) -> DataFrame:
    rows = usable(parse_messages(given.spoken_lines()))
    return rows.select("id", "channel_id", "author_id", "bot", "content", "arrival_seq")


@query("stream_messages")
def stream_messages(given: Inputs) -> DataFrame:
    root = scratch_dir(given.spark, "stream")
    given.land(given.view("dirty", "line"), f"{root}/landing")
    rows = _scanned(usable(parse_messages(stream_lines(given.spark, f"{root}/landing", max_files=1))))
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    writer.option("path", f"{root}/rows").trigger(availableNow=True).start().awaitTermination()
    return given.spark.read.schema(rows.schema).parquet(f"{root}/rows")


@query("quarantine_counts")
def quarantine_counts(given: Inputs) -> DataFrame:
    feeds = (
        ("guilds", parse_guilds(given.lines("guild_wire", "raw_json"))),
        ("channels", parse_channels(given.lines("channel_lines", "line"))),
        ("messages", parse_messages(given.lines("dirty", "line"))),
    )
    parts = [rejected(rows).select(F.lit(feed).alias("feed"), "reject_reason") for feed, rows in feeds]
    bad = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return bad.groupBy("feed", "reject_reason").agg(F.count(F.lit(1)).alias("rejected"))


# Tables and merges


@query("bootstrap_tables")
def bootstrap_tables(given: Inputs) -> DataFrame:
    """Row counts of the four tables when created and after a first load."""
    archive = Archive(given.spark, scratch_dir(given.spark, "archive")).bootstrap()

    def sizes() -> DataFrame:
        tables = {
            "guilds": archive.guilds.read(),
            "channels": archive.channels.read(),
            "users": archive.users.read(),
            "messages": archive.messages.read(),
        }
        parts = [
            rows.agg(F.count(F.lit(1)).alias("stored")).withColumn("table_name", F.lit(name))
            for name, rows in tables.items()
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])

    created = sizes().withColumnRenamed("stored", "rows_created")
    human = human_authors(given.messages())
    archive.upsert_guilds(project_guilds(given.guilds()))
    archive.upsert_channels(project_channels(message_bearing(given.channels())))
    archive.upsert_users(project_users(human))
    archive.insert_messages(project_messages(human))
    archive.bootstrap()
    loaded = sizes().withColumnRenamed("stored", "rows_loaded")
    return created.join(loaded, "table_name")


@query("guild_upsert")
def guild_upsert(given: Inputs) -> DataFrame:
    return upsert_last(given.view("guild_stored"), project_guilds(given.guilds()))


@query("channel_upsert")
def channel_upsert(given: Inputs) -> DataFrame:
    batch = project_channels(message_bearing(given.channels()))
    return upsert_last(given.view("channel_stored"), batch)


@query("users_batch_upsert")
def users_batch_upsert(given: Inputs) -> DataFrame:
    return upsert_last(given.view("users_target"), project_users(human_authors(given.messages())))


@query("user_upsert_stream")
def user_upsert_stream(given: Inputs) -> DataFrame:
    return given.streamed(seeded=True).users.read()


@query("messages_insert_ignore")
def messages_insert_ignore(given: Inputs) -> DataFrame:
    stored = given.archive()
    fresh = insert_first(stored, project_messages(human_authors(given.messages())))
    return stored.unionByName(fresh.select(*stored.columns))


@query("message_insert_stream")
def message_insert_stream(given: Inputs) -> DataFrame:
    return given.streamed(seeded=True).messages.read()


# Projections


@query("guild_projection")
def guild_projection(given: Inputs) -> DataFrame:
    return project_guilds(given.guilds())


@query("channel_projection")
def channel_projection(given: Inputs) -> DataFrame:
    return project_channels(given.channels())


@query("user_projection")
def user_projection(given: Inputs) -> DataFrame:
    return project_users(human_authors(given.messages()))


@query("message_projection")
def message_projection(given: Inputs) -> DataFrame:
    """Poll path: the guild is the one being walked."""
    walked = human_authors(given.messages()).withColumn("walk_guild_id", F.lit(7).cast("bigint"))
    return project_messages(walked, guild_id=F.col("walk_guild_id"))


@query("message_projection_live")
def message_projection_live(given: Inputs) -> DataFrame:
    return project_messages(human_authors(given.messages()))


# Scalars


def _keyed(given: Inputs, *columns) -> DataFrame:
    return given.messages().select(F.col("id").cast("bigint").alias("id"), "arrival_seq", *columns)


@query("snowflake_created_at")
def snowflake_created_at(given: Inputs) -> DataFrame:
    rows = given.view("wire", "id, arrival_seq")
    day = scalars.created_date(F.col("id")).cast("string")
    return rows.select(
        "id",
        "arrival_seq",
        scalars.created_at_ms(F.col("id")).alias("created_at_ms"),
        day.alias("created_date"),
    )


@query("edited_at_seconds")
def edited_at_seconds(given: Inputs) -> DataFrame:
    return _keyed(given, scalars.edited_at_ms(F.col("edited_timestamp")).alias("edited_at_ms"))


@query("content_empty_to_null")
def content_empty_to_null(given: Inputs) -> DataFrame:
    return _keyed(given, scalars.content_or_null(F.col("content")).alias("content"))


@query("kind_name")
def kind_names(given: Inputs) -> DataFrame:
    return _keyed(given, kind_name(F.col("kind"), MESSAGE_KINDS).alias("kind"))


@query("discriminator_text")
def discriminator_text(given: Inputs) -> DataFrame:
    return _keyed(given, scalars.discriminator_text(F.col("discriminator")).alias("discriminator"))


@query("json_capture")
def json_capture(given: Inputs) -> DataFrame:
    lists = ("mentions", "attachments", "embeds", "components", "reactions")
    return _keyed(given, *[scalars.json_list(F.col(name)).alias(name) for name in lists])


# Filters and de-duplication


@query("human_author_filter")
def human_author_filter(given: Inputs) -> DataFrame:
    return human_authors(given.messages()).select("id", "author_id", "bot", "arrival_seq")


@query("conversation_human_filter")
def conversation_human_filter(given: Inputs) -> DataFrame:
    return human_authors(given.spoken()).select("id", "channel_id", "content")


@query("message_bearing_channels")
def message_bearing_channels(given: Inputs) -> DataFrame:
    return project_channels(message_bearing(given.channels()))


@query("users_dedup_last")
def users_dedup_last(given: Inputs) -> DataFrame:
    return last_wins(project_users(human_authors(given.messages())), order=USER_ORDER)


@query("messages_dedup_first")
def messages_dedup_first(given: Inputs) -> DataFrame:
    return first_wins(project_messages(human_authors(given.messages())))


# Pages and bounds


def _source(given: Inputs) -> DataFrame:
    """What the service would list: each message once, as first delivered, bots included."""
    columns = "id, channel_id, author_id, content, arrival_seq"
    return first_wins(given.view("wire", columns)).drop("arrival_seq")


def _source_channel(given: Inputs) -> DataFrame:
    columns = "id, channel_id, author_id, content, arrival_seq"
    channel = given.view("wire", columns).where(F.col("channel_id") == PAGED_CHANNEL)
    return first_wins(channel).drop("arrival_seq")


@query("page_latest")
def page_latest(given: Inputs) -> DataFrame:
    return paging.page_latest(_source_channel(given), PAGED_CHANNEL)


@query("page_before")
def page_before(given: Inputs) -> DataFrame:
    cursor = min_message_id_in_channel(given.archive(), PAGED_CHANNEL)
    return paging.page_before(_source_channel(given), PAGED_CHANNEL, cursor)


@query("page_after")
def page_after(given: Inputs) -> DataFrame:
    cursor = max_message_id_in_channel(given.archive(), PAGED_CHANNEL)
    return paging.page_after(_source_channel(given), PAGED_CHANNEL, cursor)


@query("guild_page_after")
def guild_page_after(given: Inputs) -> DataFrame:
    return paging.guild_page_after(last_wins(project_guilds(given.guilds())), GUILD_CURSOR)


@query("page_latest_all")
def page_latest_all(given: Inputs) -> DataFrame:
    return paging.pages_latest(_source(given))


@query("page_before_all")
def page_before_all(given: Inputs) -> DataFrame:
    return paging.pages_before(_source(given), channel_bounds(given.archive()))


@query("page_after_all")
def page_after_all(given: Inputs) -> DataFrame:
    return paging.pages_after(_source(given), channel_bounds(given.archive()))


@query("conversation_page_latest_all")
def conversation_page_latest_all(given: Inputs) -> DataFrame:
    rows = given.spoken().select("id", "channel_id", "content")
    return paging.pages_latest(rows, limit=3)


@query("channel_max_id")
def channel_max_id(given: Inputs) -> DataFrame:
    return channel_bounds(given.all_messages()).select("channel_id", F.col("hi").alias("max_id"))


@query("channel_min_id")
def channel_min_id(given: Inputs) -> DataFrame:
    return channel_bounds(given.all_messages()).select("channel_id", F.col("lo").alias("min_id"))


# Counters


def _flagged(given: Inputs) -> DataFrame:
    columns = "id, channel_id, bot, webhook_id, arrival_seq"
    return counters.human_flag(first_wins(given.view("wire", columns)))


@query("processed_counts")
def processed_counts(given: Inputs) -> DataFrame:
    return counters.processed_counts(_flagged(given), given.archive())


@query("page_counts")
def page_counts(given: Inputs) -> DataFrame:
    return counters.page_counts(_flagged(given), given.archive())


@query("channel_counts")
def channel_counts(given: Inputs) -> DataFrame:
    return counters.channel_counts(last_wins(project_channels(given.channels())))


@query("guild_counts")
def guild_counts(given: Inputs) -> DataFrame:
    guilds = usable(parse_guilds(given.lines("guild_wire", "raw_json")))
    channels = parse_channels(given.lines("channel_lines", "line"))
    return counters.guild_counts(guilds, channels)


# History


def _missing_source(given: Inputs) -> DataFrame:
    columns = "id, channel_id, author_id, content, bot, webhook_id, arrival_seq"
    human = human_authors(given.view("wire", columns)).drop("bot", "webhook_id")
    return first_wins(human)


@query("backfill_rows")
def backfill_rows(given: Inputs) -> DataFrame:
    return history.backfill_rows(_missing_source(given), given.archive())


@query("catch_up_rows")
def catch_up_rows(given: Inputs) -> DataFrame:
    return history.catch_up_rows(_missing_source(given), given.archive())


@query("interior_gap_rows")
def interior_gap_rows(given: Inputs) -> DataFrame:
    return history.interior_gap_rows(_missing_source(given), given.archive())


@query("missing_messages_labelled")
def missing_messages_labelled(given: Inputs) -> DataFrame:
    return history.missing_messages_labelled(_missing_source(given), given.archive())


@query("sync_pass_guilds")
def sync_pass_guilds(given: Inputs) -> DataFrame:
    return sync.guilds_after(given.view("guild_stored"), given.guilds())


@query("sync_pass_channels")
def sync_pass_channels(given: Inputs) -> DataFrame:
    return sync.channels_after(given.view("channel_stored"), given.channels())


@query("sync_pass_users")
def sync_pass_users(given: Inputs) -> DataFrame:
    walk = sync.walk(given.channels())
    return sync.users_after(given.view("users_target"), given.messages(), walk)


@query("sync_pass_messages")
def sync_pass_messages(given: Inputs) -> DataFrame:
    return sync.messages_after(given.archive(), given.messages(), sync.walk(given.channels()))


@query("incremental_pass")
def incremental_pass(given: Inputs) -> DataFrame:
    """Two passes over all feeds; the second finds redeliveries only."""
    root = scratch_dir(given.spark, "archive")
    archiver = Archiver(given.spark, ArchiveConfig(landing=f"{root}/landing", root=f"{root}/tables"))
    given.seed(archiver.archive)
    given.land(given.view("guild_wire", "raw_json"), f"{root}/landing/guilds")
    given.land(given.view("channel_lines", "line"), f"{root}/landing/channels")
    lines = given.view("dirty", "line, arrival_seq")
    for wave in (F.col("arrival_seq") < REDELIVERED_FROM, F.col("arrival_seq") >= REDELIVERED_FROM):
        given.land(lines.where(wave).select("line"), f"{root}/landing/messages")
        archiver.run_once()
    return archiver.archive.messages.read().select(*MESSAGES.fieldNames())


@query("polled_passes")
def polled_passes(given: Inputs) -> DataFrame:
    """Incremental polled passes: half of the messages land before any channel, the rest and redeliveries after all."""
    root = scratch_dir(given.spark, "archive")
    archiver = Archiver(given.spark, ArchiveConfig(landing=f"{root}/landing", root=f"{root}/tables"))
    archiver.archive.messages.append(given.archive())
    lines = given.view("dirty", "line, arrival_seq")
    early = F.pmod(F.col("arrival_seq"), F.lit(2)) == 0
    first = F.col("arrival_seq") < REDELIVERED_FROM
    given.land(lines.where(first & early).select("line"), f"{root}/landing/messages")
    archiver.run_polled_once()
    given.land(given.view("channel_wire", "raw_json"), f"{root}/landing/channels")
    given.land(lines.where(first & ~early).select("line"), f"{root}/landing/messages")
    archiver.run_polled_once()
    given.land(lines.where(~first).select("line"), f"{root}/landing/messages")
    archiver.run_polled_once()
    return archiver.archive.messages.read().select(*MESSAGES.fieldNames())


def _passed(given: Inputs) -> Archive:
    """Seeded tables after a full polled pass that was written."""
    archive = given.seed(Archive(given.spark, scratch_dir(given.spark, "archive")).bootstrap())
    lines = [given.lines(view, "raw_json") for view in ("guild_wire", "channel_wire", "wire")]
    sync.run_pass(archive, *lines)
    return archive


@query("written_pass_guilds")
def written_pass_guilds(given: Inputs) -> DataFrame:
    return _passed(given).guilds.read()


@query("written_pass_channels")
def written_pass_channels(given: Inputs) -> DataFrame:
    return _passed(given).channels.read()


@query("written_pass_users")
def written_pass_users(given: Inputs) -> DataFrame:
    return _passed(given).users.read()


@query("written_pass_messages")
def written_pass_messages(given: Inputs) -> DataFrame:
    return _passed(given).messages.read()


# The messages table after several batches and compactions


@query("stored_messages")
def stored_messages(given: Inputs) -> DataFrame:
    return given.compacted().messages.read()


@query("stored_bounds")
def stored_bounds(given: Inputs) -> DataFrame:
    return given.compacted().messages.bounds()


@query("stored_page_latest")
def stored_page_latest(given: Inputs) -> DataFrame:
    return given.compacted().page_latest(PAGED_CHANNEL).select("id", "channel_id", "author_id", "content")


@query("stored_page_before")
def stored_page_before(given: Inputs) -> DataFrame:
    archive = given.compacted()
    cursor = archive.max_message_id_in_channel(PAGED_CHANNEL)
    return archive.page_before(PAGED_CHANNEL, cursor).select("id", "channel_id", "author_id", "content")


@query("stored_page_after")
def stored_page_after(given: Inputs) -> DataFrame:
    archive = given.compacted()
    cursor = archive.min_message_id_in_channel(PAGED_CHANNEL)
    return archive.page_after(PAGED_CHANNEL, cursor).select("id", "channel_id", "author_id", "content")


@query("stored_missing")
def stored_missing(given: Inputs) -> DataFrame:
    """What the written table lacks of the source, by digests of channel days."""
    archive = given.seed(Archive(given.spark, scratch_dir(given.spark, "archive")).bootstrap())
    absent = archive.messages.absent_by_digest(project_messages(human_authors(given.messages())))
    return absent.select("id", "channel_id", "author_id", "content", "arrival_seq")


@query("live_messages")
def live_messages(given: Inputs) -> DataFrame:
    return given.streamed(seeded=False).messages.read()


@query("live_users")
def live_users(given: Inputs) -> DataFrame:
    return given.streamed(seeded=False).users.read()


# Reads of the archive


@query("channel_timeline")
def channel_timeline(given: Inputs) -> DataFrame:
    rows = given.all_messages().select("channel_id", "created_at_ms", "id", "author_id", "content")
    return access.channel_timeline(rows)


@query("author_history")
def author_history(given: Inputs) -> DataFrame:
    rows = given.all_messages().select("author_id", "created_at_ms", "id", "channel_id", "content")
    return access.author_history(rows)


def _elements(column: str) -> Callable[[Inputs], DataFrame]:
    return lambda given: access.json_elements(given.all_messages(), column)


for _column in ("mentions", "attachments", "embeds", "components", "reactions"):
    query(f"message_{_column}")(_elements(_column))


@query("message_replies")
def message_replies(given: Inputs) -> DataFrame:
    return access.replies(given.all_messages()).select("id", "channel_id", "message_reference")


@query("content_search")
def content_search(given: Inputs) -> DataFrame:
    found = access.content_search(given.all_messages(), text=SEARCH_TEXT, pattern=SEARCH_PATTERN)
    return found.select("id", "channel_id", "author_id", "content")


@query("conversation_content_search")
def conversation_content_search(given: Inputs) -> DataFrame:
    return access.content_search(given.spoken(), text=SPOKEN_TEXT).select("id", "channel_id", "content")
