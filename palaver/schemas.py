"""Explicit schemas: landed JSON records and the four stored tables.

Landed ids are strings because many JSON writers lose digits above 2^53. JSON lists and objects
are read as their own text (a string field over a nested value keeps the JSON of that value).
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(required: str = "", **types: str | StructType) -> StructType:
    """Fields in the order given; those named in ``required`` are not nullable."""
    schema = StructType()
    for name, data_type in types.items():
        schema.add(name, data_type, nullable=name not in required.split())
    return schema


# Landed records, one JSON object per line. ``arrival_seq`` is the order of arrival: "first" and
# "last" mean nothing in a distributed read without it.
LANDED_GUILD = _struct(
    id="string",
    name="string",
    owner_id="string",
    icon="string",
    features="string",
    arrival_seq="long",
)

LANDED_CHANNEL = _struct(
    id="string",
    guild_id="string",
    name="string",
    kind="string",
    topic="string",
    nsfw="boolean",
    parent_id="string",
    position="integer",
    arrival_seq="long",
)

LANDED_AUTHOR = _struct(
    id="string",
    username="string",
    global_name="string",
    discriminator="string",
    avatar="string",
    bot="boolean",
)

LANDED_MESSAGE = _struct(
    id="string",
    guild_id="string",
    channel_id="string",
    author=LANDED_AUTHOR,
    webhook_id="string",
    edited_timestamp="timestamp",
    content="string",
    tts="boolean",
    pinned="boolean",
    kind="string",
    flags="long",
    mentions="string",
    attachments="string",
    embeds="string",
    components="string",
    reactions="string",
    message_reference="string",
    arrival_seq="long",
)

# Stored tables. ``arrival_seq`` is bookkeeping beside the guild, channel and user columns.
GUILDS = _struct(
    "id raw_json arrival_seq",
    id="long",
    name="string",
    owner_id="long",
    icon="string",
    features="string",
    raw_json="string",
    arrival_seq="long",
)

CHANNELS = _struct(
    "id nsfw raw_json arrival_seq",
    id="long",
    guild_id="long",
    name="string",
    kind="string",
    topic="string",
    nsfw="boolean",
    parent_id="long",
    position="integer",
    raw_json="string",
    arrival_seq="long",
)

USERS = _struct(
    "id bot raw_json arrival_seq",
    id="long",
    username="string",
    global_name="string",
    discriminator="string",
    avatar="string",
    bot="boolean",
    raw_json="string",
    arrival_seq="long",
)

MESSAGES = _struct(
    "id channel_id author_id created_at_ms tts pinned raw_json",
    id="long",
    guild_id="long",
    channel_id="long",
    author_id="long",
    created_at_ms="long",
    edited_at_ms="long",
    content="string",
    tts="boolean",
    pinned="boolean",
    kind="string",
    flags="long",
    mentions="string",
    attachments="string",
    embeds="string",
    components="string",
    reactions="string",
    message_reference="string",
    raw_json="string",
)

# Written per micro-batch.
PROGRESS = _struct(channel_id="long", processed="long", batch_id="long")

# Landed files that a sweep has taken.
SWEPT = _struct(path="string", modified="timestamp", sweep="long")

# Polled lines whose channel isn't known yet.
HELD = _struct(raw_json="string", source_file="string")

# Versions of the days of the messages table, and digests of the ids of a channel and day.
DAY_VERSIONS = _struct("version created_date level n", version="long", created_date="date", level="integer", replaces_from="long", n="long")

DAY_DIGESTS = _struct(channel_id="long", created_date="date", n="long", lo="long", hi="long", digest_a="long", digest_b="long")

QUARANTINE = _struct(
    raw_json="string", source_file="string", reject_reason="string", batch_id="long"
)

JSON_LIST_COLUMNS = ("mentions", "attachments", "embeds", "components", "reactions")
