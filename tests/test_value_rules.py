"""Value rules on hand-written rows."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from palaver.functions import scalars
from palaver.functions.kinds import CHANNEL_KINDS, MESSAGE_KINDS, kind_name
from palaver.functions.scalars import json_list
from palaver.operators.filters import human_authors, message_bearing
from palaver.operators.projections import (
    project_channels,
    project_guilds,
    project_messages,
    project_users,
)
from palaver.sources.landed import parse_channels, parse_guilds, parse_messages, usable
from tests.conftest import ID_STEP, message


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def values(spark, column, inputs, type_name):
    rows = spark.createDataFrame(list(enumerate(inputs)), f"n int, x {type_name}")
    return [r[0] for r in rows.orderBy("n").select(column(F.col("x"))).collect()]


def test_creation_time_is_an_unsigned_shift(spark):
    got = values(spark, scalars.created_at_ms, [0, ID_STEP, 5 * ID_STEP + 99, -1], "bigint")
    assert got == [1420070400000, 1420070400001, 1420070400005, 1420070400000 + 4398046511103]


def test_creation_time_as_a_timestamp(spark):
    got = values(spark, lambda x: scalars.created_at(x).cast("string"), [1500 * ID_STEP], "bigint")
    assert got == ["2015-01-01 00:00:01.5"]


def test_creation_day_does_not_depend_on_the_session_zone(spark):
    last_ms = 86_400_000 - 1
    ids = [0, last_ms * ID_STEP, (last_ms + 1) * ID_STEP]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = values(spark, lambda x: scalars.created_date(x).cast("string"), ids, "bigint")
            assert got == ["2015-01-01", "2015-01-01", "2015-01-02"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ids_never_wrap(spark):
    texts = ["9223372036854775807", "9223372036854775808", "x", None]
    assert values(spark, scalars.signed_id, texts, "string") == [2**63 - 1, None, None, None]


def test_edit_time_drops_the_fraction(spark, landed):
    rows = landed([message(1, edited_timestamp="1970-01-01T00:00:01.987Z")])
    assert one(project_messages(usable(parse_messages(rows))))["edited_at_ms"] == 1000


def test_only_empty_content_becomes_null(spark):
    assert values(spark, scalars.content_or_null, ["", " ", "a", None], "string") == [None, " ", "a", None]


def test_discriminators(spark):
    got = values(spark, scalars.discriminator_text, ["0042", "0", "0000", None, "abc", "9999"], "string")
    assert got == ["42", None, None, None, None, "9999"]


def test_kind_names(spark):
    codes = ["0", "19", "9999", "Regular", None, "Unknown(3)", "99999999999"]
    got = values(spark, lambda x: kind_name(x, MESSAGE_KINDS), codes, "string")
    assert got == ["Regular", "InlineReply", "Unknown(9999)", "Regular", None, "Unknown(3)", "Unknown(99999999999)"]
    codes = ["0", "5", "10", "11", "12", "15"]
    got = values(spark, lambda x: kind_name(x, CHANNEL_KINDS), codes, "string")
    assert got == ["Text", "News", "NewsThread", "PublicThread", "PrivateThread", "Forum"]


def test_message_row(spark, landed):
    record = message(
        1000,
        guild_id="3",
        kind=19,
        flags=4,
        mentions=[{"id": "8", "tags": ["a", {"b": 1}]}],
        message_reference={"message_id": "1"},
        extra={"kept": True},
    )
    record.pop("reactions")
    record["embeds"] = None
    row = one(project_messages(usable(parse_messages(landed([record])))))
    assert row["id"] == 1000 * ID_STEP and row["guild_id"] == 3 and row["author_id"] == 7
    assert row["created_at_ms"] == 1420070401000 and row["edited_at_ms"] is None
    assert row["kind"] == "InlineReply" and row["flags"] == 4
    assert json.loads(row["mentions"]) == record["mentions"]
    assert row["reactions"] == "[]" and row["embeds"] == "[]" and row["attachments"] == "[]"
    assert row["message_reference"] == '{"message_id":"1"}'
    assert row["raw_json"] == json.dumps(record, separators=(",", ":"))


def test_message_defaults(spark, landed):
    bare = {"id": "1", "channel_id": "2", "author": {"id": "3"}, "arrival_seq": 1}
    row = one(project_messages(human_authors(usable(parse_messages(landed([bare]))))))
    assert (row["tts"], row["pinned"], row["guild_id"], row["content"]) == (False, False, None, None)
    assert row["message_reference"] is None
    null_reference = message(1, message_reference=None)
    assert one(project_messages(usable(parse_messages(landed([null_reference])))))["message_reference"] is None


def test_walk_guild_replaces_the_message_guild(spark, landed):
    rows = usable(parse_messages(landed([message(1, guild_id="3")])))
    walked = rows.withColumn("walk", F.lit(9).cast("bigint"))
    assert one(project_messages(walked, guild_id=F.col("walk")))["guild_id"] == 9


def test_human_authors_keep_unknown_bots(spark, landed):
    def by(number, webhook=None, **author):
        record = message(number, author={"id": str(number), **author})
        return record if webhook is None else {**record, "webhook_id": webhook}

    records = [by(1), by(2, bot=None), by(3, bot=False), by(4, bot=True), by(5, webhook="6", bot=False)]
    rows = human_authors(usable(parse_messages(landed(records))))
    assert sorted(r.author_id for r in rows.collect()) == ["1", "2", "3"]


def test_users_are_authors_with_their_own_json(spark, landed):
    author = {"id": "7", "username": "ann", "discriminator": "0007", "x": [1, 2]}
    record = message(1, author=author, mentions=[{"id": "8"}])
    row = one(project_users(human_authors(usable(parse_messages(landed([record]))))))
    assert row["id"] == 7 and row["discriminator"] == "7" and row["bot"] is False
    assert json.loads(row["raw_json"]) == author


def test_guild_row(spark, landed):
    records = [{"id": "1", "name": "g", "owner_id": "2", "icon": "h", "arrival_seq": 1}]
    row = one(project_guilds(usable(parse_guilds(landed(records)))))
    assert (row["id"], row["owner_id"], row["icon"], row["features"]) == (1, 2, "h", "[]")


def test_channel_rows_and_filter(spark, landed):
    kinds = [0, 2, 4, 5, 10, 11, 12, 15, "Forum", "Voice", 99]
    records = [{"id": str(n), "kind": kind, "arrival_seq": n} for n, kind in enumerate(kinds)]
    rows = project_channels(message_bearing(usable(parse_channels(landed(records))))).collect()
    assert sorted((r.id, r.kind, r.nsfw) for r in rows) == [
        (0, "Text", False),
        (3, "News", False),
        (4, "NewsThread", False),
        (5, "PublicThread", False),
        (6, "PrivateThread", False),
        (7, "Forum", False),
        (8, "Forum", False),
    ]


def test_an_empty_list_is_not_parsed(spark):
    texts = spark.createDataFrame([("[]",), ("[1]",), ("{}",), ("[",), (" []",), (None,)], "text string")
    rows = texts.select(json_list(F.col("text")).alias("list"))
    assert [r.list for r in rows.collect()] == ["[]", "[1]", "[]", "[]", " []", "[]"]
    assert re.search(r"text#\d+ = \[\]", rows._jdf.queryExecution().optimizedPlan().toString())
