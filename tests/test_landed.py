"""Bad input is set aside with its reason; the rest goes on."""

from __future__ import annotations

import json

from palaver.sources.landed import (
    parse_channels,
    parse_guilds,
    parse_messages,
    read_lines,
    rejected,
    usable,
)
from tests.conftest import message


def reasons(parsed):
    return sorted(r.reject_reason for r in rejected(parsed).collect())


def test_bad_messages_are_quarantined_whole(spark, landed):
    good = message(1)
    missing_id = message(2)
    del missing_id["id"]
    no_author = message(3)
    del no_author["author"]
    no_seq = message(4)
    del no_seq["arrival_seq"]
    records = [
        good,
        missing_id,
        no_author,
        no_seq,
        "not json",
        json.dumps(message(5))[:-7],
        "[1, 2]",
        message(6, id="9223372036854775808"),
        message(7, channel_id="ten"),
        message(8, author={"username": "no id"}),
        message(9, guild_id="-4"),
        message(10, webhook_id="99999999999999999999"),
        message(11, tts="perhaps"),
        "",
        "   ",
    ]
    parsed = parse_messages(landed(records))
    assert [r.id for r in usable(parsed).collect()] == [good["id"]]
    assert reasons(parsed) == [
        "bad_author_id",
        "bad_author_id",
        "bad_channel_id",
        "bad_guild_id",
        "bad_id",
        "bad_id",
        "bad_webhook_id",
        "malformed",
        "malformed",
        "malformed",
        "malformed",
        "no_arrival_seq",
    ]


def test_rejected_lines_keep_their_text_and_file(spark, land):
    folder = land(["oops"])
    row = rejected(parse_guilds(read_lines(spark, folder))).first()
    assert row.raw_json == "oops" and folder in row.source_file


def test_optional_ids_of_guilds_and_channels(spark, landed):
    guilds = [{"id": "1", "owner_id": "x", "arrival_seq": 1}, {"id": "2", "arrival_seq": 2}]
    assert reasons(parse_guilds(landed(guilds))) == ["bad_owner_id"]
    channels = [
        {"id": "1", "guild_id": "x", "arrival_seq": 1},
        {"id": "2", "parent_id": "9223372036854775808", "arrival_seq": 2},
        {"id": "3", "position": "far", "arrival_seq": 3},
        {"id": "4", "arrival_seq": 4},
    ]
    assert reasons(parse_channels(landed(channels))) == ["bad_guild_id", "bad_parent_id", "malformed"]


def test_ids_may_be_json_numbers(spark, landed):
    record = message(1, id=12345678901234567, channel_id=10)
    assert usable(parse_messages(landed([record]))).first().id == "12345678901234567"


def test_no_input_is_no_output(spark, landed):
    parsed = parse_messages(landed([]))
    assert usable(parsed).count() == 0 and rejected(parsed).count() == 0
