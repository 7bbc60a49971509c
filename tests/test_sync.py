"""A polled pass that writes."""

from __future__ import annotations

import pytest

from palaver.archive import Archive, ArchiveConfig, Archiver
from palaver.plans.sync import run_pass
from tests.conftest import ID_STEP, message


@pytest.mark.parametrize("passes", [1, 2])
def test_a_pass_takes_the_walk_only_and_repeats_harmlessly(spark, tmp_path, landed, passes):
    guilds = [{"id": "1", "name": "g", "arrival_seq": 1}]
    channels = [
        {"id": "10", "guild_id": "1", "kind": 0, "arrival_seq": 1},
        {"id": "11", "guild_id": "1", "kind": 2, "arrival_seq": 2},
    ]
    messages = [
        message(1, author={"id": "7", "username": "a"}),
        message(2, guild_id="99", author={"id": "7", "username": "b"}),
        message(3, channel_id="11", author={"id": "7", "username": "voice"}),
        message(4, channel_id="12", author={"id": "8"}),
        message(5, author={"id": "9", "bot": True}),
        message(1, seq=6, content="again", author={"id": "6"}),
        "broken",
    ]
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    for _ in range(passes):
        run_pass(archive, landed(guilds), landed(channels), landed(messages))
    stored = {r.id // ID_STEP: (r.guild_id, r.content) for r in archive.messages.read().collect()}
    assert stored == {1: (1, "text 1"), 2: (1, "text 2")}
    assert {r.id: r.username for r in archive.users.read().collect()} == {6: None, 7: "b"}
    assert [r.id for r in archive.channels.read().collect()] == [10]
    assert archive.guilds.read().count() == 1


def test_a_polled_pass_of_the_archiver_sets_broken_lines_of_each_feed_aside(spark, tmp_path, land):
    land([{"id": "1", "name": "g", "arrival_seq": 1}, "no guild"], "landing/guilds")
    land([{"id": "10", "guild_id": "1", "kind": 0, "arrival_seq": 1}, "no channel"], "landing/channels")
    land([message(1), message(2, channel_id="12"), "no message"], "landing/messages")
    archiver = Archiver(spark, ArchiveConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "tables")))
    for _ in range(2):
        archiver.run_polled()
    assert [r.id // ID_STEP for r in archiver.archive.messages.read().collect()] == [1]
    for feed in ("guild", "channel", "message"):
        assert [r.raw_json for r in archiver.archive.quarantine(f"polled_{feed}s").collect()] == [f"no {feed}"]
