"""Incremental polled passes."""

from __future__ import annotations

import pytest

from palaver.archive import ArchiveConfig, Archiver
from tests.conftest import ID_STEP, message


@pytest.fixture
def archiver(spark, tmp_path):
    return Archiver(spark, ArchiveConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "tables")))


def stored(archiver):
    return {r.id // ID_STEP: r.guild_id for r in archiver.archive.messages.read().collect()}


def channel(number, guild, kind="0", seq=1):
    return {"id": str(number), "guild_id": str(guild), "kind": kind, "arrival_seq": seq}


def test_messages_wait_for_their_channel(archiver, land):
    land([channel(10, 3), channel(12, 3, kind="2")], "landing/channels")
    land([message(1), message(2, channel_id="11"), message(3, channel_id="12"), "broken"], "landing/messages")
    archiver.run_polled_once()
    assert stored(archiver) == {1: 3}
    assert [r.value for r in archiver.archive.last_held().collect()] != [] and archiver.archive.last_held().count() == 1
    # A new message of another channel keeps the one that waits; its channel alone releases it.
    land([message(4)], "landing/messages")
    archiver.run_polled_once()
    assert stored(archiver) == {1: 3, 4: 3} and archiver.archive.last_held().count() == 1
    land([channel(11, 5)], "landing/channels")
    archiver.run_polled_once()
    assert stored(archiver) == {1: 3, 2: 5, 4: 3}
    land([message(5, channel_id="11")], "landing/messages")
    archiver.run_polled_once()
    assert stored(archiver) == {1: 3, 2: 5, 4: 3, 5: 5} and archiver.archive.last_held().count() == 0
    assert archiver.archive.quarantine("polled").count() == 1
    progress = {(r.batch_id, r.channel_id): r.processed for r in archiver.archive.progress("polled").collect()}
    assert progress == {(0, 10): 1, (1, 10): 1, (2, 11): 2}


def test_a_channel_that_stops_carrying_messages_is_not_walked(archiver, land):
    land([channel(10, 3, seq=1)], "landing/channels")
    land([message(1)], "landing/messages")
    archiver.run_polled_once()
    land([channel(10, 3, kind="2", seq=2)], "landing/channels")
    land([message(2)], "landing/messages")
    archiver.run_polled_once()
    assert stored(archiver) == {1: 3} and archiver.archive.last_held().count() == 0


def test_passes_end_in_the_state_of_one(spark, tmp_path, land):
    """Split by files in any way, incremental passes store what a full pass over all files does."""
    channels = [channel(10 + k, k % 2) for k in range(3)]
    messages = [message(n, channel_id=str(10 + n % 3), seq=n) for n in range(30)] + [message(n, channel_id=str(10 + n % 3), seq=50 + n, content="again") for n in range(9)]
    archivers = [Archiver(spark, ArchiveConfig(landing=str(tmp_path / name / "landing"), root=str(tmp_path / name / "tables"))) for name in "ab"]
    for part in range(3):
        land(messages[part::3], "a/landing/messages")
        if part == 1:
            land(channels, "a/landing/channels")
        archivers[0].run_polled_once()
    land(messages, "b/landing/messages")
    land(channels, "b/landing/channels")
    archivers[1].run_polled()
    rows = [sorted((r.id, r.guild_id, r.content) for r in a.archive.messages.read().collect()) for a in archivers]
    users = [[(r.id, r.raw_json) for r in a.archive.users.read().collect()] for a in archivers]
    assert rows[0] == rows[1] and len(rows[0]) == 30 and users[0] == users[1]


def test_a_failed_pass_is_repeated(archiver, land, monkeypatch):
    land([channel(10, 3)], "landing/channels")
    land([message(1)], "landing/messages")
    passes = []

    def fails(*_):
        raise RuntimeError("no room")

    def stopped():
        passes.append(stored(archiver))
        if len(passes) == 1:
            monkeypatch.setattr(archiver.archive, "insert_messages", fails)
        else:
            monkeypatch.undo()
        return len(passes) == 3

    object.__setattr__(archiver.config, "poll_interval_secs", 0)
    archiver.poll_forever(stopped)
    assert passes == [{}, {}, {1: 3}]
