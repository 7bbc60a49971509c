"""Streams: same result as a batch, however the input is split, restarted or repeated."""

from __future__ import annotations

import os
import time

import pytest

from palaver.archive import ArchiveConfig, Archiver
from tests.conftest import ID_STEP, message


@pytest.fixture
def archiver(spark, tmp_path):
    def make(name="tables", **options):
        config = ArchiveConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / name), **options)
        return Archiver(spark, config)

    return make


def user(number, name):
    return {"author": {"id": str(number), "username": name}}


def state(archive):
    messages = {r.id // ID_STEP: r.content for r in archive.messages.read().collect()}
    return messages, {r.id: r.username for r in archive.users.read().collect()}


def test_passes_fill_the_archive_and_restart_where_they_stopped(archiver, land):
    land([{"id": "1", "name": "g", "arrival_seq": 1}], "landing/guilds")
    land(
        [
            {"id": "10", "guild_id": "1", "kind": 0, "arrival_seq": 1},
            {"id": "11", "guild_id": "1", "kind": 2, "arrival_seq": 2},
        ],
        "landing/channels",
    )
    land([message(2, **user(7, "a")), message(3, **user(8, "b")), "broken"], "landing/messages")
    run = archiver()
    run.run_once()
    assert state(run.archive) == ({2: "text 2", 3: "text 3"}, {7: "a", 8: "b"})
    assert [r.id for r in run.archive.guilds.read().collect()] == [1]
    assert [r.id for r in run.archive.channels.read().collect()] == [10]
    assert [r.raw_json for r in run.archive.quarantine("messages").collect()] == ["broken"]

    assert [tuple(r) for r in run.archive.progress().collect()] == [(10, 2, 0)]
    run.archive.create_views()
    assert run.spark.sql("select count(*) from messages join users on author_id = users.id").first()[0] == 2

    run.run_once()
    # Late, repeated, changed and bot messages; one of a channel that was never polled.
    land(
        [
            message(1, seq=20, **user(7, "a2")),
            message(2, seq=21, content="edited", **user(8, None)),
            message(9, seq=22, author={"id": "9", "bot": True}),
            message(4, seq=23, channel_id="555", **user(10, "c")),
        ],
        "landing/messages",
    )
    again = archiver()
    again.run_once()
    messages, users = state(again.archive)
    assert messages == {1: "text 1", 2: "text 2", 3: "text 3", 4: "text 4"}
    assert users == {7: "a2", 8: None, 10: "c"}


def test_file_order_and_splits_do_not_matter_for_ids_and_users(archiver, land):
    first = [message(n, **user(n % 2, f"v{n}")) for n in range(1, 6)]
    second = [message(n, seq=n + 10, **user(n % 2, f"v{n + 10}")) for n in range(3, 9)]
    land(second, "landing/messages")
    land(first, "landing/messages")
    split = archiver("split", max_files_per_trigger=1)
    split.run_once()
    whole = archiver("whole")
    whole.run_once()
    assert set(state(split.archive)[0]) == set(state(whole.archive)[0]) == set(range(1, 9))
    assert state(split.archive)[1] == state(whole.archive)[1] == {0: "v18", 1: "v17"}
    # In one batch the first delivery is stored, whatever file it was in.
    assert state(whole.archive)[0][4] == "text 4"


def test_the_same_file_twice_changes_nothing(archiver, land):
    records = [message(n, **user(n, f"u{n}")) for n in range(5)]
    land(records, "landing/messages")
    run = archiver()
    run.run_once()
    before = state(run.archive)
    land(records, "landing/messages")
    run.run_once()
    assert state(run.archive) == before
    assert run.archive.messages.read().count() == 5


def test_a_replayed_batch_changes_nothing(spark, archiver, land):
    from palaver.sources.landed import read_lines
    from palaver.streaming.live import message_batch

    run = archiver()
    lines = read_lines(spark, land([message(1), message(2), "broken"], "elsewhere"))
    apply = message_batch(run.archive)
    apply(lines, 0)
    before = state(run.archive)
    apply(lines, 0)
    assert state(run.archive) == before
    assert run.archive.quarantine("messages").count() == 1


def test_a_batch_keeps_few_columns_and_cuts_out_the_json_of_last_arrivals_only(spark, landed):
    from palaver.streaming import live

    records = [message(n, seq=n % 5, **user(n % 3, f"v{n}")) for n in range(9)] + [message(20, author={"id": "1", "bot": True})]
    kept = live._kept(landed(records))
    try:
        assert kept.columns == [*live.READ_ALONE, "others"]
        assert "get_json_object" not in kept._jdf.queryExecution().optimizedPlan().toString()
        human = live.human_authors(live.usable(live._parsed(kept)))
        newest = live._newest_arrivals(human)
        assert {r.author: (r.newest_seq, r.n) for r in newest.collect()} == {0: (3, 3), 1: (4, 3), 2: (3, 3)}
        few, many = live._users_of(human, newest, 3), live._users_of(human, newest, live.MAX_BROADCAST_ROWS + 1)
        assert {r.id: (r.username, r.raw_json) for r in few.collect()} == {
            n: (v, f'{{"id":"{n}","username":"{v}"}}') for n, v in ((0, "v3"), (1, "v4"), (2, "v8"))
        }
        assert sorted(few.collect()) == sorted(many.collect())
    finally:
        kept.unpersist()


def test_feeds_compact_now_and_then(archiver, land):
    for n in range(4):
        land([message(n, **user(7, f"v{n}"))], "landing/messages")
    run = archiver(max_files_per_trigger=1, compact_every=3)
    run.run_once()
    assert run.archive.users.generation() == 1
    assert state(run.archive) == ({n: f"text {n}" for n in range(4)}, {7: "v3"})


def test_files_with_an_old_modification_time_are_taken(archiver, land, tmp_path):
    land([message(1)], "landing/messages")
    run = archiver()
    run.run_once()
    land([message(2)], "landing/messages/restored")
    years_ago = time.time() - 3650 * 24 * 3600
    for path in (tmp_path / "landing/messages/restored").iterdir():
        os.utime(path, (years_ago, years_ago))
    run.run_once()
    assert set(state(run.archive)[0]) == {1, 2}


def test_polling_picks_up_new_files(archiver, land):
    run = archiver(poll_interval_secs=0)
    queries = run.run_forever()
    try:
        land([message(1)], "landing/messages")
        for query in queries:
            query.processAllAvailable()
        assert run.archive.messages.read().count() == 1
    finally:
        for query in queries:
            query.stop()


def test_a_feed_that_ended_starts_again_while_the_others_go_on(archiver):
    run = archiver(poll_interval_secs=3600)
    running = run.run_forever()
    try:
        running[2].stop()
        again = run.restarted(running)
        assert again[:2] == running[:2] and again[2] is not running[2]
        assert all(q.isActive for q in again)
        running = again
    finally:
        for query in running:
            query.stop()


def test_finished_files_leave_and_old_ones_are_swept(archiver, land, tmp_path):
    """A file dated ten years back lands while the stream runs: it is stored once, and landed files don't pile up."""
    def age(name, years):
        for path in (tmp_path / "landing/messages").glob(name):
            os.utime(path, (time.time() - years * 365 * 86_400,) * 2)

    def waiting():
        return sorted(p.name for p in (tmp_path / "landing/messages").rglob("*.json"))

    run = archiver(finished=str(tmp_path / "finished"), sweep_files=1)
    for n in range(3):
        land([message(n)], "landing/messages")
        run.run_once()
        assert len(waiting()) <= 2
    before = set(waiting())
    for n in (50, 51):
        land([message(n), "broken"], "landing/messages")
    for name in set(waiting()) - before:
        age(name, 10)
    run.run_once()
    assert set(state(run.archive)[0]) == {0, 1, 2, 50, 51}
    assert run.archive.swept("messages").count() == 2 and run.archive.quarantine("messages").count() == 2
    assert sorted(r.batch_id for r in run.archive.quarantine("messages").collect()) == [-2, -1]
    run.run_once()
    assert run.archive.swept("messages").count() == 2 and run.sweep("messages") == 0
    # A sweep that broke off before its ledger was written is repeated.
    land([message(60)], "landing/messages")
    for name in set(waiting()) - before:
        age(name, 10)
    write, run.archive.write_swept = run.archive.write_swept, lambda *_: 1 / 0
    with pytest.raises(ZeroDivisionError):
        run.sweep("messages")
    run.archive.write_swept = write
    assert run.sweep("messages") >= 1
    assert set(state(run.archive)[0]) == {0, 1, 2, 50, 51, 60}
    run.run_polled()
    assert set(state(run.archive)[0]) == {0, 1, 2, 50, 51, 60}
