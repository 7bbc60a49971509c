"""Tables on disk: creation, merge on read, compaction, replay, pruning."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

from palaver import messages
from palaver.archive import Archive
from palaver.operators.projections import project_messages, project_users
from palaver.sources.landed import parse_messages, usable
from tests.conftest import ID_STEP, message

DAY = 86_400_000


@pytest.fixture
def archive(spark, tmp_path):
    return Archive(spark, str(tmp_path / "tables")).bootstrap()


@pytest.fixture
def rows(landed):
    return lambda records: usable(parse_messages(landed(records)))


def contents(archive):
    return {r.id: r.content for r in archive.messages.read().collect()}


def test_bootstrap_creates_empty_tables_once(spark, archive, rows):
    for table in (archive.guilds, archive.channels, archive.users, archive.messages):
        assert table.read().count() == 0
    assert archive.progress().count() == 0 and archive.quarantine("messages").count() == 0
    archive.insert_messages(project_messages(rows([message(1)])))
    Archive(spark, archive.root).bootstrap()
    assert len(contents(archive)) == 1


def test_inserts_are_first_write_wins(archive, rows):
    archive.insert_messages(project_messages(rows([message(1, content="a"), message(DAY, content="b")])))
    again = [message(1, seq=9, content="changed"), message(2 * DAY, seq=3, content="c")]
    archive.insert_messages(project_messages(rows(again)), batch_rows=2)
    archive.insert_messages(project_messages(rows(again)))
    assert contents(archive) == {ID_STEP: "a", DAY * ID_STEP: "b", 2 * DAY * ID_STEP: "c"}


def files(archive, pattern="*"):
    return sorted(Path(archive.messages.path).glob(f"data/version=*/created_date={pattern}/part-*.parquet"))


def test_a_half_written_batch_is_not_seen_and_completed_by_its_replay(archive, rows, monkeypatch):
    batch = project_messages(rows([message(n * DAY) for n in range(6)]))
    archive.insert_messages(project_messages(rows([message(7)])))

    def fails(_):
        raise RuntimeError

    with monkeypatch.context() as broken:
        broken.setattr(archive.messages, "_commit", fails)
        with pytest.raises(RuntimeError):
            archive.insert_messages(batch)
    assert len(files(archive)) == 7 and list(contents(archive)) == [7 * ID_STEP]
    archive.insert_messages(batch)
    whole = contents(archive)
    assert len(whole) == 7
    archive.insert_messages(batch)
    assert contents(archive) == whole and len(files(archive)) == 7


def test_days_have_few_files_after_many_batches(archive, rows, monkeypatch):
    """50 batches of two days; a compaction that breaks off leaves what was there."""
    archive.messages.fan_in = 4
    monkeypatch.setattr(messages, "COMMITS_PER_GENERATION", 9)
    for n in range(50):
        batch = project_messages(rows([message(2 * n), message(2 * n + 1), message(DAY + n)]))
        if n == 31:
            with monkeypatch.context() as broken:
                broken.setattr(archive.messages, "compact", lambda live: None)
                archive.insert_messages(batch)
            with monkeypatch.context() as broken:
                broken.setattr(archive.messages, "_commit", lambda _: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    archive.messages.compact()
            assert len(contents(archive)) == 3 * (n + 1)
        else:
            archive.insert_messages(batch)
    live = archive.messages.days()
    assert all(len(versions) <= 3 * 3 and sum(v.rows for v in versions) in (50, 100) for versions in live.values())
    assert len(contents(archive)) == 150
    assert archive.messages.vacuum() > 50 and archive.messages.vacuum() == 0
    assert len(files(archive)) == sum(map(len, live.values())) and len(contents(archive)) == 150
    found = archive.messages.bounds().collect()
    assert [(r.channel_id, r.lo, r.hi, r.n) for r in found] == [(10, 0, (DAY + 49) * ID_STEP, 150)]
    archive.insert_messages(project_messages(rows([message(3, content="late"), message(5000)])))
    assert len(contents(archive)) == 151


def test_one_partition_per_utc_day(archive, rows):
    archive.insert_messages(project_messages(rows([message(0), message(DAY - 1), message(DAY)])))
    days = sorted(p.parent.name for p in files(archive))
    assert days == ["created_date=2015-01-01", "created_date=2015-01-02"]


def test_a_hot_day_is_split_over_tasks(spark, archive, rows):
    hot = [message(n, content="x" * 400) for n in range(4000)]
    cold = [message(n * DAY) for n in range(1, 4)]
    batch = project_messages(rows(hot + cold)).repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64k")
        archive.messages.append(batch)
    finally:
        spark.conf.set(key, before)
    assert len(files(archive, "2015-01-01")) > 1 and len(files(archive, "2015-01-03")) == 1
    assert len(contents(archive)) == 4003


def test_upserts_merge_on_read_and_survive_compaction(archive, rows):
    def users(*names):
        records = [message(seq, author={"id": "7", "username": name}) for seq, name in names]
        return project_users(rows(records))

    archive.upsert_users(users((1, "a"), (3, "c")))
    archive.upsert_users(users((2, "b")))
    assert [r.username for r in archive.users.read().collect()] == ["c"]
    archive.users.compact()
    assert archive.users.generation() == 1
    assert [r.username for r in archive.users.read().collect()] == ["c"]
    archive.upsert_users(users((2, "b")))
    assert [r.username for r in archive.users.read().collect()] == ["c"]
    archive.upsert_users(users((4, None)))
    assert [r.username for r in archive.users.read().collect()] == [None]


def test_bounds_and_pages_on_the_table(archive, rows):
    archive.insert_messages(project_messages(rows([message(n * DAY) for n in range(1, 8)])))
    assert archive.min_message_id_in_channel(10) == DAY * ID_STEP
    assert archive.max_message_id_in_channel(10) == 7 * DAY * ID_STEP
    assert archive.max_message_id_in_channel(11) is None
    page = archive.page_latest(10, limit=3).collect()
    assert [r.id // ID_STEP // DAY for r in page] == [7, 6, 5]
    assert [r.content for r in page] == [f"text {n * DAY}" for n in (7, 6, 5)]
    page = archive.page_before(10, 4 * DAY * ID_STEP, limit=2).collect()
    assert [r.id // ID_STEP // DAY for r in page] == [3, 2]
    page = archive.page_after(10, 4 * DAY * ID_STEP, limit=2).collect()
    assert [r.id // ID_STEP // DAY for r in page] == [5, 6]
    assert [r.id // ID_STEP // DAY for r in archive.timeline(10).collect()] == list(range(1, 8))


def test_compacted_days_let_reads_of_an_author_pass_over_row_groups(spark, archive, rows):
    """A day of many row groups, in which every author writes in every channel."""
    archive.messages.fan_in = 2
    key = "parquet.block.size"
    records = [message(n, channel_id=str(10 + n % 16), author={"id": str(100 + n // 16 % 24), "username": "u"}, content="x" * 200) for n in range(6000)]
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set(key, "65536")
    hadoop.set("parquet.page.size.row.check.min", "10")
    hadoop.set("parquet.block.size.row.check.min", "10")
    try:
        archive.insert_messages(project_messages(rows(records[::2])))
        archive.insert_messages(project_messages(rows(records[1::2])))
    finally:
        hadoop.unset(key)
    live = archive.messages.days()
    assert [v.level for versions in live.values() for v in versions] == [1]
    newest = max(v.number for versions in live.values() for v in versions)
    found = {"author_id": [], "channel_id": []}
    for path in files(archive):
        if f"version={newest}/" in str(path):
            for column, groups in found.items():
                groups += duckdb.sql(f"select stats_min_value::bigint, stats_max_value::bigint from parquet_metadata('{path}') where path_in_schema = '{column}'").fetchall()
    for column, one in (("author_id", 107), ("channel_id", 13)):
        groups = found[column]
        assert len(groups) > 8 and sum(lo <= one <= hi for lo, hi in groups) <= len(groups) / 2, column
    timeline = [(r.created_at_ms, r.id) for r in archive.timeline(13).collect()]
    assert timeline == sorted(timeline) and len(timeline) == 375
    assert archive.author_history(107).count() == sum(r["author"]["id"] == "107" for r in records)


def days_read(df):
    return sorted({re.search("created_date=([0-9-]+)", f)[1] for f in df.inputFiles()})


def test_pages_read_the_days_that_fill_them(archive, rows):
    records = [message(n * DAY + k) for n in range(8) for k in range(4)] + [message(n * DAY + 9, channel_id="11") for n in range(20)]
    archive.insert_messages(project_messages(rows(records)))
    archive.insert_messages(project_messages(rows([message(5 * DAY + 7)])))
    assert days_read(archive.page_latest(10, limit=4)) == ["2015-01-08"]
    assert days_read(archive.page_latest(10, limit=5)) == ["2015-01-07", "2015-01-08"]
    # The cursor lies inside a day, whose rows may be on either side of it.
    assert days_read(archive.page_before(10, (3 * DAY + 2) * ID_STEP, limit=4)) == ["2015-01-03", "2015-01-04"]
    assert days_read(archive.page_after(10, (3 * DAY + 2) * ID_STEP, limit=5)) == ["2015-01-04", "2015-01-05", "2015-01-06"]
    assert days_read(archive.messages.channel(11, before=2 * DAY * ID_STEP)) == ["2015-01-01", "2015-01-02"]
    page = archive.page_after(10, (3 * DAY + 2) * ID_STEP, limit=6).collect()
    assert [r.id // ID_STEP for r in page] == [3 * DAY + 3, *(4 * DAY + k for k in range(4)), 5 * DAY]
    assert archive.page_latest(12).collect() == [] and archive.page_before(10, 0).collect() == []
    assert all("/summary/" in f for f in archive.messages.bounds().inputFiles())


def test_reads_of_the_archive(archive, rows):
    records = [message(n, content=f"text {n}") for n in range(4)]
    archive.insert_messages(project_messages(rows(records)))
    author = archive.messages.read().first().author_id
    assert [r.id for r in archive.author_history(author).collect()] == sorted(contents(archive))
    assert archive.author_history(-1).count() == 0
    assert [r.content for r in archive.search(text="text", pattern="[3-9]$").collect()] == ["text 3"]
    assert archive.elements("mentions").columns == ["message_id", "channel_id", "position", "element"]
    assert archive.replies().count() == archive.messages.read().where("message_reference is not null").count()


def test_ids_have_small_bloom_filters(archive, rows):
    archive.insert_messages(project_messages(rows([message(n) for n in range(4)])))
    path = files(archive)[0]
    found = duckdb.sql(f"select path_in_schema from parquet_metadata('{path}') where bloom_filter_offset is not null").fetchall()
    # The one author of these rows is in a dictionary, which readers use in the same way.
    assert found == [("id",)]
    assert path.stat().st_size < 100_000
