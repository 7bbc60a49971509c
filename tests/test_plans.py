"""Plans that must hold at scale."""

from __future__ import annotations

import re

import pytest

from palaver import messages
from palaver.archive import Archive
from palaver.operators.dedup import first_wins
from palaver.operators.filters import human_authors
from palaver.operators.joins import absent_rows
from palaver.operators.paging import pages_latest
from palaver.operators.projections import project_messages
from palaver.sources.landed import parse_messages, read_lines, usable
from tests.conftest import message
from workbench.queries import REGISTRY

DAY = 86_400_000
STREAMED = ("stream", "live", "incremental", "bootstrap", "stored", "written", "polled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 as id", "id as arrival_seq", "id % 3 as channel_id")
    assert re.search(r"Exchange.*\n.*WindowGroupLimit.*Partial", plan(first_wins(df)))
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan(pages_latest(df, 10)))) == 2


def test_the_anti_join_uses_the_partitioning_of_the_dedup(spark):
    df = spark.range(100).selectExpr("id % 7 as id", "id as arrival_seq")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        text = plan(absent_rows(first_wins(df), spark.range(50)))
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning(id") == 2


def test_a_line_is_parsed_once(spark, land):
    lines = read_lines(spark, land([message(1)]))
    text = plan(project_messages(human_authors(usable(parse_messages(lines)))))
    assert text.count("from_json") == 1 and "get_json_object" not in text


def test_only_days_of_the_batch_are_read(spark, tmp_path, landed):
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    rows = usable(parse_messages(landed([message(n * DAY) for n in range(20)])))
    archive.insert_messages(project_messages(rows))
    batch = project_messages(usable(parse_messages(landed([message(3 * DAY + 1), message(4 * DAY)]))))
    fresh = archive.messages.absent(batch, batch_rows=2)
    assert sorted({f.split("created_date=")[1][:10] for f in fresh.inputFiles() if "created_date" in f}) == ["2015-01-04", "2015-01-05"]
    assert "ReadSchema: struct<id:bigint>" in plan(fresh)
    assert [r.id >> 22 for r in fresh.collect()] == [3 * DAY + 1]


@pytest.mark.parametrize("limit", [100, 20, 4, 0])
def test_large_batches_store_the_first_of_each_new_id(spark, tmp_path, landed, monkeypatch, limit):
    """Whatever is few enough to be sent to all tasks: new ids, ids to leave out, ids that come again, or none of them."""
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    archive.insert_messages(project_messages(usable(parse_messages(landed([message(n, content="old") for n in range(6)])))))
    once, again = [message(n) for n in range(4, 30)], [message(n, seq=90, content="again") for n in (4, 7, 8)]
    monkeypatch.setattr(messages, "MAX_BROADCAST_ROWS", limit)
    batch = project_messages(usable(parse_messages(landed([*again, *again, *once]))))
    fresh = archive.messages.absent(batch, batch_rows=32)
    assert sorted((r.id >> 22, r.content) for r in fresh.collect()) == [(n, f"text {n}") for n in range(6, 30)]


def test_rows_of_ids_that_come_once_are_not_ranked(spark, tmp_path, landed, monkeypatch):
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    archive.insert_messages(project_messages(usable(parse_messages(landed([message(n) for n in range(6)])))))
    batch = project_messages(usable(parse_messages(landed([message(n) for n in range(4, 30)]))))
    for limit, moved in ((8, False), (1, True)):
        monkeypatch.setattr(messages, "MAX_BROADCAST_ROWS", limit)
        fresh = archive.messages.absent(batch, batch_rows=26)
        assert "Window" not in plan(fresh) and ("LeftSemi" in plan(fresh)) == moved
        assert sorted(r.id >> 22 for r in fresh.collect()) == list(range(6, 30))


def test_channel_filters_reach_the_scan(spark, tmp_path, landed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    archive.insert_messages(project_messages(usable(parse_messages(landed([message(1)])))))
    text = plan(archive.messages.channel(10, before=5 * DAY << 22).select("id"))
    assert "EqualTo(channel_id,10)" in text and "LessThan(id," in text
    assert "ReadSchema: struct<id:bigint,channel_id:bigint>" in text


def test_pages_read_whole_rows_of_their_days_only(spark, tmp_path, landed):
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    rows = [message(n * DAY) for n in range(6)]
    archive.insert_messages(project_messages(usable(parse_messages(landed(rows)))))
    text = plan(archive.page_latest(10, 2))
    assert "dynamicpruning" in text
    # The keys come from a scan of two columns.
    assert "ReadSchema: struct<id:bigint,channel_id:bigint>" in text


def test_a_pass_over_an_unchanged_source_reads_no_stored_id(spark, tmp_path, landed):
    archive = Archive(spark, str(tmp_path / "tables")).bootstrap()
    records = [message(n * DAY + k, channel_id=str(10 + k)) for n in range(6) for k in range(3)]
    batch = project_messages(usable(parse_messages(landed(records))))
    archive.messages.append(archive.messages.absent_by_digest(batch))
    again = archive.messages.absent_by_digest(batch)
    assert not any("/data/" in f for f in again.inputFiles()) and again.count() == 0
    more = project_messages(usable(parse_messages(landed([*records, *records[:3], message(4 * DAY + 7), message(9 * DAY)]))))
    fresh = archive.messages.absent_by_digest(more)
    assert sorted(r.id >> 22 for r in fresh.collect()) == [4 * DAY + 7, 9 * DAY]


@pytest.mark.parametrize("name", [n for n in REGISTRY if not any(s in n for s in STREAMED)])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(REGISTRY[name](spark, "/root/testdata/sf0.001"))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in text
