"""What is missing, and what a pass does about it."""

from __future__ import annotations

import random

from palaver.operators import counters
from palaver.operators.access import json_elements
from palaver.operators.dedup import first_wins
from palaver.operators.filters import human_authors
from palaver.operators.merge import insert_first
from palaver.operators.projections import project_messages
from palaver.plans import history
from palaver.sources.landed import parse_messages, usable
from tests.conftest import message


def pairs(df):
    return sorted((r.channel_id, r.id) for r in df.collect())


def test_phases_are_disjoint_and_make_up_the_anti_join(spark):
    rng = random.Random(8)
    rows = [(n, 1 if n % 3 == 0 else 2 + n % 4) for n in rng.sample(range(5000), 800)]
    kept = [(n, c) for n, c in rows if 1500 < n < 3500 and n % 7 and c != 4]
    schema = "id bigint, channel_id bigint"
    source, archive = spark.createDataFrame(rows, schema), spark.createDataFrame(kept, schema)
    parts = [
        pairs(f(source, archive))
        for f in (history.backfill_rows, history.catch_up_rows, history.interior_gap_rows)
    ]
    missing = sorted((c, n) for n, c in set(rows) - set(kept))
    assert sorted(sum(parts, [])) == missing == pairs(history.missing_messages(source, archive))
    labelled = history.missing_messages_labelled(source, archive).collect()
    for part, phase in zip(parts, ("backfill", "catch_up", "interior"), strict=True):
        assert sorted((r.channel_id, r.id) for r in labelled if r.phase == phase) == part


def test_a_page_of_bots_does_not_hide_older_messages(spark, landed):
    people = [message(n) for n in range(1, 6)]
    bots = [message(n, author={"id": "1", "bot": True}) for n in range(10, 160)]
    newest = [message(500)]
    source = human_authors(usable(parse_messages(landed(people + bots + newest))))
    stored = project_messages(source).where("created_at_ms = 1420070400500")
    missing = history.missing_messages(first_wins(project_messages(source)), stored)
    assert missing.count() == 5


def test_a_second_pass_adds_nothing(spark, landed):
    batch = project_messages(human_authors(usable(parse_messages(landed([message(n) for n in range(9)])))))
    first = insert_first(batch.where("false"), batch)
    assert first.count() == 9
    assert insert_first(first, batch).count() == 0


def test_counters(spark):
    source = spark.createDataFrame(
        [(n, 1, n % 2 == 0) for n in range(250)] + [(n, 2, True) for n in range(1000, 1100)],
        "id bigint, channel_id bigint, is_human boolean",
    )
    archive = spark.createDataFrame([(100, 1), (150, 1)], "id bigint, channel_id bigint")
    rows = {r.channel_id: r for r in counters.processed_counts(source, archive).collect()}
    assert rows[1].backfill_processed == 50 and rows[1].catch_up_processed == 49
    assert rows[1].sweep_processed == 125 and rows[1].processed == 224 and rows[1].inserted == 123
    assert rows[2].backfill_processed == 100 and rows[2].processed == 200 and rows[2].inserted == 100
    pages = {r.channel_id: r for r in counters.page_counts(source, archive).collect()}
    assert (pages[1].backfill_pages, pages[1].catch_up_pages, pages[1].sweep_pages) == (1, 1, 3)
    assert (pages[2].backfill_pages, pages[2].catch_up_pages, pages[2].sweep_pages) == (1, 0, 1)


def test_json_elements_keep_their_text(spark):
    rows = spark.createDataFrame(
        [(1, 9, '[{"a":[1,2]},"x",null]'), (2, 9, "[]"), (3, 9, None)],
        "id bigint, channel_id bigint, embeds string",
    )
    got = sorted((r.message_id, r.position, r.element) for r in json_elements(rows, "embeds").collect())
    assert got == [(1, 0, '{"a":[1,2]}'), (1, 1, "x"), (1, 2, None)]


def test_catch_up_of_an_empty_channel_starts_at_its_newest_human_row(spark):
    source = spark.createDataFrame([(1, 5, True), (2, 5, False), (3, 5, False), (1, 6, False)], "id bigint, channel_id bigint, is_human boolean")
    archive = spark.createDataFrame([], "id bigint, channel_id bigint")
    pages = {r.channel_id: (r.backfill_pages, r.catch_up_pages, r.sweep_pages) for r in counters.page_counts(source, archive, page=2).collect()}
    assert pages == {5: (2, 1, 2), 6: (1, 0, 1)}
