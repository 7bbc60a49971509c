"""Pages and bounds against brute force."""

from __future__ import annotations

import random

import pytest

from palaver.operators import paging
from palaver.operators.bounds import (
    channel_bounds,
    max_message_id_in_channel,
    min_message_id_in_channel,
)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    ids = rng.sample(range(10_000), 900)
    # Channel 1 holds more than a third; channel 9 is nearly empty.
    return [(n, 1 if n % 5 < 2 else 2 + n % 3) for n in ids] + [(20_000, 9)]


@pytest.fixture
def messages(spark, rows):
    return spark.createDataFrame(rows, "id bigint, channel_id bigint").repartition(6)


def ids(df):
    return [r.id for r in df.collect()]


def in_channel(rows, channel):
    return sorted(n for n, c in rows if c == channel)


@pytest.mark.parametrize("limit", [1, 7, 100, 5000])
def test_single_channel_pages(messages, rows, limit):
    known = in_channel(rows, 1)
    assert ids(paging.page_latest(messages, 1, limit)) == known[::-1][:limit]
    cursor = known[len(known) // 2]
    older = [n for n in known[::-1] if n < cursor]
    newer = [n for n in known if n > cursor]
    assert ids(paging.page_before(messages, 1, cursor, limit)) == older[:limit]
    assert ids(paging.page_after(messages, 1, cursor, limit)) == newer[:limit]


def test_pages_of_unknown_channels_are_empty(messages):
    assert ids(paging.page_latest(messages, 77)) == []
    assert ids(paging.page_before(messages, 1, -1)) == []
    assert ids(paging.page_after(messages, 1, 10**9)) == []


def test_pages_of_all_channels(spark, messages, rows):
    got = {(r.channel_id, r.id) for r in paging.pages_latest(messages, 10).collect()}
    want = {(c, n) for c in {c for _, c in rows} for n in in_channel(rows, c)[-10:]}
    assert got == want

    stored = messages.where("id between 3000 and 6000 and channel_id <> 9")
    bounds = channel_bounds(stored)
    limits = {r.channel_id: (r.lo, r.hi) for r in bounds.collect()}
    before, after = set(), set()
    for c in {c for _, c in rows}:
        known = in_channel(rows, c)
        lo, hi = limits.get(c, (None, None))
        before |= {(c, n) for n in [n for n in known if lo is None or n < lo][-10:]}
        after |= {(c, n) for n in [n for n in known if hi is not None and n > hi][:10]}
    assert {(r.channel_id, r.id) for r in paging.pages_before(messages, bounds, 10).collect()} == before
    assert {(r.channel_id, r.id) for r in paging.pages_after(messages, bounds, 10).collect()} == after


def test_walking_pages_meets_every_row_once(messages, rows):
    known, met, cursor = in_channel(rows, 4), [], None
    while True:
        page = (
            paging.page_latest(messages, 4, 50)
            if cursor is None
            else paging.page_before(messages, 4, cursor, 50)
        )
        got = ids(page)
        met += got
        if len(got) < 50:
            break
        cursor = got[-1]
    assert met == known[::-1]


def test_guild_pages(spark):
    guilds = spark.createDataFrame([(n,) for n in range(500)], "id bigint").repartition(3)
    assert ids(paging.guild_page_after(guilds)) == list(range(200))
    assert ids(paging.guild_page_after(guilds, 450)) == list(range(451, 500))
    assert ids(paging.guild_page_after(guilds, 499)) == []


def test_bounds(messages, rows):
    assert min_message_id_in_channel(messages, 2) == in_channel(rows, 2)[0]
    assert max_message_id_in_channel(messages, 2) == in_channel(rows, 2)[-1]
    assert max_message_id_in_channel(messages, 77) is None
    assert {r.channel_id for r in channel_bounds(messages).collect()} == {c for _, c in rows}
