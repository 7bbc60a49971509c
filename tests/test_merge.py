"""First and last write wins, against brute force on small inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from palaver.operators.dedup import first_wins, last_wins
from palaver.operators.joins import absent_rows, lookup_join
from palaver.operators.merge import insert_first, upsert_last

SCHEMA = "id bigint, name string, arrival_seq bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def result(df):
    return sorted(map(tuple, df.select("id", "name", "arrival_seq").collect()))


def random_rows(seed, size, first_seq=0):
    rng = random.Random(seed)
    seqs = rng.sample(range(first_seq, first_seq + 10 * size), size)
    # A third of the rows share one key.
    return [
        (5 if rng.random() < 0.34 else rng.randrange(20), rng.choice(["a", "b", None]), seq)
        for seq in seqs
    ]


def pick(rows, newest):
    best = {}
    for row in sorted(rows, key=lambda r: r[2], reverse=not newest):
        best[row[0]] = row
    return sorted(best.values())


@pytest.mark.parametrize("seed", range(3))
def test_dedup_matches_brute_force(spark, seed):
    rows = random_rows(seed, 200)
    df = frame(spark, rows).repartition(7)
    assert result(first_wins(df)) == pick(rows, newest=False)
    assert result(last_wins(df)) == pick(rows, newest=True)


@pytest.mark.parametrize("seed", range(2))
def test_upsert_matches_brute_force_and_is_idempotent(spark, seed):
    stored = [(n, "old", -1) for n in range(0, 40, 3)]
    rows = random_rows(seed, 100)
    once = upsert_last(frame(spark, stored), frame(spark, rows))
    assert result(once) == pick(stored + rows, newest=True)
    assert result(upsert_last(once, frame(spark, rows))) == result(once)


def test_upsert_takes_nulls_and_refuses_older_rows(spark):
    stored = frame(spark, [(1, "kept", 5), (2, "lost", 5), (3, "alone", 5)])
    batch = frame(spark, [(1, "older", 4), (2, None, 6), (4, "new", 6)])
    assert result(upsert_last(stored, batch)) == [(1, "kept", 5), (2, None, 6), (3, "alone", 5), (4, "new", 6)]


@pytest.mark.parametrize("counted", [True, False])
def test_insert_keeps_the_stored_row(spark, counted):
    stored = frame(spark, [(1, "stored", 9)])
    rows = [(1, "newer", 10), (2, "second", 12), (2, "first", 11), (3, None, 13), (3, "late", 14)]
    fresh = insert_first(stored, frame(spark, rows), batch_rows=len(rows) if counted else None)
    assert result(fresh) == [(2, "first", 11), (3, None, 13)]


def test_empty_batches_change_nothing(spark):
    stored, empty = frame(spark, [(1, "a", 1)]), frame(spark, [])
    assert result(upsert_last(stored, empty)) == [(1, "a", 1)]
    assert result(insert_first(stored, empty)) == []
    assert result(insert_first(empty, stored)) == [(1, "a", 1)]


def test_large_measured_batches_are_not_broadcast(spark):
    stored, batch = frame(spark, [(1, "a", 1)]), frame(spark, [(2, "b", 2)])
    small = absent_rows(batch, stored, batch_keys=batch, batch_rows=10)
    large = absent_rows(batch, stored, batch_keys=batch, batch_rows=10**9)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("measured", [2, None])
def test_lookup_join_equals_the_plain_join(spark, how, measured):
    facts = spark.range(300).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 9))
    lookup = spark.createDataFrame([(1, "one"), (4, "four")], "k bigint, v string")
    plain = sorted(map(repr, facts.join(lookup, "k", how).collect()))
    assert sorted(map(repr, lookup_join(facts, lookup, "k", "id", how, measured).collect())) == plain


def test_equal_arrivals_end_in_the_same_row(spark):
    rows = [(1, "a", 5, "x"), (1, "b", 5, "y"), (1, "c", 4, "z")]
    schema = "id bigint, name string, arrival_seq bigint, raw_json string"
    for a, b in ((rows[:1], rows[1:]), (rows[1:], rows[:1])):
        target, batch = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
        assert upsert_last(target, batch).select("name").first()[0] == "b"
        assert first_wins(target.unionByName(batch)).select("name").first()[0] == "c"
