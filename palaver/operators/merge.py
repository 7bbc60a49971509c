"""The two merge policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from palaver.operators.dedup import first_wins, last_wins
from palaver.operators.joins import MAX_BROADCAST_ROWS, absent_rows


def upsert_last(
    target: DataFrame, batch: DataFrame, key: str = "id", order: Sequence[str] = ("arrival_seq",)
) -> DataFrame:
    """``target`` after the upsert: the newest whole row of each key.

    The order travels with the stored rows, so replaying an old batch cannot undo a newer row and
    applying a batch twice changes nothing.
    """
    return last_wins(target.unionByName(batch.select(*target.columns)), key, order)


def insert_first(
    target: DataFrame,
    batch: DataFrame,
    key: str = "id",
    order: Sequence[str] = ("arrival_seq",),
    batch_rows: int | None = None,
) -> DataFrame:
    """Rows to append to ``target``: the first of each key in ``batch`` that is not stored yet.

    ``batch_rows``, where the caller has counted the batch, allows the plan without a shuffle of
    the stored keys; stored rows then fall away before the rest is sorted and moved. A larger batch
    is de-duplicated first, so that many rows of one key never meet in a task.
    """
    if batch_rows is not None and batch_rows <= MAX_BROADCAST_ROWS:
        return first_wins(absent_rows(batch, target, key, batch, batch_rows), key, order)
    return absent_rows(first_wins(batch, key, order), target, key)
