"""One row per key, by an explicit order.

``dropDuplicates`` keeps an arbitrary row, so both rules rank by order columns. The rank limit of
one is applied before the shuffle too (the plan shows a partial WindowGroupLimit), so a key that
was delivered a billion times sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _settled(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The order, and the landed text where there is one: equal arrivals end in the same row each time."""
    return [*order, *(["raw_json"] if "raw_json" in df.columns and "raw_json" not in order else [])]


def _ranked_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_wins(
    df: DataFrame, key: str | Sequence[str] = "id", order: Sequence[str] = ("arrival_seq",)
) -> DataFrame:
    """The earliest row of each key."""
    return _ranked_first(df, key, [F.col(name).asc() for name in _settled(df, order)])


def last_wins(
    df: DataFrame, key: str | Sequence[str] = "id", order: Sequence[str] = ("arrival_seq",)
) -> DataFrame:
    """The latest row of each key, whole: its NULLs replace older values."""
    return _ranked_first(df, key, [F.col(name).desc() for name in _settled(df, order)])
