"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32
# Long keys plus one or two long columns: about 100 MB as a hashed relation.
MAX_BROADCAST_ROWS = 1_000_000


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str | list[str],
    spread_by: str,
    how: str = "left",
    lookup_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` to a narrow ``lookup`` with one row per ``key``.

    With a measured ``lookup_rows`` at or below the limit the lookup is broadcast. Otherwise every
    fact gets a salt from ``spread_by`` (a well spread column, such as the message id) and the
    lookup is repeated once per salt, so the rows of a hot key go to ``salts`` tasks. The result is
    that of the plain join.
    """
    if lookup_rows is not None and lookup_rows <= MAX_BROADCAST_ROWS:
        return facts.join(F.broadcast(lookup), key, how)
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = [key] if isinstance(key, str) else key
    return salted_facts.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")


def absent_rows(
    batch: DataFrame,
    stored: DataFrame,
    key: str = "id",
    batch_keys: DataFrame | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``stored``, which has one row per key.

    With ``batch_keys`` measured at ``batch_rows`` within the limit, the keys are broadcast to find
    the collisions, of which there are no more than that, so the stored keys are scanned but never
    shuffled. Otherwise both sides meet on the key, which spreads evenly; a batch that comes out of
    a de-duplication on that key is already partitioned and sorted for it.
    """
    keys = stored.select(key)
    if batch_keys is not None and batch_rows is not None and batch_rows <= MAX_BROADCAST_ROWS:
        keys = F.broadcast(keys.join(F.broadcast(batch_keys.select(key)), key, "left_semi"))
    return batch.join(keys, key, "left_anti")
