"""Digests of the ids of each channel and day, to find where a source and the archive differ without a read of the ids stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.scalars import created_date

COMPARED = ("n", "lo", "hi", "digest_a", "digest_b")


def digests(messages: DataFrame, unique: bool = False) -> DataFrame:
    """``channel_id, created_date, n, lo, hi, digest_a, digest_b`` of the distinct ids of each channel and day.

    A digest is the XOR of hashes, so those of disjoint sets add up to that of their union, and partial aggregation
    leaves one row per channel and day before the shuffle. ``unique`` tells that no id repeats within a channel.
    """
    ids = messages.select("channel_id", "id")
    ids = ids if unique else ids.distinct()
    return ids.groupBy("channel_id", created_date(F.col("id")).alias("created_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("lo"),
        F.max("id").alias("hi"),
        F.bit_xor(F.xxhash64("id")).alias("digest_a"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("digest_b"),
    )


def merged_digests(parts: DataFrame) -> DataFrame:
    """Digests of the union of disjoint parts."""
    return parts.groupBy("channel_id", "created_date").agg(
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.bit_xor("digest_a").alias("digest_a"),
        F.bit_xor("digest_b").alias("digest_b"),
    )


def differing(source: DataFrame, stored: DataFrame) -> DataFrame:
    """``channel_id, created_date`` where the ids of ``source`` are not those stored.

    Equal ids have equal digests, so no missing row is passed over but by chance: two sets of the same size and ends agree in
    both digests with a probability of 2^-128.
    """
    theirs = stored.select("channel_id", "created_date", F.struct(*COMPARED).alias("theirs"))
    mine = source.select("channel_id", "created_date", F.struct(*COMPARED).alias("mine"))
    both = mine.join(theirs, ["channel_id", "created_date"], "left")
    return both.where(~F.col("mine").eqNullSafe(F.col("theirs"))).select("channel_id", "created_date")
