"""The messages table: first write wins, append only, in versions of days.

An id holds its UTC day, so it always falls into one day. A write makes a new version: files of its days, a summary per
channel and day, and last, as one small file, the manifest rows that name the days of the version. Readers take the
versions that the manifest names, so a write that broke off is never seen, and the next one takes its place. A day of many
versions is compacted: its last versions of equal level become one of the next level, again by one
manifest file, so a day has a few versions for each level and every row is rewritten once a level. New versions are sorted by
channel and id; compacted ones by channel and author at once, so that row groups have narrow ranges of both.

The manifest has a row for each version of each day and the summary one for each channel, day and version. Days
are few (63 bits of id reach over 25,500), so the manifest fits the driver; the summary does not need to.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from palaver.functions.scalars import created_date
from palaver.operators.clustering import interleaved
from palaver.operators.dedup import first_wins
from palaver.operators.digests import differing, digests, merged_digests
from palaver.operators.joins import MAX_BROADCAST_ROWS, lookup_join
from palaver.operators.merge import insert_first
from palaver.operators.projections import MESSAGE_ORDER
from palaver.schemas import DAY_DIGESTS, DAY_VERSIONS, MESSAGES
from palaver.session import scratch_dir
from palaver.storage import GenerationLog, no_rows, read_if_there, remove_folder, subfolders

#: Messages are sorted by channel; these let a read of one author or one id pass over row groups. Their size follows the values;
#: a column whose values repeat enough has a dictionary instead, which serves as well.
BLOOM_FILTERS = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.enabled#author_id": "true",
    "parquet.bloom.filter.enabled#id": "true",
}

#: Versions of one level that a day has before they become one of the next, and commits before the manifest is folded.
FAN_IN, COMMITS_PER_GENERATION = 8, 200


class Version:
    """A version of one day: its number, level and rows."""

    __slots__ = ("number", "level", "rows")

    def __init__(self, number: int, level: int, rows: int):
        self.number, self.level, self.rows = number, level, rows


class MessageTable:
    """One writer; readers may come at any time. Files are sorted by ``channel_id, id``."""

    def __init__(self, spark: SparkSession, path: str, fan_in: int = FAN_IN):
        self.spark = spark
        self.path = path
        self.fan_in = fan_in
        self.layout = StructType([*MESSAGES.fields]).add("version", "long").add("created_date", DateType())
        self.log = GenerationLog(spark, f"{path}/manifest")

    def create(self) -> None:
        """Start an empty table where there is none."""
        if self.log.generation() is None:
            self.log.start(0, no_rows(self.spark, DAY_VERSIONS))

    # Reads

    def days(self) -> dict[datetime.date, list[Version]]:
        """The live versions of each day, oldest first."""
        generation = self.log.generation()
        if generation is None:
            return {}
        rows = self.spark.read.schema(DAY_VERSIONS).json([self.log.snapshot(generation), self.log.changes(generation)]).collect()
        return _live(rows)

    def read(self) -> DataFrame:
        return self._rows(self.days()).select(*MESSAGES.fieldNames())

    def summary(self) -> DataFrame:
        """``channel_id, created_date, n, lo, hi, digest_a, digest_b`` of every channel and day, without a read of messages."""
        return merged_digests(self._summary(self.days()))

    def bounds(self) -> DataFrame:
        """``channel_id, lo, hi, n`` of every channel."""
        return self._summary(self.days()).groupBy("channel_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))

    def bounds_of(self, channel_id: int) -> tuple[int, int] | None:
        """Lowest and highest id of a channel."""
        found = self._summary(self.days()).where(F.col("channel_id") == F.lit(channel_id)).agg(F.min("lo"), F.max("hi")).first()
        return None if found[0] is None else (found[0], found[1])

    def channel(self, channel_id: int, before: int | None = None, after: int | None = None) -> DataFrame:
        """Messages of a channel between two ids; days without any are not read."""
        live = self.days()
        return self._between(live, self._days_of(live, channel_id, before, after), channel_id, before, after)

    def page(self, channel_id: int, limit: int, before: int | None = None, after: int | None = None) -> DataFrame:
        """The newest ``limit`` messages of a channel, those older than ``before``, or the oldest ones newer than ``after``.

        The summary tells the days that fill the page. Its ids are found on two columns of those, then the few rows are read whole.
        """
        live = self.days()
        days = self._days_of(live, channel_id, before, after, limit)
        order = F.col("id").desc() if after is None else F.col("id").asc()
        ids = self._between(live, days, channel_id, before, after).select("id").orderBy(order).limit(limit)
        keys = ids.select("id", created_date(F.col("id")).alias("created_date"))
        if limit <= MAX_BROADCAST_ROWS:
            keys = F.broadcast(keys)
        rows = self._rows(live, days).join(keys, ["created_date", "id"], "left_semi")
        return rows.select(*MESSAGES.fieldNames()).orderBy(order)

    def _between(self, live: dict, days: list, channel_id: int, before: int | None, after: int | None) -> DataFrame:
        rows = self._rows(live, days).where(F.col("channel_id") == F.lit(channel_id))
        if before is not None:
            rows = rows.where(F.col("id") < F.lit(before))
        if after is not None:
            rows = rows.where(F.col("id") > F.lit(after))
        return rows.select(*MESSAGES.fieldNames())

    def _days_of(
        self, live: dict, channel_id: int, before: int | None, after: int | None, limit: int | None = None
    ) -> list[datetime.date]:
        """Days that hold rows between two ids; with ``limit``, the nearest that hold so many."""
        mine = self._summary(live).where(F.col("channel_id") == F.lit(channel_id))
        if before is not None:
            mine = mine.where(F.col("lo") < F.lit(before))
        if after is not None:
            mine = mine.where(F.col("hi") > F.lit(after))
        whole = F.lit(True)
        if before is not None:
            whole = whole & (F.col("hi") < F.lit(before))
        if after is not None:
            whole = whole & (F.col("lo") > F.lit(after))
        # Rows of a version that reaches over a cursor may lie on its other side: they don't count towards the limit.
        sure = F.sum(F.when(whole, F.col("n")).otherwise(0)).alias("n")
        found = mine.groupBy("created_date").agg(sure).collect()
        found = sorted(((day, n) for day, n in found), reverse=after is None)
        days, held = [], 0
        for day, n in found:
            if limit is not None and held >= limit:
                break
            days.append(day)
            held += n
        return days

    def _rows(self, live: dict, days: Iterable[datetime.date] | None = None) -> DataFrame:
        wanted = live if days is None else [day for day in days if day in live]
        paths = [f"{self.path}/data/version={v.number}/created_date={day}" for day in wanted for v in live[day]]
        if not paths:
            return no_rows(self.spark, self.layout)
        return self.spark.read.schema(self.layout).option("basePath", f"{self.path}/data").parquet(*paths)

    def _summary(self, live: dict) -> DataFrame:
        named = sorted((v.number, day) for day, versions in live.items() for v in versions)
        if not named:
            return no_rows(self.spark, DAY_DIGESTS)
        numbers = sorted({number for number, _ in named})
        layout = StructType([*DAY_DIGESTS.fields]).add("version", "long")
        rows = self.spark.read.schema(layout).option("basePath", f"{self.path}/summary").parquet(*[f"{self.path}/summary/version={n}" for n in numbers])
        keys = self.spark.createDataFrame(named, "version long, created_date date")
        return rows.join(F.broadcast(keys), ["version", "created_date"], "left_semi").select(*DAY_DIGESTS.fieldNames())

    # Writes

    def absent(self, batch: DataFrame, batch_rows: int | None = None) -> DataFrame:
        """Rows of ``batch`` to append: the first of each id, if that id is not stored. Only ids on days of the batch are read."""
        live = self.days()
        days = _collected_days(batch.where(F.col("id") >= 0).select(created_date(F.col("id")).alias("created_date")))
        return self._new_rows(self._rows(live, days).select("id"), batch, batch_rows)

    def absent_by_digest(self, batch: DataFrame) -> DataFrame:
        """The same for a batch that holds whole channel days, most of which are stored as they are.

        Digests of the ids of each channel and day are compared with those of the table. Ids are read and rows moved only for
        channel days that differ; an unchanged source reads none.
        """
        live = self.days()
        path = scratch_dir(self.spark, "differing")
        differing(digests(batch), merged_digests(self._summary(live))).write.parquet(path)
        suspects = self.spark.read.schema("channel_id long, created_date date").parquet(path)
        days = _collected_days(suspects.select("created_date"))
        if not days:
            return batch.limit(0)
        rows = batch.withColumn("created_date", created_date(F.col("id")))
        rows = lookup_join(rows, suspects, ["channel_id", "created_date"], "id", "left_semi", suspects.count())
        return self._new_rows(self._rows(live, days).select("id"), rows.drop("created_date"))

    def _new_rows(self, stored: DataFrame, batch: DataFrame, batch_rows: int | None = None) -> DataFrame:
        """The first row of each id of ``batch`` that is not stored. Ids meet alone; in a large batch only rows of ids that come more
        than once are ranked, and such rows are limited before they move. Others move to meet the new ids only where the ids to
        leave out are too many to be sent to all tasks."""
        if batch_rows is not None and batch_rows <= MAX_BROADCAST_ROWS:
            return insert_first(stored, batch, order=MESSAGE_ORDER, batch_rows=batch_rows)
        path = scratch_dir(self.spark, "batch-ids")
        counts = batch.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        counts.join(stored.select("id", F.lit(True).alias("stored")), "id", "left").write.parquet(path)
        ids = self.spark.read.schema("id long, n long, stored boolean").parquet(path)
        again, known = F.col("n") > 1, F.col("stored").isNotNull()
        new, repeated, passed_over = ids.agg(F.count_if(~known), F.count_if(again), F.count_if(again | known)).first()
        if new <= MAX_BROADCAST_ROWS:
            return first_wins(batch.join(_sent(ids.where(~known)), "id", "left_semi"), order=MESSAGE_ORDER)
        if repeated > MAX_BROADCAST_ROWS:
            return first_wins(batch, order=MESSAGE_ORDER).join(ids.where(~known).select("id"), "id", "left_semi")
        if passed_over <= MAX_BROADCAST_ROWS:
            once = batch.join(_sent(ids.where(again | known)), "id", "left_anti")
        else:
            single = batch.join(_sent(ids.where(again)), "id", "left_anti") if repeated else batch
            once = single.join(ids.where(~known & ~again).select("id"), "id", "left_semi")
        if not repeated:
            return once
        return once.unionByName(first_wins(batch.join(_sent(ids.where(again & ~known)), "id", "left_semi"), order=MESSAGE_ORDER))

    def append(self, rows: DataFrame) -> None:
        """Add rows whose ids are not stored, as one version."""
        live = self.days()
        number = self._next(live)
        self._write(rows.select(*MESSAGES.fieldNames()), number)
        found = self._summarised(number)
        if found:
            self._commit([(number, day, 0, None, n) for day, n in found])
            for day, n in found:
                live.setdefault(day, []).append(Version(number, 0, n))
            self.compact(live)

    def compact(self, live: dict | None = None) -> None:
        """Bring versions of days that have many of one level together, until none has."""
        live = self.days() if live is None else live
        while True:
            runs = {day: run for day, versions in live.items() if len(run := _last_level(versions)) >= self.fan_in}
            if not runs:
                return
            number = self._next(live)
            rows = self._rows(runs).drop("version", "created_date")
            self._write(rows, number, interleaved(rows, "channel_id", "author_id"))
            counts = dict(self._summarised(number))
            self._commit([(number, day, run[0].level + 1, run[0].number, counts[day]) for day, run in runs.items()])
            for day, run in runs.items():
                live[day] = [*live[day][: -len(run)], Version(number, run[0].level + 1, counts[day])]

    def vacuum(self) -> int:
        """Remove the days of versions that no manifest row names, and say how many. Plans that readers made before the last
        compaction still want them, so call it when such have ended."""
        named: dict[int, set[str]] = {}
        for day, versions in self.days().items():
            for v in versions:
                named.setdefault(v.number, set()).add(f"created_date={day}")
        gone = 0
        for name in subfolders(self.spark, f"{self.path}/data"):
            number = int(name.partition("=")[2])
            if number >= max(named, default=0) and number not in named:
                continue  # of a write that may be under way
            days = [day for day in subfolders(self.spark, f"{self.path}/data/{name}") if day not in named.get(number, ())]
            for day in days:
                remove_folder(self.spark, f"{self.path}/data/{name}/{day}")
            gone += len(days)
            if number not in named:
                remove_folder(self.spark, f"{self.path}/data/{name}")
                remove_folder(self.spark, f"{self.path}/summary/{name}")
        return gone

    def _next(self, live: dict) -> int:
        return 1 + max((v.number for versions in live.values() for v in versions), default=0)

    def _write(self, rows: DataFrame, number: int, cluster: Column | None = None) -> None:
        # Rebalancing brings a day together and lets AQE split a day that is too large for a task.
        (
            rows.withColumn("created_date", created_date(F.col("id")))
            .hint("rebalance", "created_date")
            .sortWithinPartitions("created_date", *([] if cluster is None else [cluster]), "channel_id", "id")
            .write.mode("overwrite")
            .options(**BLOOM_FILTERS)
            .partitionBy("created_date")
            .parquet(f"{self.path}/data/version={number}")
        )

    def _summarised(self, number: int) -> list[tuple[datetime.date, int]]:
        """Write the summary of a version; its days and their rows."""
        layout = StructType([MESSAGES["id"], MESSAGES["channel_id"]])
        rows = read_if_there(self.spark, f"{self.path}/data/version={number}", "parquet", layout)
        target = f"{self.path}/summary/version={number}"
        digests(rows, unique=True).sortWithinPartitions("channel_id").write.mode("overwrite").parquet(target)
        days = self.spark.read.schema(DAY_DIGESTS).parquet(target).groupBy("created_date").agg(F.sum("n"))
        return [tuple(row) for row in days.collect()]

    def _commit(self, rows: list[tuple]) -> None:
        """One file names all days of a version, so they appear together."""
        self.log.append(self.spark.createDataFrame(rows, DAY_VERSIONS))
        self.log.fold(COMMITS_PER_GENERATION, lambda: self._manifest(self.days()))

    def _manifest(self, live: dict) -> DataFrame:
        return self.spark.createDataFrame([(v.number, day, v.level, None, v.rows) for day, versions in live.items() for v in versions], DAY_VERSIONS)


def _live(rows: Iterable) -> dict[datetime.date, list[Version]]:
    """Versions by day that no later one replaces."""
    days: dict[datetime.date, list[Version]] = {}
    for row in sorted(rows, key=lambda row: row["version"]):
        versions = days.setdefault(row["created_date"], [])
        if row["replaces_from"] is not None:
            versions[:] = [v for v in versions if v.number < row["replaces_from"]]
        if not any(v.number == row["version"] for v in versions):
            versions.append(Version(row["version"], row["level"], row["n"]))
    return days


def _last_level(versions: list[Version]) -> list[Version]:
    """The newest versions of a day that are of one level."""
    run = [v for v in reversed(versions) if v.level == versions[-1].level]
    return run[::-1]


def _sent(ids: DataFrame) -> DataFrame:
    """Ids, measured few, for every task."""
    return F.broadcast(ids.select("id"))


def _collected_days(days: DataFrame) -> list[datetime.date]:
    return [row[0] for row in days.distinct().collect()]
