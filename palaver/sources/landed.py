"""Landed JSON lines -> typed landed rows, as a batch or as a stream.

The text of each line is kept as ``raw_json``. A line that is no JSON object of the schema, or that
lacks a usable id, keeps its text and gets a ``reject_reason``; good lines are not affected by it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from palaver.functions.scalars import signed_id
from palaver.schemas import LANDED_AUTHOR, LANDED_CHANNEL, LANDED_GUILD, LANDED_MESSAGE
from palaver.session import path_missing

CORRUPT = "_corrupt_record"
MAX_BYTES_PER_TRIGGER = 64 * 1024**3


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, source_file`` of every landed line below ``path``, or in a list of files."""
    return _with_file(spark.read.option("recursiveFileLookup", "true").text(path))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modified`` of every landed file; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("path", F.col("modificationTime").alias("modified"))


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make an empty landing folder where there is none, as a stream needs one to watch."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        spark.range(0).select(F.lit("").alias("value")).write.mode("append").text(path)


#: Restored backups and copies keep old modification times.
ANY_AGE = "365000d"
MEMORY_DAYS = 7


def stream_lines(
    spark: SparkSession,
    path: str,
    max_bytes: int = MAX_BYTES_PER_TRIGGER,
    max_files: int | None = None,
    finished: str | None = None,
) -> DataFrame:
    """The same as a stream of new files; a trigger takes a bounded amount of them.

    With ``finished``, files move there when a later trigger begins, and the stream remembers those of ``MEMORY_DAYS`` before the newest
    one only; files that land with an older time are left to a sweep. Else no file is passed over for its time, and
    the stream remembers all of them.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if finished is None:
        reader = reader.option("maxFileAge", ANY_AGE)
    else:
        reader = reader.option("maxFileAge", f"{MEMORY_DAYS}d").option("cleanSource", "archive").option("sourceArchiveDir", finished)
    if max_files is None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    else:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _with_file(reader.text(path))


def parse_guilds(lines: DataFrame) -> DataFrame:
    guilds = _parse(lines, LANDED_GUILD)
    return _with_reason(guilds, required=("id",), optional=("owner_id",))


def parse_channels(lines: DataFrame) -> DataFrame:
    channels = _parse(lines, LANDED_CHANNEL)
    return _with_reason(channels, required=("id",), optional=("guild_id", "parent_id"))


def parse_messages(lines: DataFrame) -> DataFrame:
    """Author fields come out flat, the id as ``author_id`` and the author's own JSON as
    ``author_json``, which is cut out of the line only where a plan uses it."""
    names = LANDED_AUTHOR.fieldNames()
    flat = [F.col(f"author.{n}").alias("author_id" if n == "id" else n) for n in names]
    messages = with_author_json(_parse(lines, LANDED_MESSAGE).select("*", *flat)).drop("author")
    return _with_reason(
        messages,
        required=("id", "channel_id", "author_id"),
        optional=("guild_id", "webhook_id"),
    )


def with_author_json(messages: DataFrame) -> DataFrame:
    """Parsed messages with the author's own JSON, cut out of their lines."""
    return messages.withColumn("author_json", F.get_json_object("raw_json", "$.author"))


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").drop("reject_reason", "source_file")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is not null").select("raw_json", "source_file", "reject_reason")


def _with_file(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_path").alias("source_file"))


def _parse(lines: DataFrame, schema: StructType) -> DataFrame:
    # As a generator the parse is one plan node: filters on its columns are not rewritten into a
    # second parse of the same text below it.
    body = StructType([*schema.fields]).add(CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "timeZone": "UTC"}
    return lines.where(F.trim("value") != "").select(
        F.col("value").alias("raw_json"),
        "source_file",
        F.inline(F.array(F.from_json("value", body, options))),
    )


def _with_reason(parsed: DataFrame, required: tuple[str, ...], optional: tuple[str, ...]) -> DataFrame:
    reason: Column = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
    for name in required:
        raw = signed_id(F.col(name))
        reason = reason.when(raw.isNull() | (raw < 0), F.lit(f"bad_{name}"))
    for name in optional:
        raw = signed_id(F.col(name))
        bad = F.col(name).isNotNull() & (raw.isNull() | (raw < 0))
        reason = reason.when(bad, F.lit(f"bad_{name}"))
    reason = reason.when(F.col("arrival_seq").isNull(), F.lit("no_arrival_seq"))
    return parsed.withColumn("reject_reason", reason).drop(CORRUPT)
