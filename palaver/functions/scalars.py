"""Value rules shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids count milliseconds from 2015-01-01 UTC above their low 22 bits.
ID_EPOCH_MS = 1420070400000
ID_TIME_SHIFT = 22

MS_PER_DAY = 24 * 60 * 60 * 1000


def signed_id(raw: Column) -> Column:
    """Text id -> BIGINT; NULL where it is no number or does not fit (never wraps)."""
    return raw.try_cast("bigint")


def created_at_ms(message_id: Column) -> Column:
    """Epoch milliseconds held in the high bits of an id; the shift is unsigned."""
    return F.shiftrightunsigned(message_id, ID_TIME_SHIFT) + F.lit(ID_EPOCH_MS)


def created_at(message_id: Column) -> Column:
    return F.timestamp_millis(created_at_ms(message_id))


def created_date(message_id: Column) -> Column:
    """UTC day of an id, whatever the session time zone: the partition column of ``messages``."""
    return F.date_from_unix_date(F.floor(created_at_ms(message_id) / F.lit(MS_PER_DAY)).cast("int"))


def edited_at_ms(edited: Column) -> Column:
    """Edit time in milliseconds at whole-second precision."""
    return F.unix_seconds(edited) * F.lit(1000)


def content_or_null(content: Column) -> Column:
    """Empty content is stored as NULL; white space is kept."""
    return F.nullif(content, F.lit(""))


def discriminator_text(discriminator: Column) -> Column:
    """Optional non-zero number printed as text: padding goes, zero and non-numbers are NULL."""
    return F.nullif(discriminator.try_cast("int"), F.lit(0)).cast("string")


def json_list(text: Column) -> Column:
    """JSON text of a list column, ``[]`` where there is none or the text is no JSON array. An empty list is not parsed."""
    return F.when((text != "[]") & F.json_array_length(text).isNotNull(), text).otherwise(F.lit("[]"))


def flag(value: Column) -> Column:
    """Boolean that is false where the record has none."""
    return F.coalesce(value, F.lit(False))
