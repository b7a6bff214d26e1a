"""Date and time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CUE_TIME = r"([0-9]+):([0-9]{2}):([0-9]{2})[,.]([0-9]{3})"


def compact_date(value: Column) -> Column:
    """Strict ``YYYYMMDD``; null if the shape or the calendar day is wrong."""
    return F.when(value.rlike("^[0-9]{8}$"), F.try_to_date(value, "yyyyMMdd"))


def bucket_key(day: Column, bucket: str) -> Column:
    """ISO week ``2026-W23`` or month ``2026-06``."""
    if bucket == "week":
        year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
        return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))
    if bucket == "month":
        return F.date_format(day, "yyyy-MM")
    raise ValueError(f"bucket must be 'week' or 'month', not {bucket!r}")


def instant(epoch_seconds: Column) -> Column:
    """Epoch seconds to an instant; null outside years 1 to 9999."""
    ok = epoch_seconds.between(-62135596800, 253402300799)
    return F.when(ok, F.timestamp_seconds(epoch_seconds))


def whole_minutes(seconds: Column) -> Column:
    return F.ceil(seconds / 60).cast("long")


def cue_time_ms(text: Column) -> Column:
    """``HH:MM:SS,mmm`` (dot or comma, hours unbounded) to milliseconds."""

    def part(i: int) -> Column:
        return F.regexp_extract(text, "^" + CUE_TIME + "$", i).cast("long")

    total = part(1) * 3600000 + part(2) * 60000 + part(3) * 1000 + part(4)
    return F.when(text.rlike("^" + CUE_TIME + "$"), total)


def cue_time_text(ms: Column) -> Column:
    """Milliseconds to ``HH:MM:SS,mmm``."""
    whole = F.floor(ms / 1000).cast("long")
    return F.format_string(
        "%02d:%02d:%02d,%03d",
        F.floor(whole / 3600).cast("long"),
        F.floor(whole / 60).cast("long") % 60,
        whole % 60,
        ms % 1000,
    )
