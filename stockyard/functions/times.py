"""Date and time functions that Spark names otherwise or counts otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def date_diff(unit: str, start: Column, end: Column) -> Column:
    """Boundaries of the unit crossed between two timestamps (not elapsed units)."""
    return F.floor((_seconds(F.date_trunc(unit, end)) - _seconds(F.date_trunc(unit, start))) / SECONDS[unit]).cast("bigint")


def year_month(ts: Column) -> Column:
    """The month partition of a timestamp, as yyyyMM."""
    return F.date_format(ts, "yyyyMM")


def add_days(ts: Column, days: Column | int) -> Column:
    """The same time of day some days later (or earlier)."""
    return ts + F.make_dt_interval(days=days if isinstance(days, Column) else F.lit(days))


#: Layouts that lenient parsing knows, tried in this order.
LAYOUTS = ("yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSS]", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy", "dd/MM/yyyy", "yyyyMMddHHmmss", "yyyyMMdd")


def parse_lenient(text: Column) -> Column:
    """A time in any of the known layouts, or seconds or milliseconds since 1970 in ten or thirteen digits; null if it is none."""
    clean = F.trim(text)
    number = F.when(clean.rlike("^[0-9]{10}$"), F.timestamp_seconds(clean.try_cast("bigint"))).when(clean.rlike("^[0-9]{13}$"), F.timestamp_millis(clean.try_cast("bigint")))
    return F.coalesce(number, *[F.try_to_timestamp(clean, F.lit(layout)) for layout in LAYOUTS]).cast("timestamp_ntz")


def processing_time() -> Column:
    """When the query (on a stream: the micro-batch) runs."""
    return F.current_timestamp()


def seconds_between(start: Column, end: Column) -> Column:
    return _seconds(end) - _seconds(start)


def day_of(days: Column) -> Column:
    """Days since the epoch to a date."""
    return F.date_from_unix_date(days)


def readable_size(size: Column, units: tuple[str, ...] = ("KiB", "MiB", "GiB", "TiB")) -> Column:
    """Bytes as text with a binary unit; the last unit holds everything from it on."""
    out = F.format_string("%.2f B", size.cast("double"))
    for k, unit in enumerate(units, 1):
        out = F.when(size >= 1024**k, F.format_string(f"%.2f {unit}", size / float(1024**k))).otherwise(out)
    return out
