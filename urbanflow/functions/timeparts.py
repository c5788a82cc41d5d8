"""Event-time parsing, partition parts and timestamp rendering.

Event time is carried as TIMESTAMP_NTZ holding the UTC wall clock, so the
partition a row lands in never depends on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# microseconds of 0001-01-01 and of 10000-01-01, as doubles
FIRST_MICROS = -62_135_596_800_000_000.0
END_MICROS = 253_402_300_800_000_000.0


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_wall_clock(instant: Column | str) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ of its UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(instant)), _epoch_ntz())


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text (``...Z`` or with offset) -> UTC TIMESTAMP_NTZ; junk -> null.

    ``try_to_timestamp`` keeps ANSI mode from failing the query on a bad value.
    """
    return utc_wall_clock(F.try_to_timestamp(_c(text)))


def epoch_seconds_to_time(seconds: Column | str) -> Column:
    """Epoch seconds as a double -> UTC TIMESTAMP_NTZ at microsecond precision.

    Rounding (not truncating) to the microsecond undoes the binary fraction
    noise of a float epoch. NaN, infinities and times outside the years 1 to
    9999 (epochs in milliseconds or nanoseconds among them) give null, never an
    error: one bad number must not end a stream.
    """
    micros = F.round(_c(seconds).cast("double") * F.lit(1_000_000.0))
    sound = (micros >= F.lit(FIRST_MICROS)) & (micros < F.lit(END_MICROS))  # NaN is above every number
    return F.timestamp_add("MICROSECOND", F.when(sound, micros).try_cast("long"), _epoch_ntz())


def truncate_hour(ts: Column | str) -> Column:
    """Start of the hour of a UTC wall-clock TIMESTAMP_NTZ (zone-free)."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def ntz_epoch_micros(ntz: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, computed from
    its fields (timestamp_diff would route through the session zone)."""
    t = _c(ntz)
    days = F.unix_date(t.cast("date")).cast("long")
    secs = (F.hour(t) * F.lit(3600) + F.minute(t) * F.lit(60)).cast("long")
    frac = (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long")
    return days * F.lit(86_400_000_000) + secs * F.lit(1_000_000) + frac


def time_parts(ts: Column | str) -> dict[str, Column]:
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}


def with_event_time(df: DataFrame, source: str = "timestamp", target: str = "event_ts") -> DataFrame:
    return df.withColumn(target, parse_event_time(source))


def with_time_parts(df: DataFrame, ts: str = "event_ts", hour: bool = True) -> DataFrame:
    parts = time_parts(ts)
    if not hour:
        parts.pop("hour")
    return df.withColumns(parts)


_ISO_DATE = re.compile(r"^(\d{4})-(\d{2})-(\d{2})$")
_COMPACT = re.compile(r"^(\d{4})(\d{2})(\d{2})(?:-(\d{2})(\d{2}))?$")


def parse_process_date(text: str) -> _dt.date:
    """Validate a processing date given as ``YYYY-MM-DD``, ``YYYYMMDD`` or ``YYYYMMDD-HHMM``."""
    text = text.strip()
    m = _ISO_DATE.match(text) or _COMPACT.match(text)
    if not m:
        raise ValueError(f"unrecognised processing date {text!r}")
    return _dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3)))


def with_batch_partition_cols(df: DataFrame, process_date: str | _dt.date) -> DataFrame:
    """Literal ``year/month/day`` partition columns of a batch load."""
    d = process_date if isinstance(process_date, _dt.date) else parse_process_date(process_date)
    return df.withColumns({"year": F.lit(d.year), "month": F.lit(d.month), "day": F.lit(d.day)})


# The path / audit formats of the landing jobs.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH-mm-ss"
HOUR_FORMAT = "HH"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def format_date(ts: Column | str) -> Column:
    return F.date_format(_c(ts), DATE_FORMAT)


def format_time(ts: Column | str) -> Column:
    return F.date_format(_c(ts), TIME_FORMAT)


def format_hour(ts: Column | str) -> Column:
    return F.date_format(_c(ts), HOUR_FORMAT)


def format_datetime(ts: Column | str) -> Column:
    return F.date_format(_c(ts), DATETIME_FORMAT)


def iso_z(ts: Column | str) -> Column:
    """ISO-8601 with a ``Z`` suffix; the fraction appears only when non-zero,
    like Python's ``isoformat()``."""
    t = _c(ts)
    frac = F.date_format(t, "SSSSSS")
    return F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("Z"),
    )


def ntz_to_instant(ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ read as a UTC wall clock -> TIMESTAMP instant, without
    going through the session time zone."""
    return F.timestamp_micros(ntz_epoch_micros(ntz))


def epoch_seconds(ntz: Column | str) -> Column:
    """UTC TIMESTAMP_NTZ -> epoch seconds as a double."""
    return ntz_epoch_micros(ntz).cast("double") / F.lit(1_000_000.0)
