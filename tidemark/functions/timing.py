"""Time parsing, look-back predicates and clock values."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Read after the ISO forms, which need no pattern.
EXTRA_FORMATS = ("yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyyMMdd HHmmss", "dd-MMM-yyyy HH:mm:ss")


def parse_timestamp(text, formats=EXTRA_FORMATS) -> Column:
    """Timestamp from text in any of several forms; NULL when none fits."""
    tries = [F.try_to_timestamp(text)]
    tries += [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def as_of_column(as_of) -> Column:
    """A fixed instant, a column, or the current time when None.

    Naive datetimes and text are taken as UTC.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.fromisoformat(str(as_of))
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return F.lit(as_of.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def days(n) -> Column:
    return F.make_dt_interval(F.lit(n))


def hours(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def seconds(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n).cast("decimal(18,6)"))


def since(df, column: str, start: Column, end: Column | None = None):
    """Rows at or after `start`, and up to `end` if given.

    For `event_ts` on a table partitioned by `event_date` the same bounds are
    put on the date, so whole partitions are skipped.
    """
    df = df.where(F.col(column) >= start)
    if end is not None:
        df = df.where(F.col(column) <= end)
    if column == "event_ts" and "event_date" in df.columns:
        df = df.where(F.col("event_date") >= F.to_date(start))
        if end is not None:
            df = df.where(F.col("event_date") <= F.to_date(end))
    return df


def seconds_between(start, end) -> Column:
    """Whole-second boundaries crossed between two timestamps."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def iso_text(ts) -> Column:
    """UTC ISO-8601 text with microseconds and offset."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def floor_period(ts, period_seconds: int) -> Column:
    """Start of the fixed-length period that holds the timestamp."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / F.lit(period_seconds)) * F.lit(period_seconds))
