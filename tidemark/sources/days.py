"""Zones kept by day: which days have gone out of use, and when their files may go.

Retiring days writes one note, named by the first day still in use. Readers that begin later leave earlier days out by
partition. The files of retired days are removed in a second step, once no reader that began before can need them.
"""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import folders

NOTES = "_retired"


@dataclass(frozen=True)
class Zone:
    """A folder with a partition per day: one date column, or year, month and day."""

    root: str
    columns: tuple[str, ...] = ("year", "month", "day")

    def day(self):
        """The day of a row as text that sorts by time."""
        return F.concat_ws("-", *[F.col(c).cast("string") for c in self.columns])

    def held(self, spark: SparkSession) -> dict[dt.date, str]:
        """The folder of every day there is."""
        found = {"": self.root}
        for column in self.columns:
            found = {
                f"{values}-{v}".lstrip("-"): f"{folder}/{column}={v}"
                for values, folder in found.items()
                for v in folders.parts(spark, folder, column)
            }
        return {dt.date.fromisoformat(day): folder for day, folder in found.items() if "__HIVE" not in day}


def _notes(spark: SparkSession, zone: Zone) -> list[dt.date]:
    names = folders.names(spark, f"{zone.root}/{NOTES}")
    return sorted(dt.date.fromisoformat(n) for n in names if len(n) == 10)


def first_in_use(spark: SparkSession, zone: Zone) -> dt.date | None:
    """The first day that isn't retired; None before the first retirement."""
    notes = _notes(spark, zone)
    return notes[-1] if notes else None


def in_use(rows: DataFrame, zone: Zone) -> DataFrame:
    """Rows of days that aren't retired; others are not opened."""
    first = first_in_use(rows.sparkSession, zone)
    return rows if first is None else rows.where(zone.day() >= F.lit(first.isoformat()))


def retire(spark: SparkSession, zone: Zone, first: dt.date, at: dt.datetime) -> list[dt.date]:
    """Take days before `first` out of use; returns those that still have files. A day never comes back into use."""
    before = first_in_use(spark, zone)
    if before is None or first > before:
        folders.create_once(spark, f"{zone.root}/{NOTES}/{first}", int(at.timestamp()))
    else:
        first = before
    return sorted(day for day in zone.held(spark) if day < first)


def delete(spark: SparkSession, zone: Zone, retired_before: dt.datetime) -> list[dt.date]:
    """Remove the files of days that were retired by a time; returns the days. It can be repeated after a failure."""
    due = [
        first for first in _notes(spark, zone)
        if folders.read_number(spark, f"{zone.root}/{NOTES}/{first}") <= retired_before.timestamp()
    ]
    if not due:
        return []
    removed = sorted((day, folder) for day, folder in zone.held(spark).items() if day < due[-1])
    for _, folder in removed:
        folders.remove(spark, folder)
    for older in due[:-1]:
        folders.remove(spark, f"{zone.root}/{NOTES}/{older}")
    return [day for day, _ in removed]
