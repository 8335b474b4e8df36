"""One job that expires landed files, rejects, replayed ids and seen keys."""

import datetime as dt

from pyspark.sql import SparkSession

from tidemark.schema import EVENT_RETENTION_DAYS, KEY_MEMORY_SECONDS, REJECT_RETENTION_DAYS
from tidemark.sources import days, keys, landing, rejects
from tidemark.plans import replay

#: How long a reader may go on with the days it saw when it began.
GRACE_SECONDS = 86_400


def zones(root: str, keys_root: str | None = None) -> dict[str, days.Zone]:
    """The zones below the root of the transform job, and the seen keys of bounded runs."""
    found = {"landing": landing.zone(root), "rejects": rejects.zone(root), "replayed": replay.zone(f"{root}/replayed")}
    return found | ({"keys": keys.zone(keys_root)} if keys_root else {})


def expire(
    spark: SparkSession,
    root: str,
    now: dt.datetime,
    keys_root: str | None = None,
    event_days: int = EVENT_RETENTION_DAYS,
    reject_days: int = REJECT_RETENTION_DAYS,
    key_seconds: int = KEY_MEMORY_SECONDS,
    grace_seconds: int = GRACE_SECONDS,
) -> dict[str, dict]:
    """Retire the days beyond retention, and delete those retired `grace_seconds` ago; returns both per zone.

    Ids of replayed rejects lie under the day of their reject and go with it, after the rejects themselves: no reject
    outlives the note that it was sent. A run that fails halfway is made up for by the next.
    """
    today = now.date()
    first = {
        "landing": today - dt.timedelta(days=event_days),
        "rejects": today - dt.timedelta(days=reject_days),
        "replayed": today - dt.timedelta(days=reject_days),
        "keys": (now - dt.timedelta(seconds=key_seconds)).date(),
    }
    result = {}
    for name, zone in zones(root, keys_root).items():
        retired = days.retire(spark, zone, first[name], now)
        deleted = days.delete(spark, zone, now - dt.timedelta(seconds=grace_seconds))
        result[name] = {"retired": [str(d) for d in retired], "deleted": [str(d) for d in deleted]}
    return result
