"""The transform as a bounded run, for everything a stream still holds."""

from pyspark.sql import DataFrame

from tidemark.functions import timing
from tidemark.operators import dedupe, enrich, validate
from tidemark.operators.matching import unmatched
from tidemark.schema import VALID_EVENT_TYPES
from tidemark.session import work_folder, written
from tidemark.sources import folders, keys, landing, rejects


def run(
    records: DataFrame,
    root: str,
    keys_root: str,
    run_id: str,
    as_of,
    strictness: str = "required",
    event_types=VALID_EVENT_TYPES,
    form: str = "short",
) -> None:
    """Land good records not seen before, store the bad ones, remember the keys.

    `as_of` is the run's one moment: delivery, rejection and key times. With
    the same `run_id` and `as_of` a run can be repeated at any point; it
    replaces its own folders and leaves its own keys out of the lookup. Keys
    are stored last, so a run that died has remembered nothing.
    """
    spark = records.sparkSession
    now = timing.as_of_column(as_of)
    folder = work_folder(spark, "backfill")
    try:
        # Read, decoded and checked once.
        checked = written(validate.check(records, strictness, event_types), f"{folder}/checked")
        known = keys.read(spark, keys_root, as_of, without_run=run_id)
        fresh = dedupe.drop_seen(validate.good(checked), known, as_of)
        lines = enrich.enrich(fresh, form, processed_at=now).withColumn("delivered_at", now)
        # One delivery hour, and partitions already sized by the deduplication's shuffle.
        landing.land(lines, root, run_id, rebalance=False)
        rejects.store(rejects.as_rejects(validate.bad(checked), now), root, run_id)
        # A record has one key, so the keys of what was landed need no second look at the texts' order.
        new = dedupe.seen_keys(validate.good(checked), now)
        keys.add(unmatched(new, known, "sequence_number"), keys_root, run_id)
    finally:
        folders.remove(spark, folder)
