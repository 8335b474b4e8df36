"""Upsert by event id as an anti join and a union."""

from pyspark.sql import DataFrame

from tidemark.operators.dedupe import newest_per_event
from tidemark.operators.matching import SPREAD, unmatched


def upsert(
    live: DataFrame,
    staged: DataFrame,
    intra_batch: str = "all",
    staged_ids: DataFrame | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """Live rows without the staged ids, followed by the staged rows.

    The last load wins. With `intra_batch='all'` duplicates inside the staged
    set all stay; `'latest'` keeps the newest row per id. `staged_ids` may pass
    the distinct ids already at hand. `spread` keeps an id with very many live
    rows from ending up in one task; a broadcast of the ids needs none.
    """
    staged = settle(staged, intra_batch)
    ids = staged.select("event_id").distinct() if staged_ids is None else staged_ids
    return unmatched(live, ids, "event_id", spread).unionByName(staged)


def settle(staged: DataFrame, intra_batch: str) -> DataFrame:
    if intra_batch == "latest":
        return newest_per_event(staged)
    if intra_batch != "all":
        raise ValueError(f"intra_batch must be 'all' or 'latest', not {intra_batch!r}")
    return staged
