"""Loading the landing zone into the fact table as files arrive."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.load import load
from tidemark.sources.fact import FactTable
from tidemark.sources.landing import stream_lines
from tidemark.streaming.transform_job import batch_name


def start(
    table: FactTable,
    landing_root: str,
    checkpoint: str,
    trigger: str | None = "60 seconds",
    audit_root: str | None = None,
    rejects_root: str | None = None,
    max_files: int = 1_000,
    below: str = "",
    **options,
) -> StreamingQuery:
    """Start the load job; `trigger=None` loads what is there and ends.

    A batch that runs again upserts the same ids under the same load time,
    which Spark keeps with the batch, and replaces its own rejects and audit
    rows, and so changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        load(table, batch, f"{landing_root} {name}", audit_root, rejects_root, batch_id=f"load-{name}", **options)

    writer = (
        stream_lines(table.spark, landing_root, max_files, below)
        .withColumn("loaded_at", F.current_timestamp())
        .writeStream.queryName("load")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
