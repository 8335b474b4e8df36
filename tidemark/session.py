"""Session settings and the shared working folder."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master=None, app_name="tidemark", **extra) -> SparkSession:
    """A session with the settings the jobs expect; `extra` wins over them.

    Shuffle partition counts are left to the cluster (AQE merges small ones);
    pass `shuffle_partitions` for a fixed count, as local runs do.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    partitions = extra.pop("shuffle_partitions", None)
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    settings.update({k: str(v) for k, v in extra.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_root()
    return root.rstrip("/")


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root, never used before."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """Write a frame and read it back: cuts the lineage and fixes its values."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fits_broadcast(rows: int, row_bytes: int, limit_bytes: int) -> bool:
    """Whether a frame of a counted size may be broadcast."""
    return rows * row_bytes <= limit_bytes
