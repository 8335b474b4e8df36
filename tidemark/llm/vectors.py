"""Usable vectors, and vectors dealt into tiles of bounded size."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, key="vec_id", vector="embedding") -> DataFrame:
    """Rows (id, v: array<double>) without vectors that are null, empty, zero or hold null or non-finite components."""
    v = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return v.where(F.col("id").isNotNull() & usable_vector("v"))


def usable_vector(v):
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(v, lambda x: x != 0), F.lit(False))


def tiled(rows: DataFrame, count: int, tile_rows: int) -> tuple[DataFrame, int]:
    """Rows (tile, data): vectors dealt evenly by id; `data` lists the structs of a tile."""
    number = max(1, -(-count // tile_rows))
    tile = F.pmod(F.xxhash64("id"), F.lit(number)).cast("long").alias("tile")
    return rows.select(tile, F.struct(*rows.columns).alias("row")).groupBy("tile").agg(F.collect_list("row").alias("data")), number


def unpack(data, fields=("id",)):
    """The numbers and the matrix of one tile (an Arrow list of structs)."""
    structs = data.values
    v = structs.field("v")
    matrix = v.flatten().to_numpy(zero_copy_only=False).reshape(len(structs), -1)
    return [structs.field(f).to_numpy(zero_copy_only=False) for f in fields], matrix.astype(np.float64)
