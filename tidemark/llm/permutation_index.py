"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots, nearest first. Each pivot's inverted file holds the place that each vector
gives it (the last place for one not named). A query adds up the differences of places over the files of its own pivots
(the footrule distance), takes the nearest share of the index by that, and reranks it by the exact inner product.

Pivots are a bounded sample of the vectors; every vector is indexed. The index is dealt into tiles and the queries into
blocks; a task holds one of each, and the best of all tiles are merged by rank. Null, zero and non-finite vectors take
no part, nor does a query meet its own id. Ties go to the smaller id. Fewer candidates than `k` give all of them. An
empty table gives an empty result. Vectors are expected to have one length.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.vectors import tiled, unpack, usable


def search(rows: DataFrame, is_query, k=20, pivots=120, named=120, share=0.25, tile_rows=8192, key="vec_id", vector="embedding"):
    """Rows (query_id, rank, vec_id, score). `is_query` is a condition over the key named `id`."""
    all_rows = staged(usable(rows, key, vector), "vectors")
    chosen = all_rows.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()  # at most `pivots` rows
    count = all_rows.count()
    kind = rows.schema[key].dataType.simpleString()
    tiles, number = tiled(all_rows, count, tile_rows)
    asked = all_rows.where(is_query)
    blocks, _ = tiled(asked, asked.count(), tile_rows // 4)
    copies = blocks.select(F.col("tile").alias("block"), F.col("data").alias("asked")).withColumn(
        "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long")))
    )
    pairs = copies.join(tiles, "tile").repartition("tile", "block").select("asked", "data")
    centre = np.array([r["v"] for r in chosen], np.float64)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield _search_tile(batch.column("asked")[i], batch.column("data")[i], centre, k, named, share, kind)

    schema = f"query_id {kind}, vec_id {kind}, score double"
    found = pairs.mapInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _nearest_pivots(x, centre, named):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.argsort(-(unit @ (centre / np.linalg.norm(centre, axis=1, keepdims=True)).T), axis=1, kind="stable")[:, :named]


def _nearest(far, take):
    """The places of the `take` least, of equal ones those that come first."""
    if take >= len(far):
        return np.arange(len(far))
    cut = np.partition(far, take - 1)[take - 1]
    below = np.flatnonzero(far < cut)
    return np.concatenate([below, np.flatnonzero(far == cut)[: take - len(below)]])


def _search_tile(asked, data, centre, k, named, share, kind):
    (query_ids,), q = unpack(asked)
    (ids,), x = unpack(data)
    named = min(named, len(centre))
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    lists = _nearest_pivots(x, centre, named)
    files = np.full((len(centre), len(ids)), named, np.int16)  # per pivot: the place each vector gives it
    np.put_along_axis(files.T, lists, np.arange(named, dtype=np.int16)[None, :], 1)
    take = min(len(ids), max(4 * k, int(np.ceil(share * len(ids)))))
    out = [], [], []
    for query, vector, mine in zip(query_ids, q, _nearest_pivots(q, centre, named)):
        far = np.zeros(len(ids), np.int32)
        for i, p in enumerate(mine):
            far += np.abs(files[p] - np.int16(i))
        near = _nearest(far, take)
        near = near[ids[near] != query]
        score = np.einsum("ij,j->i", x[near], vector)
        if len(near) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            kept = score >= least  # ties included
            near, score = near[kept], score[kept]
        top = np.lexsort((ids[near], -score))[:k]
        out[0].extend([query] * len(top))
        out[1].extend(ids[near][top])
        out[2].extend(score[top])
    kind = pa.int64() if kind == "bigint" else pa.int32()
    return pa.RecordBatch.from_arrays(
        [pa.array(out[0], kind), pa.array(out[1], kind), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"]
    )
