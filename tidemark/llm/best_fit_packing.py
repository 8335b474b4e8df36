"""Packing of documents into sequences: linear grouping of large lengths, configurations of few sizes, best fit.

A document's ids end with a separator. Documents longer than a sequence are cut so that only the first piece may be
shorter. Null and empty texts are the separator alone. Repeated rows are packed each. An empty table packs to nothing.
Extra columns are left out. Added tokens that a text holds (`<|endoftext|>`) get their own ids, as the tokenizer does by default.

Only the number of pieces per length (at most `capacity` numbers) reaches the driver. The plan is a list of runs
(length, first rank, last rank, first sequence, offset): the pieces of a length, numbered over all partitions, look up
their run. The number of runs depends on the capacity, not on the number of documents.
"""

import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import json_bpe
from tidemark.llm.common import slices, staged


def pieces(docs: DataFrame, tokenizer_path: str, capacity=1024, separator=2, key="doc_id", text="text") -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32)."""

    def run(batches):
        encode = json_bpe.encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch):
                out = [], [], [], [], []
                for doc, text_ in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array(array("I", [*encode(text_ or ""), separator]), "<u4").tobytes()
                    n = len(ids) // 4
                    stop = n % capacity or capacity
                    start, number = 0, 0
                    while start < n:
                        crc = zlib.crc32(ids[4 * start : 4 * stop])
                        for column, value in zip(out, (doc, number, start, stop - start, crc)):
                            column.append(value)
                        start, stop, number = stop, stop + capacity, number + 1
                kinds = batch.schema.field("key").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()
                names = ["key", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    cut = rows.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long")
    return cut.withColumnRenamed("key", key)


def _groups(counts: dict[int, int], large: int, groups: int):
    """Large pieces, longest first, in groups of equal cardinality: [[(length, count), …], …]; a group's size is its longest."""
    total = sum(c for n, c in counts.items() if n >= large)
    if not total:
        return []
    size = -(-total // groups)
    made, own, room = [], [], size
    for length in sorted((n for n in counts if n >= large), reverse=True):
        left = counts[length]
        while left:
            take = min(left, room)
            own.append((length, take))
            left, room = left - take, room - take
            if not room:
                made.append(own)
                own, room = [], size
    return made + [own] if own else made


def _configurations(sizes: list[int], counts: list[int], capacity: int):
    """Runs (group numbers, times): again and again the fullest configuration that holds the largest size left, used
    as long as the counts last. Each run uses up a group or halves one, so their number is small."""
    counts = list(counts)
    while any(counts):
        first = next(i for i, c in enumerate(counts) if c)
        room = capacity - sizes[first]
        # best[v]: groups (largest first) that fill v of the room; a group at most as often as it has pieces
        best = {0: ()}
        for i in range(first, len(sizes)):
            if not counts[i] or sizes[i] > room:
                continue
            had = counts[i] - (i == first)
            for value, chosen in sorted(best.items()):
                for times in range(1, min(had, (room - value) // sizes[i]) + 1):
                    best.setdefault(value + times * sizes[i], chosen + (i,) * times)
            if room in best:
                break
        config = (first, *best[max(best)])
        uses = {i: config.count(i) for i in config}
        times = min(counts[i] // k for i, k in uses.items())
        for i, k in uses.items():
            counts[i] -= k * times
        yield config, times


def plan(counts: dict[int, int], capacity=1024, large=160, groups=600) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first sequence, offset) that place every piece."""
    made = _groups(counts, large, groups)
    queues = [list(reversed(g)) for g in made]  # taken from the end
    used = dict.fromkeys(counts, 0)
    runs, bins, sequence = [], {}, 0  # bins: gap → [(first sequence, count, offset)]
    for config, times in _configurations([g[0][0] for g in made], [sum(c for _, c in g) for g in made], capacity):
        # Each slot takes a stretch of its group's pieces; bins are alike between two places where a slot's length changes.
        slots = []
        for i in config:
            need, stretch = times, []
            while need:
                length, have = queues[i].pop()
                take = min(have, need)
                stretch.append((length, take))
                need -= take
                if have > take:
                    queues[i].append((length, have - take))
            slots.append(stretch)
        done = 0
        while done < times:
            step = min(s[-1][1] if len(s) == 1 else s[0][1] for s in slots)
            offset = 0
            for s in slots:
                length, have = s[0]
                runs.append((length, used[length], used[length] + step, sequence, offset))
                used[length] += step
                offset += length
                if have == step:
                    s.pop(0)
                else:
                    s[0] = (length, have - step)
            if capacity > offset:
                bins.setdefault(capacity - offset, []).append((sequence, step, offset))
            sequence += step
            done += step
    gaps = sorted(bins)
    for length in sorted((n for n in counts if n < large), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                full = max(1, left // each)
                bins[capacity] = [(sequence, full, 0)]
                insort(gaps, capacity)
                sequence += full
                continue
            gap = gaps[at]
            first, have, offset = bins[gap].pop()
            take = min(have, left)
            if take < have:
                bins[gap].append((first + take, have - take, offset))
            if not bins[gap]:
                del bins[gap]
                gaps.pop(at)
            runs.append((length, used[length], used[length] + take, first, offset))
            used[length] += take
            left -= take
            if gap > length:
                if gap - length not in bins:
                    insort(gaps, gap - length)
                bins.setdefault(gap - length, []).append((first, take, offset + length))
    return runs


def ranked(rows: DataFrame, keys=("doc_id", "piece"), shares=64) -> DataFrame:
    """`rank` from 0 among pieces of equal length, without gathering a length in one task."""
    dealt = rows.withColumn("share", F.pmod(F.xxhash64(*keys), F.lit(shares)).cast("int"))
    counts = dealt.groupBy("length", "share").count()
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "share").orderBy(*keys)
    return (
        dealt.join(F.broadcast(starts), ["length", "share"])  # at most capacity × shares rows
        .withColumn("rank", F.col("base") + F.row_number().over(own) - 1)
        .drop("base", "share")
    )


def place(rows: DataFrame, capacity=1024, large=160, groups=600, keys=("doc_id", "piece")) -> DataFrame:
    """Adds `sequence_id` and `offset` to rows with a `length` of 1 to `capacity`."""
    rows = staged(rows, "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    by_length = {}
    for length, first, end, sequence, offset in plan(counts, capacity, large, groups):
        by_length.setdefault(length, []).append((first, sequence, offset))
    table = {n: np.array(sorted(r), np.int64) for n, r in by_length.items()}
    shared = rows.sparkSession.sparkContext.broadcast(table)
    columns = ranked(rows, keys)

    def look_up(frames):
        for frame in frames:
            sequence = np.zeros(len(frame), np.int64)
            offset = np.zeros(len(frame), np.int64)
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                runs = shared.value[n]
                run = runs[np.searchsorted(runs[:, 0], rank[at], "right") - 1]
                sequence[at] = run[:, 1] + rank[at] - run[:, 0]
                offset[at] = run[:, 2]
            yield pd.DataFrame({**frame.drop(columns="rank"), "sequence_id": sequence, "offset": offset})

    kept = columns.drop("rank").schema
    schema = kept.add("sequence_id", "long").add("offset", "long")
    return columns.mapInPandas(look_up, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity=1024, separator=2, key="doc_id", text="text") -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32, sequence_id, offset)."""
    cut = pieces(docs, tokenizer_path, capacity, separator, key, text)
    return place(cut, capacity, max(1, capacity // 6), keys=(key, "piece"))
