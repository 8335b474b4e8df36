"""Hard negatives: anchors in clusters, one candidate list per cluster, walked until nothing better can follow.

Anchors alike in length of vector (and, for positives, in label) are clustered; clusters of more than `members` anchors
are dealt into several groups. A group has a centre and the largest angle of a member to it. By the triangle inequality
of angles, a candidate's inner product with any member is at most |candidate| |member| cos(angle to the centre - that
angle), or |candidate| |member| where the difference is negative. The candidates of a group are sorted by that bound
once, and all members walk the list together until the bound is under what each of them still needs. Nothing is missed.

Two walks: the first positives of an anchor among rows of its label, then, from their scores, the ranges in which
negatives of each positive are wanted; a candidate whose bound is under the lower ends of a group is not sent to it.
A list is dealt into segments of a bounded number of rows, each sorted and walked in a task of its own, with the
members of the group; the first of each segment are merged.

Vectors hold whole numbers as doubles; scores are exact, and those beyond 64 bits are cut to the largest or least long.
Rows with a null id, label or vector, or with null or non-finite components, take no part. Zero vectors and empty
vectors do. Only vectors of the same length meet. Each row of a repeated id is a row of its own: as an anchor it gives
its own results, and it may be a candidate of another row of its id. Ties go to the smaller id. An empty table gives an
empty result. Other columns are not read. The centres are fitted on at most `sample` anchors.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.llm.common import staged

#: Rows of a list that are scored at once, rows of a segment, bytes of groups that are sent to all tasks at a time.
STEP, SEGMENT, GROUP_BYTES = 2048, 65_536, 32_000_000
LONG = 2**63 - 1
#: Larger than all rounding errors of a bound, as a share of it.
SLACK = 1e-9
_KEEP = "a long, slot int, score long, id long, row long"


def quantized(rows: DataFrame, scale=256, key="vec_id", label="label", vector="embedding") -> DataFrame:
    """Usable rows (row, id, label, v): components become floor(scale * x)."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    kept = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = kept.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    # floor() of a double is a long, which large ones do not fit; from 2^52 on they are whole already.
    whole = F.transform("v", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    return kept.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v"))


def _matrix(column, size) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, within a long."""
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    wide = [[int(x) for x in row] for row in b.tolist()]
    out = np.zeros((len(a), len(b)), np.int64)
    for i, row in enumerate(a.tolist()):
        own = [int(x) for x in row]
        for j, other in enumerate(wide):
            out[i, j] = max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(own, other))))
    return out


def _unit(v):
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def _centres(v: np.ndarray, k: int, rounds=8, seed=5) -> np.ndarray:
    """k-means of unit vectors by angle."""
    v = _unit(v)
    centres = v[np.random.default_rng(seed).permutation(len(v))[:k]]
    for _ in range(rounds):
        near = np.argmax(v @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, v)
        used = np.bincount(near, minlength=len(centres)) > 0
        centres = np.where(used[:, None], _unit(sums), centres)
    return centres


def grouped(anchors: DataFrame, by_label: bool, members=512, sample=65_536) -> DataFrame:
    """`g` for rows (row, label, v): alike in vector length (and label), near each other, about `members` in each."""
    size = F.size("v")
    key = F.concat_ws("/", size, "label") if by_label else size.cast("string")
    keyed = anchors.withColumn("key", key)
    large = {r["key"]: r["count"] for r in keyed.groupBy("key").count().where(F.col("count") > members).collect()}
    if not large:
        return keyed.withColumnRenamed("key", "g")
    # A bounded sample, the same share of each large key; at most one key per `members` anchors reaches the driver.
    share = sample / sum(large.values())
    hashed = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))
    some = keyed.where(F.col("key").isin(list(large)) & hashed).select("key", "v").limit(2 * sample).collect()
    samples = {}
    for r in some:
        samples.setdefault(r["key"], []).append(r["v"])
    centres = {}
    for k, v in samples.items():
        v = np.array(v, np.float64).reshape(len(v), -1)
        if v.shape[1]:
            centres[k] = _centres(v, min(len(v), math.ceil(large[k] / members)))
    shared = anchors.sparkSession.sparkContext.broadcast(centres)

    def near(batches):
        for batch in batches:
            keys = np.array(batch.column("key").to_pylist(), object)
            cluster = np.zeros(len(keys), np.int32)
            for k in set(keys):
                if k in shared.value:
                    at = np.flatnonzero(keys == k)
                    v = _matrix(batch.column("v").take(pa.array(at)), shared.value[k].shape[1])
                    cluster[at] = np.argmax(v @ shared.value[k].T, axis=1)
            yield batch.append_column("cluster", pa.array(cluster))

    schema = StructType([*keyed.schema.fields, StructField("cluster", IntegerType())])
    clustered = staged(keyed.mapInArrow(near, schema), "anchor-clusters")
    sizes = clustered.groupBy("key", "cluster").agg(F.ceil(F.count("*") / members).alias("blocks"))
    dealt = clustered.join(sizes, ["key", "cluster"])
    block = F.pmod(F.xxhash64(F.lit(3), "row"), F.col("blocks"))
    return dealt.withColumn("g", F.concat_ws("/", "key", "cluster", block)).select(*anchors.columns, "g")


def _heads(anchors: DataFrame) -> DataFrame:
    """Rows (g, centre, angle, least, labels) of rows (g, label, v, least): the largest angle, the least need per length."""
    schema = "g string, centre array<double>, n long"

    def means(batches):
        """Sums of unit vectors, one row per group and batch."""
        for batch in batches:
            for g, at in _runs(batch.column("g")):
                v = _matrix(batch.column("v").take(pa.array(at)), len(batch.column("v")[int(at[0])]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g]), pa.array([_unit(v).sum(0).tolist()], pa.list_(pa.float64())), pa.array([len(at)])], ["g", "centre", "n"]
                )

    parts = anchors.select("g", "v").mapInArrow(means, schema).select("g", F.posexplode("centre").alias("i", "x"))
    sums = parts.groupBy("g", "i").agg(F.sum("x").alias("x"))
    centre = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    centres = sums.groupBy("g").agg(centre.alias("centre"))
    with_centre = anchors.join(centres, "g", "left").withColumn("centre", F.coalesce("centre", F.array().cast("array<double>")))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    lengths = F.sqrt(dot(F.col("v"), F.col("v"))) * F.sqrt(dot(F.col("centre"), F.col("centre")))
    cosine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot(F.col("v"), F.col("centre")) / lengths))
    angle = F.when(lengths > 0, F.acos(cosine)).otherwise(F.lit(math.pi))
    return with_centre.groupBy("g").agg(
        F.first("centre").alias("centre"),
        F.max(angle).alias("angle"),
        F.min("least").alias("least"),
        F.collect_set("label").alias("labels"),
        F.count("*").alias("n"),
    )


def _runs(column):
    """(value, places) of the distinct values of a column of text."""
    values = np.array(column.to_pylist(), object)
    for value in dict.fromkeys(values):
        yield value, np.flatnonzero(values == value)


def _lists(rows: DataFrame, heads: DataFrame, same_label: bool) -> DataFrame:
    """Rows (g, bound, row, id, label, v): the candidates of every group, without those under its least need.

    The groups are sent to all tasks, as many at a time as fit `GROUP_BYTES`.
    """
    spark = rows.sparkSession
    size = heads.agg(F.sum(F.size("centre") * 8 + F.size("labels") * 16 + 64)).first()[0] or 0
    passes = max(1, math.ceil(size / GROUP_BYTES))
    out = None
    for part in range(passes):
        own = heads.where(F.pmod(F.xxhash64("g"), F.lit(passes)) == part).collect()  # at most about GROUP_BYTES
        tables = {}
        for r in own:
            tables.setdefault(len(r["centre"]), []).append((r["g"], r["centre"], r["angle"], r["least"], set(r["labels"])))
        shared = spark.sparkContext.broadcast(tables)

        def run(batches, shared=shared):
            for batch in batches:
                lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
                labels = np.array(batch.column("label").to_pylist(), object)
                for length in set(lengths.tolist()) & set(shared.value):
                    at = np.flatnonzero(lengths == length)
                    v = _matrix(batch.column("v").take(pa.array(at)), length)
                    norm, unit = np.linalg.norm(v, axis=1), _unit(v)
                    for g, centre, angle, least, own_labels in shared.value[length]:
                        wanted = np.array([(x in own_labels) for x in labels[at]]) if same_label else np.ones(len(at), bool)
                        middle = _unit(np.array(centre, np.float64).reshape(1, -1))[0]
                        apart = np.arccos(np.clip(unit @ middle, -1, 1)) - angle
                        # Per unit of a member's length. Near an angle of 0 the arc cosine is only good to 1e-7.
                        bound = norm * np.minimum(1.0, np.cos(np.clip(apart - 1e-6, 0, np.pi)) + SLACK)
                        wanted &= bound * (1 + SLACK) >= least
                        kept = pa.array(at[wanted])
                        if len(kept):
                            some = batch.take(kept)
                            columns = pa.array([g] * len(kept)), pa.array(bound[wanted]), *(some.column(c) for c in ("row", "id", "label", "v"))
                            yield pa.RecordBatch.from_arrays(list(columns), ["g", "bound", "row", "id", "label", "v"])

        found = rows.mapInArrow(run, "g string, bound double, row long, id long, label long, v array<double>")
        out = found if out is None else out.unionByName(found)
    return out


def walked(anchors: DataFrame, rows: DataFrame, k: int, same_label: bool) -> DataFrame:
    """Rows (a, slot, score, id, row): the first `k` candidates of every anchor `a` in each of its score ranges.

    `anchors` has (g, row, label, v, least, lows, highs): ranges by slot, and the lowest end over the anchor's length.
    """
    heads = staged(_heads(anchors), "anchor-groups")
    candidates = rows.count()
    segments = max(1, math.ceil(candidates / SEGMENT))
    lists = _lists(rows, heads, same_label).withColumn("segment", F.pmod(F.xxhash64("row"), F.lit(segments)).cast("int"))
    empty = F.array().cast("array<long>")
    listed = lists.select("g", "segment", F.lit(1).alias("kind"), F.col("bound"), "row", "id", "label", "v", empty.alias("lows"), empty.alias("highs"))
    members = anchors.select(
        "g", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"), F.lit(0).alias("kind"),
        F.lit(0.0).alias("bound"), "row", F.lit(0).cast("long").alias("id"), "label", "v", "lows", "highs",
    )
    dealt = listed.unionByName(members).repartition("g", "segment")
    ordered = dealt.sortWithinPartitions("g", "segment", "kind", F.desc("bound"))

    def run(batches):
        walk, head, key = None, [], None
        for batch in batches:
            marks = list(zip(batch.column("g").to_pylist(), batch.column("segment").to_pylist(), batch.column("kind").to_pylist()))
            starts = [i for i in range(len(marks)) if i == 0 or marks[i] != marks[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(marks)]):
                if marks[a][:2] != key:
                    if walk is not None:
                        yield walk.result()
                    walk, head, key = None, [], marks[a][:2]
                if marks[a][2] == 0:
                    head.append(batch.slice(a, b - a))
                elif head:
                    walk = walk or _Walk(pa.Table.from_batches(head), k, same_label)
                    for start in range(a, b, STEP):
                        walk.take(batch.slice(start, min(STEP, b - start)))
        if walk is not None:
            yield walk.result()

    first = ordered.mapInArrow(run, _KEEP)
    order = Window.partitionBy("a", "slot").orderBy(F.desc("score"), "id", "row")
    return first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


class _Walk:
    """The members of a group on their way down one sorted list."""

    def __init__(self, members: pa.Table, k: int, same_label: bool):
        self.k, self.same = k, same_label
        self.row = members.column("row").to_numpy()
        self.label = members.column("label").to_numpy()
        self.v = _matrix(members.column("v"), len(members.column("v")[0]))
        self.norm = np.linalg.norm(self.v, axis=1)
        lows, highs = members.column("lows").to_pylist(), members.column("highs").to_pylist()
        self.slots = max(map(len, lows))
        self.low = np.array([x + [LONG] * (self.slots - len(x)) for x in lows], np.int64)  # a slot that wants nothing
        self.high = np.array([x + [-LONG] * (self.slots - len(x)) for x in highs], np.int64)
        self.best = [tuple(np.zeros(0, np.int64) for _ in range(4)) for _ in range(self.slots)]  # member, score, id, row
        self.done = False

    def take(self, batch):
        """Score the next candidates, unless no member can use what follows."""
        if self.done:
            return
        top = batch.column("bound")[0].as_py() * (1 + SLACK)
        reach = top * self.norm * (1 + SLACK) + 1e-6
        if (reach[:, None] < self.low).all():
            self.done = True
            return
        row, ids = batch.column("row").to_numpy(), batch.column("id").to_numpy()
        scores = products(self.v, _matrix(batch.column("v"), self.v.shape[1]))
        alike = self.label[:, None] == batch.column("label").to_numpy()[None, :]
        allowed = alike & (self.row[:, None] != row[None, :]) if self.same else ~alike
        for j in range(self.slots):
            wanted = allowed & (scores >= self.low[:, j, None]) & (scores <= self.high[:, j, None])
            if wanted.sum() > 8 * self.k * len(self.row):  # at first all are wanted: keep the best and their ties
                held = np.where(wanted, scores, -LONG)
                if held.shape[1] > self.k:
                    least = -np.partition(-held, self.k - 1, axis=1)[:, self.k - 1]
                    wanted &= scores >= least[:, None]
            who, what = np.nonzero(wanted)
            if not len(who):
                continue
            new = who, scores[who, what], ids[what], row[what]
            m, s, i, r = (np.concatenate([x, y]) for x, y in zip(self.best[j], new))
            order = np.lexsort((r, i, ~s, m))  # ~s falls as s rises, without overflow
            m, s, i, r = m[order], s[order], i[order], r[order]
            start = np.flatnonzero(np.diff(m, prepend=-1))
            place = np.arange(len(m)) - np.repeat(start, np.diff([*start, len(m)]))
            kept = place < self.k
            self.best[j] = m[kept], s[kept], i[kept], r[kept]
            full = place == self.k - 1
            self.low[m[full], j] = np.maximum(self.low[m[full], j], s[full])

    def result(self):
        parts = [(self.row[m], np.full(len(m), j), s, i, r) for j, (m, s, i, r) in enumerate(self.best)]
        columns = [np.concatenate(c) for c in zip(*parts)]
        kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["a", "slot", "score", "id", "row"])


def mine(
    rows: DataFrame, is_anchor, positives=5, negatives=3, low=50, high=95, members=512, sample=65_536
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows from `quantized`.

    For each of an anchor's first `positives` rows of its label, the first `negatives` rows of other labels whose score
    is at least `low` and at most `high` percent of the positive's.
    """
    rows = staged(rows, "candidate-vectors")
    anchors = staged(rows.where(is_anchor), "anchor-vectors")
    none = F.lit(float("-inf"))
    everything = [F.array(F.lit(end).cast("long")).alias(name) for name, end in (("lows", -LONG), ("highs", LONG))]
    first = grouped(anchors, True, members, sample).select("g", "row", "label", "v", none.alias("least"), *everything)
    near = staged(walked(staged(first, "positive-groups"), rows, positives, True), "positives")

    exact = F.col("score").cast("decimal(38,0)")
    # Whole numbers between low and high percent of the score: quotients rounded up and down.
    lowest = F.ceil(exact * low / 100).cast("long")
    highest = F.floor(exact * high / 100).cast("long")
    ranges = near.select("a", "n", "id", "score", lowest.alias("lowest"), highest.alias("highest")).where("lowest <= highest")
    ranges = staged(ranges, "wanted-ranges")
    # The slots of an anchor are its distinct ranges: positives of equal score share one.
    slots = ranges.groupBy("a").agg(F.array_sort(F.collect_set(F.struct("lowest", "highest"))).alias("slots"))  # at most `positives`
    sides = slots.select(F.col("a").alias("row"), "slots", F.col("slots.lowest").alias("lows"), F.col("slots.highest").alias("highs"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    least = F.when(length > 0, F.array_min("lows") / length * (1 - SLACK) - 1e-6).otherwise(none)
    wanting = anchors.join(sides, "row").withColumn("least", F.least(least, least * (1 + 2 * SLACK)))
    second = grouped(wanting, False, members, sample).select("g", "row", "label", "v", "least", "lows", "highs")
    found = walked(staged(second, "negative-groups"), rows, negatives, False)

    wanted = ranges.join(slots, "a").withColumn("slot", (F.array_position("slots", F.struct("lowest", "highest")) - 1).cast("int"))
    wanted = wanted.select("a", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("a"), F.col("id").alias("anchor_id"))
    hits = found.select("a", "slot", F.col("n").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return wanted.join(hits, ["a", "slot"]).join(named, "a").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
