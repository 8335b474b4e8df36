"""Reading, staging and connected components, shared by the operators of this folder."""

import time

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import work_folder, written
from tidemark.sources import folders

#: Characters that one slice of a batch may hold before it is worked on.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again, so that no lost executor repeats its work."""
    folder = work_folder(df.sparkSession, name)
    out = written(df, folder)
    out._staged_in = folder
    return out


def discard(*frames: DataFrame) -> None:
    """Remove staged frames that nothing reads any more: call it once what was made from them is staged itself."""
    for frame in frames:
        folders.remove(frame.sparkSession, frame._staged_in)
        release(frame.sparkSession)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go: Spark removes them when the driver's JVM collects its garbage.

    The first collection frees what holds a shuffle, the second the shuffle.
    """
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def stored_rows(df: DataFrame) -> int:
    """Rows of a staged frame, from the footers of its files."""
    return df.count()


def held_out(doc_id, parts: int, part: int):
    """Whether crc32 of the id as text leaves `part` when divided by `parts`; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def drawn(marked: DataFrame, n: int, salts=16) -> DataFrame:
    """Rows (group, key, mark, times): at most `n` of the rows (group, key, mark) of each group, those of least hash of the key.

    Ranked are first the rows of a (group, salt), then the `n` x `salts` least of a group. Equal rows are counted, not gathered.
    """
    order = [F.xxhash64("key"), F.col("key"), F.col("mark")]
    each = marked.groupBy("group", "key", "mark").agg(F.count("*").alias("c"))
    salted = each.withColumn("salt", F.pmod(F.xxhash64(F.lit(7), "key", "mark"), F.lit(salts)))
    least = salted.withColumn("r", F.row_number().over(Window.partitionBy("group", "salt").orderBy(*order))).where(F.col("r") <= n)
    before = Window.partitionBy("group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = n - F.coalesce(F.sum("c").over(before), F.lit(0))
    return least.withColumn("left", left).where("left > 0").select("group", "key", "mark", F.least("c", "left").alias("times"))


def sampled(rows: DataFrame, group: str, n: int, salts=16) -> DataFrame:
    """At most `n` rows (key, text, `group`) of each group, those of least hash of the key.

    Only ids and hashes are ranked; the texts of the chosen ones follow by a broadcast of at most `n` ids a group. Rows
    alike in key and text come back as often as they are chosen. Groups that are null and null texts are left out.
    """
    known = rows.where(F.col(group).isNotNull() & F.col("text").isNotNull()).select("key", "text", F.col(group).alias("group"))
    marked = known.withColumn("mark", F.xxhash64("text"))
    a, b = marked.alias("a"), F.broadcast(drawn(marked, n, salts)).alias("b")
    same = (F.col("a.group") == F.col("b.group")) & F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.mark") == F.col("b.mark"))
    return _copies(a.join(b, same), group)


def sampled_texts(docs: DataFrame, labels: DataFrame, group: str, n: int, salts=16) -> DataFrame:
    """The same of the join of `docs` (key, text) and `labels` (key, `group`); no text takes part in that join."""
    known = docs.where("key is not null and text is not null").select("key", "text", F.xxhash64("text").alias("mark"))
    wanted = labels.where(F.col(group).isNotNull()).select("key", F.col(group).alias("group"))
    a = known.alias("a")
    b = F.broadcast(drawn(known.select("key", "mark").join(wanted, "key"), n, salts)).alias("b")
    return _copies(a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.mark") == F.col("b.mark"))), group)


def _copies(chosen: DataFrame, group: str) -> DataFrame:
    """Rows (key, text, `group`) of texts `a` met by drawn rows `b`, each as often as it was drawn."""
    found = chosen.select("b.group", "a.key", "a.mark", "a.text", "b.times")
    found = found.groupBy("group", "key", "mark").agg(F.first("text").alias("text"), F.first("times").alias("times"))
    copies = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return copies.select("key", "text", F.col("group").alias(group))


def slices(batch: pa.RecordBatch, column="text", most=SLICE_CHARS):
    """A batch in pieces of bounded text size; one row at least in each."""
    sizes = [len(x) if x else 0 for x in batch.column(column).to_pylist()]
    start, chars = 0, 0
    for i, n in enumerate(sizes):
        if i > start and chars + n > most:
            yield batch.slice(start, i - start)
            start, chars = i, 0
        chars += n
    if start < len(sizes):
        yield batch.slice(start)


def priority(node):
    """A fixed pseudo-random order of nodes, so that chains shrink in logarithmic rounds."""
    return F.xxhash64(node)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component being the least node.

    Each round every node joins the neighbour of least priority (or stays, if it is the least itself) and the
    edges are rewritten between the joined nodes. Rounds are written tables; the driver sees only whether
    edges are left. Nodes without edges do not appear. Loops and repeated edges are harmless; null ends are ignored.
    """
    known = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    left = staged(known.distinct(), f"{name}-edges")
    maps = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(priority(F.col("b")).alias("p"), F.col("b").alias("v"))).alias("m"))
        own = F.struct(priority(F.col("a")).alias("p"), F.col("a").alias("v"))
        joined = staged(least.select(F.col("a").alias("node"), F.least("m", own)["v"].alias("into")), f"{name}-round")
        maps.append(joined)
        first = joined.select(F.col("node").alias("a"), F.col("into").alias("a2"))
        second = joined.select(F.col("node").alias("b"), F.col("into").alias("b2"))
        moved = left.join(first, "a").join(second, "b").where("a2 <> b2")
        ends = moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        after = staged(ends.distinct(), f"{name}-edges")
        discard(left)
        left = after
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = maps[0]
    for later in maps[1:]:
        step = later.select(F.col("node").alias("into"), F.col("into").alias("next"))
        roots = roots.join(step, "into", "left").select("node", F.coalesce("next", "into").alias("into"))
    roots = staged(roots, f"{name}-roots")
    discard(*maps)
    least = roots.groupBy("into").agg(F.min("node").alias("component"))
    return roots.join(least, "into").select("node", "component")


def spread_join(rows: DataFrame, small: DataFrame, key: str, salts=32, spread_by="doc_id") -> DataFrame:
    """Left join where one key may hold a third of `rows`: rows of a key go to `salts` tasks, and `small` (one row
    per key) is copied to those of them that hold the key. `rows` is read twice."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = salted.select(key, "__salt").distinct().join(small, key)
    return salted.join(copies, [key, "__salt"], "left").drop("__salt")


def copied_join(rows: DataFrame, few: DataFrame, key: str, salts=8, spread_by="doc_id") -> DataFrame:
    """Inner join where one key may hold a third of `rows`, read once: `few` (one row per key, far fewer keys than
    `rows` has) is copied to the `salts` tasks over which the rows of a key are spread.

    The merge hint is there because Spark's size estimate leaves out the copies and compression, and would broadcast them.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [key, "__salt"]).drop("__salt")


def links_to_forest(a, b) -> list[tuple[int, int]]:
    """Of links between numbered items, those that a spanning forest needs."""
    parent, kept = {}, []

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def tile_pairs(tiles: DataFrame, near=None, number=None) -> DataFrame:
    """Pairs of tiles (`tile`, `low`, `high`, `data`): each unordered pair once, a tile with itself included.

    `near` is a condition over (a.low, a.high, b.low, b.high). Only numbers are paired here; the tiles' data follow
    by two joins on the tile number, so that a task holds two tiles at a time. `number` is the number of tile numbers.
    """
    heads = staged(tiles.select("tile", "low", "high"), "tile-heads")
    n = heads.count() if number is None else number
    a = heads.select(F.col("tile").alias("ta"), F.col("low").alias("la"), F.col("high").alias("ha"))
    b = heads.select(F.col("tile").alias("tb"), F.col("low").alias("lb"), F.col("high").alias("hb"))
    numbered = a.withColumn("tb", F.explode(F.sequence(F.col("ta"), F.lit(max(n - 1, 0)).cast("long"))))
    pairs = numbered.join(b, "tb")
    if near is not None:
        pairs = pairs.where(near)
    left = tiles.select(F.col("tile").alias("ta"), F.col("data").alias("da"))
    right = tiles.select(F.col("tile").alias("tb"), F.col("data").alias("db"))
    return (
        pairs.select("ta", "tb").join(left, "ta").join(right, "tb")
        .repartition(F.col("ta"), F.col("tb")).select("ta", "tb", "da", "db")
    )
