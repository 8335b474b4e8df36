"""SimHash near duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles of one bit count; two tiles are compared (exclusive or, bit counts) unless
their bit counts differ by more than the radius, since each differing bit changes the count by one at most. A pair of
tiles gives the links of a spanning forest only, so a dense group gives no square of links.

Null and empty texts have fingerprint zero, which links like any other. Repeated rows and equal texts share a
fingerprint. An empty table gives an empty result. Other columns are left out.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, links_to_forest, slices, spread_join, staged, tile_pairs

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Rows whose bits are unpacked at a time.
_ROWS = 65_536


def fingerprint(text: str | None, words_per_shingle=3, seed=42) -> int:
    words = _WORDS.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    size = min(words_per_shingle, len(words))
    raw = [w.encode("utf-8", "replace") for w in words]
    grams = raw if size == 1 else map(b" ".join, zip(*(raw[i:] for i in range(size))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _ROWS):
        part = h[i : i + _ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle=3, key="doc_id", text="text") -> DataFrame:
    """Rows (key, fp), fp being the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                fps = [fingerprint(t, words_per_shingle) for t in part.column("text").to_pylist()]
                signed = np.array(fps, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(signed)], ["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


def links(distinct: DataFrame, radius=2, tile_rows=8192) -> DataFrame:
    """Links (a, b) between fingerprints (column fp, each once): all pairs within the radius are connected by them."""
    counted = distinct.withColumn("ones", F.bit_count("fp"))
    per_count = {r["ones"]: r["count"] for r in counted.groupBy("ones").count().collect()}  # 65 rows at most
    if not per_count:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    base, number = {}, 0
    for ones in sorted(per_count):
        base[ones] = (number, -(-per_count[ones] // tile_rows))
        number += base[ones][1]
    literal = F.create_map(*[F.lit(x) for k, (n, t) in base.items() for x in (k, F.struct(F.lit(n).alias("n"), F.lit(t).alias("t")))])
    at = literal[F.col("ones")]
    dealt = counted.withColumn("tile", (at["n"] + F.pmod(F.xxhash64("fp"), at["t"])).cast("long"))
    tiles = dealt.groupBy("tile").agg(
        F.min("ones").alias("low"), F.max("ones").alias("high"), F.collect_list("fp").alias("data")
    )
    tiles = staged(tiles, "simhash-tiles")
    pairs = tile_pairs_of(tiles, number, radius)

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a = batch.column("da")[i].values.to_numpy().view(np.uint64)
                b = batch.column("db")[i].values.to_numpy().view(np.uint64)
                same = batch.column("ta")[i].as_py() == batch.column("tb")[i].as_py()
                from_a, from_b = [], []
                for start in range(0, len(a), 128):
                    near = np.bitwise_count(a[start : start + 128, None] ^ b[None, :]) <= radius
                    x, y = np.nonzero(near)
                    x += start
                    if same:
                        x, y = x[x < y], y[x < y]
                    from_a.append(x)
                    from_b.append(y)
                shift = 0 if same else len(a)
                kept = links_to_forest(np.concatenate(from_a), np.concatenate(from_b) + shift)
                both = a if same else np.concatenate([a, b])
                ends = np.array(kept, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[ends[:, 0]].view(np.int64)), pa.array(both[ends[:, 1]].view(np.int64))], ["a", "b"]
                )

    return pairs.mapInArrow(compare, "a long, b long")


def tile_pairs_of(tiles: DataFrame, number: int, radius: int) -> DataFrame:
    near = (F.col("lb") <= F.col("ha") + radius) & (F.col("la") <= F.col("hb") + radius)
    return tile_pairs(tiles, near, number)


def near_duplicates(docs: DataFrame, words_per_shingle=3, radius=2, key="doc_id", text="text") -> DataFrame:
    """Rows (key, fp, component_id): the least key among documents reachable over links."""
    marked = staged(fingerprints(docs, words_per_shingle, key, text), "fingerprints")
    each = staged(marked.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    joined = components(links(each.select("fp"), radius), "simhash")
    rooted = each.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = staged(rooted.join(least, "root").select("fp", "component_id"), "simhash-components")
    return spread_join(marked, ids, "fp", spread_by=key)
