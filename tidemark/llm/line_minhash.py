"""Fuzzy line deduplication by MinHash.

Lines are compared trimmed. Equal lines are brought together first, told by the 128 bits of their md5, so that no text is
shuffled. A line's set is its character shingles. Their 32-bit hashes fall into bins by their top bits, and a bin's
signature row is the least hash, or that of the first bin with one in an order of its own. Lines that share a band of
signature rows are candidates: each is compared with the band's first line by the exact Jaccard similarity of the shingles
themselves. A line of a band that this leaves apart from its first line is compared with the others of its band where
the band has few lines (a band of two is done); in larger bands with the lines only of such bands that share one of its
rarest shingles, as any similar line must (see `rare_pairs`), never with all lines of a band. So unlike lines that meet by
chance, which most lines apart are, cost no more than their own small bands. The pairs (band, line) are dealt over the
cluster by their bands as packed arrays, and each part is sorted; of a band with very many lines a part keeps no more than
it is still to hand on. Of each connected component the line that comes first (by document, then place) stays, all other places go.

Signatures, the runs of equal bands and verification work on Arrow batches: the form in built-in functions alone was
beyond the limits (see the README for its figures). Everything else is joins and grouping.

Blank lines stay where they are. A null text stays null. Rows with a null key are passed through unchanged. A line
shorter than a shingle is one shingle. Rows of a repeated key are documents of their own, in the order in which the table
is read; so ties can't occur, as places are unique. Texts of any length are whole. An empty table gives an empty result.
`dedupe` leaves extra columns out; `without_repeats` keeps them and expects a unique key.
"""

import math
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import components, discard, release, slices, spread_join, staged
from tidemark.operators.matching import SPREAD, matched
from tidemark.session import fits_broadcast

SHINGLE = 5
#: 0.991 of the pairs at a similarity of 0.8 share a band, and 3 in 10^9 of those at 0.04, which unrelated lines have.
BAND_ROWS = 7
BANDS = 20
BINS = BAND_ROWS * BANDS
#: White space that trimming takes away.
SPACES = " \t\x0b\x0c\r"
#: Characters, and lines, worked on at a time: their numbers should stay in a core's cache.
CHARS = 250_000
LINES = 1_000
#: Lines whose bands are packed together, pairs (band, line) for a task, pairs that a task holds before it hands on large bands.
DEALT, PAIRS, HELD = 20_000, 500_000, 2_000_000
#: Bytes of a wanted line's place, and how many bytes of places are sent to all tasks.
_PLACE_BYTES = 64
PLACES_LIMIT = 64 * 1024 * 1024
#: Shingles are counted by this many groups of hashes; more frequent groups come later in a line's order.
COUNTERS = 1 << 18
#: Bits of a line's parities: more than the shingles by which similar lines of 1000 differ, else long lines all agree.
PARITIES = 1024
#: Lines of a band up to which they are compared two by two.
FEW = 32
#: Bits of a character in a shingle's number.
_LETTER = 12
_EMPTY = np.uint32(2**32 - 1)
_ODD = np.random.default_rng(5).integers(1 << 62, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_SMALL_ODD = (_ODD[:8] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
#: For each bin (column) the order in which a bin without a hash asks the others.
_DONORS = np.random.default_rng(6).permuted(np.tile(np.arange(BINS)[:, None], (1, BINS)), axis=0)


def _mixed(h):
    """64-bit numbers with every bit spread over all bits."""
    h = (h ^ (h >> np.uint64(32))) * _ODD[14]
    h = (h ^ (h >> np.uint64(29))) * _ODD[15]
    return h ^ (h >> np.uint64(32))


def _code_points(lines: list[str]):
    """The lines' code points one after another, lines shorter than a shingle padded, and their sizes."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), "<u4")
    return codes, np.fromiter(map(len, padded), np.int64, len(padded))


def _shingle_hashes(lines: list[str]):
    """A hash for every place at which a shingle may begin, `_EMPTY` where it would reach into the next line; the sizes."""
    codes, sizes = _code_points(lines)
    whole = max(0, len(codes) - SHINGLE + 1)
    h = codes[:whole] * _SMALL_ODD[0]
    part = np.empty_like(h)
    for i in range(1, SHINGLE):
        np.multiply(codes[i : i + whole], _SMALL_ODD[i], out=part)
        h += part
    for shift, odd in ((15, 5), (13, 6)):
        np.right_shift(h, np.uint32(shift), out=part)
        h ^= part
        h *= _SMALL_ODD[odd]
    np.right_shift(h, np.uint32(16), out=part)
    h ^= part
    ends = np.cumsum(sizes)[:-1]
    for back in range(1, SHINGLE):
        h[ends - back] = _EMPTY
    return h, sizes


def signatures(lines: list[str]) -> np.ndarray:
    """One row per line, one least shingle hash per bin. A bin without one takes that of the first bin with one in its order."""
    h, sizes = _shingle_hashes(lines)
    at = np.repeat(np.arange(len(lines), dtype=np.int64) * BINS, sizes)[: len(h)]
    at += ((h >> np.uint32(16)) * np.uint32(BINS)) >> np.uint32(16)
    low = np.full(len(lines) * BINS, _EMPTY)
    np.minimum.at(low, at, h)
    low = low.reshape(-1, BINS)
    rows = low.copy()
    line, lacking = np.nonzero(low == _EMPTY)
    for donors in _DONORS:
        if not len(line):
            break
        got = low[line, donors[lacking]]
        rows[line, lacking] = got
        still = got == _EMPTY
        line, lacking = line[still], lacking[still]
    return rows


def band_hashes(rows: np.ndarray) -> np.ndarray:
    """One hash per line and band."""
    parts = rows.astype(np.uint64).reshape(len(rows), BANDS, BAND_ROWS)
    h = _mixed(parts * _ODD[:BAND_ROWS] + _ODD[BAND_ROWS]).sum(2, dtype=np.uint64)
    return _mixed(h + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def banded(lines: DataFrame) -> DataFrame:
    """The rows with `bands` instead of `line`."""
    others = [f for f in lines.schema if f.name != "line"]
    names = [f.name for f in others]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "line", CHARS):
                for start in range(0, part.num_rows, LINES):
                    few = part.slice(start, LINES)
                    hashes = band_hashes(signatures(few.column("line").to_pylist()))
                    at = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * BANDS)
                    bands = pa.ListArray.from_arrays(at, pa.array(hashes.ravel()))
                    yield pa.RecordBatch.from_arrays([*[few.column(n) for n in names], bands], [*names, "bands"])

    schema = T.StructType([*others, T.StructField("bands", T.ArrayType(T.LongType()))])
    return lines.select(*names, "line").mapInArrow(run, schema)


def _runs(batches):
    """Of sorted (band, node) those whose band occurs again, with the band's first node as hub, `kind` 0.

    The first and last band of a task may go on in the tasks beside it. Their hubs come as rows of kind 1, or kind 2 if
    the band has one node in this task.
    """

    def out(band, node, hub, kind):
        kinds = np.full(len(band), kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (band, node, hub, kinds)], ["band", "node", "hub", "kind"])

    first = held = None  # (band, hub, whether it has several nodes)
    for batch in batches:
        band, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "node"))
        if not len(band):
            continue
        starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
        sizes = np.diff(np.r_[starts, len(band)])
        hubs, several = node[starts].copy(), sizes > 1
        if held is not None and held[0] == band[0]:
            if not held[2]:
                one = np.array([held[1]])
                yield out(band[:1], one, one, 0)
            hubs[0], several[0] = held[1], True
        elif first is None and held is not None:
            first = held
        if first is None and len(starts) > 1:
            first = (band[0], hubs[0], bool(several[0]))
        keep = np.repeat(several, sizes)
        yield out(band[keep], node[keep], np.repeat(hubs, sizes)[keep], 0)
        held = (band[-1], hubs[-1], bool(several[-1]))
    for edge in {first, held} - {None}:
        band, hub = np.array([edge[0]]), np.array([edge[1]])
        yield out(band, hub, hub, 1 if edge[2] else 2)


def _dealt(parts: int):
    """A mapInArrow function: rows (part, least, bands, nodes) of rows (node, bands), pairs packed by ranges of bands."""

    def run(batches):
        held, lines = [], 0

        def packed():
            band = np.concatenate([h[0] for h in held])
            node = np.concatenate([h[1] for h in held])
            part = ((band.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint16)
            order = np.argsort(part, kind="stable")
            least = int(node.min())
            node = node - least
            node = node.astype(np.uint32 if node.max() < 1 << 32 else np.int64)
            starts = np.flatnonzero(np.diff(part[order].astype(np.int32), prepend=-1))
            cuts = list(zip(starts, [*starts[1:], len(order)]))
            for i in range(0, len(cuts), 256):
                places = [order[a:b] for a, b in cuts[i : i + 256]]
                columns = [
                    pa.array([int(part[x[0]]) for x in places], pa.int32()), pa.array([least] * len(places), pa.int64()),
                    pa.array([band[x].tobytes() for x in places], pa.binary()), pa.array([node[x].tobytes() for x in places], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "least", "bands", "nodes"])

        for batch in batches:
            bands = batch.column("bands")
            sizes = pc.list_value_length(bands).to_numpy(zero_copy_only=False)
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), sizes)
            held.append((bands.flatten().to_numpy(zero_copy_only=False).astype(np.int64), node))
            lines += batch.num_rows
            if lines > DEALT:
                yield from packed()
                held, lines = [], 0
        if lines:
            yield from packed()

    return run


def _members(batches):
    """Of packed pairs what `_runs` finds in them. Bands with a large share of what a task holds are handed on as they come,
    each time with the least of these nodes as hub and a row of kind 1 for it."""
    schema, large = pa.schema({"band": pa.int64(), "node": pa.int64()}), set()
    bands, nodes, size, most = [], [], 0, HELD

    def several(band, node):
        """Sorted (band, node) of bands that occur again or are large."""
        order = np.argsort(band)
        band, node = band[order], node[order]
        again = band[1:] == band[:-1]
        keep = np.r_[False, again] | np.r_[again, False]
        if large:
            keep |= np.isin(band, list(large))
        band, node = band[keep], node[keep]
        order = np.lexsort((node, band))
        return band[order], node[order]

    def handed(band, node):
        starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
        hubs = np.repeat(node[starts], np.diff(np.r_[starts, len(band)]))
        for b, n, h, kind in ((band, node, hubs, 0), (band[starts], node[starts], node[starts], 1)):
            columns = [pa.array(x) for x in (b, n, h, np.full(len(b), kind, np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["band", "node", "hub", "kind"])

    for batch in batches:
        for least, b, n in zip(*(batch.column(c).to_pylist() for c in ("least", "bands", "nodes"))):
            bands.append(np.frombuffer(b, np.int64))
            nodes.append(np.frombuffer(n, np.uint32 if 2 * len(n) == len(b) else np.int64).astype(np.int64) + least)
            size += len(bands[-1])
            if size > most:
                band, node = np.concatenate(bands), np.concatenate(nodes)
                found, counts = np.unique(band, return_counts=True)
                large.update(found[counts > HELD // 64].tolist())
                mine = np.isin(band, list(large))
                if mine.any():
                    yield from handed(*several(band[mine], node[mine]))
                bands, nodes = [band[~mine]], [node[~mine]]
                size = len(bands[0])
                most = max(HELD, 2 * size)
    if not size:
        return
    band, node = several(np.concatenate(bands), np.concatenate(nodes))
    mine = np.isin(band, list(large))
    if mine.any():
        yield from handed(band[mine], node[mine])
    if not mine.all():
        yield from _runs([pa.RecordBatch.from_arrays([pa.array(band[~mine]), pa.array(node[~mine])], schema=schema)])


def band_members(signed: DataFrame) -> DataFrame:
    """Rows (band, node, hub) of rows (node, bands), for bands of several nodes; the hub is a band's least node.

    Bands of which rows are handed on with several hubs, as `large` ones may be, are put together.
    """
    tasks = max(signed.sparkSession.sparkContext.defaultParallelism, -(-signed.count() * BANDS // PAIRS))
    packed = signed.select("node", "bands").mapInArrow(_dealt(min(1 << 16, 4 * tasks)), "part int, least long, bands binary, nodes binary")
    dealt = packed.repartition(tasks, "part")
    found = staged(dealt.mapInArrow(_members, "band long, node long, hub long, kind int"), "line-bands")
    ends = found.where("kind > 0").groupBy("band").agg(F.min("hub").alias("whole"), F.countDistinct("hub").alias("c"))
    cut = F.broadcast(ends.where("c > 1").drop("c"))  # at most 64 rows for each task
    members = found.where("kind <> 1").join(cut, "band", "left").where("kind = 0 or whole is not null")
    members = members.select("band", "node", F.coalesce("whole", "hub").alias("hub"))
    members._staged_in = found._staged_in
    return members


def shingles(line: str) -> set[str]:
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def similar(a: str, b: str, similarity: float) -> bool:
    """Whether the Jaccard similarity of the lines' shingles is at least that."""
    x, y = shingles(a), shingles(b)
    common = len(x & y)
    return common >= similarity * (len(x) + len(y) - common)


def shingle_numbers(lines: list[str]) -> list[np.ndarray] | None:
    """Each line's distinct shingles as sorted numbers, the same for the same shingle among these lines and for no other.

    None if the lines hold more different characters than a number has room for.
    """
    codes, sizes = _code_points(lines)
    if codes.max(initial=0) >> _LETTER:
        letters, codes = np.unique(codes, return_inverse=True)
        if len(letters) >> _LETTER:
            return None
    codes = codes.astype(np.uint64)
    inside = np.ones(len(codes), bool)
    for back in range(1, SHINGLE):
        inside[np.cumsum(sizes) - back] = False
    inside = inside[: len(codes) - SHINGLE + 1]
    h = codes[: len(inside)].copy()
    for i in range(1, SHINGLE):
        h |= codes[i : i + len(inside)] << np.uint64(_LETTER * i)
    h = h[inside]
    ends = np.cumsum(sizes - SHINGLE + 1).tolist()
    out, start = [], 0
    for text, end in zip(lines, ends):
        own = h[start:end]
        if len(text) < SHINGLE:  # told from a whole shingle by the bits that no character uses
            own[0] |= np.uint64((SHINGLE - len(text)) << _LETTER * SHINGLE)
        own.sort()
        new = np.empty(len(own), bool)
        new[0] = True
        np.not_equal(own[1:], own[:-1], out=new[1:])
        out.append(own[new])
        start = end
    return out


def near_pairs(a: list[str], b: list[str], similarity: float) -> list[bool]:
    """For each pair of lines, whether `similar` holds. The pairs of a line mostly follow one another."""
    at, firsts = [], []
    for x in a:
        if not firsts or firsts[-1] != x:
            firsts.append(x)
        at.append(len(firsts) - 1)
    numbers = shingle_numbers(firsts + b)
    if numbers is None:
        return [similar(x, y, similarity) for x, y in zip(a, b)]
    near = []
    for i, y in zip(at, numbers[len(firsts) :]):
        x = numbers[i]
        if min(len(x), len(y)) < similarity * max(len(x), len(y)):
            near.append(False)
            continue
        both = np.concatenate((x, y))
        both.sort()
        common = np.count_nonzero(both[1:] == both[:-1])
        near.append(bool(common >= similarity * (len(x) + len(y) - common)))
    return near


def verified(pairs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Of distinct pairs (a, b) of line numbers those whose shingle sets are similar."""
    one = lines.select(F.col("node").alias("a"), F.col("line").alias("la"))
    two = lines.select(F.col("node").alias("b"), F.col("line").alias("lb"))
    both = spread_join(pairs.join(two, "b"), one, "a", spread_by="b")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "la", CHARS):
                for few in slices(part, "lb", CHARS):
                    near = near_pairs(few.column("la").to_pylist(), few.column("lb").to_pylist(), similarity)
                    yield few.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "la", "lb").mapInArrow(run, "a long, b long")


def _shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """Each line's distinct shingles as 64-bit hashes."""
    codes, sizes = _code_points(lines)
    codes = codes.astype(np.uint64)
    whole = len(codes) - SHINGLE + 1
    h = codes[:whole] * _ODD[0]
    for i in range(1, SHINGLE):
        h += codes[i : i + whole] * _ODD[i]
    h = _mixed(h)
    ends = np.cumsum(sizes).tolist()
    return [np.unique(h[start : end - SHINGLE + 1]) for start, end in zip([0, *ends], ends)]


def shingle_counts(lines: DataFrame) -> np.ndarray:
    """In how many lines the shingles of each of `COUNTERS` groups occur: a table of fixed size."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch, "line", CHARS):
                for own in _shingle_sets(part.column("line").to_pylist()):
                    np.add.at(counts, (own % np.uint64(COUNTERS)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "c"])

    found = lines.select("line").mapInArrow(run, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[found.column("at").to_numpy()] = found.column("c").to_numpy()
    return counts


def _ceiling(x: float) -> int:
    return math.ceil(x - 1e-9)


def rare_shingles(lines: DataFrame, counts: np.ndarray, similarity: float) -> DataFrame:
    """Rows (shingle, node, own, apart, i, m, short, p0...) of rows (node, own, apart, line).

    A line's m shingles stand in one order for all lines, rarer ones first. The first of them are given, at place i, as
    many as a line needs to meet one of the other's where it is the longer, and `short` where it is the shorter of a pair.
    A shingle turns one bit of the line's parities over, so two lines' parities differ in no more bits than shingles.
    """
    words = [f"p{j}" for j in range(PARITIES // 64)]
    names = ["shingle", "node", "own", "apart", "i", "m", "short", *words]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "line", CHARS):
                sets = _shingle_sets(part.column("line").to_pylist())
                shingle, place, size, short, parities = [], [], [], [], []
                for own in sets:
                    m = len(own)
                    order = np.lexsort((own, counts[(own % np.uint64(COUNTERS)).astype(np.int64)]))
                    n = m - _ceiling(similarity * m) + 1
                    shingle.append(own[order[:n]].view(np.int64))
                    place.append(np.arange(len(shingle[-1]), dtype=np.int32))
                    size.append(m)
                    odd = np.bincount((own >> np.uint64(40)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
                    parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                    short.append(place[-1] < m - _ceiling(2 * similarity / (1 + similarity) * m) + 1)
                times = [len(x) for x in shingle]
                line = np.repeat(np.arange(len(sets)), times)
                cells = [part.column(c).take(pa.array(line)) for c in ("node", "own", "apart")]
                sizes = pa.array(np.repeat(size, times).astype(np.int32))
                own = [pa.array(np.concatenate(x)) for x in (shingle, place, short)]
                bits = [pa.array(x) for x in np.ascontiguousarray(np.array(parities)[line].T)]
                yield pa.RecordBatch.from_arrays([own[0], *cells, own[1], sizes, own[2], *bits], names)

    rows = lines.select("node", "own", "apart", "line")
    kinds = "shingle long, node long, own long, apart boolean, i int, m int, short boolean"
    return rows.mapInArrow(run, ", ".join([kinds, *[f"{w} long" for w in words]]))


def rare_pairs(lines: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of lines (node, own, apart, line), one of them apart and their `own` different, that may be similar.

    Lines at the similarity have `need` shingles in common. The first common one is so early in both that as many are
    left after it, so it is among the rarest of either; and their parities differ in no more bits than they have shingles
    that are not common. No similar pair is left out; most others are, within the join.
    """
    rare = staged(rare_shingles(lines, shingle_counts(lines), similarity), "line-rare-shingles")
    x, y = rare.where("short").alias("x"), rare.alias("y")
    need = f"{similarity / (1 + similarity)!r} * (x.m + y.m) - 1e-6"
    same = "x.shingle = y.shingle and x.own <> y.own and (x.m < y.m or x.m = y.m and x.node <> y.node)"
    differ = " + ".join(f"bit_count(x.p{j} ^ y.p{j})" for j in range(PARITIES // 64))
    near = F.expr(f"{same} and least(x.m - x.i, y.m - y.i) >= {need} and {differ} <= x.m + y.m - 2 * ({need})")
    ends = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    apart = x.where("apart").join(y, near).select(*ends)
    others = x.where("not apart").join(y.where("apart"), near).select(*ends)
    pairs = staged(apart.unionByName(others).distinct(), "line-rest")
    discard(rare)
    return pairs


def few_pairs(known: DataFrame) -> DataFrame:
    """Pairs (a, b) of lines (band, node, own, apart, first) of one band, one of them apart and their `own` different.

    The first line of a band is in no pair, as it has been compared with all others.
    """
    rest = known.where("not first").drop("first")
    x, y = rest.where("apart").alias("x"), rest.alias("y")
    met = F.expr("x.band = y.band and x.own <> y.own and (not y.apart or x.node < y.node)")
    return x.join(y, met).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def rest_pairs(known: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of lines (band, node, own, apart, first) that share a band, may be similar and aren't compared yet.

    Pairs of larger bands may also be of two bands.
    """
    sizes = known.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.max("apart").alias("mixed"))
    sizes = staged(sizes.where("mixed and size > 2").select("band", "size"), "line-mixed-bands")
    few = matched(known, sizes.where(F.col("size") <= FEW), "band", SPREAD)
    few = staged(few_pairs(few).distinct(), "line-few-pairs")
    large = matched(known, sizes.where(F.col("size") > FEW), "band", SPREAD)
    large = large.groupBy("node").agg(F.first("own").alias("own"), F.max("apart").alias("apart"))
    large = staged(large.join(texts, "node").select("node", "own", "apart", "line"), "line-apart")
    rare = rare_pairs(large, similarity)
    pairs = staged(few.unionByName(rare).distinct(), "line-rest")
    discard(sizes, few, large, rare)
    return pairs


def merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) once more, with links (a, b) between nodes of them or of none."""
    labels = joined.select("node", "component")
    ends = links.join(labels.toDF("a", "ca"), "a", "left").join(labels.toDF("b", "cb"), "b", "left")
    ends = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    more = staged(components(ends, "line-components"), "line-merged")
    known = labels.join(more.toDF("component", "whole"), "component", "left")
    known = known.select("node", F.coalesce("whole", "component").alias("component"))
    return known.unionByName(more.join(labels, "node", "left_anti"))


def _trimmed(line):
    """Trimming itself looks at every character, so it is left to lines with white space at an end."""
    ends = [at for c in SPACES for at in (line.startswith(c), line.endswith(c))]
    return F.when(reduce(or_, ends), F.trim(line, F.lit(SPACES))).otherwise(line)


def _lines(docs: DataFrame, key, text) -> DataFrame:
    """Rows (key, n, line) of the lines that aren't blank."""
    each = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n")).alias("n", "raw"))
    return each.select("key", "n", _trimmed(F.col("raw")).alias("line")).where("line <> ''")


def kept_lines(docs: DataFrame, similarity=0.8, key="doc_id", text="text") -> DataFrame:
    """Rows (key, n): the places of lines that stay, blank ones not included."""
    each = _lines(docs, key, text)
    signed = banded(each.select("key", "n", F.unhex(F.md5("line")).alias("digest"), "line"))
    first = signed.groupBy("digest").agg(F.min(F.struct("key", "n")).alias("place"), F.first("bands").alias("bands"))
    first = first.withColumn("node", F.monotonically_increasing_id())
    # Numbers are given once, as the table is written.
    distinct = staged(first.select("node", "place.key", "place.n", "bands"), "distinct-lines")
    release(distinct.sparkSession)
    places = staged(distinct.select("node", "key", "n"), "line-places")
    members = band_members(distinct)
    discard(distinct)
    # From here on only lines that share a band are read.
    wanted = staged(places.join(members.select("node").distinct(), "node"), "line-wanted")
    few = fits_broadcast(wanted.count(), _PLACE_BYTES, PLACES_LIMIT)
    texts = staged(each.join(F.broadcast(wanted) if few else wanted, ["key", "n"]).select("node", "line"), "line-texts")
    discard(wanted)
    stars = staged(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "line-pairs")
    links = staged(verified(stars, texts, similarity), "line-links")
    discard(stars)
    joined = components(links, "line-stars")

    # Lines of a band that its first line did not bring together.
    labels = joined.select("node", F.col("component").alias("own"))
    hubs = labels.select(F.col("node").alias("hub"), F.col("own").alias("hub_own"))
    known = spread_join(members, hubs, "hub", spread_by="node")
    known = known.join(labels, "node", "left")  # a line is in `BANDS` bands at most
    own, hub_own = F.coalesce("own", "node"), F.coalesce("hub_own", "hub")
    first = (F.col("node") == F.col("hub")).alias("first")
    known = staged(known.select("band", "node", own.alias("own"), (own != hub_own).alias("apart"), first), "line-band-labels")
    discard(members)
    rest = rest_pairs(known, texts, similarity)
    discard(known)
    more = staged(verified(rest, texts, similarity), "line-more-links")
    discard(rest, texts)
    roots = joined if more.isEmpty() else merged(joined, more)

    # Only lines in a component of several need to be compared by place.
    placed = roots.join(places, "node")
    stays = placed.groupBy("component").agg(F.min(F.struct("key", "n", "node")).alias("m")).select("m.node")
    gone = placed.join(stays, "node", "left_anti").select("node")
    return places.join(gone, "node", "left_anti").select(F.col("key").alias(key), "n")


def without_repeats(docs: DataFrame, similarity=0.8, key="doc_id", text="text") -> DataFrame:
    """The rows with all their columns, texts without repeated lines, and n_lines, n_kept. Line breaks and spacing stay."""
    kept = kept_lines(docs, similarity, key, text).groupBy(key).agg(F.collect_set("n").alias("__kept"))
    # Columns of their own, so that a text is split once and its lines are looked at once.
    rows = docs.join(kept, key, "left").withColumn("__lines", F.split(F.col(text), "\n"))
    lines, stay = F.col("__lines"), F.col("__stay")
    known = F.coalesce(F.col("__kept"), F.array().cast("array<int>"))
    left = F.filter(lines, lambda x, i: F.array_contains(known, i) | ~F.regexp_like(x, F.lit(r"\S")))
    rows = rows.withColumn("__stay", F.when(F.col(key).isNull(), lines).otherwise(left))
    return rows.select(
        *[F.array_join(stay, "\n").alias(text) if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(stay), F.lit(0)).cast("long").alias("n_kept"),
    )


def dedupe(docs: DataFrame, similarity=0.8, key="doc_id", text="text") -> DataFrame:
    """Rows (key, text, n_lines, n_kept): texts without repeated lines, line breaks and spacing as they were."""
    if docs.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
        return without_repeats(docs.select(key, text), similarity, key, text)
    rows = docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("body"))
    # Row numbers are given once, as the table is written.
    place = F.when(F.col("id").isNotNull(), F.struct("id", "row"))
    rows = staged(rows.select(place.alias("place"), "id", "body"), "line-documents")
    found = without_repeats(rows, similarity, "place", "body")
    return found.select(F.col("id").alias(key), F.col("body").alias(text), "n_lines", "n_kept")
