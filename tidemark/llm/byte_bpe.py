"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, the others merged.

Short pieces of one size are merged together, one pair of each piece in a round; long ones with a heap over linked bytes.

`encode_decode` gives one row per document: its ids as bytes (little-endian unsigned 32-bit), and the decoded bytes.
Null and empty texts have no ids and decode to nothing. Repeated rows give repeated results. Other columns are kept
out of the result except the key. An empty table gives an empty result.
"""

import base64
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import PieceStore
from tidemark.llm.common import slices

KEYS_PER_BUCKET = 4
#: Bytes of a piece up to which it is merged with others of its size, and pieces worked on at a time.
SHORT = 32
TOGETHER = 20_000
_STORES = {}


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """A minimal perfect hash: every known key has a slot of its own in 0..n-1, and no slot is free.

    Keys are dealt into buckets; large buckets look first for a displacement that puts their keys into free slots,
    buckets of one key take what is left and note the slot itself. An unknown key gets some slot, so the caller compares.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // KEYS_PER_BUCKET)
        h = self.digests(keys)
        bucket = self._buckets(h)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        self.key_at = np.full(self.n, -1, np.int64)
        sizes = np.diff(starts)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[starts[b] : starts[b + 1]]
            if len(own) < 2:
                break
            offset, width = 0, 32
            while True:
                tries = np.arange(offset, offset + width)
                slots = self._slots(h[own][:, None], tries[None, :])
                good = (self.key_at[slots] < 0).all(0)
                ranked = np.sort(slots, 0)
                good &= (ranked[1:] != ranked[:-1]).all(0)
                if good.any():
                    at = int(np.argmax(good))
                    self.shift[b] = tries[at]
                    self.key_at[slots[:, at]] = own
                    break
                offset, width = offset + width, min(4096, 2 * width)
        free = iter(np.flatnonzero(self.key_at < 0))
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            self.key_at[slot] = order[starts[b]]
            self.shift[b] = -slot - 1

    @staticmethod
    def digests(keys) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _buckets(self, h):
        return (h % np.uint64(self.buckets)).astype(np.int64)

    def _slots(self, h, shift):
        """The slot that a displacement gives to a key: a new hash for each displacement."""
        x = h ^ (shift.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(self.n)).astype(np.int64)

    def candidates(self, keys) -> np.ndarray:
        """For each key, the number of the only known key that it can be."""
        h = self.digests(keys)
        shift = self.shift[self._buckets(h)]
        slot = np.where(shift < 0, -shift - 1, self._slots(h, np.maximum(shift, 0)))
        return self.key_at[slot]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece: of all neighbouring parts the pair of lowest rank, leftmost first, is joined again and again."""
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is joined to its left neighbour
    before = list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, mid, end = heappop(heap)
        if after[i] != mid or mid >= n or after[mid] != end:
            continue
        after[i], after[mid] = end, 0
        if end < n:
            before[end] = i
            far = after[end]
            if (r := get(piece[i:far])) is not None:
                heappush(heap, (r, i, end, far))
        left = before[i]
        if left >= 0 and (r := get(piece[left:end])) is not None:
            heappush(heap, (r, left, i, end))
    ids, i = [], 0
    while i < n:
        end = after[i]
        ids.append(ranks[piece[i:end]])
        i = end
    return ids


class Merger:
    """Merges many pieces of one size at a time, with the same ids as `merge`."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values()) + 1  # the rank of two parts that make no token
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        joins = {}
        for token, rank in ranks.items():
            for at in range(1, len(token)):
                left, right = ranks.get(token[:at]), ranks.get(token[at:])
                if left is not None and right is not None:
                    joins[left * self.none + right] = rank
        self.keys = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in self.keys.tolist()], np.int64)

    def _ranks(self, left, right):
        """The rank of what two parts make, by their ids."""
        if not len(self.keys):
            return np.full(left.shape, self.none)
        key = left * self.none + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], self.none)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces of one size, as bytes. In a round the leftmost pair of lowest rank of every piece is joined."""
        out = [b""] * len(pieces)
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)].reshape(len(pieces), -1)
        place = np.arange(len(pieces))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while len(place):
            n, size = ids.shape
            each = np.arange(n)
            if size > 1:
                at = ranks.argmin(1)
                least = ranks[each, at]
                done = least == self.none
            else:
                done = np.ones(n, bool)
            if done.any():
                raw, width = ids[done].astype("<u4").tobytes(), 4 * size
                for i, to in enumerate(place[done].tolist()):
                    out[to] = raw[i * width : (i + 1) * width]
                go = ~done
                place, ids, ranks = place[go], ids[go], ranks[go]
                if not len(place):
                    break
                at, least, each = at[go], least[go], np.arange(len(place))
            stay = np.ones(ids.shape, bool)
            stay[each, at + 1] = False
            ids[each, at] = least
            ids = ids[stay].reshape(len(place), -1)
            stay = np.ones(ranks.shape, bool)
            stay[each, at] = False
            ranks = ranks[stay].reshape(len(place), -1)
            rows = np.flatnonzero(at < size - 2)
            ranks[rows, at[rows]] = self._ranks(ids[rows, at[rows]], ids[rows, at[rows] + 1])
            rows = np.flatnonzero(at > 0)
            ranks[rows, at[rows] - 1] = self._ranks(ids[rows, at[rows] - 1], ids[rows, at[rows]])
        return out


class Encoder:
    def __init__(self, tokens: list[bytes], hashed: PerfectHash, pattern: str):
        self.tokens, self.hashed = tokens, hashed
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self.find = regex.compile(pattern).findall
        self.packed = [i.to_bytes(4, "little") for i in range(len(tokens))]
        self.merger = Merger(self.ranks)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        cut = [[t] if t.isalpha() or t[1:].isalpha() and t[0] == " " else self.find(t) for t in texts]
        distinct = list({p for parts in cut for p in parts})
        raw = [p.encode("utf-8", "replace") for p in distinct]
        ids, sized = {}, {}
        if raw:
            for text, piece, at in zip(distinct, raw, self.hashed.candidates(raw).tolist()):
                if self.tokens[at] == piece:
                    ids[text] = self.packed[at]
                elif len(piece) <= SHORT:
                    sized.setdefault(len(piece), ([], []))[0].append(text)
                    sized[len(piece)][1].append(piece)
                else:
                    ids[text] = b"".join([self.packed[i] for i in merge(piece, self.ranks)])
        for same, pieces in sized.values():
            for start in range(0, len(same), TOGETHER):
                ids.update(zip(same[start : start + TOGETHER], self.merger.merge(pieces[start : start + TOGETHER])))
        return [b"".join([ids[p] for p in parts]) for parts in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_decode(docs: DataFrame, vocabulary_path: str, pattern: str, key="doc_id", text="text") -> DataFrame:
    """Per document: the key, `ids` (binary) and `decoded` (binary).

    The hash is built once from the vocabulary file and sent to the executors; its size is that of the file.
    """
    tokens = read_ranks(vocabulary_path)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))

    def run(batches):
        store_key = (vocabulary_path, pattern)
        if store_key not in _STORES:
            encoder = Encoder(*shared.value, pattern)
            _STORES[store_key] = encoder, PieceStore(encoder.encode_many)
        encoder, store = _STORES[store_key]
        for batch in batches:
            for part in slices(batch):
                ids = store.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.binary())],
                    ["key", "ids", "decoded"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key="doc_id") -> DataFrame:
    return encoded.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
