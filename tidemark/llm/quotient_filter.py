"""Counting quotient filters over packed word-id n-grams.

Ids are packed into two halves of `half` bits and permuted by a Feistel network, which can be undone. The upper bits of
the permuted number are its quotient, all others its remainder, so nothing is lost: a filter gives back every n-gram with
its exact count. A filter is kept sorted: per quotient the number of its remainders in unary, the remainders in as few
whole bytes as hold them, and the counters in a byte each, with the large ones at the end. Sorted filters are merged.

Numbers of up to 64 bits are held in one array, longer ones (more than 2^21 ids) in two.
"""

import numpy as np

ROUNDS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
BIG = 255


def _scramble(x, factor, bits):
    y = x * np.uint64(factor)
    y ^= y >> np.uint64(29)
    y *= np.uint64(0xFF51AFD7ED558CCD)
    return (y >> np.uint64(32) ^ y) & np.uint64((1 << bits) - 1)


class Packing:
    """Packs up to `words` ids (1 to `largest`; 0 for none) into numbers (high, low); low is None if high holds all."""

    def __init__(self, largest: int, words: int = 3):
        self.bits = max(1, int(largest).bit_length())
        self.words = words
        self.half = max(8, -(-self.bits * words // 2))
        if self.half > 62:
            raise ValueError("too many ids for two halves of 62 bits")
        self.single = 2 * self.half <= 64
        self.high_bits = 2 * self.half if self.single else self.half
        self.low_bits = 0 if self.single else self.half

    def pack(self, ids):
        """`ids`: one array per word."""
        left = np.zeros(len(ids[0]), np.uint64)
        right = np.zeros(len(ids[0]), np.uint64)
        at = 0
        for column in ids:  # the first word lies lowest; one may lie across the halves
            column = column.astype(np.uint64)
            if at < self.half:
                right |= (column << np.uint64(at)) & np.uint64((1 << self.half) - 1)
                if at + self.bits > self.half:
                    left |= column >> np.uint64(self.half - at)
            else:
                left |= column << np.uint64(at - self.half)
            at += self.bits
        for i, factor in enumerate(ROUNDS):
            if i % 2:
                right = right ^ _scramble(left, factor, self.half)
            else:
                left = left ^ _scramble(right, factor, self.half)
        if self.single:
            return left << np.uint64(self.half) | right, None
        return left, right

    def unpack(self, high, low):
        mask = np.uint64((1 << self.half) - 1)
        left, right = (high >> np.uint64(self.half), high & mask) if self.single else (high, low)
        for i, factor in reversed(list(enumerate(ROUNDS))):
            if i % 2:
                right = right ^ _scramble(left, factor, self.half)
            else:
                left = left ^ _scramble(right, factor, self.half)
        ids, at, own = [], 0, np.uint64((1 << self.bits) - 1)
        for _ in range(self.words):
            if at >= self.half:
                x = left >> np.uint64(at - self.half)
            else:
                x = right >> np.uint64(at)
                if at + self.bits > self.half:
                    x = x | left << np.uint64(self.half - at)
            ids.append((x & own).astype(np.int64))
            at += self.bits
        return ids


def counted(high, low, counts=None):
    """Sorted distinct numbers with their counts; runs that are sorted already are merged."""
    if counts is None:
        counts = np.ones(len(high), np.int64)
    if low is None:
        order = np.argsort(high, kind="stable")
    else:
        order = np.lexsort((low, high))
        low = low[order]
    high = high[order]
    new = np.ones(len(high), bool)
    if len(high):
        new[1:] = high[1:] != high[:-1] if low is None else (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)
    return high[at], None if low is None else low[at], sums


def _in_bytes(numbers, bits):
    width = -(-bits // 8)
    return np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(), width


def _from_bytes(data, width, n):
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


class Filter:
    """Sorted distinct numbers whose uppermost `prefix` bits are `segment`, with counts."""

    def __init__(self, packing: Packing, prefix: int, segment: int, high, low, counts):
        self.packing, self.prefix, self.segment = packing, prefix, segment
        self.high, self.low, self.counts = high, low, counts

    def to_bytes(self) -> bytes:
        n = len(self.high)
        left = self.packing.high_bits - self.prefix
        quotient_bits = min(left, max(1, n.bit_length()))
        remainder_bits = left - quotient_bits
        own = self.high & np.uint64((1 << left) - 1)
        quotients = (own >> np.uint64(remainder_bits)).astype(np.int64)
        unary = np.zeros(n + (1 << quotient_bits), np.uint8)
        unary[np.arange(n) + quotients] = 1
        rest, _ = _in_bytes(own & np.uint64((1 << remainder_bits) - 1), remainder_bits)
        low = b"" if self.low is None else _in_bytes(self.low, self.packing.low_bits)[0]
        large = self.counts >= BIG
        small = np.where(large, BIG, self.counts).astype(np.uint8)
        head = np.array([n, quotient_bits], "<i8").tobytes()
        return head + np.packbits(unary).tobytes() + rest + low + small.tobytes() + self.counts[large].astype("<i8").tobytes()

    @classmethod
    def from_bytes(cls, packing: Packing, prefix: int, segment: int, data: bytes):
        n, quotient_bits = np.frombuffer(data, "<i8", 2).tolist()
        remainder_bits = packing.high_bits - prefix - quotient_bits
        at = 16

        def take(size):
            nonlocal at
            at += size
            return data[at - size : at]

        slots = n + (1 << quotient_bits)
        unary = np.unpackbits(np.frombuffer(take(-(-slots // 8)), np.uint8), count=slots)
        quotients = (np.flatnonzero(unary) - np.arange(n)).astype(np.uint64)
        width = -(-remainder_bits // 8)
        high = quotients << np.uint64(remainder_bits) | _from_bytes(take(n * width), width, n)
        if prefix:
            high |= np.uint64(segment << (packing.high_bits - prefix))
        low = None
        if packing.low_bits:
            width = -(-packing.low_bits // 8)
            low = _from_bytes(take(n * width), width, n)
        counts = np.frombuffer(take(n), np.uint8).astype(np.int64)
        large = np.flatnonzero(counts == BIG)
        counts[large] = np.frombuffer(take(8 * len(large)), "<i8")
        return cls(packing, prefix, segment, high, low, counts)

    def merged(self, other):
        """One filter of both; counts of the same number are added."""
        low = None if self.low is None else np.concatenate([self.low, other.low])
        both = counted(np.concatenate([self.high, other.high]), low, np.concatenate([self.counts, other.counts]))
        return Filter(self.packing, self.prefix, self.segment, *both)


def cut(packing: Packing, prefix: int, high, low, counts):
    """Filters of sorted numbers by their uppermost `prefix` bits; only those that hold something."""
    if not prefix:
        if len(high):
            yield Filter(packing, 0, 0, high, low, counts)
        return
    segments = (high >> np.uint64(packing.high_bits - prefix)).astype(np.int64)
    starts = np.flatnonzero(np.diff(segments, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(high)]):
        yield Filter(packing, prefix, int(segments[a]), high[a:b], None if low is None else low[a:b], counts[a:b])
