"""Personal data by a semi-Markov conditional random field beside fixed patterns.

Patterns give the base spans (email, ip, card, phone). Segments of up to `LONGEST` tokens are scored by features of the
whole span, and the segmentation of highest score is found by dynamic programming over boundaries and types together.
The field is trained by likelihood on a bounded sample of windows around digits and signs of addresses, labelled by the
patterns, with features that do not name the patterns, so it also takes spans that these miss. Spans it finds that touch
no base span are added; base spans always stay.

All of a text is decoded. What is skipped are segments whose kind (signs of an address, digits, groups of digits) can't
score above outside whatever their other features are, by the weights at hand: the result is that of decoding every
segment of the whole text, as tests compare. Features know an address by its sign: `jo at ex dot org` looks to the field
like any other words, so it is not found.

Null and empty texts have no spans. Equal rows give equal results. Without any labelled span nothing is added. An empty
table gives an empty result. Extra columns are left out.
"""

import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate, islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

KINDS = ["email", "ip", "card", "phone"]
LONGEST = 15
WINDOWS = 1500
#: Tokens of a training window; longer ones are not drawn for training. Decoding takes texts of any length.
TRAINED_TOKENS = 60

_LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A start within a run of digits can match only if the run's start does.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TOKENS = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_TRIGGER = re.compile(r"@|[(\[]\s?at\s?[)\]]|[0-9][0-9().\x20-]{5,}[0-9]", re.I)
#: Where a segment may differ from plain words: at a sign of an address, at digits, or (beyond ASCII) at what may be one.
_ANCHOR = re.compile(r"[0-9@(\[\x80-\U0010ffff]")
_RUN = re.compile(r"[0-9]+")
_AT = re.compile(r"@|[(\[]\s?[aA][tT]\s?[)\]]")
#: As many tokens as lie between the anchors of segments that can overlap.
_GAP = re.compile(r"\s*(?:(?:[A-Za-z]+|[^\sA-Za-z0-9])\s*){0,%d}" % (2 * LONGEST - 2))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind and start."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = "".join(_DIGITS.findall(m.group()))
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.findall(m.group())) <= 15:
                found.append((3, *m.span()))
    return found


def windows(text: str, around=24) -> list[tuple[int, int]]:
    """Stretches of text around triggers to learn from, cut where no address or number goes on; near ones are one."""
    out = []
    for m in _TRIGGER.finditer(text):
        start, end = max(0, m.start() - around), min(len(text), m.end() + around)
        while start and (text[start - 1] in _LOCAL or text[start - 1] == "@"):
            start -= 1
        while end < len(text) and (text[end] in _LOCAL or text[end] == "@"):
            end += 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@lru_cache(200_000)
def features(span: str) -> tuple[float, ...]:
    digits = "".join(_DIGITS.findall(span))
    d, n = len(digits), len(span)
    letters = sum(map(str.isalpha, span))
    groups = re.findall(r"[0-9]+", span)
    at = len(re.findall(r"@|[(\[]\s?at\s?[)\]]", span, re.I))
    return (
        1.0, at == 1, at > 1, at == 1 and span[0].isalnum() and span[-1].isalnum() and "." in span.split("@")[-1],
        " " in span and at > 0, letters > 0, letters == 0 and d > 0, span[0] == "+",
        8 <= d <= 15 and letters == 0, 16 <= d <= 19 and letters == 0 and luhn(digits), 16 <= d <= 19,
        d > 19, d < 8, len(groups) == 4 and span.count(".") == 3 and letters == 0,
        all(len(g) < 4 and int(g) < 256 for g in groups) and len(groups) == 4, span.count(".") == 3,
        span[0].isdigit(), span[-1].isdigit(), not span[-1].isalnum(), not span[0].isalnum() and span[0] != "+",
        "  " in span or "\n" in span, min(n, 40) / 40,
    )


def lattice(text: str, of=features):
    """Token bounds and, per end and length, the features of the segment."""
    tokens = [m.span() for m in _TOKENS.finditer(text)]
    segments = []
    for j in range(len(tokens)):
        for i in range(max(0, j - LONGEST + 1), j + 1):
            segments.append((i, j + 1, of(text[tokens[i][0] : tokens[j][1]])))
    return tokens, segments


def _packed(rows) -> np.ndarray:
    """Features in a byte each: all are 0 or 1 but the last, which counts fortieths."""
    return (np.array(rows) * ([1] * (len(rows[0]) - 1) + [40])).round().astype(np.uint8)


def _unpacked(packed) -> np.ndarray:
    rows = packed.astype(float)
    rows[:, -1] /= 40
    return rows


def _potentials(segments, weights):
    return np.array([s[2] for s in segments]) @ weights.T if segments else np.zeros((0, len(KINDS)))


def decode(text: str, weights) -> list[tuple[int, int, int]]:
    """The best segmentation's spans (kind number, start, end)."""
    tokens, segments = lattice(text)
    scores = _potentials(segments, weights)
    best = np.full(len(tokens) + 1, -np.inf)
    best[0], back = 0.0, [None] * (len(tokens) + 1)
    top, kind = (scores.max(1), scores.argmax(1)) if len(scores) else ([], [])
    for (i, j, _), s, k in zip(segments, top, kind):
        if best[i] + s > best[j]:
            best[j], back[j] = best[i] + s, (i, int(k))
        if j == i + 1 and best[i] >= best[j]:  # outside of any span
            best[j], back[j] = best[i], (i, None)
    out, j = [], len(tokens)
    while j:
        i, k = back[j]
        if k is not None:
            out.append((k, tokens[i][0], tokens[j - 1][1]))
        j = i
    return out[::-1]


def _sizes(digits: int) -> int:
    return 0 if not digits else 1 if digits < 8 else 2 if digits < 16 else 3 if digits < 20 else 4


def _most(w, at: int, size: int, four: bool, words: bool, dotted: bool) -> float:
    """What a segment can score at most: by its signs of an address (2 for more), class of digits, and whether it has
    four groups of digits, letters, and three dots."""
    up = lambda *columns: np.maximum(0, np.max([w[:, c] for c in columns], axis=0))
    fixed = w[:, 0] + (0, w[:, 1], w[:, 2])[at] + (w[:, 12], w[:, 12], 0, w[:, 10], w[:, 11])[size]
    fixed = fixed + (w[:, 15] if dotted else 0) + (w[:, 5] if words else w[:, 6] if size else 0)
    free = up(20) + up(21) + (up(7, 16, 19) + up(17, 18) if size else up(7, 19) + up(18))
    free = free + (up(4) if at else 0) + (up(3) if at == 1 else 0) + (up(14) if four else 0)
    if not words:
        free = free + (w[:, 8] if size == 2 else up(9) if size == 3 else 0) + (w[:, 13] if four and dotted else 0)
    return float((fixed + free).max())


def _before(text: str, end: int, count: int) -> list[tuple[int, int]]:
    """The last `count` tokens before a token bound."""
    reach = 16 * count
    while True:
        start = max(0, end - reach)
        found = [m.span() for m in _TOKENS.finditer(text, start, end)]
        if start == 0 or len(found) > count:  # the first one may be cut
            return found[-count:]
        reach *= 4


def _anchors(text: str):
    """(kind, start, end) of signs of an address, runs of digits, and odd digits (other than 0 to 9)."""
    at = 0
    while (m := _ANCHOR.search(text, at)) is not None:
        start, at = m.span()
        c = m.group()
        if c >= "\x80":
            if c.isdigit():
                yield "odd", start, at
        elif c >= "0" and c <= "9":
            at = _RUN.match(text, start).end()
            yield "run", start, at
        elif (m := _AT.match(text, start)) is not None:
            at = m.end()
            yield "at", start, at


class Field:
    """Decoding of whole texts with given weights (none: base spans only)."""

    def __init__(self, weights):
        self.weights = weights
        if weights is not None:
            every = product(range(3), range(5), (False, True), (False, True), (False, True))
            # Rounding is left to the safe side.
            self.possible = {kind: _most(weights, *kind) > -1e-9 for kind in every}
            self.everywhere = any(ok for kind, ok in self.possible.items() if kind[:3] == (0, 0, False))

    def spans(self, text: str):
        """(base spans, base and added spans), each (kind number, start, end)."""
        base = base_spans(text)
        covered = []
        for s, e in sorted((s, e) for _, s, e in base):
            if covered and s <= covered[-1][1]:
                covered[-1] = (covered[-1][0], max(e, covered[-1][1]))
            else:
                covered.append((s, e))
        ends = [e for _, e in covered]
        added = []
        for k, s, e in self.decoded(text):
            at = bisect_left(ends, s + 1)  # the first stretch that ends after the span's start
            if at == len(covered) or covered[at][0] >= e:
                added.append((k, s, e))
        return base, sorted(base + added)

    def decoded(self, text: str) -> list[tuple[int, int, int]]:
        """The spans of `decode` for the whole text."""
        if self.weights is None:
            return []
        if self.everywhere:
            return decode(text, self.weights)
        out, group, reach = [], [], -1
        for anchor in _anchors(text):
            if group and anchor[1] > reach:
                out += self._stretch(text, group)
                group = []
            group.append(anchor)
            reach = _GAP.match(text, anchor[2]).end()
        return out + self._stretch(text, group) if group else out

    def _stretch(self, text, anchors):
        """The spans that hold one of these anchors; no other anchor is near."""
        signs = [(s, e) for kind, s, e in anchors if kind == "at"]
        odd = [s for kind, s, _ in anchors if kind == "odd"]
        runs = [e - s for kind, s, e in anchors if kind == "run"]
        size, four = _sizes(sum(runs)), len(runs) > 3
        kinds = (k for k, ok in self.possible.items() if ok and k[0] <= len(signs) and k[1] <= size and k[2] <= four)
        if not odd and next(kinds, None) is None:
            return []
        first, last = anchors[0][1], anchors[-1][2]
        tokens = _before(text, first, LONGEST - 1) if first else []
        tokens += [m.span() for m in _TOKENS.finditer(text, first, last)]
        tokens += [m.span() for m in islice(_TOKENS.finditer(text, last), LONGEST - 1)]
        n = len(tokens)
        numeric = ["0" <= text[s] <= "9" for s, _ in tokens]
        digits = [0, *accumulate((e - s) * x for (s, e), x in zip(tokens, numeric))]
        groups = [0, *accumulate(map(int, numeric))]
        others, starts, ends = set(odd), {s for s, _ in signs}, {e for _, e in signs}
        strange = [0, *accumulate(int(s in others) for s, _ in tokens)]
        begun = [0, *accumulate(int(s in starts) for s, _ in tokens)]
        ended = [0, *accumulate(int(e in ends) for _, e in tokens)]
        words = [0, *accumulate(int(text[s].isalpha()) for s, _ in tokens)]
        dots = [0, *accumulate(int(text[s] == ".") for s, _ in tokens)]
        segments = []
        for j in range(n):
            for i in range(max(0, j - LONGEST + 1), j + 1):
                kind = (
                    min(2, max(0, ended[j + 1] - begun[i])), _sizes(digits[j + 1] - digits[i]), groups[j + 1] - groups[i] == 4,
                    words[j + 1] > words[i], dots[j + 1] - dots[i] == 3,
                )
                if self.possible[kind] or strange[j + 1] > strange[i]:
                    segments.append((i, j + 1, features(text[tokens[i][0] : tokens[j][1]])))
        scores = _potentials(segments, self.weights)
        found = [(i, j, s, int(k)) for (i, j, _), s, k in zip(segments, scores.max(1).tolist(), scores.argmax(1)) if s > 0] if segments else []
        best, back, at = [0.0] * (n + 1), [None] * (n + 1), 0
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            while at < len(found) and found[at][1] == j:
                i, _, s, k = found[at]
                if best[i] + s > best[j]:
                    best[j], back[j] = best[i] + s, (i, k)
                at += 1
        out, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                out.append((k, tokens[i][0], tokens[j - 1][1]))
                j = i
        return out[::-1]


def _gradient(window, weights):
    """Observed less expected features of one labelled window."""
    n, at, packed, gold = window
    matrix, segments = _unpacked(packed), at.tolist()
    scores = matrix @ weights.T
    forward = np.full(n + 1, -np.inf)
    backward = np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0.0
    total = np.logaddexp.reduce(scores, axis=1)
    for (i, j), s in zip(segments, total):
        forward[j] = np.logaddexp(forward[j], forward[i] + s)
        if j == i + 1:
            forward[j] = np.logaddexp(forward[j], forward[i])
    for (i, j), s in sorted(zip(segments, total), key=lambda x: -x[0][0]):
        backward[i] = np.logaddexp(backward[i], s + backward[j])
        if j == i + 1:
            backward[i] = np.logaddexp(backward[i], backward[j])
    p = np.exp(forward[at[:, 0]][:, None] + scores + backward[at[:, 1]][:, None] - forward[n])
    return (gold - p).T @ matrix


def fit(labelled: list[tuple[str, list]], rounds=25, rate=0.5, ridge=1e-3):
    """Weights (kinds × features) from windows and their base spans.

    This runs on the driver, so windows are held in bytes and their features are not kept in the cache.
    """
    made = []
    for text, spans in labelled:
        tokens, segments = lattice(text, features.__wrapped__)
        if not segments or len(tokens) > TRAINED_TOKENS:
            continue
        known = {(s, e): k for k, s, e in spans}
        gold = np.zeros((len(segments), len(KINDS)), np.uint8)
        for at, (i, j, _) in enumerate(segments):
            if (k := known.get((tokens[i][0], tokens[j - 1][1]))) is not None:
                gold[at, k] = 1
        made.append((len(tokens), np.array([s[:2] for s in segments]), _packed([s[2] for s in segments]), gold))
    if not any(w[3].any() for w in made):
        return None
    weights = np.zeros((len(KINDS), len(features("0"))))
    weights[:, 0] = -2
    squares = np.full_like(weights, 1e-8)
    for _ in range(rounds):
        for start in range(0, len(made), 50):
            part = made[start : start + 50]
            g = sum(_gradient(w, weights) for w in part) / len(part) - ridge * weights
            squares += g * g
            weights += rate * g / np.sqrt(squares)
    return weights


def _apart(spans):
    """Leftmost spans that do not overlap, as training needs them."""
    out, end = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            out.append((k, s, e))
            end = e
    return out


def learned(docs: DataFrame, text="text"):
    """Weights from a bounded sample of windows, or None without any labelled span."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [t[s:e] for t in part.column("text").to_pylist() if t for s, e in windows(t)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["text"])

    cut = docs.select(F.col(text).alias("text")).mapInArrow(run, "text string")
    drawn = cut.where(F.length("text") <= 8 * TRAINED_TOKENS).distinct()
    sample = drawn.orderBy(F.xxhash64("text"), "text").limit(WINDOWS).collect()  # at most WINDOWS short windows
    return fit([(r["text"], _apart(base_spans(r["text"]))) for r in sample])


def find(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Rows (key, base, spans): arrays of (kind, start, end) by kind and start; `spans` holds added ones too."""
    shared = docs.sparkSession.sparkContext.broadcast(learned(docs, text))
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        field = Field(shared.value)
        for batch in batches:
            for part in slices(batch):
                found = [field.spans(t or "") for t in part.column("text").to_pylist()]
                columns = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], span) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], ["key", "base", "spans"])
        features.cache_clear()  # the worker goes on to other steps

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    spans = "array<struct<kind:int,start:long,end:long>>"
    return rows.mapInArrow(run, f"key {kind}, base {spans}, spans {spans}").withColumnRenamed("key", key)


def joined(spans):
    """`kind:start:end`, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_of(spans, kind: str):
    """How many spans are of a kind."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def redacted(text: str | None, spans) -> str | None:
    """The text with its spans (kind number, start, end) replaced by their kinds in brackets."""
    parts, end = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            parts += [text[end:s], f"[{KINDS[k]}]"]
        elif e <= end:
            continue
        end = e
    return text if not parts else "".join(parts) + text[end:]


def redact(docs: DataFrame, text="text") -> DataFrame:
    """The documents, all columns kept, with every span replaced by its kind in brackets. Each row has its own spans."""
    shared = docs.sparkSession.sparkContext.broadcast(learned(docs, text))

    def run(batches):
        field = Field(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for part in slices(batch, text):
                out = [t if not t else redacted(t, field.spans(t)[1]) for t in part.column(text).to_pylist()]
                yield part.set_column(at, text, pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)
