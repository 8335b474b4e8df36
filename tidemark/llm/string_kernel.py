"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words sums over three-letter subsequences within a span, weighted down by their spread, so gapped
spellings and inserted characters stay near. A sentence meets a landmark as well as its best word does. What stands
between white space is taken joined and also split at its punctuation. Of a word of more than `LONG` letters (a list
without spaces, a script without spaces) every stretch of a landmark's length counts as a word too. Nyström's map
makes these numbers features; a linear machine is trained on labelled sentences: those of clean documents, and of each
toxic document the sentence that scores highest. A document is as toxic as its worst sentence.

Learning uses a bounded sample of labelled documents (`sample` of each label). Null and empty texts score as a sentence
without any landmark. A landmark has at most `MARK` letters; texts are scored whole. Repeated rows count each. With no labelled toxic or no clean text, every score is 0. Other columns
are left out.
"""

import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sampled_texts, slices, staged

SPAN = 5
DECAY = 0.6
#: Kernel values below this count as no likeness.
NEAR = 0.5
#: Words of more letters are also met stretch by stretch.
LONG = 24
#: Letters of a landmark at most.
MARK = 64
#: Letters that a stretch may have beyond its landmark, so that inserted ones stay inside.
_SLACK = (0, 2)
#: Letters of a long word that are worked on at a time.
_PART = 8192
_SENTENCES = re.compile(r"[.!?]\s|[\n\r]+")
_SINGLES = re.compile(r"(?<!\w)(?:[^\W\d_][\W_]{1,3}){3,}[^\W\d_](?!\w)")
_OTHER = re.compile(r"[\W\d_]+")
#: The places of three letters within a span, and the weight of each.
_PLACES = [(j, k, DECAY**k) for j, k in itertools.combinations(range(1, SPAN), 2)]


def words(sentence: str) -> set[str]:
    """Letters only, lower case, joined over punctuation and split at it; runs of single letters also as one word."""
    low = sentence.lower()
    found = set()
    for w in low.split():
        if w.isalpha():
            found.add(w)
        else:
            parts = _OTHER.split(w)
            found.update(parts)
            found.add("".join(parts))
    found.update(_OTHER.sub("", m) for m in _SINGLES.findall(low))
    return {w for w in found if len(w) >= 3}


def subsequences(word: str) -> dict[str, float]:
    out = {}
    n = len(word)
    for i in range(n - 2):
        for j, k, weight in _PLACES:
            if i + k < n:
                s = word[i] + word[i + j] + word[i + k]
                out[s] = out.get(s, 0.0) + weight
    return out


class Kernel:
    """Normalised kernel values of a word against all landmarks."""

    def __init__(self, landmarks: list[str], limit=500_000):
        self.landmarks, self.limit, self.known, self.table = landmarks, limit, {}, {}
        for i, mark in enumerate(landmarks):
            own = subsequences(mark)
            norm = math.sqrt(sum(v * v for v in own.values()))
            for s, v in own.items():
                self.table.setdefault(s, np.zeros(len(landmarks)))[i] = v / norm
        self.by_length = {}
        for i, mark in enumerate(landmarks):
            self.by_length.setdefault(len(mark), []).append(i)
        gram = np.array([self.raw(m) for m in landmarks]).reshape(len(landmarks), len(landmarks))
        values, vectors = np.linalg.eigh(gram)
        self.whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T

    def raw(self, word):
        own = subsequences(word)
        total = np.zeros(len(self.landmarks))
        for s, v in own.items():
            if (row := self.table.get(s)) is not None:
                total += v * row
        return total / math.sqrt(sum(v * v for v in own.values()))

    def near(self, word):
        """The values that are `NEAR` at least, others as 0, or None if there is none.

        A landmark's vector has length 1, so no value is above the length of the part of the word's vector that lies on
        subsequences of landmarks. Most words are done with that.
        """
        own = subsequences(word)
        known = self.table.keys()
        shared = [v for s, v in own.items() if s in known]
        if sum([v * v for v in shared]) < (NEAR * NEAR - 1e-9) * sum([v * v for v in own.values()]):
            return None
        value = self.raw(word)
        return np.where(value >= NEAR, value, 0.0) if value.max(initial=0) >= NEAR else None

    def stretches(self, word) -> set[str]:
        """Of the stretches as long as a landmark (and `_SLACK`) those that may be near it, none missing."""
        found, reach = set(), max(self.by_length, default=0) + max(_SLACK)
        for start in range(0, len(word), _PART):
            part = word[start : start + _PART + reach]
            n, spans = len(part), {}
            for j, k, weight in _PLACES:
                sums = spans.setdefault(k, np.zeros((n + 1, len(self.landmarks))))
                for i in range(n - k):
                    if (row := self.table.get(part[i] + part[i + j] + part[i + k])) is not None:
                        sums[i + 1] += weight * row
            for sums in spans.values():
                np.cumsum(sums, axis=0, out=sums)
            for length, marks in self.by_length.items():
                for size in {length + more for more in _SLACK}:
                    if size > n:
                        continue
                    at = np.arange(n - size + 1)
                    total = sum(s[at + max(0, size - k)][:, marks] - s[at][:, marks] for k, s in spans.items())
                    # Equal subsequences only make a stretch's norm larger than this.
                    norm = math.sqrt(sum(w * w * max(0, size - k) for _, k, w in _PLACES))
                    for i in np.flatnonzero(total.max(1) >= NEAR * norm - 1e-9):
                        found.add(part[i : i + size])
        return found

    def __call__(self, word):
        if len(word) <= LONG:
            return self.met(word)
        near = [v for w in {word, *self.stretches(word)} if (v := self.met(w)) is not None]
        return np.max(near, axis=0) if near else None

    def met(self, word):
        found = self.known.get(word, False)
        if found is False:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.near(word)
            if len(word) <= MARK:
                self.known[word] = found
        return found

    def sentences(self, text: str | None) -> np.ndarray:
        """One row per sentence that meets a landmark."""
        out = []
        for sentence in _SENTENCES.split(text or ""):
            near = [v for w in words(sentence) if (v := self(w)) is not None]
            if near:
                out.append(np.max(near, axis=0))
        return np.array(out).reshape(len(out), len(self.landmarks))


def landmarks(sample: DataFrame, number=64) -> list[str]:
    """Words that most distinguish toxic from clean texts of the sample."""

    def run(batches):
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = sorted(w for w in set().union(*map(words, _SENTENCES.split(text or ""))) if len(w) <= MARK)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([label] * len(found), pa.int32())], ["word", "label"])

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return []
    counted = sample.mapInArrow(run, "word string, label int").groupBy("word").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("all")
    )
    clean = (F.col("all") - F.col("toxic") + 0.5) / (sizes[0] + 1)
    gain = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (sizes[1] + 1) / clean)
    marked = counted.where("toxic >= 2").select("word", gain.alias("gain")).where("gain > 0")
    return [r["word"] for r in marked.orderBy(F.desc("gain"), "word").limit(number).collect()]


def fit(docs: DataFrame, labels: DataFrame, sample=4000, number=64, rounds=5, cost=1.0, key="doc_id", text="text"):
    """A model from the texts of `docs` that `labels` (key, label 0 or 1) names, or None if one label is missing.

    At most `sample` texts of each label are used. They are drawn on ids; only their texts are fetched.
    """
    known = labels.where("label in (0, 1)").select(F.col(key).alias("key"), F.col("label").cast("int").alias("label"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    some = staged(sampled_texts(texts, known, "label", sample).select("text", "label"), "toxicity-sample")
    marks = landmarks(some, number)
    if not marks:
        return None

    def run(batches):
        kernel = Kernel(marks)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kernel.sentences(text).astype("<f4").tobytes()], pa.binary()), pa.array([label], pa.int32())], ["x", "label"]
                )

    rows = some.mapInArrow(run, "x binary, label int").toArrow()  # at most 2 × sample texts
    kernel = Kernel(marks)
    bags = [np.frombuffer(x, "<f4").reshape(-1, len(marks)) @ kernel.whiten for x in rows.column("x").to_pylist()]
    labels = np.array(rows.column("label").to_pylist())
    empty = np.zeros((1, len(marks)))
    clean = np.vstack([empty, *[b for b, y in zip(bags, labels) if not y]])
    toxic = [b if len(b) else empty for b, y in zip(bags, labels) if y]
    best = [b[np.argmax((b * b).sum(1))] for b in toxic]
    weights = None
    for _ in range(rounds):
        weights = svm(np.vstack([clean, best]), np.r_[-np.ones(len(clean)), np.ones(len(best))], cost)
        best = [b[np.argmax(b @ weights[:-1])] for b in toxic]
    margins = np.array([margin(b, weights) for b in bags])
    return marks, weights, platt(margins, labels)


def margin(bag, weights) -> float:
    return float(max(bag @ weights[:-1], default=0.0) if len(bag) else 0.0) + float(weights[-1])


def svm(x, y, cost, steps=600):
    """Squared hinge loss by accelerated gradient steps, both labels weighing alike."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    size = 1 / (1e-4 / cost + 2 * np.linalg.norm(x.T @ (x * share[:, None]), 2))
    w = ahead = np.zeros(x.shape[1])
    for i in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - size * (1e-4 / cost * ahead - 2 * x.T @ (share * slack * y))
        w, ahead = new, new + i / (i + 3) * (new - w)
    return w


def platt(margins, labels, steps=200):
    """(slope, shift) of the logistic curve through margins and labels, by Newton's steps."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - labels) * margins).sum() + 1e-2 * a, (p - labels).sum()])
        r = p * (1 - p) + 1e-9
        h = np.array([[(r * margins**2).sum() + 1e-2, (r * margins).sum()], [(r * margins).sum(), r.sum() + 1e-6]])
        da, db = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - da, b - db
    return a, b


def score(docs: DataFrame, model, key="doc_id", text="text") -> DataFrame:
    """Rows (key, score)."""
    if model is None:
        return docs.select(key, F.lit(0.0).alias("score"))
    marks, weights, (a, b) = model

    def run(batches):
        kernel = Kernel(marks)
        for batch in batches:
            for part in slices(batch):
                m = np.array([margin(kernel.sentences(t) @ kernel.whiten, weights) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(1 / (1 + np.exp(-np.clip(a * m + b, -30, 30))))], ["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
