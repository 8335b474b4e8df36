"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of whole texts are standardised, mapped to cosines of random directions (a Gaussian kernel's approximation),
and fitted by normal equations that are summed over partitions. Isotonic regression on rows not used for the fit turns
fitted values into scores from 0 to 1.

Null and empty texts have statistics of zero and get a score as well. Repeated rows count each. Without labelled rows
every score is 0.5. Rows with a null label are not learned from. Other columns are left out.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, staged

FEATURES = 256
GROUPS = 16
BINS = 200


def statistics(text: str | None) -> list[float]:
    text = text or ""
    n = len(text)
    if not n:
        return [0.0] * 15
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    w, k = max(1, len(words)), max(1, len(lines))
    raw = text.encode("utf-8", "replace")
    points = np.frombuffer(raw, np.uint8)
    upper = int(((points >= 65) & (points <= 90)).sum())
    digit = int(((points >= 48) & (points <= 57)).sum())
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    count = np.bincount(points, minlength=256)
    part = count[count > 0] / len(points)
    packed = len(zlib.compress(raw, 1)) / len(raw)
    return [
        np.log1p(n), np.log1p(w), np.log1p(n / k), n / w, upper / n, digit / n, letters / n,
        (count[33] + count[63]) / w, (count[124] + count[60] + count[62] + count[123] + count[125]) / w,
        (count[46] + count[44]) / w, len(set(words)) / w, len(set(lines)) / k, packed,
        float(-(part * np.log2(part)).sum()), (count[35] + count[64] + count[47] + count[95] + count[37]) / w,
    ]


def measured(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Rows (key, s: array<double>)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [statistics(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(found, pa.list_(pa.float64()))], ["key", "s"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, s array<double>").withColumnRenamed("key", key)


def _matrix(column):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _mapped(s, model):
    z = np.clip((s - model["mean"]) / model["deviation"], -6, 6)
    waves = np.sqrt(2 / FEATURES) * np.cos(z @ model["lines"] + model["phases"])
    return np.hstack([waves, np.ones((len(s), 1))])


def _summed(frame: DataFrame, partial, width: int) -> np.ndarray:
    """The sum of one float array per partition, added up in two steps; one array per group reaches the driver."""

    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            total += partial(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(groups):
        total = np.zeros(width)
        for batch in groups:
            for value in batch.column("sums"):
                total += np.frombuffer(value.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = frame.mapInArrow(run, "sums binary").repartition(GROUPS)
    return sum((np.frombuffer(r["sums"]) for r in parts.mapInArrow(add, "sums binary").collect()), np.zeros(width))


def fit(labelled: DataFrame, ridge=1e-3, gamma=0.05, seed=11) -> dict | None:
    """A model from rows (key, s, label)."""
    rows = staged(labelled.where("label is not null").select("doc_id", "s", F.col("label").cast("double").alias("label")), "quality-rows")
    size = len(statistics(""))
    sums = _summed(rows.select("s"), lambda b: np.concatenate([[b.num_rows], *(lambda m: (m.sum(0), (m * m).sum(0)))(_matrix(b.column("s")))]), 1 + 2 * size)
    if not sums[0]:
        return None
    mean = sums[1 : 1 + size] / sums[0]
    deviation = np.sqrt(np.maximum(sums[1 + size :] / sums[0] - mean**2, 1e-12)) + 1e-6
    random = np.random.default_rng(seed)
    model = {
        "mean": mean, "deviation": deviation,
        "lines": random.standard_normal((size, FEATURES)) * np.sqrt(2 * gamma),
        "phases": random.uniform(0, 2 * np.pi, FEATURES),
    }
    aside = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    width = FEATURES + 1

    def normal(batch):
        x = _mapped(_matrix(batch.column("s")), model)
        y = batch.column("label").to_numpy(zero_copy_only=False)
        return np.concatenate([(x.T @ x).ravel(), x.T @ y])

    total = _summed(rows.where(~aside).select("s", "label"), normal, width * width + width)
    gram = total[: width * width].reshape(width, width)
    model["weights"] = np.linalg.solve(gram + ridge * (1 + gram[-1, -1]) * np.eye(width), total[width * width :])

    def binned(batch):
        value = _mapped(_matrix(batch.column("s")), model) @ model["weights"]
        at = np.clip(((value + 0.5) * BINS / 2).astype(int), 0, BINS - 1)
        y = batch.column("label").to_numpy(zero_copy_only=False)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    seen = _summed(rows.where(aside).select("s", "label"), binned, 2 * BINS)
    model["knots"] = isotonic(seen[:BINS], seen[BINS:])
    return model


def isotonic(weight, positive):
    """(centres, rising shares) by pooling neighbouring bins that fall; none if nothing was set aside."""
    blocks = []
    for i, (w, p) in enumerate(zip(weight, positive)):
        if w:
            blocks.append([w, p, w * ((i + 0.5) * 2 / BINS - 0.5)])
            while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
                last = blocks.pop()
                blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    return [b[2] / b[0] for b in blocks], [b[1] / b[0] for b in blocks]


def score(stats: DataFrame, model: dict | None, key="doc_id") -> DataFrame:
    """Rows (key, score)."""
    if model is None:
        return stats.select(key, F.lit(0.5).alias("score"))
    shared = stats.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def run(batches):
        for batch in batches:
            value = _mapped(_matrix(batch.column("s")), shared.value) @ shared.value["weights"] if batch.num_rows else np.zeros(0)
            centres, shares = shared.value["knots"]
            value = np.interp(value, centres, shares) if centres else np.clip(value, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(value)], [key, "score"])

    kind = stats.schema[key].dataType.simpleString()
    return stats.select(key, "s").mapInArrow(run, f"{key} {kind}, score double")
