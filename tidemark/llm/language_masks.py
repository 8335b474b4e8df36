"""Language identification by language-bitmask n-gram filters.

One bit-sliced Bloom filter for all languages: a row of the filter is a bit mask of languages (a further mask for
every 64), an n-gram's languages are the conjunction of its rows. A text's score per language is the number of its n-grams the filter gives to it, less
the false positives expected from the share of the language's bits that are set.

Null texts and texts without a letter are `und` with score 0. Ties go to the language first in order. Repeated rows
count each. With nothing to learn from, everything is `und`. Other columns are left out.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sampled, slices, staged

BITS = 20
HASHES = 3
UNDECIDED = "und"


def ngrams(text: str, size: int) -> np.ndarray:
    """Hashes of the letter n-grams of a text; everything but letters counts as one space."""
    words = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    points = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    if not words or len(points) < size:
        return np.zeros(0, np.uint64)
    n = len(points) - size + 1
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = (h ^ points[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def rows_of(h: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return [((h >> np.uint64(20 * i)) & mask).astype(np.int64) for i in range(HASHES)]


def fit(labelled: DataFrame, size=4, rows_per_language=2000, share=0.34, text="text", lang="lang", key="doc_id"):
    """(languages, filter, set share per language) from at most `rows_per_language` texts of each language.

    An n-gram belongs to every language in which at least `share` as many texts hold it as in the language with most.
    """
    known = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    some = staged(sampled(known, "lang", rows_per_language).drop("key"), "language-sample")
    sizes = {r["lang"]: r["count"] for r in some.groupBy("lang").count().collect()}
    langs = sorted(sizes)

    def grams(batches):
        for batch in batches:
            for text_, lang_ in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                found = np.unique(ngrams(text_, size)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array([lang_] * len(found), pa.string())], ["gram", "lang"]
                )

    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for p in sizes.items() for x in p] or [F.lit(""), F.lit(1)]), F.col("lang"))
    counted = some.mapInArrow(grams, "gram long, lang string").groupBy("gram", "lang").agg(F.count("*").alias("n"))
    rated = counted.where("n > 1").groupBy("gram").agg(F.collect_list(F.struct("lang", rate.alias("rate"))).alias("all"))
    member = F.transform(
        F.filter("all", lambda x: x["rate"] >= share * F.array_max(F.transform("all", lambda y: y["rate"]))),
        lambda x: x["lang"],
    )
    number = {name: i for i, name in enumerate(langs)}

    def marks(batches):
        for batch in batches:
            names = batch.column("langs")
            own = np.array([number[x] for x in names.flatten().to_pylist()], np.int64)
            gram = np.repeat(batch.column("gram").to_numpy().view(np.uint64), names.value_lengths().to_numpy())
            mask = (np.uint64(1) << (own % 64).astype(np.uint64)).view(np.int64)
            for at in rows_of(gram):
                yield pa.RecordBatch.from_arrays([pa.array(own // 64), pa.array(at), pa.array(mask)], ["part", "at", "mask"])

    # The filter is or-ed together before it reaches the driver: at most 2^20 masks for 64 languages, whatever the texts.
    bloom = np.zeros((max(1, -(-len(langs) // 64)), 1 << BITS), np.uint64)
    marked = rated.select("gram", member.alias("langs")).mapInArrow(marks, "part long, at long, mask long")
    whole = marked.groupBy("part", "at").agg(F.bit_or("mask").alias("mask")).toArrow()
    bloom[whole.column("part").to_numpy(), whole.column("at").to_numpy()] = whole.column("mask").to_numpy().view(np.uint64)
    full = [float(((bloom[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) ** HASHES for i in range(len(langs))]
    return langs, bloom, full


def classify(text, model, size=4) -> tuple[str, float]:
    langs, bloom, full = model
    h = ngrams(text, size) if text else np.zeros(0, np.uint64)
    if not langs or not any(c.isalpha() for c in text or ""):
        return UNDECIDED, 0.0
    if not len(h):
        return langs[0], 1 / len(langs)
    masks = None
    for at in rows_of(h):
        masks = bloom[:, at] if masks is None else masks & bloom[:, at]
    n = len(h)
    scores = []
    for i, wrong in enumerate(full):
        hits = int(((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum())
        scores.append(max(0.0, (hits - wrong * n) / (1 - wrong + 1e-12)))
    best = int(np.argmax(scores))
    return langs[best], float((scores[best] + 1 / n) / (sum(scores) + len(langs) / n))


def predict(docs: DataFrame, model, size=4, key="doc_id", text="text") -> DataFrame:
    """Rows (key, lang_pred, score). The model holds 2^20 masks for every 64 languages, whatever was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [classify(t, shared.value, size) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    ["key", "lang_pred", "score"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def recognised(docs: DataFrame, model, size=4, text="text") -> DataFrame:
    """The rows in which a language is recognised, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                found = [classify(t, shared.value, size)[0] != UNDECIDED for t in part.column(text).to_pylist()]
                yield part.filter(pa.array(found, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
