"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where both sides are known to agree.

The pre-token pattern of a byte-level tokenizer looks ahead by a few characters and never back. So from a true start of a
match on, all matches depend on the text from there on alone. A chunk that begins anywhere may start with wrong matches;
once it has a match start in common with the chunk before it, at a place where that chunk is right, both go on alike. The
chunk before is right up to `margin` characters before its end (the look-ahead and the longest added token). So huge
texts are cut into chunks that overlap, each is encoded with offsets in a task of its own, and neighbours are spliced at
the first common match start of their overlap. Texts with a pair of chunks that have none (a word or a run of white
space longer than the overlap) are cut again with the overlap and the chunks four times as long, until a chunk is the whole text.

Other texts are encoded whole, and so are all texts for tokenizers of another kind.

Rows with a null or empty text have no bytes and no tokens. Repeated rows and rows with a null key are counted each. An
empty table gives an empty result. Columns other than the key and the text are left out.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import json_bpe
from tidemark.llm.common import slices, staged

#: Characters behind its end that decide a match of the pre-token pattern: the rest of a contraction.
LOOK_AHEAD = 2


def added_tokens(path: str) -> list[str] | None:
    """The strings of the added tokens, or None if texts may not be cut for this tokenizer."""
    model = json_bpe.read(path) if path.endswith(".json") else None
    return json_bpe.added_tokens(model) if model and json_bpe.cuts_byte_level(model) else None


def counter(path: str):
    """A function from a text to the number of its tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    encode = json_bpe.encoder(path)
    return lambda text: len(encode(text))


def match_starts(tokenizer, text: str):
    """(n, places, before): number of tokens, and for each start of a match its place and the tokens before it."""
    found = tokenizer.encode(text, add_special_tokens=False)
    words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
    starts = np.array([a for a, _ in found.offsets], np.int64)
    new = np.flatnonzero(np.diff(words, prepend=-2) != 0)
    return len(words), starts[new], new


def _spliced(long: DataFrame, path: str, chunk: int, overlap: int, margin: int) -> DataFrame:
    """Rows (row, n_tokens) of long texts; n_tokens is null where two chunks have no match start in common."""

    def cut(batches):
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                text = text.as_py()
                for number, begin in enumerate(range(0, len(text), chunk)):
                    own = text[begin : begin + chunk + overlap]
                    last = begin + chunk >= len(text)
                    columns = [row], [number], [begin], [last], [own]
                    kinds = pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, ["row", "number", "begin", "last", "text"])

    def encode(batches):
        tokenizer = json_bpe.library(path)
        names = ["row", "number", "last", "n", "head", "head_before", "tail", "tail_before"]
        many = pa.list_(pa.int64())
        kinds = pa.int64(), pa.int64(), pa.bool_(), pa.int64(), many, many, many, many
        for batch in batches:
            for i in range(batch.num_rows):
                row, number, begin, last, text = (column[i].as_py() for column in batch.columns)
                n, places, before = match_starts(tokenizer, text)
                head = places < overlap
                tail = (places >= chunk) & (places <= len(text) - margin)
                values = row, number, last, n, places[head] + begin, before[head], places[tail] + begin, before[tail]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    chunks = long.mapInArrow(cut, "row long, number long, begin long, last boolean, text string")
    marks = chunks.repartition("row", "number").mapInArrow(
        encode,
        "row long, number long, last boolean, n long, head array<long>, head_before array<long>, "
        "tail array<long>, tail_before array<long>",
    )
    marks = staged(marks, "chunk-marks")
    left = marks.where("not last").select("row", "number", "tail", "tail_before")
    right = marks.select("row", (F.col("number") - 1).alias("number"), "head", "head_before")
    place = F.array_min(F.array_intersect("tail", "head"))
    pairs = left.join(right, ["row", "number"]).withColumn("place", place)

    def tokens_before(places, counts):
        return F.get(counts, (F.array_position(places, F.col("place")) - 1).cast("int"))

    # The left chunk counts up to the place, the right one goes on from there.
    shift = tokens_before("tail", "tail_before") - tokens_before("head", "head_before")
    ends = marks.where("last").select("row", F.col("n").alias("shift"))
    each = pairs.select("row", shift.alias("shift")).unionByName(ends)
    whole = F.count("*") == F.count("shift")
    return each.groupBy("row").agg(F.when(whole, F.sum("shift")).alias("n_tokens"))


def count(docs: DataFrame, path: str, chunk=65_536, overlap=1_024, key="doc_id", text="text") -> DataFrame:
    """Rows (key, n_bytes, n_tokens); texts of more than `chunk` characters are encoded in chunks of that size."""
    added = added_tokens(path)
    margin = 1 + LOOK_AHEAD + max(map(len, added or []), default=0)
    if not margin < overlap <= chunk:
        raise ValueError(f"an overlap is more than {margin} characters and no longer than a chunk")
    kind = docs.schema[key].dataType.simpleString()

    def measure(batches):
        tokens = counter(path)
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                n = [tokens(t) if added is None or len(t) <= chunk else None for t in texts]
                kept = [t if m is None else None for t, m in zip(texts, n)]
                columns = [part.column("row"), part.column("key"), part.column("n_bytes"), pa.array(n, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "key", "n_bytes", "n_tokens", "text"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    # Only the texts still to be cut are kept beside the counts.
    measured = staged(rows.mapInArrow(measure, f"row long, key {kind}, n_bytes long, n_tokens long, text string"), "token-counts")
    done = [measured.where("n_tokens is not null").select("key", "n_bytes", "n_tokens")]
    left = measured.where("n_tokens is null").select("row", "key", "n_bytes", "text")
    while not left.isEmpty():
        spliced = staged(_spliced(left.select("row", "text"), path, chunk, overlap, margin), "spliced-counts")
        counted = spliced.where("n_tokens is not null")
        done.append(left.select("row", "key", "n_bytes").join(counted, "row").select("key", "n_bytes", "n_tokens"))
        left = left.join(spliced.where("n_tokens is null").select("row"), "row", "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.withColumnRenamed("key", key)
