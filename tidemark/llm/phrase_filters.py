"""Phrase collocations: n-grams of word ids counted in counting quotient filters, scored by their lowest cut.

1. Words are counted per group (language). A phrase that occurs `least` times holds only words that do, so those get ids
   and all others end a stretch; this loses no candidate.
2. Each task counts the 2- and 3-word n-grams of its texts in filters cut by the uppermost bits of the permuted numbers,
   so that hot phrases reach the shuffle once per filter. Sorted filters of a segment are merged one after the other.
3. What occurs `least` times is given back as ids; parts, containing phrases and words are joined to it.

Ids follow the order of the words' md5, so 12 bytes a word, of which the place is the id, tell all words: they are sent to
all tasks up to `dictionary_bytes`. Beyond that, texts are taken in chunks of a bounded size, and each chunk gets the ids of
its own words by a join. Scores are exact up to counts of 10^16. A group that is null counts as `unknown`. Null and empty texts hold no
words. Repeated rows count each. An empty table gives an empty result. Other columns are not read.
"""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import copied_join, discard, release, staged
from tidemark.llm.quotient_filter import Filter, Packing, counted, cut

#: A-Z in lower case, ends of pieces as line breaks, tabs as spaces.
TABLE = bytes(
    ord("\n") if chr(b) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
BREAK = b"\n"
END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
#: Bytes of text worked on at once, distinct words and n-grams that a task gathers, n-grams of a segment.
STRETCH, WORDS, GRAMS, SEGMENT = 4_000_000, 300_000, 4_000_000, 4_000_000
#: Bytes of a word in a dictionary: the first ones of its md5. By them another word is taken for one of a million with a
#: chance of one in 10^22.
DIGEST = 12
#: Bytes of text that get the ids of their words together.
CHUNK = 16_000_000


def words_of(text: bytes):
    """The words of a text in order, with a break wherever a piece may end; lists of a bounded part of the text.

    A part ends where a piece does, so only a piece without an end can make it longer.
    """
    start = 0
    while start < len(text):
        part = text[start : start + STRETCH]
        if start + STRETCH < len(text):
            ends = END.search(text, start + STRETCH)
            part = text[start : ends.end() if ends else len(text)]
        start += len(part)
        yield [w for w in part.translate(TABLE).replace(BREAK, b" \n ").split(b" ") if w]


def _texts(batch, group="group", text="text"):
    """(group, bytes of text), for the rows with a text."""
    for i, g in enumerate(batch.column(group).to_pylist()):
        value = batch.column(text)[i].cast(pa.large_binary()).as_py()
        if value:
            yield g, value


def count_words(docs: DataFrame) -> DataFrame:
    """Rows (group, word, f) of rows (group, text)."""

    def run(batches):
        found = {}

        def rows():
            for g, counts in found.items():
                counts.pop(BREAK, None)
                words = pa.array(map(bytes.decode, counts), pa.string())
                columns = pa.array([g] * len(counts), pa.string()), words, pa.array(list(counts.values()), pa.int64())
                yield pa.RecordBatch.from_arrays(list(columns), ["group", "word", "f"])
            found.clear()

        for batch in batches:
            for g, text in _texts(batch):
                for words in words_of(text):
                    found.setdefault(g, Counter()).update(words)
                    if sum(map(len, found.values())) > WORDS:
                        yield from rows()
        yield from rows()

    counts = docs.mapInArrow(run, "group string, word string, f long")
    return counts.groupBy("group", "word").agg(F.sum("f").alias("f"))


def _digest(word, group):
    """The bytes by which a dictionary tells a word of a group; no word holds a line break."""
    return F.substring(F.unhex(F.md5(F.concat_ws("\n", word, group))), 1, DIGEST)


def numbered(words: DataFrame) -> DataFrame:
    """`id` from 1 for rows (group, word, …) in the order of their `digest`, numbered by its first byte."""
    dealt = words.withColumn("digest", _digest("word", "group"))
    dealt = dealt.withColumn("bucket", F.substring("digest", 1, 1))
    sizes = dealt.groupBy("bucket").count()
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    starts = sizes.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("bucket").orderBy("digest")
    ranked = dealt.join(F.broadcast(starts), "bucket").withColumn("id", F.col("base") + F.row_number().over(own))
    return ranked.drop("bucket", "base")


def _count_grams(ids_of, packing, prefix, longest):
    """A mapInArrow function: rows (segment, filter) of what `ids_of` gives for batches, arrays with 0 as a break."""

    def run(batches):
        kept, size = [], 0

        def filters():
            high = np.concatenate([k[0] for k in kept])
            low = None if packing.single else np.concatenate([k[1] for k in kept])
            all_counts = np.concatenate([k[2] for k in kept])
            found = list(cut(packing, prefix, *counted(high, low, all_counts)))
            for i in range(0, len(found), 1024):
                some = found[i : i + 1024]
                columns = pa.array([f.segment for f in some], pa.int64()), pa.array([f.to_bytes() for f in some], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns), ["segment", "filter"])

        for ids in ids_of(batches):
            held = ids > 0
            for n in range(2, longest + 1):
                whole = held[: len(ids) - n + 1].copy()
                for k in range(1, n):
                    whole &= held[k : len(ids) - n + 1 + k]
                at = np.flatnonzero(whole)
                if len(at):
                    kept.append(counted(*packing.pack([ids[at + k] for k in range(n)])))
                    size += len(kept[-1][0])
            if size > GRAMS:
                yield from filters()
                kept, size = [], 0
        if kept:
            yield from filters()

    return run


def _joined(parts):
    """Arrays of ids put together, with a break after each, in pieces of a bounded size."""
    out, size = [], 0
    for ids in parts:
        out += ids, np.zeros(1, np.int64)
        size += len(ids)
        if size > STRETCH // 8:
            yield np.concatenate(out)
            out, size = [], 0
    if out:
        yield np.concatenate(out)


def _halves(digests: bytes):
    """The digests' first eight and last four bytes as numbers of the same order."""
    both = np.frombuffer(digests, np.uint8).reshape(-1, DIGEST)
    return np.ascontiguousarray(both[:, :8]).view(">u8")[:, 0].astype(np.uint64), np.ascontiguousarray(both[:, 8:]).view(">u4")[:, 0].astype(np.uint32)


def dictionary(known: DataFrame, largest: int):
    """The digests of rows (id, digest) in the order of ids, read partition by partition."""

    def packed(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            yield pa.RecordBatch.from_pydict({"ids": [ids], "digests": [b"".join(batch.column("digest").to_pylist())]})

    high, low = np.zeros(largest, np.uint64), np.zeros(largest, np.uint32)
    for row in known.select("id", "digest").mapInArrow(packed, "ids binary, digests binary").toLocalIterator():
        at = np.frombuffer(row["ids"], "<i8") - 1
        high[at], low[at] = _halves(bytes(row["digests"]))
    return high, low


def found_ids(high, low, group: str, words: list[bytes]) -> np.ndarray:
    """The ids of a group's words, 0 for those a dictionary does not hold."""
    end = b"\n" + group.encode()
    own_high, own_low = _halves(b"".join(hashlib.md5(w + end, usedforsecurity=False).digest()[:DIGEST] for w in words))
    at = np.searchsorted(high, own_high)
    ids = np.zeros(len(words), np.int64)
    left = np.arange(len(words))
    while len(left):  # those alike in the first eight bytes stand beside one another
        left = left[at[left] < len(high)]
        left = left[high[at[left]] == own_high[left]]
        same = low[at[left]] == own_low[left]
        ids[left[same]] = at[left[same]] + 1
        left = left[~same]
        at[left] += 1
    return ids


def _ids_by_dictionary(shared):
    def each(batches):
        high, low = shared.value
        seen = {}  # of a bounded number of words
        for batch in batches:
            for g, text in _texts(batch):
                for words in words_of(text):
                    if sum(map(len, seen.values())) > WORDS:
                        seen.clear()
                    known = seen.setdefault(g, {BREAK: 0})
                    new = list(set(words).difference(known))
                    if new:
                        known.update(zip(new, found_ids(high, low, g, new).tolist()))
                    yield np.array([known[w] for w in words], np.int64)

    return lambda batches: _joined(each(batches))


def _ids_by_chunk(batches):
    """Of sorted rows (chunk, group, text, id): the words of a chunk with their ids, then its texts, which have no id."""

    def each():
        chunk, known = None, {}
        for batch in batches:
            rows = zip(batch.column("chunk").to_pylist(), batch.column("id").to_pylist(), _texts(batch))
            for number, i, (g, text) in rows:
                if number != chunk:
                    chunk, known = number, {}
                if i is not None:
                    known.setdefault(g, {})[text] = i
                    continue
                own = known.get(g, {})
                for words in words_of(text) if own else ():
                    yield np.array([own.get(w, 0) for w in words], np.int64)

    return _joined(each())


def _with_own_words(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (chunk, group, text, id): texts in chunks of about `CHUNK` bytes, each after the words it holds, which have an id.

    Texts are moved once, words once for each chunk that holds them.
    """

    def chunked(batches):
        first, size = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            ends = size + np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
            size = int(ends[-1]) if len(ends) else size
            yield batch.append_column("chunk", pa.array(first + ends // CHUNK))

    def distinct(batches):
        found = {}

        def rows():
            for (chunk, g), words in found.items():
                words.discard(BREAK)
                columns = pa.array([chunk] * len(words), pa.int64()), pa.array([g] * len(words), pa.string()), pa.array(map(bytes.decode, words), pa.string())
                yield pa.RecordBatch.from_arrays(list(columns), ["chunk", "group", "word"])
            found.clear()

        for batch in batches:
            for chunk, (g, text) in zip(batch.column("chunk").to_pylist(), _texts(batch)):
                for words in words_of(text):
                    found.setdefault((chunk, g), set()).update(words)
                    if sum(map(len, found.values())) > WORDS:
                        yield from rows()
        yield from rows()

    rows = docs.where("text <> ''").select("group", "text").mapInArrow(chunked, "group string, text string, chunk long")
    rows = staged(rows, "phrase-chunks")
    held = rows.select("chunk", "group", "text").mapInArrow(distinct, "chunk long, group string, word string")
    words = known.select("group", "word", "id").hint("merge")
    found = staged(held.join(words, ["group", "word"]).select("chunk", "group", F.col("word").alias("text"), "id").distinct(), "phrase-chunk-words")
    release(docs.sparkSession)
    texts = rows.select("chunk", "group", "text", F.lit(None).cast("long").alias("id"))
    both = found.unionByName(texts).repartition("chunk")
    return both.sortWithinPartitions("chunk", F.col("id").isNull()), (rows, found)


def count_phrases(docs: DataFrame, known: DataFrame, occurrences: int, least: int, dictionary_bytes: int, longest=3) -> DataFrame:
    """Staged rows (a, b, c, f): ids of 2 or 3 words (c null for 2) that occur at least `least` times.

    `known` has (group, word, digest, id).
    """
    spark = docs.sparkSession
    largest = known.agg(F.max("id")).first()[0]
    if not largest:
        return staged(spark.createDataFrame([], "a long, b long, c long, f long"), "phrases")
    packing = Packing(largest, longest)
    # Every word starts at most one phrase of each length.
    prefix = min(packing.high_bits - 8, max(4, math.ceil(math.log2(max(1, occurrences * (longest - 1) / SEGMENT)))))
    if largest * DIGEST <= dictionary_bytes:
        shared = spark.sparkContext.broadcast(dictionary(known, largest))
        ids_of, texts, used = _ids_by_dictionary(shared), docs, ()
    else:
        shared, ids_of = None, _ids_by_chunk
        texts, used = _with_own_words(docs, known)
    shards = texts.mapInArrow(_count_grams(ids_of, packing, prefix, longest), "segment long, filter binary")

    def merge(batches):
        def rows(whole):
            enough = whole.counts >= least
            ids = packing.unpack(whole.high[enough], None if whole.low is None else whole.low[enough])
            columns = [pa.array(i, pa.int64(), mask=i == 0) for i in ids] + [pa.array(whole.counts[enough], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "c", "f"])

        # Filters in powers of two, so that each entry is merged a logarithmic number of times.
        segment, open_ = None, []

        def closed():
            whole = open_[0][1]
            for _, more in open_[1:]:
                whole = whole.merged(more)
            return rows(whole)

        for batch in batches:
            for number, data in zip(batch.column("segment").to_pylist(), batch.column("filter")):
                if segment is not None and number != segment:
                    yield closed()
                    open_ = []
                segment = number
                own = 1, Filter.from_bytes(packing, prefix, number, data.as_py())
                while open_ and open_[-1][0] == own[0]:
                    n, last = open_.pop()
                    own = 2 * n, last.merged(own[1])
                open_.append(own)
        if open_:
            yield closed()

    dealt = shards.repartition("segment").sortWithinPartitions("segment")
    found = staged(dealt.mapInArrow(merge, "a long, b long, c long, f long"), "phrases")
    if shared is not None:
        shared.unpersist()
    discard(*used)
    return found


def mine(
    docs: DataFrame, least=10, share=50, top=2000, unknown="und", dictionary_bytes=64_000_000, group="lang", text="text"
) -> DataFrame:
    """Rows (group, rank, phrase, a, l, r, n, score), the first `top` of each group.

    Candidates are phrases of 2 and 3 words that occur a >= `least` times. A cut into parts that occur l and r times gives
    floor(1000000 * a * a / (l * r)); the lowest counts, of equal ones the first. A candidate goes if a longer one that
    holds it occurs in at least `share` percent of a.
    """
    texts = docs.select(F.coalesce(F.col(group), F.lit(unknown)).alias("group"), F.col(text).alias("text"))
    words = staged(count_words(texts), "phrase-words")
    totals = staged(words.groupBy("group").agg(F.sum("f").alias("n")), "phrase-totals")
    known = staged(numbered(words.where(F.col("f") >= least)), "phrase-dictionary")
    discard(words)
    occurrences = totals.agg(F.sum("n")).first()[0] or 0
    found = count_phrases(texts, known, occurrences, least, dictionary_bytes)
    release(found.sparkSession)

    # One word may stand in a third of all phrases: small sides are copied to the tasks that its rows are spread over.
    def word(column, *names):
        kept = [F.col(n).alias(f"{n}_{column}") for n in names]
        return known.select(F.col("id").alias(column), *kept)

    pairs = found.where("c is null").select("a", "b", "f")
    rows = copied_join(found, word("a", "word", "f", "group"), "a", spread_by="b")
    rows = copied_join(rows, word("b", "word", "f"), "b", spread_by="a")
    last = rows.where("c is not null")
    last = copied_join(last, word("c", "word", "f"), "c", spread_by="a")
    sides = pairs.select(F.struct("a", "b").alias("pair"), F.col("f").alias("f_pair"))
    triples = last.withColumn("pair", F.struct("a", "b"))
    triples = copied_join(triples, sides.withColumnRenamed("f_pair", "f_ab"), "pair", spread_by="c")
    triples = triples.withColumn("pair", F.struct("b", "c"))
    triples = copied_join(triples, sides.withColumnRenamed("f_pair", "f_bc"), "pair", spread_by="a")

    exact = "decimal(38,0)"

    def score(l, r):
        times = F.col("f").cast("decimal(19,0)")
        return F.call_function("div", (times * times).cast(exact) * F.lit(1_000_000).cast("decimal(7,0)"), (l.cast("decimal(19,0)") * r.cast("decimal(19,0)")).cast(exact))

    def scored(l, r):
        return F.struct(score(F.col(l), F.col(r)).alias("score"), F.col(l).alias("l"), F.col(r).alias("r"))

    first, second = scored("f_a", "f_bc"), scored("f_ab", "f_c")
    three = triples.select(
        F.col("group_a").alias("group"),
        F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"),
        "f",
        F.when(second["score"] < first["score"], second).otherwise(first).alias("cut"),
    )
    longer = staged(found.where("c is not null").select("a", "b", "c", "f"), "phrase-triples")
    holds = longer.select("a", "b", "f").unionByName(longer.select(F.col("b").alias("a"), F.col("c").alias("b"), "f"))
    most = holds.groupBy("a", "b").agg(F.max("f").alias("most"))
    two = rows.where("c is null").join(most.hint("merge"), ["a", "b"], "left")
    two = two.where(F.coalesce(F.col("most"), F.lit(0)) * 100 < F.col("f") * share).select(
        F.col("group_a").alias("group"),
        F.concat_ws(" ", "word_a", "word_b").alias("phrase"),
        "f",
        scored("f_a", "f_b").alias("cut"),
    )
    both = staged(two.unionByName(three).select("group", "phrase", "f", "cut.*"), "phrase-scores")

    order = [F.desc("score"), F.desc("f"), F.asc("phrase")]
    salted = both.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("group", "salt").orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order)).cast("long"))
    ranked = ranked.where(F.col("rank") <= top).join(totals, "group")
    return ranked.select(F.col("group").alias(group), "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
