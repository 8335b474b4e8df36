"""Hard negatives, phrases and token counts against brute force, and on odd rows."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import plan
from tidemark.llm import json_bpe, negative_lists, phrase_filters, quotient_filter, token_counts
from tidemark.llm.common import copied_join

JSON = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<double>, label int, key string, g string, score double, row int"
DOCS = "doc_id long, text string, lang string, row int, group string, f long, n_tokens string"


# --- hard negatives -------------------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", "g", 0.0, 1) for i, v, label in rows], VECTORS)


def expected_negatives(rows, is_anchor, positives, negatives, low=50, high=95):
    used = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            used.append((i, [int(np.floor(256 * x)) for x in v], label))
    out = []
    for a, (i, v, label) in enumerate(used):
        if not is_anchor(i):
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j, b, other)
            for b, (j, w, other) in enumerate(used)
            if b != a and len(w) == len(v)
        ]
        scored.sort()
        near = [s for s in scored if s[3] == label][:positives]
        for score, j, _, _ in near:
            fit = [s for s in scored if s[3] != label and -low * score <= -100 * s[0] <= -high * score][:negatives]
            out += [(i, j, n, s[1], -score, -s[0]) for n, s in enumerate(fit, 1)]
    return sorted(out)


def found_negatives(spark, rows, members=512, **options):
    frame = negative_lists.quantized(vectors(spark, rows), 256)
    found = negative_lists.mine(frame, F.col("id") % 3 == 0, members=members, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("members, segment", [(512, 65_536), (4, 40)])
def test_hard_negatives_agree_with_brute_force(spark, monkeypatch, members, segment):
    """Ties, copies, repeated ids, two lengths, zero and empty vectors, and rows that take no part."""
    monkeypatch.setattr(negative_lists, "SEGMENT", segment)
    rng = np.random.default_rng(3)
    rows = [(i, np.round(rng.normal(1, 1, 4), 1).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(i % 20, [1.0, 1.0, 0.5, 0.5], i % 3) for i in range(60)]
    rows += [(200 + i, rng.normal(1, 1, 2).tolist(), i % 2) for i in range(20)]
    rows += [(300, [0.0] * 4, 0), (303, [0.0] * 4, 1), (306, [], 1), (309, [], 0), (312, [], 0)]
    rows += [(None, [1.0] * 4, 0), (6, None, 0), (9, [1.0] * 4, None), (12, [1.0, None, 1.0, 1.0], 0), (15, [float("nan")] * 4, 1)]
    rows += [(18, [float("inf"), 1.0, 1.0, 1.0], 1)]
    want = expected_negatives(rows, lambda i: i % 3 == 0, 5, 3)
    assert len(want) > 500
    assert found_negatives(spark, rows, members) == want


def test_hard_negatives_with_large_numbers_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-(2**20), 2**20, 5) * 2.0 + rng.integers(0, 2, 5)).tolist(), int(i % 2)) for i in range(30)]
    assert found_negatives(spark, rows) == expected_negatives(rows, lambda i: i % 3 == 0, 5, 3)


def test_hard_negatives_of_nothing(spark):
    assert found_negatives(spark, []) == []
    assert found_negatives(spark, [(3, [1.0], 0)]) == []


def test_walk_ends_early_and_loses_nothing():
    """A member reads on only while the bound reaches what it needs."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    v = rng.normal(0, 1, (5000, 3)) * rng.exponential(20, 5000)[:, None]
    v = np.floor(v)
    order = np.argsort(-np.linalg.norm(v, axis=1))
    v = v[order]
    table = pa.table({
        "row": np.arange(5000), "id": np.arange(5000), "label": np.zeros(5000, np.int64),
        "v": v.tolist(), "bound": np.linalg.norm(v, axis=1),
    })
    member = pa.table({"row": [-1], "label": [0], "v": [[3.0, 1.0, 2.0]], "lows": [[-negative_lists.LONG]], "highs": [[negative_lists.LONG]]})
    walk = negative_lists._Walk(member, 3, True)
    steps = 0
    for batch in table.to_batches(max_chunksize=100):
        walk.take(batch)
        if walk.done:
            break
        steps += 1
    scores = v @ np.array([3.0, 1.0, 2.0])
    assert steps < 25
    assert walk.result().column("score").to_pylist() == sorted(scores, reverse=True)[:3]


# --- phrases --------------------------------------------------------------------------------------------------------


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0, "g", 1, "n") for i, (t, lang) in enumerate(rows)], DOCS)


def expected_phrases(rows, least, share=50, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts[lang or "und", tuple(words[i : i + n])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in found.items():
        holding = [b for (other, more), b in found.items() if other == lang and len(more) > len(words) and words in (more[:2], more[1:])]
        if any(100 * b >= share * a for b in holding):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    rows = []
    for lang, phrases in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(rows)


def random_documents(n, seed):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "é", "É", "文字", "x" * 50, "it's", "-", "\x00", "\xa0", "ß"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!?"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60)))
        out.append((text, rng.choice(["en", "en", "de", None])))
    return out + [(None, "en"), ("", "fr"), ("  .", None), out[0], out[0]]


@pytest.mark.parametrize("dictionary_bytes", [64_000_000, 0])
def test_phrases_agree_with_brute_force(spark, monkeypatch, dictionary_bytes):
    """With the dictionary sent to all tasks and with the ids joined to each text; many small filters are merged."""
    monkeypatch.setattr(phrase_filters, "GRAMS", 50)
    monkeypatch.setattr(phrase_filters, "WORDS", 5)
    monkeypatch.setattr(phrase_filters, "SEGMENT", 100)
    rows = random_documents(60, 1)
    for least, top in ((2, 2000), (5, 7)):
        found = phrase_filters.mine(documents(spark, rows), least=least, top=top, dictionary_bytes=dictionary_bytes)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = expected_phrases(rows, least, top=top)
        assert len(want) > 10
        assert sorted(tuple(r) for r in found.collect()) == want


def test_copies_of_a_small_side_are_not_broadcast(spark):
    """Spark sizes them as if there were no copies."""
    rows, few = spark.range(2000).selectExpr("id % 50 as k", "id as doc_id"), spark.range(50).selectExpr("id as k", "id * 2 as v")
    joined = copied_join(rows, few, "k")
    assert "BroadcastHashJoin" not in plan(joined)
    assert joined.count() == 2000 and joined.where("v <> 2 * k").isEmpty()


def test_words_are_told_by_their_digests(spark):
    words = spark.createDataFrame([("g", f"w{i}", 12) for i in range(500)] + [("h", "w1", 10)], "group string, word string, f long")
    known = phrase_filters.numbered(words).persist()
    ids = {(r.group, r.word): r.id for r in known.collect()}
    assert sorted(ids.values()) == list(range(1, 502))
    high, low = phrase_filters.dictionary(known, 501)
    assert high.nbytes + low.nbytes == 12 * 501
    for group in ("g", "h", "i"):
        found = phrase_filters.found_ids(high, low, group, [b"w1", b"nothing", b"w499"])
        assert found.tolist() == [ids.get((group, w), 0) for w in ("w1", "nothing", "w499")]


def test_digests_alike_in_their_first_bytes(monkeypatch):
    digests = {b"a\ng": b"\x01" * 12, b"b\ng": b"\x01" * 8 + b"\x02" * 4, b"c\ng": b"\x01" * 8 + b"\x03" * 4, b"d\ng": b"\xff" * 12}
    monkeypatch.setattr(phrase_filters.hashlib, "md5", lambda x, **_: SimpleNamespace(digest=lambda: digests[x]))
    high, low = phrase_filters._halves(b"".join(digests[k] for k in (b"a\ng", b"b\ng", b"c\ng")))
    assert phrase_filters.found_ids(high, low, "g", [b"c", b"a", b"d", b"b"]).tolist() == [3, 1, 0, 2]
    assert phrase_filters.found_ids(high[:2], low[:2], "g", [b"c", b"a", b"d", b"b"]).tolist() == [0, 1, 0, 2]


def test_a_chunk_moves_each_of_its_words_once(spark, monkeypatch):
    """The texts of a chunk get the ids of their words together, not each text its own."""
    monkeypatch.setattr(phrase_filters, "CHUNK", 300)
    docs = documents(spark, [("one two three four", "en")] * 200).select(F.col("lang").alias("group"), "text").coalesce(1)
    words = spark.createDataFrame([("en", w, 200) for w in ("one", "two", "three", "four")], "group string, word string, f long")
    rows, _ = phrase_filters._with_own_words(docs, phrase_filters.numbered(words))
    assert rows.where("id is null").count() == 200
    chunks = rows.select("chunk").distinct().count()
    assert chunks == 200 * 18 // 300 + 1 and rows.where("id is not null").count() == 4 * chunks


def test_phrases_of_long_texts_and_of_nothing(spark, monkeypatch):
    assert phrase_filters.mine(documents(spark, [])).count() == 0
    assert phrase_filters.mine(documents(spark, [(None, None), ("a b", "en")])).count() == 0
    monkeypatch.setattr(phrase_filters, "STRETCH", 40)
    text = "one two three, " * 400 + "four five " * 300
    rows = [(text, "en")]
    found = phrase_filters.mine(documents(spark, rows))
    assert sorted(tuple(r) for r in found.collect()) == expected_phrases(rows, 10)


def test_scores_are_exact_beyond_64_bits(spark):
    n = 10_000_000_000
    row = spark.range(1).select((F.lit(n) + F.col("id")).alias("f"))
    times = F.col("f").cast("decimal(19,0)")
    top = (times * times).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    assert row.select(F.call_function("div", top, (times * times).cast("decimal(38,0)"))).first()[0] == 1_000_000


@pytest.mark.parametrize("largest", [1, 300, 2**21 - 1, 2**21, 2**40])
def test_quotient_filters_lose_nothing(largest):
    rng = np.random.default_rng(largest % 1000)
    packing = quotient_filter.Packing(largest)
    ids = [rng.integers(1, largest, 2000, endpoint=True) for _ in range(3)]
    ids[2][::3] = 0
    want = Counter(zip(*(i.tolist() for i in ids)))
    for prefix in (0, 4):
        parts = {}
        for piece in np.array_split(np.arange(2000), 7):
            for f in quotient_filter.cut(packing, prefix, *quotient_filter.counted(*packing.pack([i[piece] for i in ids]))):
                f.counts[:] *= 300  # beyond a byte
                back = quotient_filter.Filter.from_bytes(packing, prefix, f.segment, f.to_bytes())
                parts[f.segment] = parts[f.segment].merged(back) if f.segment in parts else back
        got = Counter()
        for f in parts.values():
            for *words, n in zip(*(i.tolist() for i in packing.unpack(f.high, f.low)), f.counts.tolist()):
                got[tuple(words)] += n // 300
        assert got == want


# --- token counts ---------------------------------------------------------------------------------------------------

ODD = ["a", "b", "the", "THE", "é", "ß", "文", "1", "2²", "½", ".", ",", "!", "?", "'", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t",
       "\r\n", "\x1c", "\xa0", "　", "_", "-", "<|endoftext|>", "<|endof", "😀", "́", "ing", "$", "\x85", "​"]


def odd_texts(n, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(length))) for _ in range(n)]


def test_ids_are_those_of_the_library():
    library = Tokenizer.from_file(JSON)
    encode = json_bpe.encoder(JSON)
    texts = odd_texts(3000, 40, 1) + [f(chr(c)) for c in range(0x250) for f in ("{0}".format, "a{0} {0}b".format, " {0}{0}1".format)]
    for text in texts:
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids, text


def test_files_whose_merges_are_out_of_order_are_left_to_the_library():
    model = json_bpe.read(JSON)
    assert len(json_bpe.ranks(model)) == 50_256
    merges = model["model"]["merges"]
    merges[5], merges[6] = merges[6], merges[5]
    assert json_bpe.ranks(model) is None


@pytest.mark.parametrize("chunk, overlap", [(60, 40), (90, 45), (65_536, 1_024)])
def test_spliced_counts_are_those_of_the_library(spark, chunk, overlap):
    texts = odd_texts(150, 120, 2) + [None, "", " " * 900, "x" * 700, "ab " * 400, "same", "same", "<|endoftext|>" * 40]
    frame = documents(spark, [(t, "en") for t in texts])
    frame = frame.unionByName(frame.where("doc_id < 5")).unionByName(frame.where("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")))
    found = token_counts.count(frame, JSON, chunk, overlap)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    library = Tokenizer.from_file(JSON)
    rows = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in frame.collect()]
    assert Counter(tuple(r) for r in found.collect()) == Counter(rows)


def test_long_texts_are_cut_and_other_tokenizers_are_not(spark):
    text = " ".join(odd_texts(400, 40, 3))
    frame = documents(spark, [(text, "en"), ("word " * 20_000 + "y" * 3000 + " z" * 20_000, "en")])
    library = Tokenizer.from_file(JSON)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in [r.text for r in frame.orderBy("doc_id").collect()]]
    found = token_counts.count(frame, JSON, 2_000, 200).orderBy("doc_id")
    assert [r.n_tokens for r in found.collect()] == want
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.count(frame, path).orderBy("doc_id").first().n_tokens == len(pieces.encode(text))
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.count(frame, path).orderBy("doc_id").first().n_tokens == len(
        Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    )


def test_counts_of_an_empty_table(spark):
    assert token_counts.count(documents(spark, []), JSON).count() == 0
    with pytest.raises(ValueError):
        token_counts.count(documents(spark, []), JSON, 100, 10)
