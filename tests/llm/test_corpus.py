"""Operators for training text against brute force, exact round trips and held-out labels, and on odd rows."""

import hashlib
import itertools
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helpers import plan
from tidemark.llm import (
    best_fit_packing,
    byte_bpe,
    collision_counting,
    language_masks,
    line_minhash,
    permutation_index,
    quality_features,
    queries,
    simhash_tiles,
    span_crf,
    string_kernel,
)
from tidemark.llm.chunks import PieceStore
from tidemark.llm.common import components, held_out, sampled, sampled_texts

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, line string, piece int"
ODD = [None, "", " ", "\n\n", "x" * 30_000, "a b c " * 3000, "same text here", "same text here", "é ü 文字 🙂", "1 2 3", "+1 (2", "@@ a@b.c"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, "l", 1) for i, t in enumerate(texts)], SCHEMA)


def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(params=["odd", "empty"])
def odd(request, spark):
    return frame(spark, ODD if request.param == "odd" else [])


def test_odd_rows_in_every_operator(spark, odd):
    n = odd.count()
    assert byte_bpe.digests(byte_bpe.encode_decode(odd, RANKS, public_tokenizers.PATTERN)).count() == n
    packed = best_fit_packing.pack(odd, JSON).toPandas()
    assert packed.doc_id.nunique() == n
    model = language_masks.fit(odd)
    predicted = {r.doc_id: r for r in language_masks.predict(odd, model).collect()}
    assert len(predicted) == n and all(0 <= r.score <= 1 for r in predicted.values())
    if n:
        assert predicted[0].lang_pred == predicted[1].lang_pred == predicted[9].lang_pred == "und"
    lines = {r.doc_id: r for r in line_minhash.dedupe(odd).collect()}
    assert len(lines) == n
    if n:
        assert lines[0].text is None and lines[1].text == "" and lines[3].text == "\n\n"
        assert lines[6].text == "same text here" and lines[7].text == ""
    near = {r.doc_id: r for r in simhash_tiles.near_duplicates(odd).collect()}
    assert len(near) == n
    if n:
        assert near[0].fp == 0 and near[1].component_id == near[0].component_id == 0 and near[7].component_id == 6
    stats = quality_features.measured(odd)
    labelled = stats.withColumn("label", (F.col("doc_id") % 2).cast("int"))
    for known in (labelled, labelled.limit(0)):
        assert quality_features.score(stats, quality_features.fit(known)).where("score between 0 and 1").count() == n
    toxic = odd.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"), F.lit("x").alias("text"))
    assert string_kernel.score(odd, string_kernel.fit(odd, toxic)).where("score between 0 and 1").count() == n
    assert span_crf.find(odd).count() == n
    assert span_crf.redact(odd).count() == n


def test_encoding_is_that_of_the_library(spark):
    texts = [d["text"] for d in documents()] + [t or "" for t in ODD]
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(RANKS))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = byte_bpe.encode_decode(frame(spark, texts), RANKS, public_tokenizers.PATTERN).collect()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()


def test_pieces_merged_together_are_those_merged_alone():
    rng = random.Random(6)
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(RANKS)) if t}
    merger = byte_bpe.Merger(ranks)
    for size in (1, 2, 3, 5, 9, 16, 32):
        alphabets = (b"aeinrst hl", bytes(range(256)), b"ab")
        pieces = [bytes(rng.choices(rng.choice(alphabets), k=size)) for _ in range(300)]
        got = [np.frombuffer(x, "<u4").tolist() for x in merger.merge(pieces)]
        assert got == [byte_bpe.merge(p, ranks) for p in pieces]


def test_a_full_store_learns_the_batch_anew():
    store = PieceStore(lambda words: [w.encode() for w in words], limit=5)
    for text in ("a b c", "a d e f", "b c d e f g h i j k", "x y  z", ""):
        assert store.encode([text, text + " q"]) == [text.encode(), (text + " q").encode()]


def test_perfect_hash_has_one_slot_per_key():
    keys = [str(i).encode() for i in range(3000)]
    hashed = byte_bpe.PerfectHash(keys)
    assert hashed.candidates(keys).tolist() == list(range(3000))


def test_packing_is_whole_and_tight(spark):
    rows = queries.op1_best_fit_packing(spark, SF).toPandas()
    tokenizer = Tokenizer.from_file(JSON)
    for d in documents():
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2]
        own = rows[rows.doc_id == d["doc_id"]].sort_values("piece")
        assert own.length.sum() == len(ids) and own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert (own.length.iloc[1:] == 1024).all()
        for start, length, crc in zip(own.start, own.length, own.ids_crc32):
            assert zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
    rows = rows.sort_values(["sequence_id", "offset"])
    assert ((rows.groupby("sequence_id").length.cumsum() - rows.length) == rows.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 1024
    assert rows.sequence_id.nunique() <= 1.06 * rows.length.sum() / 1024 + 1


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_piece_once(seed):
    draw = random.Random(seed)
    counts = {draw.randint(1, 64): draw.randint(1, 300) for _ in range(20)}
    room, seen = {}, {}
    for length, first, end, sequence, offset in best_fit_packing.plan(counts, 64, 10, 7):
        seen.setdefault(length, []).extend(range(first, end))
        for i in range(end - first):
            room.setdefault(sequence + i, []).append((offset, length))
    assert {n: sorted(r) for n, r in seen.items()} == {n: list(range(c)) for n, c in counts.items()}
    for placed in room.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64


def test_language_of_held_out_documents(spark):
    found = queries.op2_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "lang"]).to_pandas()
    both = found.merge(truth, on="doc_id")
    assert (both.lang_pred == both.lang)[both.held_out].mean() > 0.97


def shingles(t):
    return {t[i : i + 5] for i in range(len(t) - 4)} if len(t) >= 5 else {t}


def brute_lines(texts, similarity=0.8):
    places = {}
    for i, t in enumerate(texts):
        for n, line in enumerate(t.split("\n")):
            if line.strip():
                places.setdefault(line.strip(), (i, n))
    root = {line: line for line in places}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = sorted(((line, shingles(line)) for line in places), key=lambda x: len(x[1]))
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if len(x) < similarity * len(y):
                break
            common = len(x & y)
            if common >= similarity * (len(x) + len(y) - common):
                root[find(a)] = find(b)
    best = {}
    for line, place in places.items():
        best[find(line)] = min(best.get(find(line), place), place)
    stay = set(best.values())
    return ["\n".join(x for n, x in enumerate(t.split("\n")) if not x.strip() or (i, n) in stay) for i, t in enumerate(texts)]


def test_line_dedup_agrees_with_brute_force(spark):
    draw = random.Random(3)
    base = ["".join(draw.choices("abcdefghij klmnop", k=200)) for _ in range(12)]
    texts = []
    for i in range(40):
        own = []
        for _ in range(draw.randint(1, 4)):
            line = draw.choice(base)
            at = draw.randrange(len(line))
            own.append(line[:at] + draw.choice(["", "Z", "Q9"]) + line[at:])
        texts.append("\n".join([*own, "", "short"]))
    got = {r.doc_id: r.text for r in line_minhash.dedupe(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts)


def test_lines_of_repeated_ids_are_compared_as_documents(spark):
    a, b = "the quick brown fox jumps over the lazy dog", "another line that is not like it at all"
    rows = [(1, a), (7, a), (7, b), (None, a), (7, b + "\n" + a)]
    docs = spark.createDataFrame([(i, t, 5, 6, "k", 1) for i, t in rows], "doc_id long, text string, n_lines int, n_kept int, key string, node int")
    found = sorted(((r.doc_id, r.text, r.n_lines, r.n_kept) for r in line_minhash.dedupe(docs).collect()), key=repr)
    assert found == sorted([(1, a, 1, 1), (7, "", 1, 0), (7, b, 1, 1), (None, a, 1, 1), (7, "", 2, 0)], key=repr)


def roots_of(n, links):
    own = list(range(n))
    for a, b in links:
        x, y = own[a], own[b]
        own = [min(x, y) if v in (x, y) else v for v in own]
    return own


def test_texts_are_split_once_as_lines_are_left_out(spark):
    """The kept lines' text and number are taken from one list, and rows without a key or without kept lines are whole."""
    rows = [(1, "one line that stays\n \none line that stays"), (None, "x\nx"), (2, "one line that stays\n\n"), (3, None)]
    found = line_minhash.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_kept) for r in found.collect()), key=repr)
    want = [(1, "one line that stays\n ", 3, 2), (2, "\n", 3, 2), (3, None, 0, 0), (None, "x\nx", 2, 2)]
    assert got == want


def test_simhash_components_agree_with_brute_force(spark):
    docs = documents()
    fps = [simhash_tiles.fingerprint(d["text"]) for d in docs]
    links = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = roots_of(len(fps), links)
    got = {r.doc_id: r for r in queries.op5_simhash(spark, SF).collect()}
    for i, d in enumerate(docs):
        assert got[d["doc_id"]].fingerprint == f"{fps[i]:016x}"
        assert got[d["doc_id"]].component_id == docs[roots[i]]["doc_id"]


def test_fingerprint_uses_sparks_hash(spark):
    hashed = spark.sql("select xxhash64('a b c') as h").first().h
    assert simhash_tiles.fingerprint("A b  c") == hashed % 2**64


def test_simhash_links_across_tiles(spark):
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(60)]
    values = sorted({v for x in values for v in (x, x ^ 1, x ^ 6)})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash_tiles.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, tile_rows=10)
    got = {r.node: r.component for r in components(links, "t").collect()}
    near = [(a, b) for a, b in itertools.combinations(range(len(values)), 2) if (values[a] ^ values[b]).bit_count() <= 2]
    groups = roots_of(len(values), near)
    for a, b in itertools.combinations(range(len(values)), 2):
        assert (groups[a] == groups[b]) == (got.get(signed[a], signed[a]) == got.get(signed[b], signed[b]))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id long")


def test_odd_vectors(spark):
    unusable = [(0, None, 1), (1, [], 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1)]
    some = [*unusable, (5, [1.0, 0.0], 1), (6, [1.0, 0.0], 1), (20, [1.0, 0.01], 1), (9, [0.0, 1.0], 1)]
    found = {r.vec_id: r for r in collision_counting.near_duplicates(vectors(spark, some)).collect()}
    assert {k: (r.n_links, r.component_id) for k, r in found.items()} == {
        **{i: (0, i) for i in range(5)}, 5: (2, 5), 6: (2, 5), 20: (2, 5), 9: (0, 9),
    }
    near = permutation_index.search(vectors(spark, some), F.col("id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in near] == [(20, 5), (20, 6), (20, 9)]
    for rows in ([], unusable):
        assert permutation_index.search(vectors(spark, rows), F.col("id") % 20 == 0).count() == 0
        assert collision_counting.near_duplicates(vectors(spark, rows)).count() == len(rows)


def test_vectors_of_repeated_ids_are_rows_of_their_own(spark):
    """k rows in give k rows out; an id is kept where it is the least of its component."""
    rows = [(1, [1.0, 0.0], 0)] * 3 + [(1, [0.0, 1.0], 0), (2, [0.0, 2.0], 0), (3, [1.0, 0.0, 0.0], 0), (4, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    found = collision_counting.near_duplicates(vectors(spark, rows))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = [(1, 3, 1, True)] * 3 + [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 3, 1, False), (None, 0, None, False)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_nearest_neighbours_recall(spark):
    data = pq.read_table(f"{SF}/embeddings.parquet").to_pandas()
    x = np.stack(data.embedding).astype(float)
    ids = data.vec_id.to_numpy()
    got = queries.op4_permutation_index(spark, SF).toPandas()
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]])
        own = got[got.query_id == ids[i]].sort_values("rank")
        assert len(own) == 20 and (np.diff(own.score) <= 0).all()
        hits += len(best & set(own.vec_id))
        total += 20
    assert hits / total >= 0.9


def test_vectors_are_compared_block_by_block_without_a_shuffle(spark, monkeypatch):
    """Two lengths in many blocks, links put together in between; no vector is shuffled to be compared."""
    for name, value in (("BLOCK_BYTES", 4000), ("FOLD", 2), ("GATHERED", 5)):
        monkeypatch.setattr(collision_counting, name, value, raising=False)
    plans, staged = [], collision_counting.staged
    monkeypatch.setattr(collision_counting, "staged", lambda df, name: plans.append((name, plan(df))) or staged(df, name))
    draw = np.random.default_rng(6)
    x = []
    for size in (16, 24):
        centres = draw.standard_normal((6, size))
        x += list(np.concatenate([c + 0.12 * draw.standard_normal((9, size)) for c in centres]).astype(np.float32))
    x[5], x[60], x[70][3], x[71] = x[6], x[61], 0.0, x[70].copy()
    x[71][3] = -0.0
    found = collision_counting.near_duplicates(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), tile_rows=7).collect()
    got = {r.vec_id: r for r in found}
    unit = [v.astype(float) / np.linalg.norm(v.astype(float)) for v in x]
    near = [[a != b and len(v) == len(w) and v @ w >= 0.95 for b, w in enumerate(unit)] for a, v in enumerate(unit)]
    roots = roots_of(len(x), [(a, b) for a, row in enumerate(near) for b, met in enumerate(row) if met and a < b])
    assert [got[i].n_links for i in range(len(x))] == [sum(row) for row in near] and max(map(sum, near)) > 4
    assert [got[i].component_id for i in range(len(x))] == roots
    compared = [p for name, p in plans if name == "vector-links" and "MapInArrow" in p]
    assert compared and not any("Exchange" in p for p in compared)


def test_collision_counting_finds_all_links(spark):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((30, 32))
    x = np.concatenate([c + 0.12 * draw.standard_normal((8, 32)) for c in centres]).astype(np.float32)
    x[5] = x[6]
    got = {r.vec_id: r for r in collision_counting.near_duplicates(
        vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), tile_rows=50).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = [(a, b) for a, b in zip(*np.nonzero(near)) if a < b]
    roots = roots_of(len(x), links)
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist()
    assert [got[i].component_id for i in range(len(x))] == roots


@pytest.mark.parametrize("name, label, least", [("op6_quality", "quality", 0.93), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES[name](spark, sf).toPandas()
    both = found.merge(pq.read_table(f"{sf}/labels.parquet").to_pandas(), on="doc_id")
    both = both[both.held_out]
    assert (both.predicted == both[label]).mean() >= least


def test_kernel_tolerates_gaps_and_inserted_characters():
    kernel = string_kernel.Kernel(["pathetic", "idiot"])
    assert kernel("idiioot")[1] > 0.5 and kernel("pathhetic")[0] > 0.5
    assert kernel("mountain") is None
    assert {"idiot"} <= string_kernel.words("you i-d-i-o-t now") and {"idiot"} <= string_kernel.words("an I D I O T here")


def test_base_spans_agree_with_plain_patterns():
    import re

    draw = random.Random(9)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(draw.choices("a1@. -+(", k=draw.randint(0, 40)))
        spans = span_crf.base_spans(text)
        assert [s[1:] for s in spans if s[0] == 0] == [m.span() for m in email.finditer(text)]
        plain = [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert [s[1:] for s in spans if s[0] == 1] == plain


def test_base_spans_stay_and_are_redacted(spark):
    text = "mail jo@ex.org or +44 20 7946 0958, card 4111 1111 1111 1111, host 10.0.0.255"
    found = span_crf.find(frame(spark, [text, None])).orderBy("doc_id").collect()
    assert [text[s.start : s.end] for s in found[0].base] == ["jo@ex.org", "10.0.0.255", "4111 1111 1111 1111", "+44 20 7946 0958"]
    assert set(map(tuple, found[0].base)) <= set(map(tuple, found[0].spans)) and found[1].base == []
    clean = span_crf.redact(frame(spark, [text])).first().text
    assert clean == "mail [email] or [phone], card [card], host [ip]"


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(
        spark.createDataFrame([(10**6, "123 456", "en", "s", 7), (10**6 + 1, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    )
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        made = stage(spark, docs, SF)
        assert made.columns == columns
        rows = made.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(after) and set(after) <= set(before)
        if name == "language":
            assert set(before) - set(after) == {10**6, 10**6 + 1} or not set(before) - set(after) - {10**6, 10**6 + 1}
        if name == "lines":
            ids = sorted(before)
            assert {i: t for i, t in zip(ids, brute_lines([before[i] for i in ids])) if t.strip()} == after
        if name == "near_duplicates":
            ids = sorted(before)
            fps = [simhash_tiles.fingerprint(before[i]) for i in ids]
            near = [(a, b) for a, b in itertools.combinations(range(len(ids)), 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
            assert set(after) == {ids[i] for i, r in enumerate(roots_of(len(ids), near)) if i == r}
        if name == "personal_data":
            assert all(not span_crf.base_spans(t) for t in after.values())
        docs = spark.createDataFrame(rows, made.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_digest_of_no_spans(spark):
    row = queries.op10_personal_data(spark, SF).where("spans = ''").first()
    assert row.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_line_bands_find_similar_lines():
    """Lines at just over 0.8 share a band nearly always; short and repeated lines have signatures of their own."""
    rng = random.Random(3)
    lines, changed = [], []
    while len(lines) < 400:
        line = "".join(rng.choice("abcdefghijklmnop ") for _ in range(250))
        other = line
        for at in rng.sample(range(0, 250, 10), 5):
            other = other[:at] + "#" + other[at + 1 :]
        if line_minhash.similar(line, other, 0.8):
            lines.append(line)
            changed.append(other)
    one, two = (line_minhash.band_hashes(line_minhash.signatures(x)) for x in (lines, changed))
    assert (one == two).any(1).mean() > 0.97
    odd = ["a", "b", "a", "ab", "\U0001f600" * 3, "x" * 70_000]
    bands = line_minhash.band_hashes(line_minhash.signatures(odd))
    assert (bands[0] == bands[2]).all() and len({tuple(r) for r in bands.tolist()}) == 5
    assert line_minhash.similar("ab", "ab", 0.8) and not line_minhash.similar("ab", "abc", 0.8)


def test_rare_shingles_leave_no_similar_pair_out(spark):
    """Long common passages with ends of their own: many pairs just over and just under the similarity."""
    rng = random.Random(5)
    made = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    common = [made(200) for _ in range(2)]
    lines = [made(rng.randint(0, 30)) + rng.choice(common) + made(rng.randint(0, 40)) for _ in range(90)] + ["a", "ab", "x" * 900]
    rows = [(i, i // 2, i % 3 == 0, x) for i, x in enumerate(lines)]
    found = line_minhash.rare_pairs(spark.createDataFrame(rows, "node long, own long, apart boolean, line string"), 0.8)
    pairs = {(r.a, r.b) for r in found.collect()}
    asked = [(x, y) for x, y in itertools.combinations(rows, 2) if x[1] != y[1] and (x[2] or y[2])]
    near = {(x[0], y[0]) for x, y in asked if line_minhash.similar(x[3], y[3], 0.8)}
    assert len(near) > 50 and near <= pairs <= {(x[0], y[0]) for x, y in asked} and len(pairs) < 0.8 * len(asked)


def test_long_unlike_lines_of_one_vocabulary_are_not_compared(spark):
    rng = random.Random(8)
    syllables = ["".join(rng.choices("aeinrst", k=3)) for _ in range(60)]
    lines = ["".join(rng.choices(syllables, k=rng.randint(300, 340))) for _ in range(40)]
    lines.append(lines[0][:-9] + "#")
    rows = [(i, i, True, x) for i, x in enumerate(lines)]
    found = line_minhash.rare_pairs(spark.createDataFrame(rows, "node long, own long, apart boolean, line string"), 0.8).collect()
    pairs = [(r.a, r.b) for r in found]
    assert (0, 40) in pairs and len(pairs) < 40


def test_lines_of_a_band_are_all_compared_but_not_with_its_first_again(spark, monkeypatch):
    monkeypatch.setattr(line_minhash, "FEW", 5)
    rng = random.Random(4)
    base = ["".join(rng.choices("abcdefghij klm", k=120)) for _ in range(6)]
    lines = [rng.choice(base)[: rng.randint(90, 120)] for _ in range(60)]
    own = [rng.choice([i, 0, 1]) for i in range(60)]
    bands = {b: sorted(rng.sample(range(60), size)) for b, size in enumerate([2] * 20 + [3, 4, 5] * 8 + [6, 30])}
    known = [(b, n, own[n], own[n] != own[nodes[0]], n == nodes[0]) for b, nodes in bands.items() for n in nodes]
    known = spark.createDataFrame(known, "band long, node long, own long, apart boolean, first boolean")
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    found = [(r.a, r.b) for r in line_minhash.rest_pairs(known, texts, 0.8).collect()]

    def asked(few):
        return {
            (x, y) for nodes in bands.values() if (len(nodes) <= 5) == few for x, y in itertools.combinations(nodes[1:], 2)
            if own[x] != own[y] and {own[x], own[y]} != {own[nodes[0]]} and (own[x] != own[nodes[0]] or own[y] != own[nodes[0]])
        }

    large = {n for nodes in bands.values() if len(nodes) > 5 for n in nodes}
    near = {p for p in asked(False) if line_minhash.similar(lines[p[0]], lines[p[1]], 0.8)}
    assert len(found) == len(set(found)) and len(near) > 10 and asked(True) | near <= set(found)
    assert all(p in asked(True) or set(p) <= large for p in found)


def test_merged_components_are_those_of_all_links(spark):
    rng = random.Random(2)
    links = [tuple(rng.sample(range(100), 2)) for _ in range(70)]
    one, two = (spark.createDataFrame(x, "a long, b long") for x in (links[:40], links[40:]))
    got = {r.node: r.component for r in line_minhash.merged(components(one, "t"), two).collect()}
    roots = roots_of(100, links)
    assert got == {n: roots[n] for link in links for n in link}


def test_runs_of_bands_go_on_over_batches_and_tasks(spark):
    rng = random.Random(9)
    rows = sorted((rng.randrange(12) ** 2, n) for n in range(300))
    by_band = {}
    for band, node in rows:
        by_band.setdefault(band, []).append(node)
    want = sorted((b, n, min(nodes)) for b, nodes in by_band.items() if len(nodes) > 1 for n in nodes)
    for size in (1, 2, 7, 300):
        batches = [pa.RecordBatch.from_pylist([{"band": b, "node": n} for b, n in rows[i : i + size]]) for i in range(0, 300, size)]
        got = [r for out in line_minhash._runs(batches) for r in out.to_pylist()]
        assert sorted((r["band"], r["node"], r["hub"]) for r in got if r["kind"] == 0) == want
        assert {r["band"] for r in got if r["kind"]} == {rows[0][0], rows[-1][0]}
    signed = spark.createDataFrame([(n, [b, -1 - n % 2]) for b, n in rows], "node long, bands array<long>")
    want += [(-1 - n % 2, n, n % 2) for _, n in rows]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = line_minhash.band_members(signed.repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.band, r.node, r.hub) for r in found) == sorted(want)


def test_bands_are_dealt_packed_and_large_ones_handed_on(spark, monkeypatch):
    """No row is made for each line and band, and a task that holds much hands on what belongs to large bands."""
    monkeypatch.setattr(line_minhash, "HELD", 64, raising=False)
    monkeypatch.setattr(line_minhash, "DEALT", 3, raising=False)
    plans, staged = [], line_minhash.staged
    monkeypatch.setattr(line_minhash, "staged", lambda df, name: plans.append(plan(df)) or staged(df, name))
    rng = random.Random(4)
    lines = [(n << 33 if n % 50 == 0 else n, [7 << 60, -(n % 2), rng.randrange(-(1 << 62), 1 << 62), n // 2 << 40]) for n in range(400)]
    by_band = {}
    for node, bands in lines:
        for band in bands:
            by_band.setdefault(band, []).append(node)
    want = sorted((b, n, min(nodes)) for b, nodes in by_band.items() if len(nodes) > 1 for n in nodes)
    signed = spark.createDataFrame(lines, "node long, bands array<long>").repartition(5)
    found = line_minhash.band_members(signed)
    assert sorted((r.band, r.node, r.hub) for r in found.collect()) == want
    assert not any("Generate" in p for p in plans)
    # What one task hands on of a large band, in several goes, has all its lines once.
    packed = pa.Table.from_pylist([{"node": n, "bands": b} for n, b in lines]).to_batches(max_chunksize=7)
    out = [r for o in line_minhash._members(line_minhash._dealt(4)(iter(packed))) for r in o.to_pylist()]
    assert sorted((r["band"], r["node"]) for r in out if r["kind"] == 0) == [(b, n) for b, n, _ in want]
    assert len({r["hub"] for r in out if r["band"] == 7 << 60}) > 1


def test_numbered_shingles_decide_as_sets_do():
    """Also for lines shorter than a shingle, zero characters and more different characters than a number has room for."""
    rng = random.Random(11)
    odd = ["a", "a\0", "a\0\0\0\0", "ab", "abcd", "abcde", "\U0001f600" * 7, "\u00e9\u4e2d" * 40, "x" * 5000]
    wide = ["".join(map(chr, range(0x4E00, 0x4E00 + 4200))), "".join(map(chr, range(0x4E00, 0x4E00 + 4500)))]
    for lines in (odd, [*odd, *wide]):
        pairs = [(x, y) for x in lines for y in lines]
        for _ in range(300):
            x = "".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 90)))
            pairs.append((x, "".join(c if rng.random() > 0.02 else "#" for c in x)))
        for limit in (0.5, 0.8, 1.0):
            found = line_minhash.near_pairs(*map(list, zip(*pairs)), limit)
            assert found == [line_minhash.similar(x, y, limit) for x, y in pairs]


def test_near_values_are_those_of_the_whole_kernel():
    kernel = string_kernel.Kernel(["idiot", "moron", "banana"])
    own, met = random.Random(8), 0
    for _ in range(4000):
        word = list(own.choice(kernel.landmarks))
        for _ in range(own.randrange(4)):
            word.insert(own.randrange(len(word)), own.choice("idotmrnba"))
        word = "".join(word[own.randrange(3):])
        value, near = kernel.raw(word), kernel.near(word)
        assert (near is None) == (value.max() < string_kernel.NEAR)
        met += near is not None
        assert near is None or np.array_equal(near, np.where(value >= string_kernel.NEAR, value, 0.0))
    assert met > 50


def test_kernel_meets_words_in_runs_without_spaces():
    kernel = string_kernel.Kernel(["pathetic", "idiot"])
    plain = "the river runs over the stones and the wind blows through the trees"
    joined = plain.replace(" ", "")
    for text in (
        "you,idiot,moron;" + plain.replace(" ", ","),
        "nice/idiot",
        joined + "idiot" + joined,
        joined + "idiioot" + joined,
        joined * 150 + "idiot" + joined * 150,
        "文" * 100 + "idiot" + "字" * 100,
        joined[:22] + "idiot" + joined[:22],
    ):
        assert kernel.sentences(text).max(initial=0) > 0.5, text[:80]
    assert not len(kernel.sentences(joined)) and not len(kernel.sentences(plain.replace(" ", ",")))
    draw = random.Random(2)
    word = "".join(draw.choice(["idiot", "idioot", "idxiot", "pathetic", "pathhetic", "river", "xq", "pat"]) for _ in range(150))
    every = {word[i : i + n] for n in (5, 7, 8, 10) for i in range(len(word) - n + 1)}
    near = {w for w in every if kernel.met(w) is not None and kernel.met(w)[[n for n in (0, 1) if len(w) - len(kernel.landmarks[n]) in (0, 2)]].any()}
    assert near and near <= kernel.stretches(word)


def test_training_holds_windows_in_bytes():
    """The driver trains: neither the features of every segment nor a cache of them may stay in its memory."""
    draw = random.Random(3)
    texts = [" ".join(draw.choices(["jo@ex.org", "10.0.0.255", "see", "(at)", "4111"], k=14)) for _ in range(60)]
    labelled = [(t, span_crf._apart(span_crf.base_spans(t))) for t in texts]
    rows = [s[2] for t in texts for s in span_crf.lattice(t)[1]]
    assert (span_crf._unpacked(span_crf._packed(rows)) == np.array(rows)).all()
    assert all(x is True or x is False for row in rows for x in row[1:-1]), "no number of its own is held for each"
    span_crf.features.cache_clear()
    tracemalloc.start()
    assert span_crf.fit(labelled, rounds=1) is not None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert span_crf.features.cache_info().currsize <= 1
    assert peak < len(rows) * 22 * 8, "less than features of eight bytes alone would take"


def test_field_decodes_the_whole_text():
    draw = random.Random(8)
    known = ["jo@ex.org", "10.0.0.255", "4111 1111 1111 1111", "+44 20 7946 0958", "+1 555 010 9999", "mary.ann@mail.example.com"]
    learned = [f"{a} {b} {c}" for b in known for a in ("by", "see 12", "(") for c in ("now", "or 7", ").")]
    weights = span_crf.fit([(t, span_crf._apart(span_crf.base_spans(t))) for t in learned])
    parts = [*known, "and", "the", "12", "2024", "555/123/4567", "10 dot 0 dot 0 dot 1", "a (at) b.org", "x [ AT ] y.z", "@", "١٢", "²", "é", "文字", "...", "\n", "  "]
    parts += ["christopher.alexander.montgomery (at) example.org", "word " * 20, "w" * 300, "0123456789" * 3]
    # Without a sign of a kind in the weights (last), nothing may be skipped.
    loose = weights.copy()
    loose[:, 0] = 0.1
    found = 0
    for used in (weights, draw_weights(weights.shape), loose):
        field = span_crf.Field(used)
        for _ in range(150):
            text = draw.choice(["", " "]).join(draw.choices(parts, k=draw.randint(1, 14)))
            spans = span_crf.decode(text, used)
            found += len(spans)
            assert field.decoded(text) == spans, text
    assert found
    # What no window of a trigger holds whole: the part cut away, and signs that no trigger names.
    favoured = np.zeros_like(weights)
    favoured[0, [0, 1, 4, 5, 21]] = [-3, 2, 1, 1, 1]
    favoured[3, [0, 8]] = [-1, 2]
    field = span_crf.Field(favoured)
    text = "write christopher.alexander.montgomery (at) example.org"
    assert any(text[s:e].startswith("write christopher.alexander.montgomery (at)") for _, s, e in field.decoded(text))
    assert field.spans("call 555/123/4567 now")[1] == [(3, 5, 17)]


def draw_weights(shape):
    return np.random.default_rng(6).normal(-0.6, 0.8, shape)


def test_pipeline_stages_keep_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def text(seed):
        own = random.Random(seed)
        return "\n".join(" ".join("".join(own.choices("abcdefghijklmnop", k=own.randint(3, 9))) for _ in range(14)) for _ in range(3))

    one, two, three, four = (text(i) for i in range(4))
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        docs = spark.createDataFrame([(i, t, "en", f"s{n}", len(t or "")) for n, (i, t) in enumerate(rows)], schema)
        made = stages[name](spark, docs, SF)
        assert made.columns == docs.columns
        found = made.collect()
        assert all(r.n_chars == len(r.text) for r in found)
        return sorted(((r.doc_id, r.text, r.source) for r in found), key=lambda r: int(r[2][1:]))

    def named(rows):
        return [(i, t, f"s{n}") for n, (i, t) in enumerate(rows)]

    rows = [(None, one), (7, two), (7, three), (None, four)]
    taught = [(i, t) for i in range(20, 40) for t in (one, two, three, four)]
    assert run("language", [*rows, (None, "123"), *taught])[:4] == named(rows)
    assert run("lines", rows) == named(rows)
    # A repeated row repeats all lines; rows of one id keep their own ones.
    assert run("lines", [(7, two), (7, two), (7, three + "\n" + two.split("\n")[0])]) in (
        [(7, two, "s0"), (7, three, "s2")], [(7, two, "s1"), (7, three, "s2")],
        [(7, two.split("\n", 1)[1], "s0"), (7, three + "\n" + two.split("\n")[0], "s2")], [(7, two.split("\n", 1)[1], "s1"), (7, three + "\n" + two.split("\n")[0], "s2")],
    )
    assert run("near_duplicates", rows) == named(rows)
    kept = run("near_duplicates", [(7, two), (7, two), (7, two), (None, two), (9, two), (None, one), (None, one)])
    assert [(i, t) for i, t, _ in kept] == [(7, two), (None, one)]
    mail = [(None, "write jo@ex.org soon"), (7, "host 10.0.0.255 is up"), (7, "ring me at jo@ex.org now"), (None, "nothing here")]
    assert [t for _, t, _ in run("personal_data", mail)] == ["write [email] soon", "host [ip] is up", "ring me at [email] now", "nothing here"]
    packed = stages["packing"](spark, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema), SF).toPandas()
    assert len(packed) == 4 and packed.doc_id.isna().sum() == 2 and packed.ids_crc32.nunique() == 4


def test_sample_is_drawn_on_ids_only(spark):
    rows = [(i % 97 if i % 5 else None, f"text {i % 211}", "a" if i % 3 else "b") for i in range(1500)] + [(1, "t", None), (1, None, "a")]
    frame_ = spark.createDataFrame(rows, "key long, text string, lang string")
    hashes = {r.key: r.h for r in frame_.select("key", F.xxhash64("key").alias("h")).distinct().collect()}
    for n in (1, 100, 400, 5000):
        drawn = sampled(frame_, "lang", n, salts=4)
        got = drawn.collect()
        for group in "ab":
            all_keys = sorted((hashes[k], -1 if k is None else k) for k, t, g in rows if g == group and t is not None)
            assert sorted((hashes[r.key], -1 if r.key is None else r.key) for r in got if r.lang == group) == all_keys[:n]
        assert not {tuple(r) for r in got} - {(k, t, g) for k, t, g in rows}
    windows = [part for part in drawn._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in part]
    assert windows and not any("text#" in part for part in windows)


def test_sample_of_labelled_texts_is_that_of_their_join(spark):
    rows = [(i % 61 if i % 5 else None, None if i % 13 == 0 else f"text {i % 211}") for i in range(900)]
    docs = spark.createDataFrame(rows, "key long, text string")
    labels = spark.createDataFrame([(i % 50, i % 3 or None) for i in range(120)] + [(None, 1)], "key long, label int")
    for n in (1, 40, 300, 10_000):
        own = sampled_texts(docs, labels, "label", n, salts=4)
        joined = sampled(docs.join(labels, "key"), "label", n, salts=4)
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, joined.collect()))
    joins = [p for p in own._jdf.queryExecution().optimizedPlan().toString().split("Join")[1:-1]]
    assert joins and not any("text#" in p.split("Project")[1].split("]")[0] for p in joins[1:] if "Project" in p)


def test_copies_are_cut_by_id(spark):
    draw = np.random.default_rng(3)
    x = draw.standard_normal((1200, 16)).astype(np.float32)
    copies = draw.permutation(1200)[:500]
    x[copies] = x[copies[0]]
    asked = int(max(copies)) // 20 * 20
    x[asked] = x[copies[0]]
    same = sorted({*copies.tolist(), asked} - {asked})
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)]
    near = permutation_index.search(vectors(spark, rows), F.col("id") == asked).orderBy("rank").collect()
    assert [r.vec_id for r in near] == same[:20]
    far = draw.integers(0, 9, 3000)
    for take in (1, 400, 1111, 3000, 5000):
        assert sorted(permutation_index._nearest(far, take)) == sorted(np.lexsort((np.arange(3000), far))[:take])


def test_packing_encodes_added_tokens_as_the_tokenizer(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "one<|endoftext|>two  <|endoftext|>", "no token here", "x <|endoftext|>\n y"]
    tokenizer = Tokenizer.from_file(JSON)
    for r in best_fit_packing.pieces(frame(spark, texts), JSON).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_more_than_64_languages(spark):
    draw = random.Random(4)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    rows = []
    for n in range(70):
        vocabulary = ["".join(draw.choices(letters[n * 40 : n * 40 + 40], k=4)) for _ in range(12)]
        rows += [(n * 10 + i, " ".join(draw.choices(vocabulary, k=30)), f"l{n:02d}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_masks.fit(docs)
    assert len(model[0]) == 70
    got = {r.doc_id: r.lang_pred for r in language_masks.predict(docs, model).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_rows_without_an_id_are_not_held_out(spark):
    docs = spark.createDataFrame([(None,), (1,), (2,), (7,)], "doc_id long")
    got = {r.doc_id: r.h for r in docs.select("doc_id", held_out("doc_id", 4, 2).alias("h")).collect()}
    assert got == {None: False} | {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 7)}
