"""One query per operator, with production parameters, over its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    best_fit_packing,
    byte_bpe,
    collision_counting,
    language_masks,
    line_minhash,
    negative_lists,
    permutation_index,
    phrase_filters,
    quality_features,
    simhash_tiles,
    span_crf,
    string_kernel,
    token_counts,
)
from tidemark.llm.common import held_out, staged, table
from tidemark.llm.registered import QUERIES, SQL, query  # noqa: F401


@query()
def op8_byte_bpe(spark, sf_dir):
    """Ids of every text by the rank file, and the texts decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digests(byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN))


@query()
def op1_best_fit_packing(spark, sf_dir):
    """Every document in sequences of 1024 tokens."""
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op2_language_id(spark, sf_dir):
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    model = language_masks.fit(docs.where(~held_out("doc_id", 4, 2)))
    found = language_masks.predict(docs, model)
    return found.withColumn("held_out", held_out("doc_id", 4, 2))


@query()
def op5_simhash(spark, sf_dir):
    """Fingerprints of three-word shingles and their components within two bits."""
    found = simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"), 3, 2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op4_permutation_index(spark, sf_dir):
    """The 20 nearest of every twentieth vector."""
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query()
def op6_quality(spark, sf_dir):
    """Quality of every document, learned from three quarters of the labelled ones."""
    stats = staged(quality_features.measured(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    known = stats.join(labels, "doc_id").where(~held_out("doc_id", 4, 2))
    found = quality_features.score(stats, quality_features.fit(known))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op7_collision_counting(spark, sf_dir):
    """Vectors with cosine 0.95 or more, and their components."""
    return collision_counting.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


@query()
def op9_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = string_kernel.fit(docs, labels.where(~held_out("doc_id", 3, 1)))
    found = string_kernel.score(docs, model)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op3_line_dedup(spark, sf_dir):
    """Lines kept per document, and the digest of its text without the others."""
    found = line_minhash.dedupe(table(spark, sf_dir, "documents"), 0.8)
    return found.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("text_sha256"))


@query()
def op10_personal_data(spark, sf_dir):
    """Personal data of every document."""
    found = span_crf.find(table(spark, sf_dir, "documents"))
    counts = [span_crf.count_of("base", kind).alias(f"n_{kind}") for kind in span_crf.KINDS]
    return found.select("doc_id", *counts, F.sha2(span_crf.joined("base"), 256).alias("base_sha256"), span_crf.joined("spans").alias("spans"))


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(
    f"""WITH own AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS r,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS id, b.r, a.label = b.label AS alike,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM own a JOIN own b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
positives AS (
  SELECT a, anchor_id, id, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id, r) AS nth
  FROM scored WHERE alike),
ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.nth ORDER BY n.score DESC, n.id, n.r) AS rank
  FROM positives p JOIN scored n ON p.a = n.a AND NOT n.alike
  WHERE p.nth <= 5 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3"""
)
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector, some labels moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negative_lists.quantized(rows.select("vec_id", moved.alias("label"), "embedding"), 256)
    return negative_lists.mine(rows, F.col("id") % 50 == 0)


@query(
    r"""WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-
]')) AS piece FROM docs),
words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, 1 AS k, w[i] AS x, NULL AS y, NULL AS z, count(*) AS f FROM places GROUP BY ALL
  UNION ALL SELECT lang, 2, w[i], w[i + 1], NULL, count(*) FROM places WHERE i < len(w) GROUP BY ALL
  UNION ALL SELECT lang, 3, w[i], w[i + 1], w[i + 2], count(*) FROM places WHERE i < len(w) - 1 GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY 1),
ones AS (SELECT lang, x, f FROM grams WHERE k = 1 AND f >= 10),
twos AS (SELECT lang, x, y, f FROM grams WHERE k = 2 AND f >= 10),
threes AS (SELECT lang, x, y, z, f FROM grams WHERE k = 3 AND f >= 10),
holding AS (
  SELECT lang, x, y, max(f) AS most FROM (
    SELECT lang, x, y, f FROM threes UNION ALL SELECT lang, y, z, f FROM threes) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, 1 AS k, p.f AS l, q.f AS r
  FROM twos t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN ones q ON q.lang = t.lang AND q.x = t.y
  LEFT JOIN holding h ON h.lang = t.lang AND h.x = t.x AND h.y = t.y WHERE 100 * coalesce(h.most, 0) < 50 * t.f
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, p.f, q.f
  FROM threes t JOIN ones p ON p.lang = t.lang AND p.x = t.x JOIN twos q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, p.f, q.f
  FROM threes t JOIN twos p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN ones q ON q.lang = t.lang AND q.x = t.z),
scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
)
def op12_phrases(spark, sf_dir):
    """The first 2000 phrases of every language."""
    return phrase_filters.mine(table(spark, sf_dir, "documents"))


@query()
def op13_token_counts(spark, sf_dir):
    """Tokens of every text."""
    counted = token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
