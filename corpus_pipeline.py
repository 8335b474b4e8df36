"""Documents through language, line, near-duplicate and personal-data stages into packed sequences."""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import best_fit_packing, language_masks, line_minhash, simhash_tiles, span_crf
from tidemark.llm.common import held_out, staged, table

ROW, KEY = "__row", "__key"


def _numbered(docs, name):
    """The documents with a staged row number, so that rows of one doc_id or without one are told apart."""
    return staged(docs.withColumn(ROW, F.monotonically_increasing_id()), f"pipeline-{name}-rows")


def _measured(docs, columns):
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long"))).select(*columns)


def language(spark, docs, sf_dir):
    """Documents in which a language was recognised; texts without a letter go. Each row is judged by its own text."""
    model = language_masks.fit(docs.where(~held_out("doc_id", 4, 2)))
    return language_masks.recognised(docs, model)


def lines(spark, docs, sf_dir):
    """Documents without repeated lines; those with nothing left go.

    Rows come in the order of doc_id, rows of one doc_id are documents of their own. Rows without a doc_id have no place
    in that order and keep all their lines.
    """
    rows = _numbered(docs, "lines")
    known = rows.where("doc_id is not null").withColumn(KEY, F.struct("doc_id", ROW))
    left = line_minhash.without_repeats(known, 0.8, KEY).select(*docs.columns)
    left = left.unionByName(rows.where("doc_id is null").select(*docs.columns))
    return _measured(left.where(F.regexp_like("text", F.lit(r"\S"))), docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """The first document of each near-duplicate group, by doc_id; one row of it, and one without a doc_id only if no other is there."""
    rows = _numbered(docs, "near-duplicates")
    found = simhash_tiles.near_duplicates(rows, 3, 2, key=ROW).select(ROW, "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW)
    first = found.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(F.min(place).alias("first"))
    return rows.join(first.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_semi").select(*docs.columns)


def personal_data(spark, docs, sf_dir):
    """Documents with personal data replaced by its kind, each row by its own spans."""
    return _measured(span_crf.redact(docs), docs.columns)


def packing(spark, docs, sf_dir):
    """Pieces of documents and their places in sequences."""
    return best_fit_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Models and iterative components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
