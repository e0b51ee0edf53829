"""The corpus pipeline: language ID, toxicity, SimHash near-dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``docs``.  ``run`` writes each
stage as Parquet under the shared checkpoint folder and reads it back as the
next one's documents, so a lost executor repeats one stage's tasks at most.
An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import langid, simhash, toxicity
from ratecraft.llm.common import held_out, saved, table
from ratecraft.llm.queries import PIECES, pack_documents

MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: those without a letter, or whose best language has a posterior
    under one half, go.  Every row is decided by its own text, whatever its doc_id."""
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))), PIECES)
    return langid.keep_known(docs, model, MIN_LANGUAGE_SCORE)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents not predicted toxic by the labels of ``sf_dir``, every row by its own text."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("id")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, of the smallest doc_id, of every SimHash group (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, width=3, max_bits=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the documents kept: (doc_id, piece, shard, bin, bin_offset, n_words)."""
    return pack_documents(docs)


STAGES = [("language_id", language), ("toxicity", clean), ("simhash_dedup", unique), ("best_fit_packing", packed)]

ORACLE_SQL = None  # models and fingerprints have no SQL form: tests/llm checks the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
