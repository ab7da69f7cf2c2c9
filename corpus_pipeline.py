"""From raw documents to packed training sequences, in stages.

Each stage reads the table that the one before has written. The first four give the
columns of ``documents``; the last gives pieces of sequences. Executors and workers serve
all stages, so each stage bounds the Arrow batches of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from velomart.llm import chains, langid, packing, tokens, toxicity, trie_join
from velomart.llm.text import bound_batches, table
from velomart.workspace import materialize

#: Share of a text's positions that its language must hold at least.
LEAST_LANGUAGE = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: rows of a probability of at least a half go."""
    bound_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~langid.held_out(0, 5)))
    return toxicity.keep_clean(docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows without a letter, or without a language that holds most of the text, go."""
    bound_batches(spark)
    network = langid.fit(docs.where(~langid.held_out(2, 4)))
    return langid.keep_known(docs, network, LEAST_LANGUAGE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join, five words and 0.8: the first row of each group stays."""
    bound_batches(spark)
    return trie_join.without_near_copies(docs, 5, 80, 100)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages of 50 words or more stay in the first document only."""
    bound_batches(spark)
    return chains.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of the tokens into sequences of 2048."""
    bound_batches(spark)
    # Workers serve all stages, so that this one keeps fewer words than it would alone, and none at its end.
    return packing.pack(docs, tokens.vocabulary_path(), kept=200_000, stay=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("best_fit_packing", pack),
]

#: No stage of this pipeline can be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
