"""The registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from velomart.llm import (
    adaptive_codes,
    chains,
    langid,
    lexicon,
    licenses,
    merkle,
    omh,
    packing,
    quality,
    ranking,
    simple8b,
    tokens,
    toxicity,
    trie_join,
)
from velomart.llm.text import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    docs = lambda spark, sf: table(spark, sf, "documents")
    labels = lambda spark, sf: table(spark, sf, "labels")
    vocabulary = tokens.vocabulary_path
    return {
        "op1_quality_rules": lambda s, d: quality.quality_rules(docs(s, d), labels(s, d)),
        "op2_license_scan": lambda s, d: licenses.license_scan(docs(s, d)),
        "op3_token_output": lambda s, d: simple8b.token_output(docs(s, d), vocabulary()),
        "op4_language_id": lambda s, d: langid.identify(docs(s, d)),
        "op5_bpe_lexicon": lambda s, d: lexicon.encode_decode(docs(s, d), vocabulary()),
        "op6_ngram_jaccard_join": lambda s, d: trie_join.jaccard_join(docs(s, d)),
        "op7_best_fit_packing": lambda s, d: packing.pack(docs(s, d), vocabulary()),
        "op8_substring_dedup": lambda s, d: chains.repeated_passages(docs(s, d)),
        "op9_document_fingerprints": lambda s, d: omh.fingerprints(docs(s, d)),
        "op10_toxicity": lambda s, d: toxicity.toxicity(docs(s, d), labels(s, d)),
        "op11_vector_codes": lambda s, d: adaptive_codes.compress(table(s, d, "embeddings")),
        "op12_merkle_manifest": lambda s, d: merkle.manifest(docs(s, d)),
        "op13_quality_ranking": lambda s, d: ranking.classify(docs(s, d), labels(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": licenses.license_sql()}
