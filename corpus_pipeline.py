"""A training corpus from `documents`: good text, once, free of benchmark passages, mixed, as token files.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it and reads it again
before the next one.  All but the last return the columns of `documents`.  Every stage works on all
rows: NULL and empty texts are scored, fingerprinted, searched and encoded like any other, an empty
table passes through, repeated rows stay one row after the second stage, and further columns are
carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import covering_simhash, entropy_mix, pu_quality, token_files, winnowing
from tillroll.llm.shared import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return pu_quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return covering_simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    return winnowing.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return entropy_mix.repeated(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; per document doc_id, start, n_tokens and ids_crc32 as read back from them."""
    return token_files.token_digests(docs, token_files.default_tokenizer(spark))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokenized),
]

#: Fitting, components, Newton steps and the tokenizer can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"stage{number}")
    return docs
