"""A corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Each stage reads all that the stage before kept and returns the columns of ``documents``,
the last one the packed pieces.  Stages without an SQL form are tested against brute force.

A stage's result is written before the next stage begins, which then deletes the tables that the
one before had staged.  So a session runs one pipeline at a time over a folder.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from riskline.llm import exact_dedup, language, mixing, ngram_join, packing
from riskline.llm.common import drop_paths, drop_staged, staged, staged_paths, tidy
from riskline.llm.queries import table, tokenizer_path


#: Words of a shingle and percent of similarity of near copies.
NEAR_WORDS, NEAR_PERCENT = 5, 80
_LEFT: dict[str, list[str]] = {}


def _in_turn(stage):
    """``stage``, after the tables staged by the stage before are deleted, but for those that its
    documents are read from."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _LEFT.pop(sf_dir, []), keep=docs)
        tidy(spark)
        before = set(staged_paths(spark))
        out = stage(spark, docs, sf_dir)
        _LEFT[sf_dir] = [p for p in staged_paths(spark) if p not in before]
        return out

    return run


@_in_turn
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text or no letter) go."""
    return language.keep_identified(docs, language.fit(language.training_rows(docs)))


@_in_turn
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that of the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


@_in_turn
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, that of the smallest id."""
    return ngram_join.drop_near_duplicates(docs, percent=NEAR_PERCENT, words=NEAR_WORDS)


@_in_turn
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


@_in_turn
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences; a document taken twice is packed twice."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the language model, the tokenizer and the linear program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        read, docs = docs, staged(stage(spark, docs, sf_dir), name)
        if k:
            drop_staged(read)
    drop_paths(spark, _LEFT.pop(sf_dir, []), keep=docs)
    return docs
