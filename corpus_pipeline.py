"""From documents to a mixed, tokenised corpus: each stage works on what its predecessor kept, written as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm import exact_dedup, langid, mixing, ngram_join, pieces
from vitalgrid.llm.common import table
from vitalgrid.llm.queries import PIECE_MODEL
from vitalgrid.session import stored


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that labelled documents have (operator 4); the others go."""
    return langid.accepted(docs)


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts (operator 8)."""
    return exact_dedup.drop_copies(docs)


def first_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts (operator 9): the one with the smallest id."""
    return ngram_join.first_of_components(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts drawn to the sources' target weights (operator 10); a document may occur twice, or in part."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of each text (operator 1)."""
    return pieces.encode(docs, pieces.Model.load(PIECE_MODEL))


STAGES: list[tuple[str, Callable]] = [
    ("language_id", known_languages), ("exact_dedup", first_copies), ("ngram_join", first_of_similar),
    ("mixing", mixed_sources), ("sentencepiece", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", "zstd")
    return docs


#: Language scores and hypergeometric draws are not SQL: tests compare with a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
