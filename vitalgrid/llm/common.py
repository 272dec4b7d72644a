"""What several of these operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Identity of a row by content: rows that share it are repeats of one another."""
    return [F.col(id_col).alias("k_id"), F.xxhash64(text_col).alias("k_text")]


def rows_without(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is not in ``keys`` (k_id, k_text), with their own columns; null ids match."""
    own = docs.select(F.struct(*docs.columns).alias("row_"), *[c.alias(f"own_{n}") for c, n in zip(row_key(id_col, text_col), ("id", "text"))])
    return own.join(keys, F.col("own_id").eqNullSafe(F.col("k_id")) & (F.col("own_text") == F.col("k_text")),
                    "left_anti").select("row_.*")


def byte_words(text: bytes, word: re.Pattern, run: int = 1 << 20):
    """Lists of the words of UTF-8 bytes, A-Z as a-z, a run of some bytes at a time; no word is cut."""
    text, at = text.lower(), 0
    while at < len(text):
        end = at + run
        while end < len(text) and word.match(text, end):
            end = word.match(text, end).end()
        yield word.findall(text, at, end)
        at = end
