"""Language identification with a string kernel.

The kernel of two texts is the cosine of their presence vectors over the blended spectrum of 1- to 3-grams of lower-cased
characters. Kernel ridge regression, one language against the rest, is fitted in the Nystroem space of a few landmark
texts. A text is kept as the list of its n-grams' cells in a large hashed space; landmarks only have columns for the cells
they hold. A kernel value is the product of a text's presence with a landmark's, and the ridge scores are linear in kernel
values: landmarks, whitening and ridge weights are multiplied once, and a batch of texts is scored by one matrix product
of its presence with the result, one column a language.
"""

from __future__ import annotations

import unicodedata
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

#: n-gram lengths, and the size of the space presence is hashed to.
GRAMS, BITS = (1, 2, 3), 22
DIM = 1 << BITS
#: Bounds of the fit: labelled texts of a language, and landmarks of a language.
PER_LANG, LANDMARKS = 300, 40
RIDGE, TEMPERATURE = 1e-2, 0.15
#: Texts whose n-grams are kept together, and numbers of a dense batch of them.
BATCH, AT_ONCE = 256, 1 << 24
UNDETERMINED = "und"
#: Odd multipliers that hash a character, by its place in the n-gram.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


#: Lengths of the runs of code points that are not, are, are not ... letters or their marks.
_RUNS = np.array([len(list(g)) for _, g in groupby(range(0x110000), lambda c: unicodedata.category(chr(c))[0] in "LM")])


def letters() -> np.ndarray:
    """Whether a code point is a letter or a mark of one, of each."""
    return np.repeat(np.arange(len(_RUNS)) % 2 == 1, _RUNS)


def hashed(text: str, known: np.ndarray):
    """Cells of the n-grams of the whole text, by n-gram length and piece; runs of non-letters count as one space."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = known[code]
    code = np.where(inside, code, 32)[inside | np.concatenate([[True], inside[:-1]])[: len(code)]]
    step = 1 << 16
    for at in range(0, len(code), step):  # long texts in pieces that overlap by what an n-gram spans
        part = code[at : at + step + max(GRAMS) - 1].astype(np.uint64)
        total = np.zeros(len(part), np.uint64)
        for n in GRAMS:
            total = total[: len(part) - n + 1] + part[n - 1 :] * _MIX[n - 1]
            if len(total):
                yield ((total ^ (total >> np.uint64(29))) * _MIX[0]) >> np.uint64(64 - BITS)


def presence(text: str, out: np.ndarray) -> None:
    """Sets the hashed n-grams of the whole text in ``out``; runs of non-letters count as one space."""
    for found in hashed(text, letters()):
        out[found] = 1


def cells(texts) -> list[np.ndarray]:
    """The ascending cells of each text; a long one marks them in a table, so that memory is bounded by DIM."""
    known, out = letters(), []
    for t in texts:
        if len(t) < 1 << 16:
            out.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed(t, known)])).astype(np.int32))
        else:
            table = np.zeros(DIM, bool)
            for found in hashed(t, known):
                table[found] = True
            out.append(np.flatnonzero(table).astype(np.int32))
    return out


def batch(texts) -> np.ndarray:
    """Dense rows of a few texts."""
    rows = np.zeros((len(texts), DIM), np.float32)
    for row, own in zip(rows, cells(texts)):
        row[own] = 1 / np.sqrt(max(len(own), 1))
    return rows


def products(rows: list[np.ndarray], held: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Normed presence of the rows times ``columns``, whose lines belong to the ascending cells ``held``: one matrix
    product for as many rows as AT_ONCE allows."""
    out, step = np.zeros((len(rows), columns.shape[1])), max(1, AT_ONCE // max(1, len(held)))
    dense = np.zeros((min(step, len(rows)), len(held)), np.float32)
    for lo in range(0, len(rows) if len(held) else 0, step):
        part = rows[lo : lo + step]
        sizes = np.array([len(own) for own in part])
        flat, row = np.concatenate(part), np.repeat(np.arange(len(part)), sizes)
        at = np.searchsorted(held, flat)
        hit = np.append(held, -1)[at] == flat
        dense[row[hit], at[hit]] = 1
        out[lo : lo + step] = (dense[: len(part)] @ columns) / np.sqrt(np.maximum(sizes, 1))[:, None]
        dense[row[hit], at[hit]] = 0
    return out


def fit(x: list[np.ndarray], langs: list[str]) -> dict:
    """Languages and the weights of cells, from rows of ``cells``. Landmarks are each language's first rows."""
    names = sorted(set(langs), key=lambda x: x.encode())
    if not names:
        return {"names": []}
    y = np.array(langs)
    own = [x[i] for n in names for i in np.flatnonzero(y == n)[:LANDMARKS]]
    held = np.unique(np.concatenate(own))
    marks = np.zeros((len(held), len(own)), np.float32)
    for j, row in enumerate(own):
        marks[np.searchsorted(held, row), j] = 1 / np.sqrt(max(len(row), 1))
    values, vectors = np.linalg.eigh(products(own, held, marks))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-6))
    z = products(x, held, marks) @ whiten
    z = np.hstack([z, np.ones((len(z), 1))])
    share = np.sqrt(1.0 / np.array([(y == n).sum() for n in y]))[:, None]  # languages weigh the same
    signs = np.where(y[:, None] == np.array(names)[None, :], 1.0, -1.0)
    w = np.linalg.solve((z * share).T @ (z * share) + RIDGE * np.eye(z.shape[1]), (z * share).T @ (signs * share))
    return {"names": names, "cells": held, "weights": marks @ (whiten @ w[:-1]).astype(np.float32), "bias": w[-1]}


def predict(model: dict, texts: list) -> tuple[list[str], np.ndarray]:
    """Language and score (softmax of the ridge scores) of each text; UNDETERMINED and 0 for null and letterless ones."""
    names, langs, scores = model["names"], [UNDETERMINED] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))] if names else []
    for at in range(0, len(known), BATCH):
        own = known[at : at + BATCH]
        raw = products(cells([texts[i] for i in own]), model["cells"], model["weights"]) + model["bias"]
        soft = np.exp((raw - raw.max(1, keepdims=True)) / TEMPERATURE)
        soft /= soft.sum(1, keepdims=True)
        for i, best, p in zip(own, raw.argmax(1), soft):
            langs[i], scores[i] = names[best], p[best]
    return langs, scores


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most PER_LANG labelled texts of a language that are not held out, by a hash order; a bounded sample.

    Counts come first, so that a filter on the hash leaves few rows to rank.
    """
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 20))
    near = (rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place"),
                        F.col(id_col).alias("id"))
            .join(F.broadcast(counts), F.col("lang") == F.col("l"))  # one row a language
            .filter(F.col("place") * F.col("n") < 2 * PER_LANG * (1 << 20)))
    best = Window.partitionBy("lang").orderBy("place", "id", "text")
    return near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= PER_LANG).select("lang", "text", "r")


def packed_cells(texts: pd.Series) -> pd.Series:
    """Cells of whole texts: at most 4 bytes a distinct n-gram."""
    return pd.Series([own.tobytes() for own in cells(list(texts))])


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    rows = training_rows(docs, id_col, text_col, lang_col).select("lang", "r", F.pandas_udf(packed_cells, "binary")("text").alias("cells"))
    got = sorted(rows.collect(), key=lambda r: (r["lang"], r["r"]))
    return fit([np.frombuffer(r["cells"], np.int32) for r in got], [r["lang"] for r in got])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             keep: bool = False, model: dict | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; with ``keep`` also ``row``, the row's own columns.

    A null or letterless text gets ``und`` and score 0, as does every text if there is nothing to learn from. A null id
    is not held out. Repeated rows get the same answer; other columns are not looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(model or trained(docs, id_col, text_col, lang_col))  # the landmarks' cells x languages floats
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text_"), *([F.struct(*docs.columns).alias("row")] if keep else []))

    @F.pandas_udf("lang_pred string, score double")
    def tell(texts: pd.Series) -> pd.DataFrame:
        langs, scores = predict(held.value, list(texts))
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    out = rows.withColumn("told", tell("text_"))
    return out.select("doc_id", "held_out", "told.lang_pred", "told.score", *(["row"] if keep else []))


#: A score below this many times that of a blind guess among the learned languages says nothing.
LEAST_TIMES = 1.2


def accepted(docs: DataFrame, times: float = LEAST_TIMES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows in a known language, with their columns; the least score follows the number of learned languages."""
    model = trained(docs, id_col, text_col, lang_col)
    told = identify(docs, id_col, text_col, lang_col, True, model)
    least = min(times / max(1, len(model["names"])), 0.5)
    return told.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("row.*")
