"""Toxicity as an ordinal grade: a cumulative-link (proportional odds) regression on the words that occur in a text.

One weight vector serves all thresholds: P(grade >= k) = sigmoid(x.w - theta_k) with theta_1 < theta_2, and the expected
severity is the sum of these over k. Labels tell toxic from not; the grades that are fitted part the toxic texts once
more: 0 not toxic, 1 toxic, 2 toxic with more words that mark toxic texts than the median of them.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from vitalgrid.session import stored

#: Bounds of the fit: labelled texts of either label, and words in the vocabulary.
PER_LABEL, VOCABULARY = 3000, 5000
#: A word counts if its shares of toxic and other texts differ by so many standard errors, in so many texts at least.
LEAST_Z, LEAST_TEXTS = 6.0, 4
L2, ROUNDS, STEP = 1e-3, 400, 0.1
#: Inflected words share their first letters.
STEM = 5
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of a text, and the stems (first STEM letters and a hyphen) of its longer ones."""
    words = set(LETTERS.findall(text.lower())) if text else set()
    return words | {w[:STEM] + "-" for w in words if len(w) > STEM}


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(docs: list[list[int]], grades: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by Adam on the mean log loss of all thresholds; word ids are below ``words``."""
    top = int(grades.max()) if len(grades) else 0
    w, gaps = np.zeros(words), np.zeros(max(top, 1))  # thresholds: gaps[0], then plus exp of the rest
    flat, rows = np.concatenate([np.array(d, np.int64) for d in docs]), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    weight = np.full(len(docs), 1 / len(docs))
    moments = [np.zeros(words + len(gaps)), np.zeros(words + len(gaps))]
    for t in range(1, ROUNDS + 1):
        theta = gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))])
        score = np.bincount(rows, w[flat], len(docs))
        upper = np.concatenate([theta, [np.inf]])[grades]
        lower = np.concatenate([[-np.inf], theta])[grades]
        pu, pl = sigmoid(upper - score), sigmoid(lower - score)
        p, du, dl = np.maximum(pu - pl, 1e-12), pu * (1 - pu), pl * (1 - pl)
        d_score = weight * (du - dl) / p
        d_theta = np.array([-(weight * du / p)[grades == k].sum() + (weight * dl / p)[grades == k + 1].sum()
                            for k in range(top)])
        d_gaps = np.array([d_theta[k:].sum() * (1 if k == 0 else np.exp(gaps[k])) for k in range(top)])
        g = np.concatenate([np.bincount(flat, d_score[rows], words) + L2 * w, d_gaps])
        for m, x, b in ((0, g, 0.9), (1, g * g, 0.999)):
            moments[m] = b * moments[m] + (1 - b) * x
        move = STEP * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-8)
        w, gaps = w - move[:words], gaps - move[words:]
    return w, gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))])


def vocabulary_words(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(words_of(t)))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """At most PER_LABEL texts of either label by a hash order; a document with several labels is toxic if one says so."""
    marked = (labels.filter(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("g_id"))
              .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y")).withColumn("place", F.pmod(F.xxhash64("g_id", F.lit(5)), F.lit(1 << 20))))
    counts = marked.groupBy(F.col("y").alias("c_y")).agg(F.count("*").alias("n"))
    near = (marked.join(F.broadcast(counts), F.col("y") == F.col("c_y"))  # two rows; leaves about twice the bound to rank
            .filter(F.col("place") * F.col("n") < 2 * PER_LABEL * (1 << 20)))
    chosen = (near.withColumn("r", F.row_number().over(Window.partitionBy("y").orderBy("place", "g_id")))
              .filter(F.col("r") <= PER_LABEL))
    ids = F.broadcast(chosen.select("g_id", "y", "r"))  # 2 * PER_LABEL ids at most
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, F.col("id") == F.col("g_id"))
    return own.groupBy("y", "r").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one text of a repeated id


def trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[dict, np.ndarray]:
    rows = stored(training_rows(docs, labels, id_col, text_col).select("y", "r", F.pandas_udf(vocabulary_words, "array<string>")("text").alias("words")),
                  "toxicity-sample")
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(n) < 2:
        return {}, np.array([40.0])
    share = [F.count_if(F.col("y") == y) / n[y] for y in (0, 1)]
    both = F.count("*") / (n[0] + n[1])
    z = (share[1] - share[0]) / F.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))
    telling = (rows.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), z.alias("z"))
               .filter((F.col("n") >= LEAST_TEXTS) & (F.abs("z") >= LEAST_Z)).orderBy(F.desc(F.abs("z")), "word")
               .limit(VOCABULARY).collect())
    known = sorted(r["word"] for r in telling)
    marks = {r["word"] for r in telling if r["z"] > 0}
    has = F.array_intersect("words", F.array(*map(F.lit, known))) if known else F.array().cast("array<string>")
    got = sorted(rows.select("y", "r", has.alias("words")).collect(), key=lambda r: (r["y"], r["r"]))
    hits = np.array([len(marks.intersection(r["words"])) for r in got])
    y = np.array([r["y"] for r in got])
    grades = np.where(y == 0, 0, np.where(hits > np.median(hits[y == 1]), 2, 1))
    index = {x: i for i, x in enumerate(known)}
    w, theta = fit([[index[x] for x in sorted(r["words"])] for r in got], grades, len(known))
    return dict(zip(known, w.tolist())), theta


def severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade), grade (the likeliest), toxic (a grade of 1 or more is likelier than not).

    Whole texts count. Null and wordless texts have no features and get the severity of the thresholds alone; without
    toxic labels every severity is 0. Repeated rows get the same answer; other columns are not looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, id_col, text_col))

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def score(texts: pd.Series) -> pd.DataFrame:
        weights, theta = model.value
        known = weights.keys()
        x = np.array([sum(weights[v] for v in sorted(words_of(t) & known)) for t in texts])
        above = sigmoid(x[:, None] - theta[None, :])
        likely = np.argmax(np.hstack([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]]), axis=1)
        return pd.DataFrame({"severity": above.sum(1), "grade": likely.astype(np.int32), "toxic": above[:, 0] >= 0.5})

    told = docs.select(F.col(id_col).alias("doc_id"), score(text_col).alias("s"))
    return told.select("doc_id", "s.severity", "s.grade", "s.toxic")
