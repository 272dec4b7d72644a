"""Ensembles: three equal votes, and five weighted methods with sensitivity modes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.functions.scalars import date_range
from vitalgrid.operators import cluster, sigma
from vitalgrid.schema import KEYS
from vitalgrid.session import stored

METHODS = (("threshold_anomaly", "Rule-Based"), ("residual_anomaly", "Model-Based"),
           ("cluster_anomaly", "Cluster-Based"))


def vote(df: DataFrame, min_votes: int = 2) -> DataFrame:
    """``confidence_score`` and ``ensemble_anomaly`` from up to three flags; an absent method votes no.

    The strict variant that only flags unanimous rows is ``min_votes=3``.
    """
    flags = [F.coalesce(F.col(c), F.lit(False)).cast("int") for c, _ in METHODS if c in df.columns]
    votes = sum(flags, F.lit(0))
    return (df.withColumn("votes", votes)
            .withColumn("confidence_score", F.col("votes") / float(len(METHODS)))
            .withColumn("ensemble_anomaly", F.col("votes") >= min_votes))


def neighbours(df: DataFrame, part=KEYS, order=("ds",)) -> DataFrame:
    """Flagged rows among the 5 and the 7 rows around each row."""
    w = Window.partitionBy(*part).orderBy(*order)
    hit = F.col("ensemble_anomaly").cast("long")
    return (df.withColumn("near2", F.sum(hit).over(w.rowsBetween(-2, 2)))
            .withColumn("near3", F.sum(hit).over(w.rowsBetween(-3, 3))))


def severity(df: DataFrame) -> DataFrame:
    """Severity from confidence, one level up when another flagged row is close."""
    level = F.when(F.col("confidence_score") >= 0.95, 3).when(F.col("votes") >= 2, 2).otherwise(1)
    raised = F.least(F.lit(3), level + F.when(F.col("near2") > 1, 1).otherwise(0))
    name = F.when(raised == 3, "High").when(raised == 2, "Medium").otherwise("Low")
    return df.withColumn("severity", F.when(F.col("ensemble_anomaly"), name).otherwise("Normal"))


def anomaly_type(df: DataFrame) -> DataFrame:
    kind = (F.when(F.col("near3") >= 3, "Collective").when(F.col("near3") == 1, "Point")
            .otherwise("Contextual"))
    return df.withColumn("anomaly_type", F.when(F.col("ensemble_anomaly"), kind).otherwise("None"))


def reason(df: DataFrame) -> DataFrame:
    names = F.concat_ws(", ", *[F.when(F.col(c), label) for c, label in METHODS if c in df.columns])
    text = F.concat(F.lit("Detected by: "), F.when(names == "", "Unknown").otherwise(names))
    return df.withColumn("ensemble_reason", F.when(F.col("ensemble_anomaly"), text).otherwise(""))


def score(df: DataFrame, min_votes: int = 2, part=KEYS, order=("ds",)) -> DataFrame:
    """The voted ensemble: flag, confidence, severity, type, reason."""
    return reason(anomaly_type(severity(neighbours(vote(df, min_votes), part, order))))


@dataclass(frozen=True)
class Sensitivity:
    """Score limits of the severities and the votes a flag needs."""

    name: str
    low: float
    medium: float
    high: float
    min_votes: int
    min_score: float


# Modes, method weights and explanation sentences.
BALANCED = Sensitivity("Balanced (recommended)", 0.3, 0.7, 0.85, 1, 0.3)
CATCH_MORE = Sensitivity("catch more anomalies", 0.25, 0.55, 0.8, 1, 0.0)
ONLY_STRONG = Sensitivity("only strong anomalies", 0.5, 0.7, 0.9, 2, 0.7)
WEIGHTS = {"is_outlier": 0.4, "is_spike": 0.3, "is_breach": 0.4, "is_small": 0.3, "is_noise": 0.4}
TEXT_OUTLIER = "Unusually high or low compared with your typical values."
TEXT_JUMP_UP = "Sudden jump up compared with the previous day."
TEXT_DROP = "Sudden drop compared with the previous day."
TEXT_BREACH = "Outside the forecast range predicted from your past data."
TEXT_SMALL = "Unusual pattern compared with your typical days."
TEXT_NOISE = "Isolated behaviour that does not fit nearby days."
TEXT_UNFLAGGED = "Not flagged as an anomaly."


def gate(daily_df: DataFrame, start=None, end=None, min_points: int = 5, keys=KEYS) -> DataFrame:
    """Date window, then only series that still have ``min_points`` valid rows."""
    window = date_range(daily_df.where(F.col("y").isNotNull()), start, end)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return window.withColumn("_n", n).where(F.col("_n") >= min_points).drop("_n")


# Points a series needs before its mean and spread, or its clusters and forecast, say anything.
FEW, ENOUGH = 3, 20


def method_status(n: Column, std: Column, min_points: int = ENOUGH) -> Column:
    """Which of the five methods a series has points for."""
    return (F.when(n < FEW, "too few points").when(F.coalesce(std, F.lit(0.0)) <= 0, "constant series")
            .when(n < min_points, "outliers and spikes only").otherwise("all methods"))


def detect_methods(daily_df: DataFrame, min_points: int = ENOUGH, keys=KEYS) -> DataFrame:
    """The five methods on every series; all valid rows stay.

    A method that lacks points or variance votes no, and ``method_status`` says
    why. The daily table is read twice, so it is stored.
    """
    base = stored(sigma.moments(daily_df.where(F.col("y").isNotNull()), keys), "daily")
    base = base.withColumn("method_status", method_status(F.col("n"), F.col("std"), min_points))
    full, some = F.col("method_status") == "all methods", F.col("n") >= FEW
    able = cluster.plane(base.where(full), keys)
    noise = cluster.noise_points(able, keys=keys)
    banded = sigma.band_breaches(sigma.spikes(sigma.outliers(base), keys=keys), min_points, keys)
    judged = banded.withColumns({"is_outlier": F.col("is_outlier") & some, "is_spike": F.col("is_spike") & some,
                                 "is_breach": F.col("is_breach") & full})
    clustered = cluster.mark_small(cluster.plane(judged, keys), cluster.cluster_days(able, keys=keys), keys=keys)
    return cluster.mark_noise(clustered, noise, keys)


def weigh(df: DataFrame, keys=KEYS) -> DataFrame:
    """``votes``, ``score`` (share of the series' best) and ``type`` from the five flags."""
    votes = sum((F.col(c).cast("int") for c in WEIGHTS), F.lit(0))
    raw = sum((F.when(F.col(c), w).otherwise(0.0) for c, w in WEIGHTS.items()), F.lit(0.0))
    best = F.max("_raw").over(Window.partitionBy(*keys))
    kind = (F.when(F.col("is_noise") | F.col("is_small"), "Collective").when(F.col("is_spike"), "Contextual")
            .when(F.col("is_outlier"), "Point").otherwise("Normal"))
    return (df.withColumn("votes", votes).withColumn("_raw", raw).withColumn("_best", best)
            .withColumn("score", F.when(F.col("_best") > 0, F.col("_raw") / F.col("_best")).otherwise(0.0))
            .withColumn("type", kind).drop("_raw", "_best"))


def flag(df: DataFrame, mode: Sensitivity = BALANCED) -> DataFrame:
    """``is_anom`` by sensitivity; step series always include band breaches."""
    near = 1e-9
    base = (F.col("votes") >= mode.min_votes) & (F.col("score") >= mode.min_score - near)
    steps = F.lower("metric").contains("step") & F.col("is_breach")
    return df.withColumn("is_anom", base | steps)


def grade(df: DataFrame, mode: Sensitivity = BALANCED) -> DataFrame:
    """``severity`` of flagged rows."""
    near = 1e-9
    level = (F.when(F.col("score") < mode.medium - near, "Low").when(F.col("score") < mode.high - near, "Medium")
             .otherwise("High"))
    return df.withColumn("severity", F.when(F.col("is_anom"), level).otherwise("Normal"))


def explain(df: DataFrame) -> DataFrame:
    """``explanation``: the reasons in method order and the severity."""
    reasons = F.array_distinct(F.array_compact(F.array(
        F.when(F.col("is_outlier"), TEXT_OUTLIER),
        F.when(F.col("is_spike"), F.when(F.col("change") > 0, TEXT_JUMP_UP).otherwise(TEXT_DROP)),
        F.when(F.col("is_breach"), TEXT_BREACH),
        F.when(F.col("is_small"), TEXT_SMALL),
        F.when(F.col("is_noise"), TEXT_NOISE))))
    text = F.concat(F.array_join(reasons, "; "), F.lit(" (Severity: "), F.col("severity"), F.lit(")."))
    return df.withColumn("explanation", F.when(F.col("is_anom"), text).otherwise(TEXT_UNFLAGGED))


def detect(daily_df: DataFrame, mode: Sensitivity = BALANCED, min_points: int = ENOUGH, keys=KEYS) -> DataFrame:
    """The scored ensemble from daily series to explained, graded flags."""
    return explain(grade(flag(weigh(detect_methods(daily_df, min_points, keys), keys), mode), mode))
