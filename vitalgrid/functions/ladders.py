"""Labels from numbers: health status, activity level, sleep quality, trend."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Fixed values throughout: limits and labels of each ladder.
def heart_status(mean: Column) -> Column:
    return F.when(mean > 100, "Elevated").when(mean >= 60, "Normal").when(mean.isNotNull(), "Low")


def heart_emergency(mean: Column) -> Column:
    return (mean > 120) | (mean < 40)


def activity_level(mean: Column) -> Column:
    return (F.when(mean < 5000, "Sedentary").when(mean < 7500, "Low Active")
            .when(mean < 10000, "Somewhat Active").when(mean < 12500, "Active")
            .when(mean.isNotNull(), "Very Active"))


def sleep_quality(mean: Column) -> Column:
    return (F.when(mean < 6, "Poor").when(mean < 7, "Good").when(mean <= 9, "Excellent")
            .when(mean.isNotNull(), "Too Much"))


def is_stable(std: Column, mean: Column, share: float) -> Column:
    return std < mean * share


def consistency_score(std: Column, mean: Column) -> Column:
    return 100 - std / F.greatest(mean, F.lit(1.0)) * 100


def trend_label(trend: Column) -> Column:
    """A trend of exactly zero counts as decreasing."""
    return F.when(trend > 0, "Increasing").otherwise("Decreasing")


def sleep_trend_text(diff: Column) -> Column:
    return (F.when(F.abs(diff) < 0.1, "Sleep duration is relatively stable over recent weeks.")
            .when(diff > 0, "Sleep duration is increasing in the most recent week.")
            .when(diff.isNotNull(), "Sleep duration is decreasing in the most recent week."))


def health_status(hr: Column, steps: Column, sleep: Column, missing: str = "Syncing Data") -> Column:
    """Struct(label, mood) of one day."""

    def pair(label: str, mood: str) -> Column:
        return F.struct(F.lit(label).alias("label"), F.lit(mood).alias("mood"))

    tired = F.coalesce(sleep < 5.5, F.lit(False)) | (hr > 95)
    balanced = (steps >= 10000) & sleep.between(7, 9) & hr.between(55, 85)
    return (F.when(hr.isNull() | steps.isNull(), pair(missing, "neutral"))
            .when(tired, pair("Needs Rest", "tired"))
            .when(steps < 3000, pair("Low Activity", "sleepy"))
            .when(F.coalesce(balanced, F.lit(False)), pair("Great Balance", "happy"))
            .otherwise(pair("On Track", "calm")))
