"""Report tables: one text column per series or user, put together by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.functions import ladders as L
from vitalgrid.functions.scalars import fixed, percent_label, thousands, weekday_name
from vitalgrid.functions.text import to_ascii
from vitalgrid.operators import sigma, stats
from vitalgrid.schema import KEYS, metric_title, metric_unit

RULE = "=" * 80

# Wording of this library.
ADVICE = """RECOMMENDATIONS

Now: keep recording and note what changed on unusual days.
Next two weeks: write down likely causes of unusual days and adjust routines to them.
Next three months: set targets, build habits that last, follow the trend.
See a professional if anomalies get frequent or severe, if a trend keeps worsening, or if you feel unwell.

DISCLAIMER
This report is for information only. It is no medical diagnosis and no treatment advice."""

# What a reader may check first, by a word of the metric's name.
CAUSES = (("heart", "sport, coffee, worry or fever on those days; ask a doctor if they come back"),
          ("step", "long walks, journeys, illness or days off"),
          ("sleep", "late evenings, journeys, illness or worry"))
OTHER_CAUSE = "what else happened on those days"


def lines(*parts) -> Column:
    """Join the parts that are not null with line breaks."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _with_place(daily_df: DataFrame, keys) -> DataFrame:
    return daily_df.withColumn("_b", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("ds").desc())))


def _fact_columns() -> list[Column]:
    mean_of = lambda cond: F.avg(F.when(cond, F.col("y")))
    return [F.count("y").alias("n"), F.avg("y").alias("mean"), F.percentile("y", 0.5).alias("median"),
            F.coalesce(F.stddev_samp("y"), F.lit(0.0)).alias("std"), F.min("y").alias("min"), F.max("y").alias("max"),
            F.when(F.count("y") >= 14, mean_of(F.col("_b") <= 7) - mean_of(F.col("_b").between(8, 14)))
            .otherwise(0.0).alias("recent_trend")]


def series_facts(daily_df: DataFrame, keys=KEYS) -> DataFrame:
    """Statistics and recent trend of each series: what the text blocks need."""
    return _with_place(daily_df, keys).groupBy(*keys).agg(*_fact_columns())


def metric_block(facts: DataFrame) -> DataFrame:
    """``block``: statistics and narrative of each series."""
    unit, mean, std, trend = metric_unit(F.col("metric")), F.col("mean"), F.col("std"), F.col("recent_trend")
    kind = F.lower("metric")
    number = lambda c: text(fixed(F.col(c), 2), " ", unit)
    head = lines(
        text("Metric: ", metric_title(F.col("metric"))),
        text("- Average: ", number("mean")), text("- Median: ", number("median")),
        text("- Standard Deviation: ", fixed(std, 2)),
        text("- Range: ", fixed(F.col("min"), 2), " - ", number("max")),
        text("- 7-Day Trend: ", L.trend_label(trend), " (", fixed(F.abs(trend), 2), " ", unit, ")"))
    score = text("- Consistency Score: ", fixed(L.consistency_score(std, mean), 1), "%")

    def either(cond: Column, yes: str, no: str) -> Column:
        return F.when(cond, yes).otherwise(no)

    heart = lines(
        text("Health Status: ", L.heart_status(mean), " at ", fixed(mean, 1), " bpm; 60-100 bpm is normal at rest."),
        score, text("- Pattern: ", either(L.is_stable(std, mean, 0.15), "stable", "variable")),
        text("- Recent trend: ", either(trend < 0, "beats per minute are going down",
                                        "beats per minute are not going down")),
        F.when(L.heart_emergency(mean), text("[EMERGENCY ALERT] Readings of ", fixed(F.col("min"), 0), "-",
                                             fixed(F.col("max"), 0), " bpm need a professional's attention.")))
    steps = lines(
        text("Activity Level: ", L.activity_level(mean), " at ", fixed(mean, 0),
             " steps per day; 10,000 are recommended."),
        score, text("- Pattern: ", either(L.is_stable(std, mean, 0.25), "even from day to day", "uneven from day to day")),
        text("- Recent trend: ", either(trend > 0, "more steps than the week before", "no more steps than the week before")))
    sleep = lines(
        text("Sleep Quality: ", L.sleep_quality(mean), " at ", fixed(mean, 1),
             " hours per night; 7-9 are recommended."),
        score, text("- Pattern: ", either(L.is_stable(std, mean, 0.15), "nights of much the same length",
                                          "nights of differing length")),
        text("- Recent trend: ", either(trend > 0, "longer nights than the week before", "nights no longer than the week before")))
    story = (F.when(kind.contains("heart"), heart).when(kind.contains("step"), steps)
             .when(kind.contains("sleep"), sleep))
    return facts.withColumn("block", lines(head, story))


def recent_outliers(daily_df: DataFrame, top: int | None = 5, keys=KEYS) -> DataFrame:
    """The latest outliers of each series, newest first, with their deviation; all of them without ``top``."""
    flagged = sigma.deviation(sigma.outliers(sigma.moments(daily_df, keys))).where("is_outlier")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("ds").desc()))
    ranked = flagged.withColumn("rank", rank).select(*keys, "rank", "ds", "y", "deviation")
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def _with_entries(daily_df: DataFrame, top: int, keys) -> DataFrame:
    """Days with ``is_outlier`` and, for the latest ``top`` outliers of a series, their line of text."""
    flagged = sigma.deviation(sigma.outliers(sigma.moments(daily_df, keys)))
    rank = F.sum(F.col("is_outlier").cast("int")).over(
        Window.partitionBy(*keys).orderBy(F.col("ds").desc()).rowsBetween(Window.unboundedPreceding, 0))
    listed = F.col("is_outlier") & (F.col("rank") <= top)
    entry = text(F.col("rank").cast("string"), ". Date: ", F.date_format("ds", "yyyy-MM-dd"), ", Value: ",
                 fixed(F.col("y"), 2), " ", metric_unit(F.col("metric")), ", Deviation: ",
                 fixed(F.col("deviation"), 2), " std_dev from mean")
    return flagged.withColumn("rank", rank).withColumn("_e", F.when(listed, F.struct("rank", entry.alias("line"))))


def _section_columns() -> list[Column]:
    return [F.count_if("is_outlier").alias("anomalies"), F.count(F.lit(1)).alias("_n"),
            F.array_sort(F.collect_list("_e")).alias("_list")]


def _section_text() -> Column:
    body = F.when(F.size("_list") > 0, lines(
        "Top Recent Anomalies:", F.array_join(F.transform("_list", lambda e: e["line"]), "\n"))
    ).otherwise("No day stands out.")
    share = fixed(F.col("anomalies") / F.col("_n") * 100, 2)
    return lines(text("Metric: ", metric_title(F.col("metric"))),
                 text("Anomalies Detected: ", F.col("anomalies").cast("string")),
                 text("Percentage of Data: ", share, "%"), body)


def anomaly_section(daily_df: DataFrame, top: int = 5, keys=KEYS) -> DataFrame:
    """``section``: number and share of outliers and the latest of them."""
    counts = _with_entries(daily_df, top, keys).groupBy(*keys).agg(*_section_columns())
    return counts.select(*keys, "anomalies", _section_text().alias("section"))


def with_advice(report: Column, context: str) -> Column:
    return lines(report, RULE, context, ADVICE)


def user_report(daily_df: DataFrame, metrics=None, analysis: bool = True, anomalies: bool = True,
                title: str = "Health Report", context: str = "Based on your metrics and anomalies:") -> DataFrame:
    """One ASCII report per user: blocks and sections of the chosen metrics in order, then advice."""
    chosen = daily_df if metrics is None else daily_df.where(F.col("metric").isin(*metrics))
    # facts and section of a series in one grouping: its days are read and shuffled once
    both = _with_place(_with_entries(chosen, 5, KEYS), KEYS).groupBy(*KEYS).agg(*_fact_columns(), *_section_columns())
    parts = metric_block(both.withColumn("section", _section_text()))
    grouped = parts.groupBy("user_id").agg(F.array_sort(F.collect_list(
        F.struct("metric", "block", "section"))).alias("_p"))

    def chapter(name: str, field: str) -> Column:
        return lines(RULE, name, F.array_join(F.transform("_p", lambda p: p[field]), "\n\n"))

    body = lines(title, chapter("ANALYSIS OVERVIEW", "block") if analysis else F.lit(None).cast("string"),
                 chapter("ANOMALIES OVERVIEW", "section") if anomalies else F.lit(None).cast("string"))
    return grouped.select("user_id", to_ascii(with_advice(body, context)).alias("report"))


def ensemble_report(per_series: DataFrame) -> DataFrame:
    """One line block per series from an ensemble summary."""
    count = lambda c: F.col(c).cast("string")
    return per_series.select(*KEYS, lines(
        text("### ", metric_title(F.col("metric"))),
        text("- Total Anomalies: ", count("total_anomalies")),
        text("- Avg Confidence: ", fixed(F.col("avg_confidence"), 3)),
        text("- Severity: HIGH=", count("high"), " | MEDIUM=", count("medium"), " | LOW=", count("low"))
    ).alias("report"))


def likely_cause(metric: Column) -> Column:
    out = F.lit(OTHER_CAUSE)
    for word, cause in reversed(CAUSES):
        out = F.when(F.lower(metric).contains(word), cause).otherwise(out)
    return out


def insight_card(flagged: DataFrame, keys=KEYS) -> DataFrame:
    """Summary card of each series: flagged days, causes, weekly or weekday pattern."""
    severe = lambda s: F.count_if(F.col("is_anom") & (F.col("severity") == s))
    counts = flagged.groupBy(*keys).agg(
        F.count_if("is_anom").alias("n_anom"), severe("High").alias("n_high"),
        severe("Medium").alias("n_medium"), severe("Low").alias("n_low"))
    daily_df = flagged.select(*keys, "ds", "y")
    kind = F.lower("metric")
    week = stats.recent_extremes(daily_df.where(kind.contains("step")), keys=keys)
    week = week.select(*keys, lines(
        text("Steps in the last ", F.col("days").cast("string"), " days:"),
        text("- most on ", weekday_name(F.col("max_ds")), " (", thousands(F.col("max_y")), ")"),
        text("- fewest on ", weekday_name(F.col("min_ds")), " (", thousands(F.col("min_y")), ")")
    ).alias("_week"))
    slept = daily_df.where(kind.contains("sleep"))
    hi, lo = F.col("max_hours"), F.col("min_hours")
    nights = stats.weekday_pattern(slept, keys).join(stats.recent_trend(slept, keys), list(keys)).select(
        *keys, lines(
            "Sleep by weekday:",
            F.when(F.abs(hi - lo) < 0.25, text("- near the same on every weekday: ",
                                               fixed((hi + lo) / 2, 1), " hours"))
            .otherwise(lines(text("- longest on ", F.col("max_weekday"), ": ", fixed(hi, 1), " hours"),
                             text("- shortest on ", F.col("min_weekday"), ": ", fixed(lo, 1), " hours"))),
            F.when(F.col("n") >= 14, L.sleep_trend_text(F.col("recent_trend")))).alias("_nights"))
    joined = counts.join(week, list(keys), "left").join(nights, list(keys), "left")
    return joined.select(*keys, lines(
        text("Flagged days: ", F.col("n_anom").cast("string")),
        text("- High: ", F.col("n_high").cast("string")), text("- Medium: ", F.col("n_medium").cast("string")),
        text("- Low: ", F.col("n_low").cast("string")), "",
        text("Look first at: ", likely_cause(F.col("metric"))),
        F.col("_week"), F.col("_nights")).alias("card"))


def recent_anomalies(flagged: DataFrame, top: int = 15, keys=KEYS) -> DataFrame:
    """The latest flagged days of each series with the score as a percentage."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("ds").desc()))
    return (flagged.where("is_anom").withColumn("rank", rank).where(F.col("rank") <= top)
            .select(*keys, "ds", "y", percent_label(F.col("score")).alias("score"), "type", "severity"))


def top_ensemble(scored: DataFrame, top: int = 10, keys=KEYS, order: str = "ds") -> DataFrame:
    """The flagged rows of highest confidence, oldest first among equals."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("confidence_score").desc(), order))
    return (scored.where("ensemble_anomaly").withColumn("rank", rank).where(F.col("rank") <= top)
            .select(*keys, "rank", order, "confidence_score", "severity", "anomaly_type", "ensemble_reason"))
