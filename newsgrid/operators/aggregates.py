"""Counts, rates and summaries. Every grouped form is a plain aggregate with map-side combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.functions.dates import as_of_lit, seconds_between


def count_by(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    key = F.coalesce(F.col(column), F.lit("Unknown")).alias(column)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(column)


def source_mentions(stories: DataFrame) -> DataFrame:
    return count_by(stories.select(F.explode("source_names").alias("name")), "name", "mentions")


def priority_mentions(stories: DataFrame) -> DataFrame:
    named = stories.select(F.explode("priority_matches").alias("m")).select(F.col("m.name").alias("name"))
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("mentions")).orderBy(F.desc("mentions"), "name")


def feed_stats(stories: DataFrame, annotated: str = "annotated") -> DataFrame:
    return stories.agg(
        F.count(F.lit(1)).alias("stories"),
        F.count_if("critical").alias("critical_stories"),
        F.count_if(F.size("priority_matches") > 0).alias("priority_stories"),
        F.count_if("score_components.macro_related").alias("macro_stories"),
        F.count_if(F.col("ai_mode") == annotated).alias("annotated_stories"),
        F.count_if(F.col("ai_mode") != annotated).alias("fallback_stories"),
    )


def filtered_totals(stories: DataFrame) -> DataFrame:
    return feed_stats(stories).select("stories", "critical_stories", "priority_stories", "macro_stories")


def health_rollup(checks: DataFrame) -> DataFrame:
    """Per kind: totals, healthy and failed checks, transport successes and their share."""
    return checks.groupBy("kind").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count_if("transport_ok").alias("transport_ok"),
        F.count_if(F.col("transport_ok") & F.col("has_records")).alias("content_ok"),
        F.bround(F.count_if("transport_ok") / F.count(F.lit(1)), 4).alias("transport_ratio"),
    )


def freshness_by_source(items: DataFrame, as_of: str) -> DataFrame:
    newest = items.filter(F.col("published_at").isNotNull()).groupBy(F.lower("source").alias("source")).agg(
        F.max("published_at").alias("newest")
    )
    return newest.select(
        "source", F.bround(seconds_between(as_of_lit(as_of), F.col("newest")) / F.lit(86400.0), 2).alias("age_days")
    )


def series_extent(obs: DataFrame, keys=("series",)) -> DataFrame:
    return obs.groupBy(*keys).agg(
        F.min("obs_date").alias("first_date"),
        F.max("obs_date").alias("last_date"),
        F.count(F.lit(1)).alias("observations"),
        F.min_by("value", "obs_date").alias("first_value"),
        F.max_by("value", "obs_date").alias("last_value"),
    )


def observation_type_counts(obs: DataFrame) -> DataFrame:
    kind = F.col("observation_type")
    return obs.agg(
        F.count(F.lit(1)).alias("parsed"),
        F.count_if(kind == "monthly_average").alias("monthly"),
        F.count_if(kind == "two_month_average").alias("two_month"),
    )


def backlog_ratio(stories: DataFrame, annotated: str = "annotated") -> DataFrame:
    fallback, total = F.count_if(F.col("ai_mode") != annotated), F.count(F.lit(1))
    return stories.agg(
        total.alias("total"),
        fallback.alias("fallback"),
        F.bround(fallback / F.greatest(F.lit(1), total), 4).alias("ratio"),
    )


def backfill_report(items: DataFrame, stops: DataFrame, cutoff: str) -> DataFrame:
    """Per source: unique records, those within the window, their date span and the stop reason."""
    day = F.col("published_date")
    inside = day.isNull() | (day >= F.lit(cutoff).cast("date"))
    per_source = items.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("records_parsed"),
        F.count_if(inside).alias("records_within"),
        F.min(F.when(inside, day)).alias("earliest"),
        F.max(F.when(inside, day)).alias("latest"),
    )
    return stops.join(per_source, "source_id", "left").na.fill(0, ["records_parsed", "records_within"])
