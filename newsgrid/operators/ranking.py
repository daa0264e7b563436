"""Feed order, top lists and work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgrid import dims


def feed_order():
    return [F.desc("importance_score"), F.desc_nulls_last("published_at"), F.asc("id")]


def newest_order():
    return [F.desc_nulls_last("published_at"), F.desc("importance_score"), F.asc("id")]


def rank_feed(stories: DataFrame) -> DataFrame:
    return stories.orderBy(*feed_order())


def rank_newest(stories: DataFrame) -> DataFrame:
    return stories.orderBy(*newest_order())


def top_feed(stories: DataFrame, k: int = 10) -> DataFrame:
    """Leading ``k`` stories with their place; a per-task top-k, never a global sort."""
    top = stories.orderBy(*feed_order()).limit(k)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*feed_order())))


def top_critical(stories: DataFrame, k: int = 10) -> DataFrame:
    return top_feed(stories.filter("critical"), k)


def work_queue(rows: DataFrame, order, cap: int, batch: int) -> DataFrame:
    """First ``cap`` rows in order, numbered and cut into batches."""
    top = rows.orderBy(*order).limit(cap)
    place = F.row_number().over(Window.orderBy(*order))
    return top.withColumn("place", place).withColumn("batch", F.floor((F.col("place") - 1) / batch).cast("int") + 1)


def annotation_queue(pending: DataFrame, cap: int = 260, batch: int = 16) -> DataFrame:
    order = [F.desc(F.col("in_current").cast("int")), F.desc("importance_score"), F.desc_nulls_last("published_at"), F.asc("id")]
    return work_queue(pending, order, cap, batch)


def backfill_queue(stories: DataFrame, cap: int = 240, batch: int = 6, annotated: str = "annotated") -> DataFrame:
    """Stories still on rule analysis, or carrying the template summary, most useful first."""
    generic = F.coalesce(F.col("summary_zh"), F.lit("")).startswith(dims.SUMMARY_PREFIX)
    todo = stories.filter((F.coalesce(F.col("ai_mode"), F.lit("")) != annotated) | generic)
    order = [
        F.desc(F.col("in_current").cast("int")),
        F.desc((F.size("priority_matches") > 0).cast("int")),
        F.desc("importance_score"),
        F.desc_nulls_last("published_at"),
        F.asc("id"),
    ]
    return work_queue(todo, order, cap, batch)


def latest_valid_bar(bars: DataFrame, keys, value: str, ts: str) -> DataFrame:
    valid = bars.filter(F.col(value).isNotNull())
    return valid.groupBy(*keys).agg(
        F.max_by(F.round(value, 4), F.struct(ts, "event_id")).alias("price"), F.max(ts).alias("price_ts")
    )


def page_scan_stop(crawl: DataFrame, cutoff: str, max_pages: int) -> DataFrame:
    """Pages a paged crawl keeps and why it ends, per source.

    ``crawl``: source_id, page, url (null on an empty page), published_date. A page ends the scan
    when it is empty, repeats an earlier page's URL set, or holds a date before ``cutoff``; only the
    last kind is itself kept. The URL set is compared by count and an order-free hash sum, so each
    page's URLs combine map-side and are never gathered.
    """
    word = F.conv(F.substring(F.sha2(F.coalesce("url", F.lit("")), 256), 1, 15), 16, 10).cast("decimal(20,0)")
    pages = crawl.filter(F.col("page") <= max_pages).groupBy("source_id", "page").agg(
        F.count("url").alias("n_urls"), F.sum(word).alias("signature"), F.min("published_date").alias("oldest")
    )
    seen = Window.partitionBy("source_id", "n_urls", "signature").orderBy("page")
    marked = pages.withColumn("repeat", F.row_number().over(seen) > 1)
    reason = (
        F.when(F.col("n_urls") == 0, F.lit("empty_page"))
        .when(F.col("repeat"), F.lit("repeated_page"))
        .when(F.col("oldest") < F.lit(cutoff).cast("date"), F.lit("cutoff_reached"))
    )
    marked = marked.withColumn("reason", reason)
    first = F.struct("page", "reason")
    stops = marked.groupBy("source_id").agg(
        F.min(F.when(F.col("reason").isNotNull(), first)).alias("stop"), F.max("page").alias("last_page")
    )
    return stops.select(
        "source_id",
        F.when(F.col("stop.reason") == "cutoff_reached", F.col("stop.page"))
        .when(F.col("stop").isNotNull(), F.col("stop.page") - 1)
        .otherwise(F.col("last_page"))
        .alias("kept_to"),
        F.coalesce("stop.reason", F.lit("max_pages")).alias("stop_reason"),
    )
