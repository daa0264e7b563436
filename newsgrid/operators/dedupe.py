"""Exact de-duplication and key lookups.

``first_per_key`` keeps one row per key with a rank filter: Spark plans a per-task group limit
before the shuffle, so a key holding a third of all rows sends one row per task over the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgrid.functions import ids
from newsgrid.functions.dates import format_iso_utc
from newsgrid.functions.text import as_col, strip_html, title_norm, truncate, ws_clean
from newsgrid.functions.urls import canonical_url, unwrap_redirect
from newsgrid.operators.filters import drop_channels, pool_retention


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def completeness():
    present = [F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in ("published_at", "summary", "author", "region_raw")]
    lists = F.coalesce(F.size("categories_raw"), F.lit(0))
    return sum((p.cast("int") for p in present), F.lit(0)) + F.greatest(lists, F.lit(0))


def item_key():
    canon = canonical_url("url")
    title = F.concat(F.lit("title:"), title_norm(strip_html("title")), F.lit("|"), F.coalesce(F.col("published_date").cast("string"), F.lit("")))
    return F.when(canon != "", F.concat(F.lit("url:"), canon)).otherwise(title)


def dedupe_best(items: DataFrame, order=("doc_id",)) -> DataFrame:
    """One row per canonical URL (else title and day): the most complete, the earliest on a tie."""
    keyed = items.withColumns({"_key": item_key(), "_score": completeness()})
    return first_per_key(keyed, ["_key"], [F.desc("_score"), *order]).drop("_key", "_score")


def pool_merge(stored: DataFrame, new: DataFrame, as_of: str, days: int, retired, order=("doc_id",)) -> DataFrame:
    """(stored − retired channels) ∪ new, de-duplicated with stored first on ties, within retention."""
    both = drop_channels(stored, retired).withColumn("_tier", F.lit(0)).unionByName(new.withColumn("_tier", F.lit(1)))
    return pool_retention(dedupe_best(both, ("_tier", *order)).drop("_tier"), as_of, days)


def normalize_items(items: DataFrame, redirect_host: str = "bing.com") -> DataFrame:
    """Clean the text fields, resolve the URL, keep titles of five characters or more, add the id."""
    cleaned = items.withColumns(
        {
            "title": strip_html("title"),
            "url": canonical_url(unwrap_redirect("url", redirect_host)),
            "summary": truncate(strip_html("summary")),
            "author": strip_html("author"),
            "region_raw": strip_html("region_raw"),
            "categories_raw": F.array_sort(
                F.array_distinct(F.filter(F.transform("categories_raw", strip_html), lambda x: x != ""))
            ),
            "published_date": F.col("published_at").cast("date"),
        }
    ).filter(F.length("title") >= 5)
    return cleaned.withColumn("id", ids.record_id("url", "title", format_iso_utc("published_at"), "source"))


def first_by_id(items: DataFrame, order=("doc_id",)) -> DataFrame:
    rid = F.when(ws_clean("id") != "", ws_clean("id")).otherwise(ids.fallback_rid("title", "url"))
    return first_per_key(items.withColumn("rid", rid), ["rid"], order)


def processed_ids(stories: DataFrame) -> DataFrame:
    return stories.select(F.explode("raw_ids").alias("rid")).filter((F.col("rid") != "")).distinct()


def incremental_anti_join(items: DataFrame, archive: DataFrame) -> DataFrame:
    """Items whose id no archived story lists yet."""
    return items.join(processed_ids(archive), "rid", "left_anti")


def current_from_archive(enriched: DataFrame, current_ids: DataFrame) -> DataFrame:
    return enriched.join(current_ids.select("id").distinct(), "id", "left_semi")


def missing_ids(wanted: DataFrame, have: DataFrame) -> DataFrame:
    return wanted.select("id").distinct().join(have.select("id").distinct(), "id", "left_anti")


def candidate_cap(clusters: DataFrame, cap: int, order) -> DataFrame:
    """All core-source clusters plus the first others up to ``cap`` in total."""
    core = clusters.filter("is_core")
    n_core = core.agg(F.count(F.lit(1)).alias("_n_core"))
    others = clusters.filter(~F.col("is_core")).orderBy(*order).limit(cap)
    ranked = others.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))  # at most ``cap`` rows
    kept = ranked.crossJoin(F.broadcast(n_core)).filter(F.col("_rank") <= F.lit(cap) - F.col("_n_core"))
    return core.unionByName(kept.drop("_rank", "_n_core"))


def best_by_priority(rows: DataFrame, keys, priority, order) -> DataFrame:
    """One row per key: highest priority, then first in order."""
    return first_per_key(rows, keys, [as_col(priority).desc(), *order])
