"""Row filters. Config lists become literal predicates, so none of these shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.dates import add_seconds, as_of_lit
from newsgrid.functions.text import as_col, contains_any, ws_clean


def item_time():
    return F.coalesce(F.col("published_at"), F.col("fetched_at"))


def recent_window(items: DataFrame, as_of: str, days: int = 7, grace_hours: int = 4) -> DataFrame:
    """Items dated (or, undated, fetched) since as_of − days − grace, with a title and a URL."""
    cutoff = add_seconds(as_of_lit(as_of), F.lit(-(days * 86400 + grace_hours * 3600)))
    return items.filter((item_time() >= cutoff) & (ws_clean("title") != "") & (ws_clean("url") != ""))


def retention_window(rows: DataFrame, as_of: str, days: int, column: str, keep_undated: bool) -> DataFrame:
    kept = F.col(column) >= add_seconds(as_of_lit(as_of), F.lit(-days * 86400))
    return rows.filter(F.col(column).isNull() | kept if keep_undated else kept)


def pool_retention(items: DataFrame, as_of: str, days: int) -> DataFrame:
    """Raw pool retention by calendar day; undated rows stay."""
    cutoff = F.date_sub(as_of_lit(as_of).cast("date"), days)
    return items.filter(F.col("published_date").isNull() | (F.col("published_date") >= cutoff))


def archive_retention(stories: DataFrame, as_of: str, days: int = 120) -> DataFrame:
    return retention_window(stories, as_of, days, "published_at", False).filter(F.col("category").isin(dims.CATEGORIES))


def drop_channels(items: DataFrame, retired) -> DataFrame:
    channel = F.col("source_channel")
    return items.filter(channel.isNull() | ~channel.isin(list(retired)))


def has_core_source(names, core=tuple(dims.CORE_SOURCES)):
    return F.arrays_overlap(as_col(names), F.array(*[F.lit(c) for c in core]))


def domain_relevance(clusters: DataFrame, text: str, names: str, terms=tuple(dims.DOMAIN_TERMS)) -> DataFrame:
    return clusters.filter(has_core_source(names) | contains_any(F.lower(ws_clean(text)), terms))


def min_title(items: DataFrame, length: int = 5) -> DataFrame:
    return items.filter(F.length(ws_clean("title")) >= length)


def link_candidates(links: DataFrame, words, hosts, index_names=("index.html", "index_1.html")) -> DataFrame:
    """Links whose text or href mentions the topic, on an allowed host, that are not index pages."""
    from newsgrid.functions.urls import host, path

    said = contains_any(F.lower("link_text"), words) | contains_any(F.lower("url"), words)
    name = F.lower(F.substring_index(path("url"), "/", -1))
    itself = F.rtrim("url", F.lit("/")) == F.rtrim("index_url", F.lit("/"))
    return links.filter(said & host("url").isin(list(hosts)) & ~name.isin(list(index_names)) & ~itself)


def completed_period(rows: DataFrame, column: str, as_of: str) -> DataFrame:
    return rows.filter(F.col(column) < as_of_lit(as_of).cast("date"))


def gap_window(rows: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return rows.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
