"""Stable identifiers and content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgrid.functions.text import as_col, non_empty, strip_html, title_norm, ws_clean
from newsgrid.functions.urls import canonical_url


def record_id(url, title, published_text, source) -> Column:
    canon = canonical_url(url)
    parts = F.concat_ws(
        "|",
        title_norm(strip_html(title)),
        F.coalesce(as_col(published_text), F.lit("")),
        F.coalesce(as_col(source), F.lit("")),
    )
    return F.substring(F.sha2(F.when(canon != "", canon).otherwise(parts), 256), 1, 24)


def fallback_rid(title, url) -> Column:
    return F.substring(F.sha1(F.concat(title_norm(title), F.lit("|"), ws_clean(url))), 1, 24)


def story_id(raw_ids, title, published_text) -> Column:
    ids = F.coalesce(as_col(raw_ids), F.array().cast("array<string>"))
    named = F.concat(title_norm(title), F.lit("|"), F.substring(F.coalesce(as_col(published_text), F.lit("")), 1, 10))
    base = F.when(F.size(ids) > 0, F.array_join(F.array_sort(ids), "|")).otherwise(named)
    return F.substring(F.sha1(base), 1, 18)


def _quote(c: Column) -> Column:
    escaped = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _json_list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(values), _quote), ", "), F.lit("]"))


def content_fingerprint(title, category, region, entities, raw_ids, source_names, source_urls) -> Column:
    """SHA-1 over the key-sorted JSON text of the story's content, first 20 hex digits."""
    empty = F.array().cast("array<string>")
    arr = lambda x: F.coalesce(as_col(x), empty)
    sources = F.zip_with(
        arr(source_names), arr(source_urls), lambda n, u: F.concat(ws_clean(n), F.lit("|"), ws_clean(u))
    )
    body = F.concat(
        F.lit('{"category": '), _quote(ws_clean(category)),
        F.lit(', "entities": '), _json_list(non_empty(F.transform(arr(entities), ws_clean))),
        F.lit(', "raw_ids": '), _json_list(arr(raw_ids)),
        F.lit(', "region": '), _quote(ws_clean(region)),
        F.lit(', "sources": '), _json_list(sources),
        F.lit(', "title": '), _quote(ws_clean(title)),
        F.lit("}"),
    )
    return F.substring(F.sha1(body), 1, 20)
