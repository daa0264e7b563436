"""RSS and Atom documents to item rows, parsed JVM-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.functions.dates import parse_date_multi
from newsgrid.functions.text import as_col, strip_html
from newsgrid.functions.urls import host, unwrap_redirect
from newsgrid.operators.dedupe import normalize_items

_ENTRY = (
    "struct<title:string,link:array<struct<_VALUE:string,_href:string>>,url:string,description:string,summary:string,content:string,"
    "pubDate:string,published:string,updated:string,date:string,author:struct<_VALUE:string>,creator:string,"
    "category:array<struct<_VALUE:string>>,source:struct<_VALUE:string>>"
)
_DOCUMENT = f"struct<channel:struct<item:array<{_ENTRY}>>,item:array<{_ENTRY}>,entry:array<{_ENTRY}>>"
_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}


def _first(*names):
    texts = [F.trim(F.coalesce(F.col(f"e.{n}"), F.lit(""))) for n in names]
    return F.coalesce(*[F.when(t != "", t) for t in texts], F.lit(""))


def resolve_source(channel, publisher, link, name, search_channel: str, wire=("reuters", "Reuters", "reuters_via_bing"), redirect_host="bing.com"):
    """(source, channel) of a row: search feeds name the publisher, and a known wire keeps its own name."""
    word, source, wire_channel = wire
    searched = as_col(channel) == search_channel
    publisher = strip_html(publisher)
    from_wire = searched & (host(unwrap_redirect(link, redirect_host)).contains(f"{word}.com") | F.lower(publisher).contains(word))
    return (
        F.when(from_wire, F.lit(source)).when(searched & (publisher != ""), publisher).otherwise(as_col(name)),
        F.when(from_wire, F.lit(wire_channel)).otherwise(as_col(channel)),
    )


def rss_entries(feeds: DataFrame) -> DataFrame:
    """One row per feed entry with its raw texts. ``feeds``: feed_id, name, channel, xml and more."""
    doc = F.from_xml("xml", _DOCUMENT, _OPTIONS)
    empty = F.array().cast(f"array<{_ENTRY}>")
    lists = [F.coalesce(F.col(f"_d.{p}"), empty) for p in ("channel.item", "item", "entry")]
    kept = [c for c in feeds.columns if c != "xml"]
    rows = feeds.select(*kept, doc.alias("_d")).select(*kept, F.posexplode(F.concat(*lists)).alias("pos", "e"))
    texts = F.filter(F.transform("e.link", lambda x: F.trim(F.coalesce(x["_VALUE"], F.lit("")))), lambda t: t != "")
    hrefs = F.filter(F.transform("e.link", lambda x: x["_href"]), lambda t: t.isNotNull() & (t != ""))
    cats = F.filter(F.transform("e.category", lambda x: F.trim(F.coalesce(x["_VALUE"], F.lit("")))), lambda t: t != "")
    return rows.select(
        *kept,
        "pos",
        _first("title").alias("title"),
        F.coalesce(F.get(texts, F.lit(0)), F.nullif(_first("url"), F.lit("")), F.get(hrefs, F.lit(0)), F.lit("")).alias("link"),
        _first("description", "summary", "content").alias("summary"),
        _first("pubDate", "published", "updated", "date").alias("date_text"),
        _first("author._VALUE", "creator").alias("author"),
        F.coalesce(cats, F.array().cast("array<string>")).alias("categories_raw"),
        _first("source._VALUE").alias("publisher"),
    )


def rss_items(feeds: DataFrame, search_channel: str = "bing_news_rss", fetched_at: str | None = None) -> DataFrame:
    """Normalised raw items of RSS 2.0, RDF and Atom documents."""
    source, channel = resolve_source("channel", "publisher", "link", "name", search_channel)
    items = rss_entries(feeds).withColumns(
        {
            "source": source,
            "source_channel": channel,
            "url": F.col("link"),
            "published_at": parse_date_multi("date_text"),
            "region_raw": F.lit(""),
        }
    )
    return normalize_items(items).drop("link", "date_text", "publisher", "name", "channel")
