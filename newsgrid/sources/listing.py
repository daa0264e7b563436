"""Listing pages to item rows, as a structural join over tag positions.

A page is cut at its tags into numbered pieces, each a tag with the text behind it. Opening and closing tags
of a name pair up by their nesting level, so an element is an interval of pieces. The element around another is
the last one opened a level higher; dates are found once in a page's text, and an element holds one if the
first date behind its start ends before it does. The block of a link is the nearest of seven such elements
with a date, preferably a short one; texts are then cut out by intervals, only where they are used. All
of it is columns, windows within a page, and equi-joins, and grows with the number of tags.

A closing tag without an opening one is ignored, an element that is never closed holds nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.dates import LONG_DATE_RE, parse_date_multi
from newsgrid.functions.text import HIDDEN_MARKUP, html_unescape, strip_tags
from newsgrid.functions.urls import canonical_url, resolve
from newsgrid.operators.dedupe import first_per_key, normalize_items
from newsgrid.session import cut_lineage

VOID = "area base br col embed hr img input link meta param source track wbr".split()
AROUND = 7  # elements around a link that may be its block
SHORT_BLOCK = 1800
LEAST_TITLE, LEAST_PARAGRAPH = 8, 30
BIN = 64  # pieces of one join key
_MARK = "\u0001"
_EDGES = r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_TAG = r"""(?s)^(?:"[^"]*"|'[^']*'|[^'">])*>"""
_HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""


def pieces(pages: DataFrame) -> DataFrame:
    """(row, i, name, closing, tag, text, upto): numbered tags, the stripped text behind each, its end in the page's text."""
    shown = F.regexp_replace(F.coalesce("html", F.lit("")), HIDDEN_MARKUP, " ")
    cut = F.split(F.concat(F.lit("<x>"), shown), r"<(?=[!/?A-Za-z])")
    rows = pages.select("row", F.posexplode(cut).alias("i", "piece")).filter("i > 0")
    text = F.regexp_replace(html_unescape(F.regexp_replace("piece", _TAG, "")), _EDGES, "")
    named = rows.select(
        "row", "i", F.lower(F.regexp_extract("piece", r"^/?([A-Za-z][A-Za-z0-9:-]*)", 1)).alias("name"), F.col("piece").startswith("/").alias("closing"),
        F.regexp_extract("piece", _TAG, 0).alias("tag"), text.alias("text"),
    )
    size = F.when(F.col("text") == "", 0).otherwise(F.length("text") + 1)
    return named.withColumn("upto", F.sum(size).over(Window.partitionBy("row").orderBy("i")))


def elements(cut: DataFrame) -> DataFrame:
    """(row, name, o, c, tag, at, end, level, around): closed elements as intervals of pieces [o, c) and of text [at, end)."""
    by_name = Window.partitionBy("row", "name").orderBy("i")
    tags = cut.filter(~F.col("name").isin("", *VOID)).withColumn("sum", F.sum(F.when(F.col("closing"), -1).otherwise(1)).over(by_name))
    tags = tags.withColumn("least", F.least(F.min("sum").over(by_name), F.lit(0)))
    stray = F.col("closing") & (F.col("sum") < F.coalesce(F.lag("least").over(by_name), F.lit(0)))
    nested = tags.withColumn("stray", stray).withColumn("depth", F.col("sum") - F.col("least") + F.col("closing").cast("int")).filter("NOT stray")
    pair = Window.partitionBy("row", "name", "depth").orderBy("i")
    closed = nested.withColumn("c", F.lead("i").over(pair)).withColumn("ends", F.lead("upto").over(pair)).filter("NOT closing AND c IS NOT NULL AND name <> 'x'")
    size = F.when(F.col("text") == "", 0).otherwise(F.length("text") + 1)
    own = closed.select("row", "name", F.col("i").alias("o"), "c", "tag", (F.col("upto") - size).alias("at"))
    last = cut.select("row", F.col("i").alias("c"), (F.col("upto") - size).alias("end"))
    own = own.join(last, ["row", "c"])
    whole = cut.groupBy("row").agg((F.max("i") + 1).alias("c"), F.max("upto").alias("end"))
    whole = whole.select("row", F.lit("").alias("name"), F.lit(0).alias("o"), "c", F.lit("").alias("tag"), F.lit(0).cast("long").alias("at"), "end")
    every = own.unionByName(whole)
    steps = every.select("row", F.explode(F.array(F.struct(F.col("o").alias("i"), F.lit(1).alias("d")), F.struct(F.col("c").alias("i"), F.lit(-1).alias("d")))).alias("e")).select("row", "e.*")
    level = F.sum("d").over(Window.partitionBy("row").orderBy("i", "d"))
    levels = steps.withColumn("level", level).filter("d = 1").select("row", F.col("i").alias("o"), "level")
    return cut_lineage(with_around(every.join(levels, ["row", "o"])))


def with_around(held: DataFrame) -> DataFrame:
    """Adds ``around``: where the element around each one opens, the last opened a level higher."""
    as_outer = held.select("row", "level", "o", F.col("o").alias("outer"), F.lit(None).cast("int").alias("inner"))
    as_inner = held.select("row", (F.col("level") - 1).alias("level"), "o", F.lit(None).cast("int").alias("outer"), F.col("o").alias("inner"))
    opened = F.last("outer", ignorenulls=True).over(Window.partitionBy("row", "level").orderBy("o"))
    found = as_outer.unionByName(as_inner).withColumn("around", opened).filter("inner IS NOT NULL").select("row", F.col("inner").alias("o"), "around")
    return held.join(found, ["row", "o"])


def dated(cut: DataFrame, held: DataFrame) -> DataFrame:
    """Adds ``has_date`` to elements: dates are marked once in the page's text, the first behind each start decides."""
    texts = cut.filter("text <> ''").groupBy("row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]), " ").alias("page"))
    parts = texts.filter(F.col("page").rlike(DATE)).select("row", F.posexplode(F.split(F.regexp_replace("page", DATE, f"{_MARK}$0{_MARK}"), _MARK)).alias("k", "part"))
    upto = F.sum(F.length("part")).over(Window.partitionBy("row").orderBy("k"))
    dates = parts.withColumn("end", upto).filter("k % 2 = 1").select("row", (F.col("end") - F.length("part")).alias("at"), "end", F.lit(None).cast("int").alias("o"))
    asks = held.select("row", "at", F.lit(None).cast("long").alias("end"), "o")
    behind = Window.partitionBy("row").orderBy(F.desc("at"), F.col("o").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    first = dates.unionByName(asks).withColumn("date_end", F.min("end").over(behind)).filter("o IS NOT NULL").select("row", "o", "date_end")
    return held.join(first, ["row", "o"]).withColumn("has_date", F.coalesce(F.col("date_end") <= F.col("end"), F.lit(False))).drop("date_end")


DATE = LONG_DATE_RE.replace("(?iU)", "(?i)")


def binned(spans: DataFrame) -> DataFrame:
    return spans.withColumn("bin", F.explode(F.sequence(F.floor(F.col("o") / BIN).cast("int"), F.floor((F.col("c") - 1) / BIN).cast("int"))))


def texts_of(cut: DataFrame, spans: DataFrame) -> DataFrame:
    """(row, o, text) of spans of pieces: the texts within, joined by spaces."""
    told = cut.filter("text <> ''").select("row", "i", "text", F.floor(F.col("i") / BIN).cast("int").alias("bin"))
    met = binned(spans.select("row", "o", "c").distinct()).join(told, ["row", "bin"]).filter("i >= o AND i < c")
    return met.groupBy("row", "o").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]), " ").alias("text"))


def within(blocks: DataFrame, inner: DataFrame, name: str) -> DataFrame:
    """(row, o, name): the ``value`` structs of inner elements (row, at_piece, value) that open in each block, in order."""
    placed = inner.withColumn("bin", F.floor(F.col("at_piece") / BIN).cast("int"))
    met = binned(blocks.select("row", "o", "c").distinct()).join(placed, ["row", "bin"]).filter("at_piece >= o AND at_piece < c")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("at_piece", "value"))), lambda x: x["value"])
    return met.groupBy("row", "o").agg(listed.alias(name))


def href_of(tag: str) -> Column:
    return html_unescape(F.concat(*[F.regexp_extract(tag, _HREF, k) for k in (1, 2, 3)]))


def blocks_of(links: DataFrame, held: DataFrame) -> DataFrame:
    """``links`` (row, o, around) with their block as (bo, bc)."""
    outer = held.select("row", F.col("o").alias("around"), F.col("c").alias("_c"), F.col("around").alias("_next"), "has_date", (F.col("end") - F.col("at") - 1).alias("size"))
    chain = links.select("row", "o", "around")
    rings = []
    for k in range(1, AROUND + 1):
        ring = chain.join(outer, ["row", "around"])
        rings.append(ring.select("row", "o", F.struct("has_date", (F.col("has_date") & (F.col("size") < SHORT_BLOCK)).alias("short"), F.lit(k).alias("k"), F.col("around").alias("bo"), F.col("_c").alias("bc")).alias("b")))
        chain = ring.filter("_next IS NOT NULL").select("row", "o", F.col("_next").alias("around"))
    every = reduce(DataFrame.unionByName, rings)
    # The nearest short one with a date, else the farthest with one, else the nearest.
    order = F.struct(~F.col("b.short"), ~F.col("b.has_date"), F.when(F.col("b.has_date") & ~F.col("b.short"), -F.col("b.k")).otherwise(F.col("b.k")))
    best = every.groupBy("row", "o").agg(F.min_by("b", order).alias("b"))
    return links.join(best.select("row", "o", "b.bo", "b.bc"), ["row", "o"])


def listing_links(pages: DataFrame, marker: str = "/article/") -> DataFrame:
    """(page_id, page_url, pos, href, title, block, categories_raw, summary) of each article link of each page."""
    rows = cut_lineage(pages.select(F.monotonically_increasing_id().alias("row"), "page_id", F.col("url").alias("page_url"), "html"))
    cut = cut_lineage(pieces(rows))
    held = cut_lineage(dated(cut, elements(cut)))
    anchors = held.filter("name = 'a'").withColumn("href", href_of("tag")).filter("href <> ''")
    titles = texts_of(cut, anchors)
    anchors = cut_lineage(anchors.join(titles.withColumnRenamed("text", "title"), ["row", "o"]))
    links = anchors.filter(F.col("href").contains(marker) & (F.length("title") >= LEAST_TITLE))
    links = cut_lineage(blocks_of(links.select("row", "o", "around", "href", "title"), held))
    blocks = links.select("row", F.col("bo").alias("o"), F.col("bc").alias("c")).distinct()
    listed = anchors.filter(F.col("href").contains("/category/") & ~F.lower("title").isin("home", "all news"))
    categories = within(blocks, listed.select("row", F.col("o").alias("at_piece"), F.col("title").alias("value")), "categories_raw")
    found = held.filter("name = 'p'")
    paragraphs = found.join(texts_of(cut, found), ["row", "o"]).filter(F.length("text") >= LEAST_PARAGRAPH)
    paragraphs = within(blocks, paragraphs.select("row", F.col("o").alias("at_piece"), F.col("text").alias("value")), "paragraphs")
    shown = texts_of(cut, blocks).join(categories, ["row", "o"], "left").join(paragraphs, ["row", "o"], "left").withColumnsRenamed({"o": "bo", "text": "block"})
    wide = links.join(shown, ["row", "bo"]).join(rows.drop("html"), "row")
    other = F.filter("paragraphs", lambda p: ~F.lower(p).contains(F.lower("title")))
    longest = F.reduce(other, F.lit(""), lambda a, p: F.when(F.length(p) > F.length(a), p).otherwise(a))
    return wide.select(
        "page_id", "page_url", (F.row_number().over(Window.partitionBy("row").orderBy("o")) - 1).alias("pos"), "href", "title", "block",
        F.coalesce("categories_raw", F.array().cast("array<string>")).alias("categories_raw"),
        F.coalesce(F.nullif(longest, F.lit("")), F.replace("block", F.col("title"), F.lit(" "))).alias("summary"),
    )


def listing_items(pages: DataFrame, source: str, channel: str, marker: str = "/article/") -> DataFrame:
    """One normalised item per distinct article URL of each page, first occurrence first."""
    links = listing_links(pages, marker).withColumn("url", resolve("page_url", "href"))
    first = first_per_key(links.withColumn("_key", canonical_url("url")), ["page_id", "_key"], ["pos"]).drop("_key")
    author = F.regexp_extract("block", r"(?s)\bBy\s+([^|]{2,80}?)(?=\s+\d{1,2}(?:st|nd|rd|th)?\s+|$)", 1)
    regions = F.filter("categories_raw", lambda c: c.isin(dims.LISTING_REGIONS))
    items = first.withColumns(
        {
            "published_at": parse_date_multi("block"),
            "author": F.trim(author),
            "region_raw": F.coalesce(F.get(regions, F.lit(0)), F.lit("")),
            "source": F.lit(source),
            "source_channel": F.lit(channel),
        }
    )
    return normalize_items(items).drop("href", "block", "page_url")


def anchor_rows(pages: DataFrame) -> DataFrame:
    """(page_id, pos, url, link_text) of every anchor, found and resolved JVM-side."""
    tags = F.regexp_extract_all("html", F.lit(r'(?is)<a\b[^>]*?href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    rows = pages.select("page_id", F.col("url").alias("page_url"), F.posexplode(tags).alias("pos", "tag"))
    href = F.regexp_extract("tag", r'(?is)href="([^"]*)"', 1)
    return rows.select("page_id", "pos", resolve("page_url", href).alias("url"), strip_tags("tag").alias("link_text"))
