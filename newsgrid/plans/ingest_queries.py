"""Queries over scans, extraction, sinks and the incremental forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgrid import views
from newsgrid.operators import aggregates, filters, ranking
from newsgrid.plans.filter_queries import D_SCORE
from newsgrid.plans.registry import query
from newsgrid.plans.scalar_queries import d_canonical, d_strip_tags, d_unescape
from newsgrid.session import cut_lineage, shared_dir
from newsgrid.sources import disclosures, envelope, feeds, listing, prices, sinks
from newsgrid.streaming import jobs
from newsgrid.views import AS_OF, WITH_NEWS, WITH_OBS, news_items, observations, table

_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS title, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents"
_ITEM = T.StructType([T.StructField("title", T.StringType())])


def envelopes(spark, sf):
    """Every document as one envelope whose rows are its lines."""
    items = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("title")))
    body = F.struct(F.lit(1).alias("schema_version"), F.lit(AS_OF).alias("generated_at"), items.alias("items"))
    return table(spark, sf, "documents").select("doc_id", F.to_json(body).alias("body"))


@query("scan_envelope", _LINES)
def _(spark, sf):
    return envelope.envelope_rows(envelopes(spark, sf), "body", _ITEM)


@query("scan_tolerant", f"SELECT * FROM ({_LINES}) WHERE doc_id % 4 <> 0 AND doc_id % 4 <> 1")
def _(spark, sf):
    broken = (
        F.when(F.col("doc_id") % 4 == 0, F.lit("{not json"))
        .when(F.col("doc_id") % 4 == 1, F.lit(None).cast("string"))
        .otherwise(F.col("body"))
    )
    return envelope.envelope_rows(envelopes(spark, sf).withColumn("body", broken), "body", _ITEM)


def feed_documents(spark, sf):
    """Every document as a feed, RSS or Atom, with one entry per line of its text."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    clean = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f\r]", " ")
    lines = F.split(clean, "\n")
    link = lambda i: F.concat(F.lit("https://Feed.example.org/n/"), F.col("doc_id"), F.lit("-"), i, F.lit("?utm_source=rss"))
    rss = F.transform(
        lines,
        lambda x, i: F.concat(
            F.lit("<item><title>"), esc(x), F.lit("</title><link>"), link(i), F.lit("</link><category>B</category><category>A</category>"),
            F.lit("<pubDate>Sat, 20 Apr 2024 10:30:00 +0200</pubDate><dc:creator>Desk</dc:creator></item>"),
        ),
    )
    atom = F.transform(
        lines,
        lambda x, i: F.concat(
            F.lit('<entry><title type="html">'), esc(x), F.lit('</title><link rel="alternate" href="'), link(i),
            F.lit('"/><updated>2024-04-20</updated><author><name>Desk</name></author></entry>'),
        ),
    )
    head = '<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>f</title>'
    xml = F.when(
        F.col("doc_id") % 3 == 0, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>'), F.array_join(atom, ""), F.lit("</feed>"))
    ).otherwise(F.concat(F.lit(head), F.array_join(rss, ""), F.lit("</channel></rss>")))
    return table(spark, sf, "documents").select("doc_id", F.lit("Feed").alias("name"), F.lit("feed_rss").alias("channel"), xml.alias("xml"))


_D_LINE = d_strip_tags(d_unescape(r"regexp_replace(title, '[\x00-\x08\x0b\x0c\x0e-\x1f\r]', ' ', 'g')"))


@query(
    "rss_items",
    f"""WITH l AS ({_LINES}), t AS (SELECT doc_id, pos, {_D_LINE} AS title FROM l)
    SELECT doc_id, pos, title, 'https://feed.example.org/n/' || CAST(doc_id AS VARCHAR) || '-' || CAST(pos AS VARCHAR) AS url,
      CASE WHEN doc_id % 3 = 0 THEN '2024-04-20 00:00' ELSE '2024-04-20 08:30' END AS published, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Desk' END AS author,
      CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'A|B' END AS categories FROM t WHERE length(title) >= 5""",
)
def _(spark, sf):
    out = feeds.rss_items(feed_documents(spark, sf))
    return out.select(
        "doc_id", "pos", "title", "url", F.date_format("published_at", "yyyy-MM-dd HH:mm").alias("published"), "author",
        F.array_join("categories_raw", "|").alias("categories"),
    )


@query(
    "feed_source_resolve",
    f"""{WITH_NEWS} SELECT doc_id, CASE WHEN source_channel <> 'bing_news_rss' THEN 'Search' WHEN doc_id % 5 = 0 OR contains(lower(author), 'en') THEN 'Reuters' WHEN author <> '' THEN author ELSE 'Search' END AS source,
      CASE WHEN source_channel = 'bing_news_rss' AND (doc_id % 5 = 0 OR contains(lower(author), 'en')) THEN 'reuters_via_bing' ELSE source_channel END AS channel FROM news_items""",
)
def _(spark, sf):
    items = news_items(spark, sf)
    link = F.when(F.col("doc_id") % 5 == 0, F.lit("https://www.Bing.com/a?url=https%3A%2F%2Fwww.reuters.com%2Fx")).otherwise(F.col("url"))
    publisher = F.when(F.lower("author").contains("en"), F.concat(F.lit("<b>Reuters</b> "), F.col("author"))).otherwise(F.col("author"))
    source, channel = feeds.resolve_source("source_channel", publisher, link, F.lit("Search"), "bing_news_rss")
    return items.select("doc_id", source.alias("source"), channel.alias("channel"))


_D_HREF = "regexp_extract(tag, '(?is)href=\"([^\"]*)\"', 1)"


@query(
    "html_listing_links",
    f"""WITH a AS (SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?href="[^"]*"[^>]*>.*?</a>', 0)) AS tag FROM pages)
    SELECT page_id, regexp_extract(page_url, '^[a-z]+://[^/]*', 0) || {_D_HREF} AS url, {d_strip_tags('tag')} AS link_text FROM a WHERE starts_with({_D_HREF}, '/')""",
)
def _(spark, sf):
    return listing.anchor_rows(table(spark, sf, "pages")).select("page_id", "url", "link_text")


@query("html_listing_items")
def _(spark, sf):
    html = F.replace(F.replace("html", F.lit('href="/'), F.lit('href="/article/daily-')), F.lit("<nav>"), F.lit("<nav><span>By Staff Writer 11th September 2023</span>"))
    html = F.replace(html, F.lit("</a>"), F.lit(" bulletin</a>"))
    out = listing.listing_items(table(spark, sf, "pages").withColumn("html", html), "Listing", "listing_html")
    return out.select("page_id", "title", "url", "id", "published_date", "author", F.length("summary").alias("summary_chars"))


def price_pages(spark, sf):
    """One price page per order: a table with a mid column, and a later correction in embedded JSON."""
    day = lambda n: F.date_add(F.col("o_orderdate").cast("date"), n)
    price = F.format_number(F.floor(F.col("o_totalprice") / 10) / 100, 2)
    cell = lambda *xs: F.concat(*[F.concat(F.lit("<td> "), x, F.lit("</td>")) for x in xs])
    row = lambda n, written, *xs: F.concat(F.lit("<tr>"), cell(F.date_format(day(n), written), *xs), F.lit("</tr>"))
    html = F.concat(
        F.lit("<html><table class='p'><tr><th>Date</th><th>Bid</th><th><b>Mid</b></th></tr>"),
        row(0, "d MMMM yyyy", F.lit("1.00"), F.concat(F.lit("US$ "), price)),
        row(1, "MMM d, yyyy", F.lit("33.5"), F.lit("n/a")),
        row(2, "yyyy-MM-dd", F.lit("21"), F.lit("9999")),
        F.lit("<tr><td>no date</td><td>50</td></tr></table><script>var x=[{\"date\": \""),
        F.date_format(day(2), "yyyy-MM-dd"),
        F.lit("\", \"unit\": 1, \"price\": 44.25}, {'value': '45.5', 'date': '"),
        F.date_format(day(3), "yyyy-MM-dd"),
        F.lit("'}]</script></html>"),
    )
    pages = table(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html"))
    return cut_lineage(pages.repartition(32))  # the landed pages, in as many files as a crawl would leave


@query(
    "html_price_rows",
    """WITH o AS (SELECT o_orderkey AS page_id, CAST(o_orderdate AS DATE) AS d, floor(o_totalprice / 10) / 100 AS v FROM orders)
    SELECT page_id, d AS obs_date, v AS value FROM o WHERE v BETWEEN 20 AND 500
    UNION ALL SELECT page_id, d + 1, 33.5 FROM o UNION ALL SELECT page_id, d + 2, 44.25 FROM o UNION ALL SELECT page_id, d + 3, 45.5 FROM o""",
)
def _(spark, sf):
    return prices.price_rows(price_pages(spark, sf))


@query(
    "week_grid_unpivot",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_custkey % 900 AS c FROM orders)
    SELECT o_orderkey, d AS obs_date, CAST(c + 0.5 AS DOUBLE) AS value FROM o UNION ALL SELECT o_orderkey, d + 1, c + 1.5 FROM o
    UNION ALL SELECT o_orderkey, d + 3, 12.25 FROM o UNION ALL SELECT o_orderkey, d + 4, c + 4.5 FROM o""",
)
def _(spark, sf):
    d, c = F.col("o_orderdate"), F.col("o_custkey") % 900
    label = F.concat(F.date_format(d, "yyyy MMM"), F.lit("-"), F.lpad(F.dayofmonth(d).cast("string"), 2, " "), F.lit(" to "), F.date_format(F.date_add(d.cast("date"), 4), "MMM-dd"))
    num = lambda n: F.concat((c + n).cast("string"), F.lit(".5"))
    cells = F.array(num(0), num(1), F.lit(" - "), F.lit("12.25"), num(4), F.lit("77"))
    grid = table(spark, sf, "orders").select("o_orderkey", label.alias("label"), cells.alias("cells"))
    return prices.week_grid_rows(grid).select("o_orderkey", "obs_date", "value")


@query(
    "csv_monthly_scan",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-01') AS DATE) AS obs_date, round_even(o_totalprice / 100 + 0.00003, 2) AS value FROM orders
    WHERE o_orderkey % 10 <> 0 AND o_totalprice / 100 > 100 AND strftime(o_orderdate, '%Y-%m') BETWEEN '1996-03' AND '2000-09'""",
)
def _(spark, sf):
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a")).otherwise((F.col("o_totalprice") / 100 + 0.00003).cast("string"))
    line = F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM"), price)
    rows = table(spark, sf, "orders").select("o_orderkey", F.from_csv(line, "Date string, Price string").alias("r")).select("o_orderkey", "r.*")
    return prices.monthly_rows(rows, "1996-03", "2000-09").select("o_orderkey", "obs_date", "value")


@query(
    "parallel_arrays_to_rows",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, round_even(o_totalprice / 100 + 0.00003, 2) AS v FROM orders)
    SELECT o_orderkey, d AS obs_date, v AS value, CAST(1.5 AS DOUBLE) AS open FROM o WHERE v > 100 AND d < DATE '2000-06-01'
    UNION ALL SELECT o_orderkey, d + 2, 150.25, NULL FROM o WHERE d + 2 < DATE '2000-06-01'""",
)
def _(spark, sf):
    start = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate")) + 3600
    close = F.col("o_totalprice") / 100 + 0.00003
    none = F.lit(None).cast("double")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.array(start, start + 86400, start + 172800).alias("timestamp"),
        F.array(F.lit(1.5), F.lit(2.5), none).alias("open"),
        F.array(close).alias("high"), F.array(close).alias("low"),
        F.array(close, none, F.lit(150.25)).alias("close"),
    )
    return prices.zip_arrays(rows, "2000-06-01 08:00:00").select("o_orderkey", "obs_date", "value", "open")


@query(
    "pairs_to_rows",
    f"""{WITH_OBS}, p AS (SELECT series, event_id, 0 AS pos, obs_date AS d, value AS v FROM obs UNION ALL SELECT series, event_id, 1, obs_date, value + 1 FROM obs WHERE event_id % 3 = 0 UNION ALL SELECT series, event_id, 3, obs_date + 1, 7.5 FROM obs),
    r AS (SELECT *, row_number() OVER (PARTITION BY series, d ORDER BY event_id DESC, pos DESC) AS rn FROM p) SELECT series, d AS obs_date, v AS value FROM r WHERE rn = 1""",
)
def _(spark, sf):
    obs = observations(spark, sf)
    ms = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) * 1000
    second = F.when(F.col("event_id") % 3 == 0, (F.col("value") + 1).cast("string")).otherwise(F.lit('"bad"'))
    body = F.concat(F.lit("[["), ms, F.lit(", "), F.col("value"), F.lit("], ["), ms + 5, F.lit(", "), second, F.lit("], [1], ["), ms + 86400000, F.lit(", 7.5]]"))
    return prices.pairs_rows(obs.select("series", "event_id", body.alias("body")), "body", ["series"], ["event_id"])


@query(
    "bars_closed_only",
    f"""{WITH_OBS} SELECT event_id, obs_date, round_even(value * 20, 2) AS value FROM obs WHERE event_id % 4 <> 0 AND event_id % 7 <> 0 AND value * 20 > 100 AND obs_date < DATE '2024-01-25'
    UNION ALL SELECT event_id, obs_date, CAST(500 AS DOUBLE) FROM obs WHERE event_id % 7 = 0 AND obs_date < DATE '2024-01-25'""",
)
def _(spark, sf):
    n = F.col("event_id")
    bar = lambda close, closed: F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("bar_start"), close.alias("close"), closed.alias("is_closed"),
        F.lit("1.005").alias("open"), F.lit(None).cast("string").alias("high"), F.lit("x").alias("low"),
    )
    own = F.when(n % 7 == 0, F.lit("n/a")).otherwise((F.col("value") * 20).cast("string"))
    bars = F.array(bar(own, n % 4 != 0), bar(F.when(n % 7 == 0, F.lit("500")), F.lit(None).cast("boolean")))
    out = prices.closed_bars(observations(spark, sf).select("event_id", bars.alias("bars")), "2024-01-25 12:00:00")
    return out.select("event_id", "obs_date", "value")


@query(
    "completed_bars_scan",
    f"""{WITH_OBS} SELECT 'open' AS run, event_id, round_even(value, 2) AS value FROM obs WHERE k % 5 <> 0 AND obs_date <= DATE '2024-01-19'
    UNION ALL SELECT 'closed', event_id, round_even(value, 2) FROM obs WHERE k % 5 <> 0 AND obs_date <= DATE '2024-01-20'""",
)
def _(spark, sf):
    bars = observations(spark, sf).withColumn("close", F.when(F.col("k") % 5 != 0, F.col("value")))
    run = lambda name, as_of: prices.completed_bars(bars, as_of).select(F.lit(name).alias("run"), "event_id", "value")
    return run("open", "2024-01-20 22:59:00").unionByName(run("closed", "2024-01-20 23:00:00"))


# Month names for the written disclosures below.
_MONTH_NAMES = "January February March April May June July August September October November December".split()


def notices(spark, sf):
    """Every document followed by disclosure sentences; month, year and value vary by document."""
    n = F.col("doc_id")
    name = lambda m: F.element_at(F.array(*[F.lit(x) for x in _MONTH_NAMES]), m.cast("int"))
    month, month2 = n % 12 + 1, (n + 1) % 12 + 1
    value = F.concat((n % 90 + 30).cast("string"), F.lit(".25"))
    year = F.lit("2015")
    one = F.concat(F.lit(" . Fuel surcharge notice 2016/3/5 . The average price of jet fuel for the month of "), name(month), F.lit(", USD "), value, F.lit(" applies."))
    two = F.concat(
        F.lit(" The price of Singapore kerosene-type jet fuel during the two-month period of "), name(month), F.lit(" and "), name(month2), F.lit(" 2015 averaged USD $ "), value, F.lit(" per barrel."),
    )
    three = F.concat(F.lit(" The average fuel price of Singapore kerosene-type jet fuel for the month of "), name(month), F.lit(" 2014 was US$ "), value, F.lit(" per barrel."))
    return table(spark, sf, "documents").select(
        "doc_id", F.lit("https://x.example/en/release/201603/1.html").alias("url"), F.concat("text", one, F.lit("\n"), two, F.lit("\n"), three).alias("text")
    )


_D_LAST = "last_day(make_date({y}, CAST({m} AS BIGINT), 1))"


@query(
    "disclosed_average_extract",
    f"""WITH n AS (SELECT doc_id, doc_id % 12 + 1 AS m, CAST(doc_id % 90 + 30.25 AS DOUBLE) AS value FROM documents)
    SELECT doc_id, 'cargo' AS style, CAST({_D_LAST.format(y='CASE WHEN m > 3 THEN 2015 ELSE 2016 END', m='m')} AS DATE) AS period_end, value FROM n
    UNION ALL SELECT doc_id, 'cargo', CAST({_D_LAST.format(y='2014', m='m')} AS DATE), value FROM n
    UNION ALL SELECT doc_id, 'cargo_archive', CAST({_D_LAST.format(y='CASE WHEN m > 3 THEN 2015 ELSE 2016 END', m='m')} AS DATE), value FROM n
    UNION ALL SELECT doc_id, 'cargo_archive', CAST({_D_LAST.format(y='2014', m='m')} AS DATE), value FROM n
    UNION ALL SELECT doc_id, 'carrier', CAST({_D_LAST.format(y='2014', m='m')} AS DATE), value FROM n""",
)
def _(spark, sf):
    docs = notices(spark, sf)
    parts = []
    for style in (disclosures.CARGO, disclosures.CARGO_ARCHIVE, disclosures.CARRIER):
        found = disclosures.disclosed_averages(docs, style).filter("observation_type = 'monthly_average'")
        parts.append(found.select("doc_id", F.lit(style.name).alias("style"), "period_end", "value"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "two_month_average_extract",
    """WITH n AS (SELECT doc_id, doc_id % 12 + 1 AS m, (doc_id + 1) % 12 + 1 AS m2, CAST(doc_id % 90 + 30.25 AS DOUBLE) AS value FROM documents)
    SELECT doc_id, s AS style, CAST(make_date(CASE WHEN m > m2 THEN 2014 ELSE 2015 END, CAST(m AS BIGINT), 1) AS DATE) AS period_start, CAST(last_day(make_date(2015, CAST(m2 AS BIGINT), 1)) AS DATE) AS period_end, value
    FROM n, (VALUES ('carrier'), ('carrier_archive')) AS t(s)""",
)
def _(spark, sf):
    docs = notices(spark, sf)
    parts = [
        disclosures.disclosed_averages(docs, style).filter("observation_type = 'two_month_average'").select(
            "doc_id", F.lit(style.name).alias("style"), "period_start", "period_end", "value"
        )
        for style in (disclosures.CARRIER, disclosures.CARRIER_ARCHIVE)
    ]
    return parts[0].unionByName(parts[1])


CUTOFF = "2024-03-20"


def crawl(spark, sf):
    """Documents as a paged crawl: a hundred per page, addresses that come back, dates that fall.

    Every 4,800 documents are a section of their own, so sources grow with the table and every page is read.
    """
    page = F.floor(F.pmod("doc_id", F.lit(4800)) / 100)
    section = F.floor(F.col("doc_id") / 4800).cast("string")
    age = (page * (F.length("source") - 2 + F.col("doc_id") % 2)).cast("int")
    return table(spark, sf, "documents").select(
        F.concat("source", F.lit("/"), section).alias("source_id"), page.alias("page"), (F.col("doc_id") % 700).cast("string").alias("url"),
        F.date_sub(F.lit("2024-04-30").cast("date"), age * 4).alias("published_date"), "doc_id",
    )


_D_CRAWL = f"""WITH c AS (SELECT source || '/' || (doc_id // 4800) AS source_id, (doc_id % 4800) // 100 AS page, CAST(doc_id % 700 AS VARCHAR) AS url, DATE '2024-04-30' - CAST(((doc_id % 4800) // 100) * (length(source) - 2 + doc_id % 2) * 4 AS INT) AS published_date, doc_id FROM documents),
p AS (SELECT source_id, page, string_agg(url, ',' ORDER BY url) AS sig, min(published_date) AS oldest FROM c WHERE page <= 48 GROUP BY 1, 2),
m AS (SELECT *, row_number() OVER (PARTITION BY source_id, sig ORDER BY page) > 1 AS rep FROM p),
r AS (SELECT *, CASE WHEN rep THEN 'repeated_page' WHEN oldest < DATE '{CUTOFF}' THEN 'cutoff_reached' END AS reason FROM m),
s AS (SELECT source_id, min(page) FILTER (WHERE reason IS NOT NULL) AS stop_page, arg_min(reason, page) FILTER (WHERE reason IS NOT NULL) AS reason, max(page) AS last_page FROM r GROUP BY 1),
stops AS (SELECT source_id, CAST(CASE WHEN reason = 'cutoff_reached' THEN stop_page WHEN reason IS NOT NULL THEN stop_page - 1 ELSE last_page END AS BIGINT) AS kept_to, coalesce(reason, 'max_pages') AS stop_reason FROM s)"""


@query("page_scan_stop", f"{_D_CRAWL} SELECT * FROM stops")
def _(spark, sf):
    return ranking.page_scan_stop(crawl(spark, sf), CUTOFF, 48)


@query(
    "backfill_report",
    f"""{_D_CRAWL}, k AS (SELECT c.*, row_number() OVER (PARTITION BY c.source_id, url ORDER BY doc_id) AS rn FROM c JOIN stops USING (source_id) WHERE page <= kept_to),
    a AS (SELECT source_id, count(*) AS records_parsed, count_if(published_date >= DATE '{CUTOFF}') AS records_within, min(published_date) FILTER (WHERE published_date >= DATE '{CUTOFF}') AS earliest,
      max(published_date) FILTER (WHERE published_date >= DATE '{CUTOFF}') AS latest FROM k WHERE rn = 1 GROUP BY 1)
    SELECT source_id, kept_to, stop_reason, coalesce(records_parsed, 0) AS records_parsed, coalesce(records_within, 0) AS records_within, earliest, latest FROM stops LEFT JOIN a USING (source_id)""",
)
def _(spark, sf):
    from newsgrid.operators.dedupe import first_per_key

    log = crawl(spark, sf)
    stops = ranking.page_scan_stop(log, CUTOFF, 48)
    kept = log.join(stops.select("source_id", "kept_to"), "source_id").filter("page <= kept_to")
    return aggregates.backfill_report(first_per_key(kept, ["source_id", "url"], ["doc_id"]), stops, CUTOFF)


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/newsgrid-{name}-{uuid.uuid4().hex}"


@query("sink_feed_archive", f"WITH stories AS ({views.duck(views.STORIES)}) SELECT id, CAST(published_at AS DATE) AS published_day, coalesce(published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY, false) AS is_current FROM stories")
def _(spark, sf):
    out = scratch(spark, "feed")
    shaped = views.stories(spark, sf).select(
        "id", "title", "published_at", F.lit(False).alias("critical"), F.array().cast("array<struct<name:string,type:string>>").alias("priority_matches"),
        F.struct(F.lit(False).alias("macro_related")).alias("score_components"), F.col("analysis_mode").alias("ai_mode"),
    )
    day = F.coalesce(F.col("published_at").cast("date"), F.lit("1970-01-01").cast("date"))
    sinks.write_feed(shaped.withColumn("title", F.when(F.dayofmonth(day) == 1, F.lit("earlier")).otherwise(F.col("title"))), out, AS_OF)
    sinks.write_feed(shaped, out, AS_OF)  # writes what has changed since
    store = sinks.feed_store(shaped, out)
    current = store.read("current").select("id", F.lit(True).alias("is_current"))
    archive = store.read("archive").select("id", F.col("published_at").cast("date").alias("published_day"))
    return archive.join(current, "id", "left").select("id", "published_day", F.coalesce("is_current", F.lit(False)).alias("is_current"))


@query("late_item_drop", f"{WITH_NEWS} SELECT doc_id FROM news_items WHERE coalesce(published_at, fetched_at) >= TIMESTAMP '2024-03-30 20:00:00' AND title <> ''")
def _(spark, sf):
    return filters.recent_window(news_items(spark, sf), AS_OF, days=29, grace_hours=28).select("doc_id")


def _events_stream(spark, sf):
    return jobs.file_stream(spark, sf, table(spark, sf, "events").schema, "events.parquet")


POOL = "doc_id long, id string, title string, summary string, source string, source_channel string, url string, published_at timestamp_ntz, published_date date, author string, region_raw string, categories_raw array<string>"


@query(
    "stream_ingest_dedupe",
    f"""{WITH_NEWS}, r AS (SELECT *, row_number() OVER (PARTITION BY {d_canonical('url')} ORDER BY {D_SCORE} DESC, doc_id) AS rn FROM news_items)
    SELECT doc_id, id, title, strftime(published_at, '%Y-%m-%d %H:%M') AS published FROM r WHERE rn = 1""",
)
def _(spark, sf):
    out = scratch(spark, "pool")
    store = jobs.pool_store(spark, out, POOL)
    columns = [c.split()[0] for c in POOL.split(", ")]
    stream = jobs.file_stream(spark, sf, table(spark, sf, "documents").schema, "documents.parquet")
    shape = lambda batch: views.as_news_items(batch).select(*columns)
    jobs.run_pool(stream, store, f"{out}/checkpoint", shape, ("doc_id",))
    return store.read("pool").select("doc_id", "id", "title", F.date_format("published_at", "yyyy-MM-dd HH:mm").alias("published"))


@query("stream_latest_quote", "SELECT user_id, arg_max(value, (ts, event_id)) AS price, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS price_ts FROM events WHERE value > 1 GROUP BY 1")
def _(spark, sf):
    out = scratch(spark, "quote")
    bars = _events_stream(spark, sf).withColumn("value", F.when(F.col("value") > 1, F.col("value")))
    jobs.run_updates(jobs.latest_quote(bars, ("user_id",)), f"{out}/rows", f"{out}/checkpoint")
    newest = jobs.newest_update(spark.read.parquet(f"{out}/rows"), ["user_id"])
    return newest.select("user_id", "price", F.date_format("price_ts", "yyyy-MM-dd HH:mm:ss").alias("price_ts"))


@query("stateful_archive")
def _(spark, sf):
    from newsgrid.plans.cluster_queries import dated_in_week

    out = scratch(spark, "archive")
    store = jobs.archive_store(spark, out)
    stream = jobs.file_stream(spark, sf, table(spark, sf, "documents").schema, "documents.parquet")
    shape = lambda batch: dated_in_week(views.as_news_items(batch)).withColumn("discovered_via", F.lit("direct"))
    jobs.run_archive(stream, store, f"{out}/checkpoint", AS_OF, shape)
    counts = store.read("members").groupBy("id").agg(F.count(F.lit(1)).alias("n_items"))
    return store.read("stories").join(counts, "id").select("id", "title", "category", "importance_score", "n_items")
