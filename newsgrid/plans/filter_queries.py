"""Queries over the row filters and exact de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import dims, views
from newsgrid.operators import dedupe, filters
from newsgrid.plans.duck_sql import d_any, q
from newsgrid.plans.registry import query
from newsgrid.plans.scalar_queries import d_canonical, d_clean, d_norm
from newsgrid.views import AS_OF, WITH_NEWS, WITH_OBS, WITH_STORIES, news_items, observations, table


@query(
    "recent_window",
    f"""{WITH_NEWS} SELECT doc_id FROM news_items WHERE coalesce(published_at, fetched_at) >= TIMESTAMP '{AS_OF}' - INTERVAL 172 HOUR
      AND {d_clean('title')} <> '' AND {d_clean('url')} <> ''""",
)
def _(spark, sf):
    return filters.recent_window(news_items(spark, sf), AS_OF).select("doc_id")


@query(
    "retention_window",
    f"""{WITH_NEWS} SELECT 'pool' AS kind, doc_id FROM news_items WHERE published_date IS NULL OR published_date >= DATE '2024-03-16'
      UNION ALL SELECT 'archive', doc_id FROM ({views.duck(views.STORIES)}) WHERE published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY AND category <> 'Other'""",
)
def _(spark, sf):
    pool = filters.pool_retention(news_items(spark, sf), AS_OF, 45).select(F.lit("pool").alias("kind"), "doc_id")
    archive = filters.archive_retention(views.stories(spark, sf), AS_OF, 60).select(F.lit("archive").alias("kind"), "doc_id")
    return pool.unionByName(archive)


@query("retired_channel_filter", f"{WITH_NEWS} SELECT doc_id, source_channel FROM news_items WHERE source_channel NOT IN ('old_web_channel', 'ishka_law_rss')")
def _(spark, sf):
    return filters.drop_channels(news_items(spark, sf), ["old_web_channel", "ishka_law_rss"]).select("doc_id", "source_channel")


@query(
    "domain_relevance",
    f"""{WITH_STORIES} SELECT id FROM stories WHERE list_has_any(string_split(source_names_text, '|'), [{', '.join(q(c) for c in dims.CORE_SOURCES)}])
      OR {d_any(f"lower({d_clean('summary')})", dims.DOMAIN_TERMS)}""",
)
def _(spark, sf):
    return filters.domain_relevance(views.stories(spark, sf), "summary", "source_names").select("id")


@query("min_title", f"{WITH_NEWS} SELECT doc_id FROM news_items WHERE length({d_clean('title')}) >= 5")
def _(spark, sf):
    return filters.min_title(news_items(spark, sf)).select("doc_id")


@query(
    "link_candidate_filter",
    """WITH l AS (SELECT page_id, 'https://news.example.org' || regexp_extract(a, 'href="([^"]*)"', 1) || '.html' AS url, regexp_extract(a, '>([^<]*)</a>', 1) AS t
       FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/[^"]*">[^<]*</a>', 0)) AS a FROM pages))
    SELECT page_id, url FROM l WHERE (contains(lower(t), 'th') OR contains(lower(t), 'er') OR contains(lower(url), 'th') OR contains(lower(url), 'er')) AND lower(url) <> 'https://news.example.org/the.html'""",
)
def _(spark, sf):
    anchor = F.explode(F.regexp_extract_all("html", F.lit('<a href="/[^"]*">[^<]*</a>'), F.lit(0)))
    links = table(spark, sf, "pages").select("page_id", anchor.alias("a")).select(
        "page_id",
        F.concat(F.lit("https://news.example.org"), F.regexp_extract("a", 'href="([^"]*)"', 1), F.lit(".html")).alias("url"),
        F.regexp_extract("a", ">([^<]*)</a>", 1).alias("link_text"),
        F.lit("https://news.example.org/").alias("index_url"),
    )
    return filters.link_candidates(links, ["th", "er"], ["news.example.org"], ["index.html", "the.html"]).select("page_id", "url")


@query("completed_period", f"{WITH_OBS} SELECT event_id, obs_date FROM obs WHERE obs_date < DATE '2024-01-20'")
def _(spark, sf):
    return filters.completed_period(observations(spark, sf), "obs_date", "2024-01-20 09:30:00").select("event_id", "obs_date")


@query("gap_window", "SELECT o_orderkey FROM orders WHERE CAST(last_day(o_orderdate) AS DATE) BETWEEN DATE '1996-07-28' AND DATE '1999-01-31'")
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("period_end", F.last_day("o_orderdate"))
    return filters.gap_window(rows, "period_end", "1996-07-28", "1999-01-31").select("o_orderkey")


D_SCORE = (
    "(CASE WHEN published_at IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN summary <> '' THEN 1 ELSE 0 END + CASE WHEN author <> '' THEN 1 ELSE 0 END"
    " + CASE WHEN region_raw <> '' THEN 1 ELSE 0 END + len([c for c in string_split(categories_text, '|') if c <> '']))"
)


@query(
    "dedupe_best",
    f"""{WITH_NEWS}, r AS (SELECT doc_id, {d_canonical('url')} AS key, {D_SCORE} AS score, row_number() OVER (PARTITION BY {d_canonical('url')} ORDER BY {D_SCORE} DESC, doc_id) AS rn FROM news_items)
    SELECT doc_id, key, CAST(score AS INT) AS score FROM r WHERE rn = 1""",
)
def _(spark, sf):
    from newsgrid.functions.urls import canonical_url

    best = dedupe.dedupe_best(news_items(spark, sf))
    return best.select("doc_id", canonical_url("url").alias("key"), dedupe.completeness().alias("score"))


@query(
    "pool_merge",
    f"""{WITH_NEWS}, b AS (SELECT *, 0 AS tier FROM news_items WHERE doc_id % 2 = 0 AND source_channel <> 'old_web_channel' UNION ALL SELECT *, 1 FROM news_items WHERE doc_id % 2 = 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY {d_canonical('url')} ORDER BY {D_SCORE} DESC, tier, doc_id) AS rn FROM b)
    SELECT doc_id, strftime(published_at, '%Y-%m-%d %H:%M') AS published, title FROM r WHERE rn = 1 AND (published_date IS NULL OR published_date >= DATE '2024-02-10')""",
)
def _(spark, sf):
    items = news_items(spark, sf)
    pool = dedupe.pool_merge(
        items.filter("doc_id % 2 = 0"), items.filter("doc_id % 2 = 1"), AS_OF, 80, ["old_web_channel"]
    )
    ordered = pool.orderBy(F.desc_nulls_last("published_at"), F.desc("title"))
    return ordered.select("doc_id", F.date_format("published_at", "yyyy-MM-dd HH:mm").alias("published"), "title")


@query(
    "normalize_items",
    f"""{WITH_NEWS}, c AS (SELECT doc_id, {d_clean('title')} AS title, {d_canonical('url')} AS url, source FROM news_items)
    SELECT doc_id, title, url, substr(sha256(url), 1, 24) AS id FROM c WHERE length(title) >= 5""",
)
def _(spark, sf):
    return dedupe.normalize_items(news_items(spark, sf)).select("doc_id", "title", "url", "id")


@query(
    "first_by_id",
    f"""{WITH_NEWS}, k AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'r' || CAST(doc_id - doc_id % 5 AS VARCHAR) ELSE substr(sha1({d_norm('title')} || '|' || 'u' || lang), 1, 24) END AS rid FROM news_items),
    r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY doc_id) AS rn FROM k) SELECT doc_id, rid FROM r WHERE rn = 1""",
)
def _(spark, sf):
    shared = F.concat(F.lit("r"), (F.col("doc_id") - F.col("doc_id") % 5).cast("string"))
    items = news_items(spark, sf).withColumns(
        {"id": F.when(F.col("doc_id") % 2 == 0, shared).otherwise(F.lit(" ")), "url": F.concat(F.lit("u"), F.col("lang"))}
    )
    return dedupe.first_by_id(items).select("doc_id", "rid")


@query("incremental_anti_join", "SELECT 'r' || CAST(doc_id AS VARCHAR) AS rid FROM documents WHERE doc_id % 3 <> 0 AND doc_id NOT IN (SELECT 2 * doc_id FROM documents)")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    ref = lambda n: F.concat(F.lit("r"), (F.col("doc_id") * n).cast("string"))
    archive = docs.select(F.array(ref(3), ref(2)).alias("raw_ids"))
    items = docs.select(ref(1).alias("rid"))
    return dedupe.incremental_anti_join(items, archive)


@query("current_from_archive", f"{WITH_STORIES} SELECT id, title FROM stories WHERE published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY")
def _(spark, sf):
    stories = views.stories(spark, sf)
    current = filters.retention_window(stories, AS_OF, 7, "published_at", False)
    return dedupe.current_from_archive(stories, current).select("id", "title")


@query("missing_ids", f"{WITH_STORIES} SELECT id FROM stories WHERE published_at IS NOT NULL AND category = 'Other'")
def _(spark, sf):
    stories = views.stories(spark, sf)
    return dedupe.missing_ids(stories.filter("published_at IS NOT NULL"), stories.filter("category <> 'Other'"))


@query(
    "candidate_cap",
    f"""{WITH_STORIES}, c AS (SELECT doc_id, published_at, doc_id % 20 = 0 AND list_has_any(string_split(source_names_text, '|'), [{', '.join(q(c) for c in dims.CORE_SOURCES)}]) AS is_core FROM stories),
    r AS (SELECT *, row_number() OVER (PARTITION BY is_core ORDER BY published_at DESC NULLS LAST, doc_id) AS rn, count(*) FILTER (WHERE is_core) OVER () AS n_core FROM c)
    SELECT doc_id, is_core FROM r WHERE is_core OR rn <= 360 - n_core""",
)
def _(spark, sf):
    core = (F.col("doc_id") % 20 == 0) & filters.has_core_source("source_names")
    rows = views.stories(spark, sf).select("doc_id", "published_at", core.alias("is_core"))
    return dedupe.candidate_cap(rows, 360, [F.desc_nulls_last("published_at"), "doc_id"]).select("doc_id", "is_core")


@query(
    "within_release_dedupe",
    """WITH d AS (SELECT o_orderkey, o_custkey AS release_id, CAST(last_day(o_orderdate) AS DATE) AS obs_date, CASE WHEN o_orderkey % 3 = 0 THEN 'monthly_average' ELSE 'two_month_average' END AS observation_type FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY release_id, obs_date ORDER BY CASE WHEN observation_type = 'monthly_average' THEN 2 ELSE 1 END DESC, o_orderkey) AS rn FROM d)
    SELECT o_orderkey, release_id, observation_type FROM r WHERE rn = 1""",
)
def _(spark, sf):
    kind = F.when(F.col("o_orderkey") % 3 == 0, F.lit("monthly_average")).otherwise(F.lit("two_month_average"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("release_id"), F.last_day("o_orderdate").alias("obs_date"), kind.alias("observation_type")
    )
    rank = F.when(F.col("observation_type") == "monthly_average", F.lit(2)).otherwise(F.lit(1))
    return dedupe.best_by_priority(rows, ["release_id", "obs_date"], rank, ["o_orderkey"]).select("o_orderkey", "release_id", "observation_type")
