"""Queries over contract checks, health and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import dims, views
from newsgrid.operators import aggregates, quality, ranking
from newsgrid.plans.base import enriched, served_table
from newsgrid.plans.duck_sql import SCORED
from newsgrid.plans.feed_queries import _ORDER
from newsgrid.plans.registry import query
from newsgrid.plans.scalar_queries import d_list
from newsgrid.views import AS_OF, EVENTS_AS_OF, WITH_CHECKS, WITH_NEWS, WITH_STORIES, news_items, source_checks, table

_CATS = d_list(dims.CATEGORIES)
_AS = f"TIMESTAMP '{AS_OF}'"


def _arm(name, cond, source, key="id", detail="''", severity="error"):
    return f"SELECT '{name}' AS check, '{severity}' AS severity, coalesce({key}, '') AS key, coalesce(CAST({detail} AS VARCHAR), '') AS detail FROM {source} WHERE {cond}"


_BROKEN = """b AS (SELECT *, CASE WHEN length(summary) % 50 = 0 THEN NULL WHEN length(summary) % 50 = 1 THEN 's1' ELSE id END AS bid,
   CASE WHEN length(summary) % 40 = 0 THEN importance_score + 60 ELSE importance_score END AS sc,
   CASE WHEN length(summary) % 3 = 0 THEN [url] WHEN length(summary) % 3 = 1 THEN [url, ''] ELSE [url, url] END AS urls FROM stories)"""


def broken(spark, sf):
    """Stories with contract faults of every kind, placed by text length."""
    n = F.length("summary")
    src = lambda *us: F.array(*[F.struct(F.lit("x").alias("name"), u.alias("url")) for u in us])
    url = F.col("url")
    return views.stories(spark, sf).withColumns(
        {
            "sources": F.when(n % 3 == 0, src(url)).when(n % 3 == 1, src(url, F.lit(""))).otherwise(src(url, url)),
            "importance_score": F.when(n % 40 == 0, F.col("importance_score") + 60).otherwise(F.col("importance_score")),
            "raw_ids": F.when(n % 30 == 0, F.slice("raw_ids", 1, 0)).otherwise(F.col("raw_ids")),
            "id": F.when(n % 50 == 0, F.lit(None)).when(n % 50 == 1, F.lit("s1")).otherwise(F.col("id")),
        }
    )


@query(
    "dq_clustered",
    " UNION ALL ".join(
        [
            f"{WITH_STORIES}, {_BROKEN} " + _arm("missing_id", "bid IS NULL", "b", "bid"),
            _arm("missing_title", "title = ''", "b", "bid"),
            _arm("bad_category", f"category NOT IN {_CATS}", "b", "bid", "category"),
            _arm("bad_score", "sc NOT BETWEEN 0 AND 100", "b", "bid", "sc"),
            _arm("bad_published_at", "published_at IS NULL", "b", "bid"),
            _arm("outside_retention", f"published_at < {_AS} - INTERVAL 100 DAY", "b", "bid"),
            _arm("source_without_url", "list_contains(urls, '')", "b", "bid", "1"),
            _arm("duplicate_source_url", "len(urls) = 2 AND urls[1] = urls[2]", "b", "bid"),
            _arm("source_count_mismatch", "source_count <> len(urls)", "b", "bid", "source_count"),
            _arm("raw_ids_missing", "length(summary) % 30 = 0", "b", "bid"),
            "SELECT 'duplicate_id', 'error', bid, CAST(count(*) AS VARCHAR) FROM b WHERE bid IS NOT NULL GROUP BY bid HAVING count(*) > 1",
            "SELECT 'url_in_two_stories', 'error', url, min(bid) FROM b WHERE bid IS NOT NULL GROUP BY url HAVING count(DISTINCT bid) > 1",
        ]
    ),
)
def _(spark, sf):
    return quality.dq_clustered(broken(spark, sf), AS_OF, 100)


@query(
    "dq_enriched",
    " UNION ALL ".join(
        [
            f"{SCORED}, b AS (SELECT * REPLACE (CASE WHEN length(title) % 3 = 0 THEN importance_score - 15 ELSE importance_score END AS importance_score, CASE WHEN length(title) % 7 = 0 THEN ' ' ELSE why_it_matters_zh END AS why_it_matters_zh) FROM enriched) "
            + _arm("bad_category", f"category NOT IN {_CATS}", "b", "id", "category"),
            _arm("why_empty", "why_it_matters_zh = ' '", "b"),
            _arm("below_entity_floor", f"len(names) > 0 AND importance_score < 86", "b", "id", "importance_score"),
            _arm("below_material_floor", "priority_material_event AND importance_score < 92", "b", "id", "importance_score"),
            _arm("below_macro_floor", "macro_related AND importance_score < 83", "b", "id", "importance_score"),
            _arm("bad_published_at", "published_at IS NULL", "b"),
            _arm("outside_retention", f"published_at < {_AS} - INTERVAL 110 DAY", "b"),
            _arm("critical_below_90", "critical AND importance_score < 90", "b", "id", "importance_score", "warning"),
        ]
    ),
)
def _(spark, sf):
    n = F.length("title")
    df = served_table(enriched(spark, sf)).withColumns(
        {
            "importance_score": F.when(n % 3 == 0, F.col("importance_score") - 15).otherwise(F.col("importance_score")),
            "why_it_matters_zh": F.when(n % 7 == 0, F.lit(" ")).otherwise(F.col("why_it_matters_zh")),
        }
    )
    return quality.dq_enriched(df, dims.SAMPLE_CONFIG, AS_OF, 110)


@query(
    "dq_homepage",
    f"""{SCORED}, top AS (SELECT id, critical, row_number() OVER (ORDER BY {_ORDER}) AS place FROM enriched ORDER BY place LIMIT 11),
    ages AS (SELECT id, critical, row_number() OVER (ORDER BY published_at DESC NULLS LAST, importance_score DESC, id) AS place FROM enriched ORDER BY place LIMIT 12)
    SELECT 'not_critical' AS check, 'error' AS severity, id AS key, 'critical' AS detail FROM ages WHERE NOT critical
    UNION ALL SELECT 'list_too_long', 'error', 'critical', '12'
    UNION ALL SELECT 'unknown_id', 'error', 'nobody', 'feed'
    UNION ALL SELECT 'feed_not_top', 'error', id, CASE WHEN place = 10 THEN 'nobody' END FROM top WHERE place = 10""",
)
def _(spark, sf):
    df = served_table(enriched(spark, sf))
    feed = ranking.top_feed(df, 10).select(
        F.lit("feed").alias("list"), "place", F.when(F.col("place") == 10, F.lit("nobody")).otherwise(F.col("id")).alias("id")
    )
    newest = ranking.rank_newest(df).limit(12).select(F.lit("critical").alias("list"), F.lit(0).alias("place"), "id")
    return quality.dq_homepage(df, feed.unionByName(newest), 10)


@query(
    "dq_stage_subset",
    f"""{WITH_STORIES} SELECT 'missing_enriched' AS check, 'error' AS severity, id AS key, '' AS detail FROM stories WHERE category = 'Other'
    UNION ALL SELECT 'archive_smaller', 'error', 'archive', CAST(count_if(published_at >= TIMESTAMP '2024-03-01') AS VARCHAR) FROM stories""",
)
def _(spark, sf):
    s = views.stories(spark, sf)
    return quality.dq_stage_subset(s, s.filter("category <> 'Other'"), s.filter("published_at >= TIMESTAMP_NTZ '2024-03-01 00:00:00'"))


@query(
    "dq_required_fields",
    " UNION ALL ".join(
        [
            f"{WITH_STORIES} " + _arm("missing_title", "title = ''", "stories"),
            _arm("missing_region", "region = ''", "stories"),
            _arm("missing_published_at", "published_at IS NULL", "stories"),
        ]
    ),
)
def _(spark, sf):
    return quality.dq_required_fields(views.stories(spark, sf), ("title", "summary", "category", "region", "importance_score", "published_at", "url"))


_D_HEALTH = """h AS (SELECT *, http_status = 200 AND error IS NULL AS transport_ok, records > 0 AS has_records FROM checks),
healthy AS (SELECT *, transport_ok AND (has_records OR kind = 'rss_search') AS ok FROM h)"""


@query("health_semantics", f"{WITH_CHECKS}, {_D_HEALTH} SELECT event_id, transport_ok, has_records, ok FROM healthy")
def _(spark, sf):
    return quality.health_semantics(source_checks(spark, sf)).select("event_id", "transport_ok", "has_records", "ok")


@query(
    "health_rollup",
    f"""{WITH_CHECKS}, {_D_HEALTH} SELECT kind, count(*) AS total, count_if(ok) AS ok, count_if(NOT ok) AS failed, count_if(transport_ok) AS transport_ok,
      count_if(transport_ok AND has_records) AS content_ok, round_even(count_if(transport_ok) / count(*), 4) AS transport_ratio FROM healthy GROUP BY kind""",
)
def _(spark, sf):
    return aggregates.health_rollup(quality.health_semantics(source_checks(spark, sf)))


@query(
    "freshness_by_source",
    f"""{WITH_NEWS} SELECT lower(source) AS source, round_even(date_diff('second', max(published_at), {_AS}) / 86400.0, 2) AS age_days FROM news_items WHERE published_at IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    return aggregates.freshness_by_source(news_items(spark, sf), AS_OF)


@query("core_source_alive", f"{WITH_CHECKS}, {_D_HEALTH} SELECT count(*) AS core_checks, count(*) = 0 OR bool_or(ok) AS alive FROM healthy WHERE starts_with(source_id, 'src_1')")
def _(spark, sf):
    return quality.core_source_alive(quality.health_semantics(source_checks(spark, sf)), ["src_1"])


_LIMITS = {"reuters": (True, 30), "ishka airfinance": (False, 1), "flightglobal": (True, 0), "nobody": (True, 14)}


def _coverage_sql():
    hard = "SELECT 'hard' AS kind, '{n}' AS name, {ok} AS ok, CAST({m} AS DOUBLE) AS measure FROM {t}"
    arms = [
        hard.format(n="direct_all_feeds_return_records", ok="count(*) > 0 AND count(*) = count_if(transport_ok AND has_records)", m="count_if(transport_ok AND has_records)", t="healthy WHERE starts_with(source_id, 'src_2')"),
        hard.format(n="search_transport_ratio", ok="round_even(count_if(transport_ok) / count(*), 4) >= 0.9", m="round_even(count_if(transport_ok) / count(*), 4)", t="healthy WHERE kind = 'rss_search'"),
        hard.format(n="baseline_recall", ok="avg(quality) = 1", m="avg(quality)", t="labels"),
    ]
    for s, (must, days) in _LIMITS.items():
        if must:
            arms.append(hard.format(n=s + "_present", ok="count(*) > 0", m="count(*)", t=f"news_items WHERE lower(source) = '{s}'"))
        age = f"round_even(date_diff('second', max(published_at), {_AS}) / 86400.0, 2)"
        arms.append(hard.replace("'hard'", "'warning'").format(n=s + "_fresh", ok=f"coalesce({age} <= {days}, false)", m=age, t=f"news_items WHERE lower(source) = '{s}'"))
    return f"{WITH_NEWS}, checks AS ({views.duck(views.SOURCE_CHECKS)}), {_D_HEALTH} " + " UNION ALL ".join(arms)


@query("coverage_report", _coverage_sql())
def _(spark, sf):
    recall = table(spark, sf, "labels").agg(F.avg("quality").alias("recall"))
    return quality.coverage_report(
        quality.health_semantics(source_checks(spark, sf)), news_items(spark, sf), recall, {"direct": "src_2"}, AS_OF, _LIMITS
    )


# The limits of the operational health check (hours, days, shares).
THRESHOLDS = [
    ("failed_checks", "error", 0.0, True),
    ("feed_age_hours", "error", 3.0, True),
    ("newest_story_age_hours", "warning", 96.0, True),
    ("fallback_ratio", "warning", 0.2, False),
    ("fallback_ratio", "warning", 0.5, False),
    ("ishka airfinance_age_days", "warning", 2.0, True),
    ("aviation news online_age_days", "warning", 3.0, True),
    ("reuters_age_days", "warning", 10.0, True),
    ("flightglobal_age_days", "warning", 14.0, True),
]


def health_metrics(spark, sf):
    """Operational metrics in long form, from the checks, the stories and the raw items."""
    checks = quality.health_semantics(source_checks(spark, sf))
    stories = views.stories(spark, sf)
    one = lambda df, name, value: df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")
    hours = lambda ts, as_of: F.timestamp_diff("SECOND", ts, F.lit(as_of).cast("timestamp_ntz")) / F.lit(3600.0)
    ages = aggregates.freshness_by_source(news_items(spark, sf), AS_OF)
    return (
        one(checks, "failed_checks", F.count_if(~F.col("ok")))
        .unionByName(one(checks, "feed_age_hours", hours(F.max("checked_at"), EVENTS_AS_OF)))
        .unionByName(one(stories, "newest_story_age_hours", hours(F.max("published_at"), AS_OF)))
        .unionByName(one(stories, "fallback_ratio", F.count_if(F.col("analysis_mode") != "annotated") / F.count(F.lit(1))))
        .unionByName(ages.select(F.concat("source", F.lit("_age_days")).alias("metric"), F.col("age_days").alias("value")))
    )


_D_METRICS = f"""m AS (SELECT 'failed_checks' AS metric, CAST(count_if(NOT ok) AS DOUBLE) AS value FROM healthy
  UNION ALL SELECT 'feed_age_hours', date_sub('second', max(checked_at), TIMESTAMP '{EVENTS_AS_OF}') / 3600.0 FROM healthy
  UNION ALL SELECT 'newest_story_age_hours', date_diff('second', max(published_at), {_AS}) / 3600.0 FROM news_items
  UNION ALL SELECT 'fallback_ratio', count_if(n_chars % 2 = 1) / count(*) FROM news_items
  UNION ALL SELECT lower(source) || '_age_days', round_even(date_diff('second', max(published_at), {_AS}) / 86400.0, 2) FROM news_items WHERE published_at IS NOT NULL GROUP BY 1)"""
_D_LIMITS = "th AS (SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{s}', {l}, {str(x).lower()})" for m, s, l, x in THRESHOLDS) + ") AS t(metric, severity, lim, miss))"
_D_VIOL = f"""{WITH_NEWS}, checks AS ({views.duck(views.SOURCE_CHECKS)}), {_D_HEALTH}, {_D_METRICS}, {_D_LIMITS},
 hit AS (SELECT th.*, m.value, row_number() OVER (PARTITION BY th.metric ORDER BY lim DESC) AS rn FROM th LEFT JOIN m USING (metric) WHERE CASE WHEN value IS NULL THEN miss ELSE value > lim END),
 v AS (SELECT metric AS check, severity, metric AS key, round(value, 4) AS value FROM hit WHERE rn = 1)"""


def health_violations(spark, sf):
    limits = spark.createDataFrame(THRESHOLDS, "metric string, severity string, limit double, missing_fails boolean")
    return quality.pipeline_health(health_metrics(spark, sf), limits)


@query("pipeline_health", f"{_D_VIOL} SELECT v.check, severity, key, value FROM v")
def _(spark, sf):
    return health_violations(spark, sf).withColumn("value", F.expr("try_cast(detail AS DOUBLE)")).drop("detail")


@query(
    "publish_gate",
    f"""{_D_VIOL} SELECT count_if(severity = 'error') AS errors, count_if(severity = 'warning') AS warnings,
      CASE WHEN count_if(severity = 'error') > 0 THEN 'fail' WHEN count(*) > 0 THEN 'degraded' ELSE 'healthy' END AS status, count_if(severity = 'error') = 0 AS publish_allowed FROM v""",
)
def _(spark, sf):
    return quality.publish_gate(health_violations(spark, sf))
