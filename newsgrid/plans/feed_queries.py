"""Queries over the served feed: order, lists, counts, search and facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import views
from newsgrid.functions.text import MODEL_KEY_PATTERN
from newsgrid.operators import aggregates, feed, ranking
from newsgrid.plans.base import enriched, served_table
from newsgrid.plans.duck_sql import SCORED
from newsgrid.plans.registry import query
from newsgrid.views import AS_OF, WITH_NEWS, WITH_STORIES, news_items

_ORDER = "importance_score DESC, published_at DESC NULLS LAST, id"
_MODE = "CASE WHEN n_chars % 2 = 0 THEN 'annotated' ELSE 'fallback_rules' END"


def served(spark, sf):
    """Enriched stories, half of them standing for annotated ones."""
    return enriched(spark, sf).withColumn("ai_mode", F.col("analysis_mode"))


def _places(df):
    return df.select("id", "importance_score", F.col("place"))


@query("top_feed", f"{SCORED} SELECT id, importance_score, row_number() OVER (ORDER BY {_ORDER}) AS place FROM enriched ORDER BY {_ORDER} LIMIT 10")
def _(spark, sf):
    return _places(ranking.top_feed(enriched(spark, sf)))


@query("top_critical", f"{SCORED} SELECT id, importance_score, row_number() OVER (ORDER BY {_ORDER}) AS place FROM enriched WHERE critical ORDER BY {_ORDER} LIMIT 10")
def _(spark, sf):
    return _places(ranking.top_critical(enriched(spark, sf)))


@query("rank_feed", f"{SCORED} SELECT id, importance_score FROM enriched")
def _(spark, sf):
    return ranking.rank_feed(enriched(spark, sf)).select("id", "importance_score")


@query("rank_newest", f"{SCORED} SELECT id, importance_score, strftime(published_at, '%Y-%m-%d %H:%M') AS published FROM enriched")
def _(spark, sf):
    return ranking.rank_newest(enriched(spark, sf)).select(
        "id", "importance_score", F.date_format("published_at", "yyyy-MM-dd HH:mm").alias("published")
    )


@query(
    "annotation_queue",
    f"""{WITH_STORIES}, p AS (SELECT *, published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS cur FROM stories),
    r AS (SELECT id, row_number() OVER (ORDER BY CASE WHEN cur THEN 1 ELSE 0 END DESC, importance_score DESC, published_at DESC NULLS LAST, id) AS place FROM p WHERE analysis_mode <> 'annotated')
    SELECT id, place, CAST((place - 1) // 16 AS INT) + 1 AS batch FROM r WHERE place <= 260""",
)
def _(spark, sf):
    pending = views.stories(spark, sf).filter("analysis_mode <> 'annotated'").withColumn("in_current", in_current())
    return ranking.annotation_queue(pending).select("id", "place", "batch")


def in_current():
    return F.coalesce(F.col("published_at") >= F.expr(f"TIMESTAMP_NTZ '{AS_OF}' - INTERVAL 7 DAYS"), F.lit(False))


@query(
    "backfill_queue",
    f"""{SCORED}, p AS (SELECT *, coalesce(published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY, false) AS cur, CASE WHEN n_even THEN 'annotated text' ELSE summary_zh END AS s
       FROM (SELECT *, analysis_mode = 'annotated' AND source_count < 3 AS n_even FROM enriched)),
    r AS (SELECT id, row_number() OVER (ORDER BY CASE WHEN cur THEN 1 ELSE 0 END DESC, CASE WHEN len(names) > 0 THEN 1 ELSE 0 END DESC, importance_score DESC, published_at DESC NULLS LAST, id) AS place FROM p
       WHERE analysis_mode <> 'annotated' OR starts_with(s, '根据公开标题与元数据：'))
    SELECT id, place, CAST((place - 1) // 6 AS INT) + 1 AS batch FROM r WHERE place <= 240""",
)
def _(spark, sf):
    own = (F.col("analysis_mode") == "annotated") & (F.col("source_count") < 3)
    df = served(spark, sf).withColumn("summary_zh", F.when(own, F.lit("annotated text")).otherwise(F.col("summary_zh")))
    return ranking.backfill_queue(df.withColumn("in_current", in_current())).select("id", "place", "batch")


@query("count_by_source", f"{WITH_NEWS} SELECT source, count(*) AS n FROM news_items GROUP BY source")
def _(spark, sf):
    return aggregates.count_by(news_items(spark, sf), "source")


@query("count_by_channel", f"{WITH_NEWS} SELECT coalesce(nullif(source_channel, 'old_web_channel'), 'Unknown') AS source_channel, count(*) AS n FROM news_items GROUP BY 1")
def _(spark, sf):
    channel = F.nullif("source_channel", F.lit("old_web_channel"))
    return aggregates.count_by(news_items(spark, sf).withColumn("source_channel", channel), "source_channel")


@query("count_by_category", f"{WITH_STORIES} SELECT category, count(*) AS n FROM stories GROUP BY category")
def _(spark, sf):
    return aggregates.count_by(views.stories(spark, sf), "category")


@query("source_mentions", f"{WITH_STORIES}, u AS (SELECT unnest(string_split(source_names_text, '|')) AS name FROM stories) SELECT name, count(*) AS mentions FROM u GROUP BY name")
def _(spark, sf):
    return aggregates.source_mentions(views.stories(spark, sf))


@query("priority_mentions", f"{SCORED}, u AS (SELECT unnest(names) AS name FROM enriched) SELECT name, count(*) AS mentions FROM u GROUP BY name")
def _(spark, sf):
    return aggregates.priority_mentions(enriched(spark, sf))


@query(
    "conditional_counts",
    f"""{SCORED} SELECT count(*) AS stories, count_if(critical) AS critical_stories, count_if(len(names) > 0) AS priority_stories, count_if(macro_related) AS macro_stories,
      count_if(analysis_mode = 'annotated') AS annotated_stories, count_if(analysis_mode <> 'annotated') AS fallback_stories FROM enriched""",
)
def _(spark, sf):
    return aggregates.feed_stats(served(spark, sf))


@query(
    "backlog_ratio",
    f"""{WITH_STORIES} SELECT count(*) AS total, count_if(analysis_mode <> 'annotated') AS fallback, round_even(count_if(analysis_mode <> 'annotated') / greatest(1, count(*)), 4) AS ratio FROM stories""",
)
def _(spark, sf):
    return aggregates.backlog_ratio(views.stories(spark, sf).withColumn("ai_mode", F.col("analysis_mode")))


_D_KEY = r"regexp_replace(upper({c}), '[\s\-_/().]', '', 'g')"
_D_COMPANIES = f"""tag_keys AS (SELECT DISTINCT {_D_KEY.format(c='m')} AS key FROM (SELECT unnest(models) AS m FROM enriched)),
ents AS (SELECT id, e, {_D_KEY.format(c='e')} AS key FROM (SELECT id, unnest(string_split(entities_text, '|')) AS e FROM enriched) WHERE e <> ''),
companies AS (SELECT id, e AS company FROM ents WHERE NOT regexp_matches(key, '{MODEL_KEY_PATTERN}') AND key NOT IN (SELECT key FROM tag_keys)
  UNION SELECT id, n FROM (SELECT id, unnest(names) AS n FROM enriched))"""
SEARCHABLE = f"""{SCORED}, {_D_COMPANIES}, lists AS (SELECT id, list_sort(list(company)) AS cs FROM companies GROUP BY id),
 s AS (SELECT e.*, lower(array_to_string(list_concat([title, summary_zh, why_it_matters_zh], [x for x in string_split(entities_text, '|') if x <> ''], coalesce(cs, []), models, tags), ' ')) AS hay, coalesce(cs, []) AS cs
   FROM enriched e LEFT JOIN lists USING (id))"""


@query(
    "feed_search",
    f"""{SEARCHABLE}
    SELECT 'text' AS search, id FROM s WHERE contains(hay, 'th') AND CAST(published_at AS DATE) BETWEEN DATE '2024-01-20' AND DATE '2024-04-10'
    UNION ALL SELECT 'source', id FROM s WHERE list_contains(string_split(source_names_text, '|'), 'Reuters') AND category = 'Engines & MRO'
    UNION ALL SELECT 'company', id FROM s WHERE list_contains(cs, 'Airbus') AND region = 'Europe'
    UNION ALL SELECT 'model', id FROM s WHERE list_contains(models, 'A320NEO') AND critical
    UNION ALL SELECT 'priority', id FROM s WHERE len(names) > 0 AND contains(hay, 'air china')
    UNION ALL SELECT 'macro', id FROM s WHERE macro_related""",
)
def _(spark, sf):
    df = served_table(enriched(spark, sf))
    searches = {
        "text": dict(q="TH ", date_from="2024-01-20", date_to="2024-04-10"),
        "source": dict(source="Reuters", category="Engines & MRO"),
        "company": dict(company="Airbus", region="Europe"),
        "model": dict(model="A320NEO", mode="critical"),
        "priority": feed.preset_params({"q": "Air China", "priority": "1"}),
        "macro": dict(mode="macro", sort="newest"),
    }
    found = [feed.feed_search(df, **p).select(F.lit(name).alias("search"), "id") for name, p in searches.items()]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


@query(
    "facet_values",
    f"""{SCORED}, {_D_COMPANIES}, f AS (SELECT 'source' AS facet, unnest(string_split(source_names_text, '|')) AS value FROM enriched
      UNION SELECT 'category', category FROM enriched UNION SELECT 'region', region FROM enriched UNION SELECT 'aircraft', unnest(models) FROM enriched
      UNION SELECT 'company', company FROM companies) SELECT facet, value FROM f WHERE value <> ''""",
)
def _(spark, sf):
    return feed.facet_values(served_table(enriched(spark, sf)))


@query(
    "filtered_totals",
    f"""{SEARCHABLE} SELECT count(*) AS stories, count_if(critical) AS critical_stories, count_if(len(names) > 0) AS priority_stories, count_if(macro_related) AS macro_stories
      FROM s WHERE region = 'Europe' AND CAST(published_at AS DATE) >= DATE '2024-02-01'""",
)
def _(spark, sf):
    return aggregates.filtered_totals(feed.feed_search(served_table(served(spark, sf)), region="Europe", date_from="2024-02-01"))
