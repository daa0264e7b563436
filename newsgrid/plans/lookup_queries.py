"""Queries over joins with snippets, prior results and annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import dims, views
from newsgrid.operators import lookups, score
from newsgrid.plans.base import joined, texted
from newsgrid.plans.duck_sql import RULED, q
from newsgrid.plans.registry import query
from newsgrid.plans.scalar_queries import d_clean, d_fingerprint
from newsgrid.views import WITH_NEWS, WITH_STORIES, news_items, table


@query(
    "snippet_join",
    f"""WITH c AS (SELECT conv_id, turn, {d_clean('text')} AS t FROM conversations), f AS (SELECT conv_id, lower(t) AS l, min(turn) AS pos, arg_min(t, turn) AS t FROM c WHERE t <> '' GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS rn FROM f)
    SELECT conv_id, string_agg(substr(t, 1, 650), '|' ORDER BY rn) AS snippets FROM r WHERE rn <= 3 GROUP BY conv_id""",
)
def _(spark, sf):
    conv = table(spark, sf, "conversations")
    rid = F.concat_ws(":", "conv_id", "turn")
    rows = conv.select("conv_id", F.col("turn").alias("pos"), rid.alias("raw_id"))
    raw = conv.select(rid.alias("raw_id"), F.col("text").alias("summary"))
    return lookups.snippets(rows, raw, "conv_id").select("conv_id", F.array_join("snippets", "|").alias("snippets"))


@query(
    "prior_result_join",
    f"""{WITH_STORIES}, n AS (SELECT id, {d_fingerprint('category', region='region', raw='[raw_id]', names="string_split(source_names_text, '|')", links="[url for x in string_split(source_names_text, '|')]")} AS fp, n_chars FROM (SELECT *, length(summary) AS n_chars FROM stories))
    SELECT id, fp AS fingerprint, n_chars % 2 = 0 AND n_chars % 5 <> 0 AND n_chars % 3 <> 0 AS reused FROM n""",
)
def _(spark, sf):
    n = F.length("summary")
    stories = views.stories(spark, sf).withColumn("fingerprint", score.fingerprint())
    prior = stories.filter(n % 3 != 0).select(
        "id",
        F.when(n % 2 == 0, F.col("fingerprint")).otherwise(F.lit("stale")).alias("prior_fingerprint"),
        F.when(n % 5 == 0, F.lit(" ")).otherwise(F.lit("kept")).alias("prior_summary"),
        F.lit("why").alias("prior_why"),
        F.lit(True).alias("prior_has_components"),
    )
    return lookups.reuse_prior(stories, prior).select("id", "fingerprint", "reused")


_TOPICS = list(dims.MACRO_TOPICS)


@query(
    "annotation_apply",
    f"""{RULED}, a AS (SELECT r.*, l.doc_id IS NOT NULL AS hit, l.quality, l.toxic FROM ruled r LEFT JOIN labels l ON l.doc_id = r.doc_id)
    SELECT id, CASE WHEN hit AND quality = 1 THEN 'Annotated ' || {d_clean('title')} ELSE summary_zh END[1:220] AS summary_zh,
      CASE WHEN hit THEN CASE WHEN quality = 1 THEN 100 WHEN toxic = 1 THEN 0 ELSE market_materiality END ELSE market_materiality END AS market_materiality,
      CASE WHEN hit THEN toxic = 1 ELSE critical_candidate END AS critical_candidate,
      array_to_string(list_sort(CASE WHEN hit THEN list_distinct(list_concat([{q(_TOPICS[4])}], tags)) ELSE tags END), '|') AS macro_tags,
      CASE WHEN hit THEN 'annotated' ELSE 'fallback_rules' END AS ai_mode FROM a""",
)
def _(spark, sf):
    ruled = score.rule_annotation(texted(spark, sf)).withColumn(
        "summary_zh", F.substring("summary_zh", 1, 220)
    )
    titles = views.stories(spark, sf).select("doc_id", "id", "title")
    text_list = lambda *xs: F.array(*[F.lit(x) for x in xs])
    ann = table(spark, sf, "labels").join(titles, "doc_id").select(
        "id",
        F.when(F.col("quality") == 1, F.concat(F.lit(" Annotated  "), F.col("title"))).alias("ann_summary"),
        F.lit(None).cast("string").alias("ann_why"),
        F.when(F.col("quality") == 1, F.lit("180")).when(F.col("toxic") == 1, F.lit("-3.5")).otherwise(F.lit("n/a")).alias("ann_materiality"),
        F.lit(None).cast("string").alias("ann_lessor"),
        F.lit(None).cast("string").alias("ann_macro"),
        (F.col("toxic") == 1).alias("ann_critical"),
        F.lit("").alias("ann_reason"),
        text_list("Not a topic", _TOPICS[4] + " ").alias("ann_macro_tags"),
        text_list("Airbus").alias("ann_key_entities"),
        text_list("a320 neo").alias("ann_aircraft_tags"),
    )
    out = lookups.apply_annotations(ruled, ann, _TOPICS)
    return out.select("id", "summary_zh", "market_materiality", "critical_candidate", joined("macro_tags", "macro_tags"), "ai_mode")


@query(
    "annotation_category",
    f"""{WITH_STORIES} SELECT id, CASE WHEN doc_id % 7 = 0 THEN 'Engines & MRO' WHEN doc_id % 5 = 0 THEN 'Legal & Regulatory' WHEN doc_id % 3 = 0 AND category <> 'Other' THEN category ELSE 'Airlines & Credit' END AS category FROM stories""",
)
def _(spark, sf):
    n = F.col("doc_id")
    given = F.when(n % 5 == 0, F.lit(" Legal & Regulatory ")).otherwise(F.lit("Sports"))
    locked = F.when(n % 7 == 0, F.lit("Engines & MRO"))
    prior = F.when(n % 3 == 0, F.col("category"))
    return views.stories(spark, sf).select("id", lookups.annotation_category(locked, given, prior, F.lit("Airlines & Credit")).alias("category"))


@query(
    "annotation_request",
    f"""{WITH_NEWS} SELECT id, substr({d_clean('title')}, 1, 280) AS title, substr({d_clean('summary')}, 1, 300) AS summary, substr({d_clean('region_raw')}, 1, 70) AS region, source AS sources,
      array_to_string(list_sort(list_distinct([c for c in string_split(categories_text, '|') if c <> ''])), '|') AS raw_categories,
      array_to_string(list_sort(list_distinct([c for c in string_split(entities_text, '|') if c <> ''])), '|') AS entities FROM news_items""",
)
def _(spark, sf):
    items = news_items(spark, sf).withColumns({"region": F.col("region_raw"), "source_names": F.array("source")})
    lists = [F.array_join(c, "|").alias(c) for c in ("sources", "raw_categories", "entities")]
    return lookups.annotation_request(items).select("id", "title", "summary", "region", *lists)


@query(
    "story_request",
    f"""{WITH_STORIES} SELECT id, substr({d_clean('title')}, 1, 320) AS title, category, region, array_to_string([c for c in string_split(entities_text, '|') if c <> ''], '|') AS entities, source_names_text AS sources FROM stories""",
)
def _(spark, sf):
    lists = [F.array_join(c, "|").alias(c) for c in ("entities", "sources")]
    return lookups.story_request(views.stories(spark, sf)).select("id", "title", "category", "region", *lists)
