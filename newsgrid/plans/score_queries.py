"""Queries over extraction, classification, scoring and ranking decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import dims, views
from newsgrid.functions.text import alias_match, contains_any, ws_clean
from newsgrid.operators import classify, lookups, score
from newsgrid.plans.base import enriched, joined, texted, whole_texted
from newsgrid.plans.duck_sql import (
    D_QUALITY, D_RECENCY, RULED, SCORED, WHOLE_TEXTED, d_alias, d_compact, d_count, d_distinct_ci, d_rank, q,
)
from newsgrid.plans.registry import query
from newsgrid.plans.scalar_queries import d_clean
from newsgrid.views import AS_OF, WITH_NEWS, WITH_STORIES, news_items

_D_TEXT = f"{d_clean('title')} || ' | ' || {d_clean('summary')}"
_D_ENTS = (
    "list_concat("
    + ", ".join(f"[{d_clean('m')} for m in regexp_extract_all(txt, {q('(?i)' + p)}, 0)]" for p in dims.ENTITY_PATTERNS[:2])
    + ", "
    + ", ".join(f"[{d_clean('m')} for m in regexp_extract_all(txt, {q('(?i)' + p)}, 0)]" for p in dims.ENTITY_PATTERNS[2:])
    + ")"
)


@query(
    "entity_extract",
    f"""{WITH_NEWS}, t AS (SELECT doc_id, CASE WHEN {d_clean('title')} = '' THEN {d_clean('summary')} ELSE {_D_TEXT} END AS txt FROM news_items),
    e AS (SELECT doc_id, {_D_ENTS} AS all_found FROM t)
    SELECT doc_id, array_to_string(list_slice({d_distinct_ci('all_found')}, 1, 16), '|') AS entities FROM e""",
)
def _(spark, sf):
    return news_items(spark, sf).select("doc_id", F.array_join(classify.extract_terms("title", "summary"), "|").alias("entities"))


@query("model_tag_extract", f"{WHOLE_TEXTED} SELECT id, array_to_string(models, '|') AS models FROM texted")
def _(spark, sf):
    return whole_texted(spark, sf).select("id", joined("text_models", "models"))


def _low():
    return F.lower(ws_clean(F.concat_ws(" ", ws_clean("title"), ws_clean("summary"))))


_D_LOW = f"lower(trim({d_clean('title')} || ' ' || {d_clean('summary')}))"
_D_SCORES = "[" + ", ".join(d_count("low", v) for v in dims.KEYWORDS.values()) + "]"
_D_NAMES = "[" + ", ".join(q(k) for k in dims.KEYWORDS) + "]"


@query(
    "keyword_category",
    f"""{WITH_NEWS}, t AS (SELECT doc_id, source_channel, CASE WHEN doc_id % 6 = 0 THEN lower(lang) ELSE {_D_LOW} END AS low FROM news_items),
    s AS (SELECT *, {_D_SCORES} AS sc FROM t)
    SELECT doc_id, CASE WHEN list_max(sc) > 0 THEN {_D_NAMES}[list_position(sc, list_max(sc))] WHEN source_channel IN ('aviationnews_engine', 'aviationnews_maintenance') THEN 'Engines & MRO'
      WHEN source_channel IN ('aviationnews_legal', 'aviationnews_regulatory') THEN 'Legal & Regulatory' WHEN starts_with(source_channel, 'ishka_') THEN 'Leasing & Trading' ELSE 'Airlines & Credit' END AS category FROM s""",
)
def _(spark, sf):
    low = F.when(F.col("doc_id") % 6 == 0, F.lower("lang")).otherwise(_low())
    items = news_items(spark, sf).select("doc_id", "source_channel", low.alias("low"))
    return items.select("doc_id", classify.keyword_category("low", "source_channel").alias("category"))


_D_LOCKS = d_compact((c, "(" + " OR ".join(f"regexp_matches(low, {q('(?i)' + p)})" for p in ps) + ")") for c, ps in dims.LOCK_PATTERNS.items())


@query(
    "category_lock",
    f"""{WITH_STORIES}, t AS (SELECT id, category, lower({d_clean('title')} || ' | ' || {d_clean('summary')} || ' | ' || replace(entities_text, '|', ' ')) AS low FROM stories),
    h AS (SELECT id, category, {_D_LOCKS} AS hits FROM t)
    SELECT id, CASE WHEN len(hits) = 1 AND (category = 'Other' OR category = hits[1]) THEN hits[1] END AS locked FROM h""",
)
def _(spark, sf):
    low = F.lower(F.concat_ws(" | ", ws_clean("title"), ws_clean("summary"), F.array_join("entities", " ")))
    rows = views.stories(spark, sf).select("id", "category", low.alias("low"))
    return rows.select("id", classify.category_lock("low", "category").alias("locked"))


@query(
    "provisional_importance",
    f"""{WITH_STORIES}, t AS (SELECT id, {_D_LOW} AS low, list_max([{d_rank('n', 60)} for n in string_split(source_names_text, '|')]) AS rk FROM stories)
    SELECT id, CAST(least(greatest(45 + greatest(0, rk - 60) // 4 + least(24, 4 * {d_count('low', dims.STRONG_TERMS)}), 35), 88) AS INT) AS importance FROM t""",
)
def _(spark, sf):
    top = F.array_max(F.transform("source_names", lambda n: lookups.source_rank(n, 60)))
    rows = views.stories(spark, sf).select("id", _low().alias("low"), top.alias("top"))
    return rows.select("id", classify.provisional_importance("low", "top").alias("importance"))


@query("alias_tag_join", f"{WHOLE_TEXTED}, u AS (SELECT id, unnest(names) AS name FROM texted) SELECT id, name FROM u")
def _(spark, sf):
    return whole_texted(spark, sf).select("id", F.explode("priority_matches").alias("m")).select("id", F.col("m.name").alias("name"))


@query("topic_tag_join", f"{WHOLE_TEXTED} SELECT id, array_to_string(tags, '|') AS tags FROM texted")
def _(spark, sf):
    return whole_texted(spark, sf).select("id", F.array_join("rule_tags", "|").alias("tags"))


@query("contains_any", f"{WHOLE_TEXTED} SELECT id, severe_event AS severe, direct_lessor_event AS direct, material_event AS material FROM texted")
def _(spark, sf):
    low = F.lower("scoring_text")
    return whole_texted(spark, sf).select(
        "id",
        contains_any(low, dims.SEVERE_TERMS).alias("severe"),
        contains_any(low, dims.DIRECT_TERMS).alias("direct"),
        contains_any(low, dims.MATERIAL_TERMS).alias("material"),
    )


_ALIASES = ["SAS", "IAG", "thatin", "hehely", "Wizz", "KLM", "Chang'an Airlines", "国航", "Air France-KLM"]


@query(
    "alias_match",
    f"SELECT doc_id, " + ", ".join(f"{d_alias('low', a)} AS a{i}" for i, a in enumerate(_ALIASES)) + f" FROM (SELECT doc_id, lower(text) AS low FROM documents)",
)
def _(spark, sf):
    docs = views.table(spark, sf, "documents").select("doc_id", F.lower("text").alias("low"))
    return docs.select("doc_id", *[alias_match("low", a).alias(f"a{i}") for i, a in enumerate(_ALIASES)])


_RULE_COLS = "market_materiality, lessor_relevance, macro_relevance, critical_candidate, summary_zh, why_it_matters_zh"


@query("rule_annotation", f"{RULED} SELECT id, {_RULE_COLS}, candidate_reason AS critical_reason_zh, array_to_string(names, '|') AS key_entities FROM ruled")
def _(spark, sf):
    return score.rule_annotation(texted(spark, sf)).select(
        "id", *_RULE_COLS.split(", "), "critical_reason_zh", F.array_join("key_entities", "|").alias("key_entities")
    )


@query("source_quality", f"{WITH_STORIES} SELECT id, {D_QUALITY} AS quality FROM stories")
def _(spark, sf):
    return views.stories(spark, sf).select("id", lookups.best_rank("source_names").alias("quality"))


@query("source_rank_lookup", f"{WITH_NEWS} SELECT doc_id, {d_rank('source', 60)} AS cluster_rank, {d_rank('source', 65)} AS quality_rank FROM news_items")
def _(spark, sf):
    return news_items(spark, sf).select(
        "doc_id", lookups.source_rank("source", 60).alias("cluster_rank"), lookups.source_rank("source", 65).alias("quality_rank")
    )


@query("recency_score", f"{WITH_NEWS} SELECT doc_id, {D_RECENCY} AS recency FROM news_items")
def _(spark, sf):
    return news_items(spark, sf).select("doc_id", score.recency_score(F.col("published_at"), AS_OF).alias("recency"))


@query("macro_flags", f"{SCORED} SELECT id, macro_related, systemic_macro FROM enriched")
def _(spark, sf):
    return score.macro_flags(score.rule_annotation(texted(spark, sf))).select("id", "macro_related", "systemic_macro")


_PARTS = ", ".join(score.COMPONENTS)


@query("weighted_score", f"{SCORED} SELECT id, importance_score AS score, {_PARTS} FROM enriched")
def _(spark, sf):
    ruled = score.rule_annotation(texted(spark, sf))
    return score.weighted_score(ruled, dims.SAMPLE_CONFIG, AS_OF).select("id", "score", *score.COMPONENTS)


@query("critical_decision", f"{SCORED} SELECT id, importance_score AS score, critical, critical_reason_zh FROM enriched")
def _(spark, sf):
    scored = score.weighted_score(score.rule_annotation(texted(spark, sf)), dims.SAMPLE_CONFIG, AS_OF)
    return score.critical_decision(scored).select("id", "score", "critical", "critical_reason_zh")


@query(
    "enrich",
    f"""{SCORED} SELECT id, title, category, region, importance_score, critical, critical_reason_zh, summary_zh, why_it_matters_zh, array_to_string(names, '|') AS names,
      array_to_string(list_sort(tags), '|') AS macro_tags, array_to_string(models, '|') AS aircraft_tags, weighted_base, bonuses, applied_floor FROM enriched""",
)
def _(spark, sf):
    return enriched(spark, sf).select(
        "id", "title", "category", "region", "importance_score", "critical", "critical_reason_zh", "summary_zh", "why_it_matters_zh",
        F.array_join(F.transform("priority_matches", lambda m: m["name"]), "|").alias("names"),
        joined("macro_tags", "macro_tags"), joined("aircraft_tags", "aircraft_tags"),
        "score_components.weighted_base", "score_components.bonuses", "score_components.applied_floor",
    )
