"""Faceted feed query over the enriched archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.functions.text import is_model_code, model_key, search_text
from newsgrid.operators.ranking import feed_order, newest_order


def story_companies(stories: DataFrame) -> DataFrame:
    """(id, company): entities that are not model codes, plus watched names.

    A model code has the usual shape, or equals the key of any aircraft tag in the table.
    """
    tag_keys = stories.select(F.explode("aircraft_tags").alias("t")).select(model_key("t").alias("key")).distinct()
    ents = stories.select("id", F.explode("entities").alias("company")).filter(
        (F.col("company") != "") & ~is_model_code("company")
    )
    kept = ents.withColumn("key", model_key("company")).join(tag_keys, "key", "left_anti").select("id", "company")
    names = stories.select("id", F.explode("priority_matches").alias("m")).select("id", F.col("m.name").alias("company"))
    return kept.unionByName(names).distinct()


def company_lists(stories: DataFrame) -> DataFrame:
    """(id, companies): entity and watch lists are capped, so each list is short."""
    return story_companies(stories).groupBy("id").agg(F.array_sort(F.collect_list("company")).alias("companies"))


def feed_search(
    stories: DataFrame,
    q: str = "",
    date_from: str = "",
    date_to: str = "",
    source: str = "",
    category: str = "",
    region: str = "",
    company: str = "",
    model: str = "",
    mode: str = "",
    sort: str = "importance",
) -> DataFrame:
    """All given conditions together; cheap column filters run before the company list is built."""
    day = F.col("published_at").cast("date")
    conditions = [
        (date_from, lambda: day >= F.lit(date_from).cast("date")),
        (date_to, lambda: day <= F.lit(date_to).cast("date")),
        (source, lambda: F.array_contains("source_names", source)),
        (category, lambda: F.col("category") == category),
        (region, lambda: F.col("region") == region),
        (model, lambda: F.array_contains("aircraft_tags", model)),
        (mode == "critical", lambda: F.col("critical")),
        (mode == "priority", lambda: F.size("priority_matches") > 0),
        (mode == "macro", lambda: F.col("score_components.macro_related")),
    ]
    rows = stories
    for given, condition in conditions:
        if given:
            rows = rows.filter(condition())
    if company:
        rows = rows.join(story_companies(stories).filter(F.col("company") == company).select("id"), "id", "left_semi")
    if q.strip():
        rows = rows.join(company_lists(stories), "id", "left")
        hay = search_text(
            "title", "summary_zh", "why_it_matters_zh", "entities", "companies", "aircraft_tags", "macro_tags"
        )
        rows = rows.filter(hay.contains(q.strip().lower())).drop("companies")
    return rows.orderBy(*(newest_order() if sort == "newest" else feed_order()))


URL_MODES = ("critical", "priority", "macro")


def preset_params(params: dict) -> dict:
    """Search arguments from URL parameters: one mode flag, q, from and to."""
    mode = next((m for m in URL_MODES if params.get(m) == "1"), "")
    return {"q": params.get("q", ""), "date_from": params.get("from", ""), "date_to": params.get("to", ""), "mode": mode}


def facet_values(stories: DataFrame) -> DataFrame:
    """Distinct values per facet in one pass over the stories plus the company rule."""
    named = lambda facet, values: F.transform(values, lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))
    stacked = F.concat(
        named("source", F.col("source_names")),
        named("category", F.array("category")),
        named("region", F.array("region")),
        named("aircraft", F.col("aircraft_tags")),
    )
    plain = stories.select(F.explode(stacked).alias("x")).select("x.facet", "x.value")
    companies = story_companies(stories).select(F.lit("company").alias("facet"), F.col("company").alias("value"))
    both = plain.unionByName(companies).filter(F.col("value").isNotNull() & (F.col("value") != ""))
    return both.distinct().orderBy("facet", "value")
