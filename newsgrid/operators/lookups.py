"""Joins against stored results, snippets and annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.numbers import clamp_int
from newsgrid.functions.text import as_col, non_empty, ws_clean


def source_rank(name, default: int = 60):
    ranks = F.create_map(*[F.lit(x) for pair in dims.SOURCE_RANK.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, ws_clean(name)), F.lit(default))


def best_rank(names, unknown: int = 65, none: int = 60):
    ranks = F.transform(non_empty(F.transform(as_col(names), ws_clean)), lambda n: source_rank(n, unknown))
    return F.coalesce(F.array_max(ranks), F.lit(none))


def members(stories: DataFrame, key: str = "id") -> DataFrame:
    """(story key, position, raw id) rows of a story table."""
    return stories.select(F.col(key), F.posexplode("raw_ids").alias("pos", "raw_id"))


def snippets(member_rows: DataFrame, raw: DataFrame, key: str = "id", k: int = 3, cut: int = 650) -> DataFrame:
    """First ``k`` case-insensitively distinct summaries of a story's raw items, in member order.

    Repeats collapse in a partial aggregate and the top ``k`` is a rank filter, so a story with
    very many members never gathers them in one task; at most ``k`` rows per story reach the list.
    """
    joined = member_rows.join(raw.select("raw_id", ws_clean("summary").alias("_text")), "raw_id").filter(F.col("_text") != "")
    first = joined.groupBy(key, F.lower("_text").alias("_low")).agg(
        F.min("pos").alias("_pos"), F.min_by("_text", "pos").alias("_text")
    )
    top = first.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy("_pos"))).filter(F.col("_rn") <= k)
    listed = F.array_sort(F.collect_list(F.struct("_rn", F.substring("_text", 1, cut).alias("t"))))
    return top.groupBy(key).agg(F.transform(listed, lambda s: s["t"]).alias("snippets"))


def reuse_prior(stories: DataFrame, prior: DataFrame) -> DataFrame:
    """Join the earlier enrichment; it is reusable when fingerprint and required texts agree.

    ``prior``: id, fingerprint, summary, why and anything to carry over, all prefixed ``prior_`` except id.
    """
    same = (
        (F.col("prior_fingerprint") == F.col("fingerprint"))
        & (ws_clean("prior_summary") != "")
        & (ws_clean("prior_why") != "")
        & F.col("prior_has_components")
    )
    return stories.join(prior, "id", "left").withColumn("reused", F.coalesce(same, F.lit(False)))


def apply_annotations(stories: DataFrame, annotations: DataFrame, allowed_tags) -> DataFrame:
    """Overlay externally produced annotations on rule results; rows without one keep the fallback.

    Annotation columns carry the prefix ``ann_``; list columns are arrays.
    """
    joined = stories.join(annotations.withColumn("_hit", F.lit(True)), "id", "left")
    empty = F.array().cast("array<string>")
    arr = lambda name: F.coalesce(F.col(name), empty)
    cleaned = lambda name: non_empty(F.transform(arr(name), ws_clean))
    tags = F.filter(cleaned("ann_macro_tags"), lambda t: t.isin(list(allowed_tags)))
    models = F.transform(cleaned("ann_aircraft_tags"), lambda t: F.replace(F.upper(t), F.lit(" "), F.lit("")))
    text = lambda name, old, cut: F.when(ws_clean(name) != "", F.substring(ws_clean(name), 1, cut)).otherwise(F.col(old))
    overlay = {
        "summary_zh": text("ann_summary", "summary_zh", 220),
        "why_it_matters_zh": text("ann_why", "why_it_matters_zh", 240),
        "market_materiality": clamp_int("ann_materiality", 0, 100, "market_materiality"),
        "lessor_relevance": clamp_int("ann_lessor", 0, 100, "lessor_relevance"),
        "macro_relevance": clamp_int("ann_macro", 0, 100, "macro_relevance"),
        "critical_candidate": F.coalesce(F.col("ann_critical"), F.lit(False)),
        "critical_reason_zh": F.substring(ws_clean("ann_reason"), 1, 180),
        "macro_tags": F.array_union(tags, arr("macro_tags")),
        "key_entities": F.slice(F.array_union(cleaned("ann_key_entities"), arr("key_entities")), 1, 16),
        "aircraft_tags": F.slice(F.array_union(models, arr("aircraft_tags")), 1, 12),
        "ai_mode": F.lit("annotated"),
    }
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    final = {name: F.when(hit, value).otherwise(F.col(name)) for name, value in overlay.items()}
    return joined.withColumns(final).drop("_hit", *[c for c in annotations.columns if c.startswith("ann_")])


def annotation_category(locked, annotated, prior, provisional):
    """Locked category, else an allowed annotated one, else an allowed prior one, else the provisional."""
    allowed = lambda c: F.when(ws_clean(c).isin(dims.CATEGORIES), ws_clean(c))
    return F.coalesce(as_col(locked), allowed(annotated), allowed(prior), as_col(provisional))


def annotation_request(clusters: DataFrame) -> DataFrame:
    """Truncated, sorted projection of a story that an external annotator receives."""
    sorted_set = lambda c, n: F.slice(F.array_sort(F.array_distinct(non_empty(F.transform(c, ws_clean)))), 1, n)
    return clusters.select(
        "id",
        F.substring(ws_clean("title"), 1, 280).alias("title"),
        F.substring(ws_clean("summary"), 1, 300).alias("summary"),
        F.substring(ws_clean("region"), 1, 70).alias("region"),
        F.array_sort(F.array_distinct(non_empty(F.transform("source_names", ws_clean)))).alias("sources"),
        sorted_set("categories_raw", 8).alias("raw_categories"),
        sorted_set("entities", 10).alias("entities"),
    )


def story_request(stories: DataFrame) -> DataFrame:
    """Projection of an enriched story for re-annotation: list order kept, lists capped."""
    return stories.select(
        ws_clean("id").alias("id"),
        F.substring(ws_clean("title"), 1, 320).alias("title"),
        ws_clean("category").alias("category"),
        ws_clean("region").alias("region"),
        F.slice(non_empty(F.transform("entities", ws_clean)), 1, 16).alias("entities"),
        F.slice(non_empty(F.transform("source_names", ws_clean)), 1, 8).alias("sources"),
    )
