"""Rule analysis, weighted score, critical decision and the enrichment that assembles them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions import ids
from newsgrid.functions.dates import as_of_lit, seconds_between
from newsgrid.functions.frames import staged
from newsgrid.functions.numbers import clamp_int
from newsgrid.functions.text import as_col, contains_any, scoring_text, ws_clean
from newsgrid.operators.classify import alias_tags, model_tags, topic_tags
from newsgrid.operators.lookups import best_rank


def recency_score(published_at, as_of: str):
    """100 − 7.5 per day of age within [35, 100]; future dates count as now, undated rows get 45."""
    days = F.greatest(F.lit(0.0), seconds_between(as_of_lit(as_of), published_at) / F.lit(86400.0))
    return F.when(as_col(published_at).isNull(), F.lit(45)).otherwise(clamp_int(F.lit(100) - days * 7.5, 35, 100, 50))


def category_base(category):
    table = F.create_map(*[F.lit(x) for pair in dims.CATEGORY_BASE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, as_col(category)), F.lit(dims.CATEGORY_BASE_DEFAULT))


def with_text(stories: DataFrame, config: dims.PriorityConfig) -> DataFrame:
    """Add the scoring text, its tags and the term flags every later rule reads."""
    snips = F.col("snippets") if "snippets" in stories.columns else F.array().cast("array<string>")
    text = stories.withColumn("scoring_text", scoring_text("title", "category", "region", "entities", snips))
    low = text.withColumn("_low", F.lower("scoring_text"))
    return staged(
        low,
        {
            "priority_matches": alias_tags("_low", config),
            "rule_tags": topic_tags("_low", config),
            "severe_event": contains_any("_low", dims.SEVERE_TERMS),
            "direct_lessor_event": contains_any("_low", dims.DIRECT_TERMS),
            "material_event": contains_any("_low", config.material_terms),
            "text_models": model_tags("scoring_text", "entities"),
        },
    ).drop("_low")


def rule_annotation(df: DataFrame) -> DataFrame:
    """Deterministic analysis used wherever no annotation exists; needs ``with_text`` columns."""
    category = ws_clean("category")
    severe, direct = F.col("severe_event"), F.col("direct_lessor_event")
    why = F.create_map(*[F.lit(x) for pair in dims.WHY_TEXT.items() for x in pair])
    base = category_base(category)
    at_least = lambda flag, n, value: F.when(flag, F.greatest(value, F.lit(n))).otherwise(value)
    materiality = at_least(
        F.size("priority_matches") > 0, 78, at_least(severe, 88, clamp_int("importance_score", 35, 90, 55))
    )
    return staged(
        df,
        {
            "summary_zh": F.concat(F.lit(dims.SUMMARY_PREFIX), ws_clean("title")),
            "why_it_matters_zh": F.coalesce(F.try_element_at(why, category), F.lit(dims.WHY_TEXT_DEFAULT)),
            "market_materiality": materiality,
            "lessor_relevance": at_least(direct, 91, at_least(severe, 88, base)),
            "macro_relevance": F.when(category == dims.MACRO_CATEGORY, F.lit(82))
            .when(F.size("rule_tags") > 0, F.lit(72))
            .otherwise(F.lit(30)),
            "critical_candidate": severe,
            "critical_reason_zh": F.when(severe, F.lit(dims.CANDIDATE_REASON)).otherwise(F.lit("")),
            "macro_tags": F.col("rule_tags"),
            "key_entities": F.transform("priority_matches", lambda m: m["name"]),
            "aircraft_tags": F.col("text_models"),
            "ai_mode": F.lit("fallback_rules"),
        },
    )


def macro_flags(df: DataFrame) -> DataFrame:
    df = df.withColumn("all_tags", F.array_union("rule_tags", "macro_tags"))
    macro, lessor = F.col("macro_relevance"), F.col("lessor_relevance")
    related = (F.size("all_tags") > 0) & ((F.col("category") == dims.MACRO_CATEGORY) | (macro >= 55) | (lessor >= 70))
    df = staged(df, {"macro_related": F.coalesce(related, F.lit(False))})
    systemic = F.col("macro_related") & ((macro >= 76) | (F.size("all_tags") >= 2)) & (lessor >= 62)
    return df.withColumn("systemic_macro", systemic)


def weighted_score(df: DataFrame, config: dims.PriorityConfig, as_of: str) -> DataFrame:
    """Weighted base, bonuses and floors, with every component kept."""
    df = staged(
        macro_flags(df),
        {
            "source_quality": best_rank("source_names"),
            "recency": recency_score("published_at", as_of),
            "multi_source": F.least(
                F.lit(100), F.lit(55) + F.greatest(F.lit(0), F.coalesce(F.nullif("source_count", F.lit(0)), F.lit(1)) - 1) * 15
            ).cast("int"),
            "priority_entity": F.size("priority_matches") > 0,
            "systemic_macro": F.col("systemic_macro"),
        },
    )
    material = F.col("priority_entity") & (
        F.col("material_event") | F.col("severe_event") | (F.col("lessor_relevance") >= 84) | (F.col("market_materiality") >= 82)
    )
    base = F.bround(
        F.col("market_materiality") * 0.32 + F.col("lessor_relevance") * 0.34 + F.col("source_quality") * 0.16
        + F.col("recency") * 0.12 + F.col("multi_source") * 0.06,
        0,
    ).cast("int")
    df = staged(df, {"priority_material_event": material, "weighted_base": base})
    add = lambda flag, n: F.when(F.col(flag), F.lit(n)).otherwise(F.lit(0))
    many = F.when(F.size("priority_matches") >= 2, F.lit(config.multi_entity_bonus)).otherwise(F.lit(0))
    bonuses = (
        add("direct_lessor_event", 7) + add("severe_event", 10) + add("priority_entity", config.entity_boost) + many
        + add("macro_related", 12) + add("systemic_macro", 4)
    )
    floor = F.greatest(
        *[
            F.when(F.col(flag), F.lit(n))
            for flag, n in (
                ("priority_entity", config.entity_floor),
                ("priority_material_event", config.material_floor),
                ("macro_related", config.macro_floor),
                ("systemic_macro", config.systemic_floor),
            )
        ]
    )
    df = staged(df, {"bonuses": bonuses, "applied_floor": floor})
    raw = F.least(F.lit(100), F.col("weighted_base") + F.col("bonuses"))
    return staged(df, {"score": clamp_int(F.greatest(raw, F.coalesce("applied_floor", F.lit(0))))})


def critical_decision(df: DataFrame) -> DataFrame:
    score, severe, material = F.col("score"), F.col("severe_event"), F.col("priority_material_event")
    systemic, direct = F.col("systemic_macro"), F.col("direct_lessor_event")
    critical = (
        ((score >= 92) & (severe | material | systemic))
        | ((score >= 90) & F.col("critical_candidate") & (direct | severe | systemic))
        | (score >= 97)
    )
    given = ws_clean("critical_reason_zh")
    head, tail = dims.REASON_PRIORITY
    reason = (
        F.when(~F.col("critical"), F.lit(""))
        .when(given != "", F.substring(given, 1, 180))
        .when(severe, F.lit(dims.REASON_SEVERE))
        .when(material, F.concat(F.lit(head), F.get(F.col("priority_matches"), F.lit(0))["name"], F.lit(tail)))
        .when(systemic, F.lit(dims.REASON_SYSTEMIC))
        .otherwise(F.lit(dims.REASON_OTHER))
    )
    return staged(staged(df, {"critical": critical}), {"critical_reason_zh": reason})


COMPONENTS = [
    "market_materiality", "lessor_relevance", "macro_relevance", "source_quality", "recency", "multi_source",
    "weighted_base", "bonuses", "applied_floor", "priority_entity", "priority_material_event", "macro_related",
    "systemic_macro", "severe_event", "direct_lessor_event",
]


def fingerprint():
    return ids.content_fingerprint(
        "title", "category", "region", "entities", "raw_ids", "source_names", F.transform("source_names", lambda n: F.col("url"))
    )


def finish(df: DataFrame, config: dims.PriorityConfig, as_of: str) -> DataFrame:
    """Score annotated rows (rule or external) and assemble the served story."""
    scored = critical_decision(weighted_score(df, config, as_of))
    return scored.withColumns(
        {
            "importance_score": F.col("score"),
            "macro_tags": F.col("all_tags"),
            "aircraft_tags": F.slice(F.array_union("text_models", "aircraft_tags"), 1, 12),
            "score_components": F.struct(*COMPONENTS),
            "enriched_at": as_of_lit(as_of),
        }
    ).drop("score", "all_tags", "rule_tags", "text_models", "material_event", *COMPONENTS)


def enrich(stories: DataFrame, config: dims.PriorityConfig, as_of: str) -> DataFrame:
    """Rule-annotated, scored and flagged stories: one narrow pass, no shuffle."""
    return finish(rule_annotation(with_text(stories, config)), config, as_of)
