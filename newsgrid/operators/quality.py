"""Contract checks as tables of violations ``(check, severity, key, detail)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.dates import add_seconds, as_of_lit, seconds_between
from newsgrid.functions.text import as_col, ws_clean


def _violations(df: DataFrame, key: str, checks, severity: str = "error") -> DataFrame:
    """Rows failing each (name, failing condition, detail); null conditions pass."""
    found = [
        F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(name).alias("check"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail")))
        for name, bad, detail in checks
    ]
    rows = df.select(F.coalesce(F.col(key), F.lit("")).alias("key"), F.explode(F.array_compact(F.array(*found))).alias("v"))
    return rows.select(F.col("v.check").alias("check"), F.lit(severity).alias("severity"), "key", F.col("v.detail").alias("detail"))


def _row(name, severity, key, detail):
    return [F.lit(name).alias("check"), F.lit(severity).alias("severity"), as_col(key).cast("string").alias("key"), as_col(detail).cast("string").alias("detail")]


def _duplicates(df: DataFrame, key: str, name: str) -> DataFrame:
    counts = df.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return counts.select(*_row(name, "error", F.col(key), F.col("_n")))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _window_floor(as_of: str, days: int):
    return add_seconds(as_of_lit(as_of), F.lit(-days * 86400))


def dq_clustered(stories: DataFrame, as_of: str, days: int = 122) -> DataFrame:
    """Clustered-story contract; ``sources`` is an array of structs with a ``url``."""
    urls = F.filter(F.transform("sources", lambda s: F.coalesce(s["url"], F.lit(""))), lambda u: u != "")
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    none = F.lit(None)
    rows = _violations(
        stories,
        "id",
        [
            ("missing_id", empty("id"), none),
            ("missing_title", empty("title"), none),
            ("bad_category", ~F.coalesce(F.col("category"), F.lit("")).isin(dims.CATEGORIES), F.col("category")),
            ("bad_score", F.col("importance_score").isNull() | ~F.col("importance_score").between(0, 100), F.col("importance_score")),
            ("bad_published_at", F.col("published_at").isNull(), none),
            ("outside_retention", F.col("published_at") < _window_floor(as_of, days), none),
            ("sources_missing", F.coalesce(F.size("sources"), F.lit(0)) <= 0, none),
            ("source_without_url", F.size(urls) < F.size("sources"), F.size("sources") - F.size(urls)),
            ("duplicate_source_url", F.size(F.array_distinct(urls)) < F.size(urls), none),
            ("source_count_mismatch", ~F.col("source_count").eqNullSafe(F.size("sources")), F.col("source_count")),
            ("raw_ids_missing", F.coalesce(F.size("raw_ids"), F.lit(0)) <= 0, none),
        ],
    )
    owners = stories.select("id", F.explode(F.array_distinct(urls)).alias("url"))
    shared = owners.groupBy("url").agg(F.min("id").alias("_a"), F.max("id").alias("_b")).filter("_a <> _b")
    return _union([rows, _duplicates(stories, "id", "duplicate_id"), shared.select(*_row("url_in_two_stories", "error", F.col("url"), F.col("_a")))])


def dq_enriched(stories: DataFrame, config: dims.PriorityConfig, as_of: str, days: int = 122) -> DataFrame:
    """Enriched-story contract: texts, bounds, floors, retention; low critical scores warn."""
    score, parts = F.col("importance_score"), F.col("score_components")
    none = F.lit(None)
    blank = lambda c: ws_clean(c) == ""
    errors = _violations(
        stories,
        "id",
        [
            ("missing_id", blank("id"), none),
            ("bad_category", ~F.coalesce(F.col("category"), F.lit("")).isin(dims.CATEGORIES), F.col("category")),
            ("summary_empty", blank("summary_zh"), none),
            ("why_empty", blank("why_it_matters_zh"), none),
            ("priority_matches_null", F.col("priority_matches").isNull(), none),
            ("macro_tags_null", F.col("macro_tags").isNull(), none),
            ("aircraft_tags_null", F.col("aircraft_tags").isNull(), none),
            ("critical_null", F.col("critical").isNull(), none),
            ("components_missing", parts.isNull(), none),
            ("bad_score", score.isNull() | ~score.between(0, 100), score),
            ("below_entity_floor", (F.size("priority_matches") > 0) & (score < config.entity_floor), score),
            ("below_material_floor", parts["priority_material_event"] & (score < config.material_floor), score),
            ("below_macro_floor", parts["macro_related"] & (score < config.macro_floor), score),
            ("bad_published_at", F.col("published_at").isNull(), none),
            ("outside_retention", F.col("published_at") < _window_floor(as_of, days), none),
        ],
    )
    warnings = _violations(stories, "id", [("critical_below_90", F.col("critical") & (score < 90), score)], "warning")
    return _union([errors, _duplicates(stories, "id", "duplicate_id"), warnings])


def dq_homepage(stories: DataFrame, home: DataFrame, k: int = 10) -> DataFrame:
    """Front-page lists ``home(list, place, id)`` against the ranked stories."""
    from newsgrid.operators.ranking import top_feed

    known = stories.select("id", "critical")
    listed = home.join(known.withColumn("_known", F.lit(True)), "id", "left")
    rows = _violations(
        listed,
        "id",
        [
            ("unknown_id", F.col("_known").isNull(), F.col("list")),
            ("not_critical", (F.col("list") == "critical") & ~F.col("critical"), F.col("list")),
        ],
    )
    sizes = home.groupBy("list").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k)
    ranked = top_feed(stories, k).select(F.col("place"), F.col("id").alias("_want"))
    pairs = home.filter(F.col("list") == "feed").select("place", "id").join(ranked, "place", "full")
    wrong = pairs.filter(~F.col("id").eqNullSafe(F.col("_want")))
    return _union(
        [
            rows,
            sizes.select(*_row("list_too_long", "error", F.col("list"), F.col("n"))),
            wrong.select(*_row("feed_not_top", "error", F.coalesce("_want", F.lit("")), F.coalesce("id", F.lit("")))),
        ]
    )


def dq_stage_subset(current: DataFrame, enriched: DataFrame, archive: DataFrame) -> DataFrame:
    """Every current id enriched; archive at least as large; current not empty."""
    missing = current.select("id").distinct().join(enriched.select("id").distinct(), "id", "left_anti")
    sizes = current.agg(F.count(F.lit(1)).alias("c")).crossJoin(archive.agg(F.count(F.lit(1)).alias("a")))
    return _union(
        [
            missing.select(*_row("missing_enriched", "error", F.col("id"), F.lit(""))),
            sizes.filter("a < c").select(*_row("archive_smaller", "error", F.lit("archive"), F.col("a"))),
            sizes.filter("c = 0").select(*_row("current_empty", "error", F.lit("current"), F.lit("0"))),
        ]
    )


REQUIRED = ("title", "summary_zh", "why_it_matters_zh", "category", "importance_score", "published_at", "primary_url")


def dq_required_fields(stories: DataFrame, fields=REQUIRED) -> DataFrame:
    checks = [(f"missing_{f}", F.coalesce(F.col(f).cast("string"), F.lit("")) == "", F.lit(None)) for f in fields]
    return _violations(stories, "id", checks)


def health_semantics(checks: DataFrame) -> DataFrame:
    """A search feed is healthy on HTTP 200 without error; a direct feed also needs a record."""
    transport = F.coalesce(F.col("http_status") == 200, F.lit(False)) & (F.coalesce(F.col("error"), F.lit("")) == "")
    has = F.coalesce(F.col("records"), F.lit(0)) > 0
    return checks.withColumns({"transport_ok": transport, "has_records": has}).withColumn(
        "ok", F.col("transport_ok") & (F.col("has_records") | (F.col("kind") == "rss_search"))
    )


def publish_gate(violations: DataFrame) -> DataFrame:
    """One row: error and warning counts, the status, and whether publishing is allowed."""
    errors, warnings = F.count_if(F.col("severity") == "error"), F.count_if(F.col("severity") == "warning")
    return violations.agg(errors.alias("errors"), warnings.alias("warnings")).select(
        "errors",
        "warnings",
        F.when(F.col("errors") > 0, F.lit("fail")).when(F.col("warnings") > 0, F.lit("degraded")).otherwise(F.lit("healthy")).alias("status"),
        (F.col("errors") == 0).alias("publish_allowed"),
    )


def core_source_alive(checks: DataFrame, prefixes) -> DataFrame:
    """Fails only when core checks exist and every one of them failed."""
    core = reduce(lambda a, b: a | b, [F.col("source_id").startswith(p) for p in prefixes])
    return checks.agg(
        F.count_if(core).alias("core_checks"),
        (F.count_if(core & F.col("ok")) > 0).alias("_any"),
    ).select("core_checks", (F.col("_any") | (F.col("core_checks") == 0)).alias("alive"))


def coverage_report(checks: DataFrame, items: DataFrame, recall: DataFrame, groups: dict, as_of: str, limits: dict) -> DataFrame:
    """Hard coverage requirements and freshness warnings in the long form (kind, name, ok, measure).

    ``groups`` maps direct-feed names to source_id prefixes; ``limits`` maps lower-cased source names
    to (must exist, maximum age in days); ``recall`` holds one row with ``recall``.
    """
    content = F.col("transport_ok") & F.col("has_records")
    search = F.col("kind") == "rss_search"
    direct = {name: F.col("source_id").startswith(prefix) for name, prefix in groups.items()}
    aggs = [F.count_if(search).alias("_s"), F.count_if(search & F.col("transport_ok")).alias("_st")]
    for name, member in direct.items():
        aggs += [F.count_if(member).alias(f"_{name}_n"), F.count_if(member & content).alias(f"_{name}_ok")]
    by_check = checks.agg(*aggs)
    newest = items.agg(
        *[F.max(F.when(F.lower("source") == s, F.col("published_at"))).alias(f"_max_{i}") for i, s in enumerate(limits)],
        *[F.count_if(F.lower("source") == s).alias(f"_cnt_{i}") for i, s in enumerate(limits)],
    )
    one = by_check.crossJoin(newest).crossJoin(recall.select(F.col("recall").alias("_recall")))
    ratio = F.coalesce(F.bround(F.try_divide("_st", "_s"), 4), F.lit(0.0))
    out = [("hard", f"{n}_all_feeds_return_records", (F.col(f"_{n}_n") > 0) & (F.col(f"_{n}_n") == F.col(f"_{n}_ok")), F.col(f"_{n}_ok")) for n in groups]
    out.append(("hard", "search_transport_ratio", ratio >= 0.90, ratio))
    out.append(("hard", "baseline_recall", F.col("_recall") == 1.0, F.col("_recall")))
    for i, (source, (must, days)) in enumerate(limits.items()):
        if must:
            out.append(("hard", f"{source}_present", F.col(f"_cnt_{i}") > 0, F.col(f"_cnt_{i}")))
        age = F.bround(seconds_between(as_of_lit(as_of), F.col(f"_max_{i}")) / F.lit(86400.0), 2)
        out.append(("warning", f"{source}_fresh", F.coalesce(age <= days, F.lit(False)), age))
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"), ok.alias("ok"), m.cast("double").alias("measure"))
            for k, n, ok, m in out
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.kind", "r.name", "r.ok", "r.measure")


def pipeline_health(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics (metric, value) against thresholds (metric, severity, limit, missing_fails).

    A metric above its limit violates; a missing one violates where ``missing_fails``. Where several
    limits of one metric are passed only the highest is reported.
    """
    joined = thresholds.join(metrics, "metric", "left")
    bad = F.when(F.col("value").isNull(), F.col("missing_fails")).otherwise(F.col("value") > F.col("limit"))
    hit = joined.filter(bad)
    top = hit.groupBy("metric").agg(F.max_by(F.struct("severity", "limit", "value"), "limit").alias("t"))
    return top.select(
        F.col("metric").alias("check"), F.col("t.severity").alias("severity"), F.col("metric").alias("key"),
        F.coalesce(F.round("t.value", 4).cast("string"), F.lit("missing")).alias("detail"),
    )
