"""Shared fragments of the DuckDB check SQL."""

from __future__ import annotations

from newsgrid import dims
from newsgrid.plans.scalar_queries import d_clean
from newsgrid.views import AS_OF, WITH_STORIES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def d_any(low: str, terms) -> str:
    return "(" + " OR ".join(f"contains({low}, {q(t)})" for t in terms) + ")"


def d_count(low: str, terms) -> str:
    return "(" + " + ".join(f"CAST(contains({low}, {q(t)}) AS INT)" for t in terms) + ")"


def d_alias(low: str, alias: str) -> str:
    from newsgrid.functions.text import is_phrase

    a = alias.lower()
    return f"contains({low}, {q(a)})" if is_phrase(a) else f"regexp_matches(' ' || {low} || ' ', '[^a-z0-9]{a}[^a-z0-9]')"


def d_compact(pairs) -> str:
    """List of labels whose condition holds, in the given order."""
    return "[x for x in [" + ", ".join(f"CASE WHEN {cond} THEN {q(label)} END" for label, cond in pairs) + "] if x IS NOT NULL]"


def d_word(c: str, at: int) -> str:
    return f"CAST('0x' || substr(sha1({c}), {at}, 15) AS BIGINT)"


def d_rank(name: str, default) -> str:
    return "CASE " + name + " " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in dims.SOURCE_RANK.items()) + f" ELSE {default} END"


def d_distinct_ci(xs: str) -> str:
    return f"list_filter({xs}, lambda x, i: list_position(list_transform({xs}, lambda y: lower(y)), lower(x)) = i)"


def d_priority(low: str, config=dims.SAMPLE_CONFIG) -> str:
    return d_compact((e.name, "(" + " OR ".join(d_alias(low, a) for a in e.aliases) + ")") for e in config.entities)


def d_topics(low: str, config=dims.SAMPLE_CONFIG) -> str:
    return d_compact((tag, d_any(low, terms)) for tag, terms in config.topics.items())


MODEL_RE = "(?i)\\b(?:" + dims.MODEL_PATTERN + ")\\b"
_codes = lambda x: f"[replace(upper({d_clean('c')}), ' ', '') for c in regexp_extract_all({x}, {q(MODEL_RE)}, 0)]"
D_MODELS = f"list_sort(list_distinct(list_concat({_codes('scoring_text')}, flatten([{_codes('e')} for e in string_split(entities_text, '|')]))))"

_case = lambda table, key, default: "CASE " + key + " " + " ".join(f"WHEN {q(k)} THEN {v if isinstance(v, int) else q(v)}" for k, v in table.items()) + f" ELSE {default} END"
_names = "string_split(source_names_text, '|')"

TEXTED = f"""{WITH_STORIES}, t0 AS (SELECT *, array_to_string([x for x in list_concat([{d_clean('title')}, {d_clean('category')}, {d_clean('region')}],
   [{d_clean('e')} for e in string_split(entities_text, '|')], [substr({d_clean('summary')}, 1, 650)]) if x <> ''], ' | ') AS scoring_text FROM stories),
t1 AS (SELECT *, lower(scoring_text) AS low FROM t0),
texted AS (SELECT *, {d_priority('low')} AS names, {d_topics('low')} AS tags, {d_any('low', dims.SEVERE_TERMS)} AS severe_event,
   {d_any('low', dims.DIRECT_TERMS)} AS direct_lessor_event, {d_any('low', dims.MATERIAL_TERMS)} AS material_event, {D_MODELS} AS models FROM t1)"""
_CUT = f"substr({d_clean('summary')}, 1, 650)"
WHOLE_TEXTED = TEXTED.replace(_CUT, d_clean("summary"))

RULED = f"""{TEXTED}, r0 AS (SELECT *, least(greatest(importance_score, 35), 90) AS m0, {_case(dims.CATEGORY_BASE, 'category', 72)} AS l0 FROM texted),
ruled AS (SELECT *, CAST(CASE WHEN len(names) > 0 THEN greatest(78, CASE WHEN severe_event THEN greatest(88, m0) ELSE m0 END) WHEN severe_event THEN greatest(88, m0) ELSE m0 END AS INT) AS market_materiality,
  CAST(greatest(l0, CASE WHEN severe_event THEN 88 ELSE 0 END, CASE WHEN direct_lessor_event THEN 91 ELSE 0 END) AS INT) AS lessor_relevance,
  CASE WHEN category = 'Macro & Geopolitics' THEN 82 WHEN len(tags) > 0 THEN 72 ELSE 30 END AS macro_relevance,
  severe_event AS critical_candidate, CASE WHEN severe_event THEN {q(dims.CANDIDATE_REASON)} ELSE '' END AS candidate_reason,
  {q(dims.SUMMARY_PREFIX)} || {d_clean('title')} AS summary_zh, {_case(dims.WHY_TEXT, 'category', q(dims.WHY_TEXT_DEFAULT))} AS why_it_matters_zh FROM r0)"""

D_RECENCY = f"""CASE WHEN published_at IS NULL THEN 45 ELSE CAST(least(greatest(round_even(100 - greatest(0.0, date_diff('second', published_at, TIMESTAMP '{AS_OF}') / CAST(86400.0 AS DOUBLE)) * CAST(7.5 AS DOUBLE), 0), 35), 100) AS INT) END"""
D_QUALITY = f"list_max([{d_rank('n', 65)} for n in {_names}])"

_d = lambda x: f"CAST({x} AS DOUBLE)"
_CFG = dims.SAMPLE_CONFIG
SCORED = f"""{RULED}, f0 AS (SELECT *, len(tags) > 0 AND (category = 'Macro & Geopolitics' OR macro_relevance >= 55 OR lessor_relevance >= 70) AS macro_related,
   {D_QUALITY} AS source_quality, {D_RECENCY} AS recency, CAST(least(100, 55 + (source_count - 1) * 15) AS INT) AS multi_source, len(names) > 0 AS priority_entity FROM ruled),
f1 AS (SELECT *, macro_related AND (macro_relevance >= 76 OR len(tags) >= 2) AND lessor_relevance >= 62 AS systemic_macro,
   priority_entity AND (material_event OR severe_event OR lessor_relevance >= 84 OR market_materiality >= 82) AS priority_material_event,
   CAST(round_even(market_materiality * {_d('0.32')} + lessor_relevance * {_d('0.34')} + source_quality * {_d('0.16')} + recency * {_d('0.12')} + multi_source * {_d('0.06')}, 0) AS INT) AS weighted_base FROM f0),
f2 AS (SELECT *, CASE WHEN direct_lessor_event THEN 7 ELSE 0 END + CASE WHEN severe_event THEN 10 ELSE 0 END + CASE WHEN priority_entity THEN {_CFG.entity_boost} ELSE 0 END
    + CASE WHEN len(names) >= 2 THEN {_CFG.multi_entity_bonus} ELSE 0 END + CASE WHEN macro_related THEN 12 ELSE 0 END + CASE WHEN systemic_macro THEN 4 ELSE 0 END AS bonuses,
    nullif(greatest(CASE WHEN priority_entity THEN {_CFG.entity_floor} ELSE 0 END, CASE WHEN priority_material_event THEN {_CFG.material_floor} ELSE 0 END,
      CASE WHEN macro_related THEN {_CFG.macro_floor} ELSE 0 END, CASE WHEN systemic_macro THEN {_CFG.systemic_floor} ELSE 0 END), 0) AS applied_floor FROM f1),
f3 AS (SELECT * EXCLUDE (importance_score), least(100, greatest(least(100, weighted_base + bonuses), coalesce(applied_floor, 0))) AS importance_score FROM f2),
f4 AS (SELECT *, (importance_score >= 92 AND (severe_event OR priority_material_event OR systemic_macro)) OR (importance_score >= 90 AND critical_candidate
     AND (direct_lessor_event OR severe_event OR systemic_macro)) OR importance_score >= 97 AS critical FROM f3),
enriched AS (SELECT *, CASE WHEN NOT critical THEN '' WHEN candidate_reason <> '' THEN candidate_reason WHEN severe_event THEN {q(dims.REASON_SEVERE)}
   WHEN priority_material_event THEN {q(dims.REASON_PRIORITY[0])} || names[1] || {q(dims.REASON_PRIORITY[1])} WHEN systemic_macro THEN {q(dims.REASON_SYSTEMIC)}
   ELSE {q(dims.REASON_OTHER)} END AS critical_reason_zh FROM f4)"""
