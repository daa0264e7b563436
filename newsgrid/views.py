"""Views of the given tables in the shapes the operators read, in Spark and in DuckDB SQL.

One SQL template serves both engines, so a query and its oracle start from identical rows.
Every view keeps every row and the whole text of its base table. Clock: ``AS_OF``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgrid import dims

AS_OF = "2024-04-30 00:00:00"
EVENTS_AS_OF = "2024-01-31 12:00:00"

# Values that fill the columns the base tables lack; picked by row number, growing with the table.
SOURCES = [
    "Reuters", "Ishka Airfinance", "Flightglobal", "Aviation News Online", "Bloomberg", "CNBC",
    "Associated Press", "Trade Wire", "Daily Ledger", "FlightGlobal", "Regional Post", "Market Notes",
]
CHANNELS = [
    "reuters_via_bing", "ishka_latest_rss", "flightglobal_rss", "aviationnews_engine", "bing_news_rss",
    "bing_news_rss", "aviationnews_legal", "old_web_channel", "bing_news_rss", "flightglobal_rss",
    "aviationnews_maintenance", "ishka_law_rss",
]
LEADS = [
    "Airbus A320neo delivery to Air China under sale and leaseback with AerCap",
    "Boeing 737 MAX 8 order backlog grows as production rate recovers",
    "Airline bankruptcy filing puts A330-300 fleet at risk of repossession",
    "Aviation ABS prices as interest rate outlook softens",
    "GTF engine shop visit delays ground A321neo operators",
    "Lease rate and market value outlook for the 787-9",
    "Court ruling cites Cape Town Convention in recovery dispute",
    "Oil price shock and airspace closure weigh on Korean Air",
    "Quarterly notes on airport retail",
    "Wizz Air and SAS agree joint venture on ATR 72-600 capacity",
    "JOLCO financing closed for E190-E2 pair by CALC",
    "Staff appointments and events diary",
    "Tariff dispute hits engine parts supply chain, Rolls-Royce Trent XWB output",
    "Chang'an Airlines signs PDP financing with BOC Aviation",
    "IAG reports profit and passenger traffic growth",
    "C919 certification delay and quality issue at supplier",
    "Awards task force named",
    "Air France-KLM and KLM Royal Dutch Airlines extend MRO maintenance deal",
    "空客 deliveries and 国航 fleet renewal plan",
]
ENTITY_LISTS = [
    "Airbus|Air China|AerCap|A320neo", "Boeing|737 MAX 8", "A330-300|airbus|Airbus", "", "A321neo|Pratt & Whitney",
    "787-9|Boeing|Avolon", "Legal Desk", "Korean Air", "Airport Co", "Wizz Air|SAS|ATR 72-600", "CALC|E190-E2|Embraer",
]
REGIONS = ["Europe", "Americas", "", "Asia/Pacific", "Middle East", "Africa"]
CATEGORY_LISTS = ["Leasing|Finance", "OEM", "Airlines|Credit|Airlines", "", "Engines", "Values|Leasing|Rates", "Legal"]


def _pick(values, key: str) -> str:
    quote = lambda v: "'" + v.replace("'", "’") + "'"
    whens = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"(CASE CAST({key} AS BIGINT) % {len(values)} {whens} END)"


_NUM = "coalesce(try_cast(substr(source, 4) AS BIGINT), 0)"

NEWS_ITEMS = f"""
SELECT doc_id, 'r' || CAST(doc_id AS {{str}}) AS id,
 trim(regexp_extract(text, '^[^.!?\\n]*', 0)) AS title,
 {_pick(LEADS, "doc_id")} || '. ' || text AS summary,
 {_pick(SOURCES, _NUM)} AS source, {_pick(CHANNELS, _NUM)} AS source_channel,
 'https://News.example.com/a/' || CAST(doc_id - doc_id % 3 AS {{str}}) || '?utm_source=' || source || '&k=' || lang || '#top' AS url,
 CASE WHEN doc_id % 11 = 0 THEN NULL ELSE {{plus_minutes}} END AS published_at,
 CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST({{plus_minutes}} AS DATE) END AS published_date,
 {{ts}} '{AS_OF}' AS fetched_at,
 CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Author ' || lang END AS author,
 {_pick(REGIONS, "doc_id")} AS region_raw, {_pick(CATEGORY_LISTS, "doc_id")} AS categories_text,
 {_pick(ENTITY_LISTS, "doc_id")} AS entities_text, lang, n_chars
FROM documents"""

STORIES = f"""
SELECT doc_id, 's' || CAST(doc_id AS {{str}}) AS id, title, summary,
 {_pick(dims.CATEGORIES + ["Other"], "doc_id * 5 + n_chars")} AS category, CAST(30 + n_chars % 70 AS INT) AS importance_score,
 region_raw AS region, entities_text, published_at, CAST(1 + n_chars % 3 AS INT) AS source_count,
 CASE n_chars % 3 WHEN 0 THEN source WHEN 1 THEN source || '|Bloomberg' ELSE source || '|Trade Wire|Reuters' END AS source_names_text,
 url, id AS raw_id, CASE WHEN n_chars % 2 = 0 THEN 'annotated' ELSE 'fallback_rules' END AS analysis_mode
FROM ({NEWS_ITEMS}) AS n"""

OBSERVATIONS = """
SELECT event_id, event_type AS series, CAST(ts AS DATE) AS obs_date, ts, value, CAST(event_id % 3 AS INT) AS tier,
 CAST({json_k} AS INT) AS k, user_id FROM events"""

SOURCE_CHECKS = """
SELECT event_id, 'src_' || CAST(user_id AS {str}) AS source_id, CASE WHEN user_id % 3 = 0 THEN 'rss_search' ELSE 'rss' END AS kind,
 CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 503 ELSE 200 END AS http_status,
 CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'ParseError' ELSE NULL END AS error,
 CASE WHEN event_id % 7 = 0 THEN 0 ELSE CAST(event_id % 20 AS INT) END AS records, ts AS checked_at FROM events"""

_SPARK = {
    "str": "STRING",
    "ts": "TIMESTAMP_NTZ",
    "plus_minutes": "timestampadd(MINUTE, CAST((doc_id * 7919) % 172800 AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')",
    "json_k": "get_json_object(props, '$.k')",
}
_DUCK = {
    "str": "VARCHAR",
    "ts": "TIMESTAMP",
    "plus_minutes": "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((doc_id * 7919) % 172800 AS BIGINT))",
    "json_k": "json_extract_string(props, '$.k')",
}


def duck(template: str) -> str:
    return template.format(**_DUCK)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark, sf_dir, base: str, template: str) -> DataFrame:
    return spark.sql(template.format(**_SPARK).replace(f"FROM {base}", "FROM {base}"), base=table(spark, sf_dir, base))


def as_news_items(documents: DataFrame) -> DataFrame:
    """Rows of ``documents`` as raw news items; the lists arrive as text and become arrays here."""
    df = documents.sparkSession.sql(NEWS_ITEMS.format(**_SPARK).replace("FROM documents", "FROM {documents}"), documents=documents)
    return df.withColumns(
        {
            "categories_raw": F.filter(F.split("categories_text", "[|]"), lambda x: x != ""),
            "entities": F.filter(F.split("entities_text", "[|]"), lambda x: x != ""),
        }
    )


def news_items(spark, sf_dir) -> DataFrame:
    return as_news_items(table(spark, sf_dir, "documents"))


def stories(spark, sf_dir) -> DataFrame:
    """One story per document, in the clustered-story shape; source names and entities as arrays."""
    df = _view(spark, sf_dir, "documents", STORIES)
    return df.withColumns(
        {
            "entities": F.filter(F.split("entities_text", "[|]"), lambda x: x != ""),
            "source_names": F.split("source_names_text", "[|]"),
            "raw_ids": F.array("raw_id"),
        }
    )


def observations(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, "events", OBSERVATIONS)


def source_checks(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, "events", SOURCE_CHECKS)


WITH_NEWS = f"WITH news_items AS ({duck(NEWS_ITEMS)})"
WITH_STORIES = f"WITH stories AS ({duck(STORIES)})"
WITH_OBS = f"WITH obs AS ({duck(OBSERVATIONS)})"
WITH_CHECKS = f"WITH checks AS ({duck(SOURCE_CHECKS)})"
