"""Queries over time-series reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsgrid import views
from newsgrid.operators import aggregates, ranking, series
from newsgrid.plans.registry import query
from newsgrid.session import shared_dir
from newsgrid.sources import sinks
from newsgrid.views import WITH_OBS, observations, table

_COLS = ("series", "obs_date", "event_id", "value")


def _last(where: str, tiers: str = "0") -> str:
    return f"""r AS (SELECT series, obs_date, event_id, value, row_number() OVER (PARTITION BY series, obs_date ORDER BY {tiers} DESC, event_id DESC) AS rn FROM obs WHERE {where})
    SELECT series, obs_date, event_id, value FROM r WHERE rn = 1"""


@query("series_upsert", f"{WITH_OBS}, {_last('tier < 2', 'tier')}")
def _(spark, sf):
    obs = observations(spark, sf)
    return series.series_upsert(obs.filter("tier = 0"), obs.filter("tier = 1")).select(*_COLS)


@query("summary_override", f"{WITH_OBS}, {_last('true', 'CASE WHEN tier = 2 THEN 1 ELSE 0 END')}")
def _(spark, sf):
    obs = observations(spark, sf)
    return series.series_upsert(obs.filter("tier <> 2"), obs.filter("tier = 2")).select(*_COLS)


@query(
    "series_fill_only",
    f"""{WITH_OBS}, base AS (SELECT * FROM obs WHERE k < 3), f AS (SELECT *, row_number() OVER (PARTITION BY series, obs_date ORDER BY event_id) AS rn FROM obs WHERE k >= 3
      AND (series, obs_date) NOT IN (SELECT series, obs_date FROM base))
    SELECT series, obs_date, event_id, value FROM base UNION ALL SELECT series, obs_date, event_id, value FROM f WHERE rn = 1""",
)
def _(spark, sf):
    obs = observations(spark, sf)
    return series.series_fill_only(obs.filter("k < 3"), obs.filter("k >= 3")).select(*_COLS)


@query("tiered_merge", f"{WITH_OBS}, {_last('true', 'tier')}")
def _(spark, sf):
    obs = observations(spark, sf)
    return series.tiered_merge(*[obs.filter(F.col("tier") == i) for i in range(3)]).select(*_COLS)


_PERIODS = """p AS (SELECT o_orderkey AS event_id, o_orderpriority AS series, CAST(last_day(o_orderdate) AS DATE) AS obs_date, o_totalprice / 1000 AS value,
   CASE WHEN o_orderstatus = 'F' THEN 'monthly_average' ELSE 'two_month_average' END AS observation_type FROM orders)"""


def periods(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", F.lit("monthly_average")).otherwise(F.lit("two_month_average"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("series"), F.last_day("o_orderdate").alias("obs_date"),
        (F.col("o_totalprice") / 1000).alias("value"), kind.alias("observation_type"),
    )


@query(
    "granularity_priority",
    f"""WITH {_PERIODS}, r AS (SELECT *, row_number() OVER (PARTITION BY series, obs_date ORDER BY CASE WHEN observation_type = 'monthly_average' THEN 2 ELSE 1 END DESC, event_id) AS rn FROM p)
    SELECT series, obs_date, event_id, observation_type FROM r WHERE rn = 1""",
)
def _(spark, sf):
    return series.granularity_priority(periods(spark, sf)).select("series", "obs_date", "event_id", "observation_type")


@query(
    "observation_type_counts",
    f"WITH {_PERIODS} SELECT count(*) AS parsed, count_if(observation_type = 'monthly_average') AS monthly, count_if(observation_type = 'two_month_average') AS two_month FROM p",
)
def _(spark, sf):
    return aggregates.observation_type_counts(periods(spark, sf))


@query(
    "conflict_report",
    f"""{WITH_OBS}, {_PERIODS}, f AS (SELECT series, obs_date, arg_min(value, event_id) AS kept_value FROM obs GROUP BY 1, 2),
    g AS (SELECT series, obs_date, min(event_id) AS first_id, arg_min(value, event_id) AS first_value, arg_min(observation_type, event_id) AS first_kind,
      min(event_id) FILTER (WHERE observation_type = 'monthly_average') AS month_id, arg_min(value, event_id) FILTER (WHERE observation_type = 'monthly_average') AS month_value FROM p GROUP BY 1, 2),
    t AS (SELECT p.series, p.obs_date, p.event_id, p.value, CASE WHEN event_id > month_id AND observation_type = 'monthly_average' THEN month_value
      WHEN event_id > first_id AND (month_id IS NULL OR event_id <= month_id) AND observation_type = first_kind THEN first_value END AS kept_value FROM p JOIN g USING (series, obs_date)),
    r AS (SELECT series, obs_date, event_id, value, row_number() OVER (PARTITION BY series, obs_date ORDER BY event_id) AS n FROM obs WHERE value IS NOT NULL),
    m AS (WITH RECURSIVE k AS (SELECT series, obs_date, n, event_id, value, value AS kept, CAST(NULL AS DOUBLE) AS kept_value FROM r WHERE n = 1
      UNION ALL SELECT r.series, r.obs_date, r.n, r.event_id, r.value, CASE WHEN round(abs(k.kept - r.value), 9) <= 25 THEN r.value ELSE k.kept END, CASE WHEN round(abs(k.kept - r.value), 9) > 25 THEN k.kept END
      FROM k JOIN r ON r.series = k.series AND r.obs_date = k.obs_date AND r.n = k.n + 1) SELECT * FROM k WHERE kept_value IS NOT NULL)
    SELECT 'first' AS rule, o.series, o.obs_date, o.event_id, f.kept_value, o.value FROM obs o JOIN f USING (series, obs_date) WHERE round(abs(o.value - f.kept_value), 9) > 0.03
    UNION ALL SELECT 'typed', series, obs_date, event_id, kept_value, value FROM t WHERE round(abs(value - kept_value), 9) > 0.03
    UNION ALL SELECT 'moving', series, obs_date, event_id, kept_value, value FROM m""",
)
def _(spark, sf):
    obs = observations(spark, sf)
    ruled = lambda name, df: df.select(F.lit(name).alias("rule"), "series", "obs_date", "event_id", "kept_value", "value")
    first, typed = ruled("first", series.conflict_report(obs, 0.03)), ruled("typed", series.typed_conflicts(periods(spark, sf), 0.03))
    return first.unionByName(typed).unionByName(ruled("moving", series.moving_conflicts(obs, 25)))


@query(
    "series_extent",
    f"""{WITH_OBS}, s AS (SELECT series, tier, obs_date, max(value) AS value FROM obs GROUP BY 1, 2, 3)
    SELECT series, tier, min(obs_date) AS first_date, max(obs_date) AS last_date, count(*) AS observations, arg_min(value, obs_date) AS first_value, arg_max(value, obs_date) AS last_value FROM s GROUP BY 1, 2""",
)
def _(spark, sf):
    daily = observations(spark, sf).groupBy("series", "tier", "obs_date").agg(F.max("value").alias("value"))
    return aggregates.series_extent(daily, ("series", "tier"))


_PRICES = """SELECT o_orderpriority AS series, o_orderstatus AS provider, CAST(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS INT) AS priority,
   CAST(o_orderdate AS DATE) AS obs_date, max(o_totalprice) AS value, min(o_orderkey) AS event_id FROM orders GROUP BY 1, 2, 3, 4"""


def prices(spark, sf):
    rank = F.when(F.col("o_orderstatus") == "P", F.lit(0)).when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(2))
    keys = [F.col("o_orderpriority").alias("series"), F.col("o_orderstatus").alias("provider"), rank.alias("priority")]
    return table(spark, sf, "orders").groupBy(*keys, F.col("o_orderdate").cast("date").alias("obs_date")).agg(
        F.max("o_totalprice").alias("value"), F.min("o_orderkey").alias("event_id")
    )


def _checked(lo: int, hi: int, jump: float, part: str) -> str:
    return f"""l AS (SELECT *, lag(value) OVER (PARTITION BY {part} ORDER BY obs_date, event_id) AS prev_value FROM prices),
    c AS (SELECT *, NOT (value > {lo} AND value < {hi}) AS implausible, coalesce(abs(value / prev_value - 1) > {jump}, false) AS jumped FROM l)"""


@query(
    "day_over_day_check",
    f"""WITH prices AS ({_PRICES}), {_checked(2000, 450000, 0.25, 'series, provider')} SELECT series, provider, obs_date, value, prev_value, implausible, jumped FROM c""",
)
def _(spark, sf):
    out = series.day_over_day_check(prices(spark, sf), 2000, 450000, 0.25, ("series", "provider"))
    return out.select("series", "provider", "obs_date", "value", "prev_value", "implausible", "jumped")


@query(
    "provider_fallback",
    f"""WITH prices AS ({_PRICES}), {_checked(0, 1000000, 150.0, 'series, provider')}, v AS (SELECT series, provider, priority FROM c GROUP BY 1, 2, 3
      HAVING count(*) >= 100 AND max(obs_date) >= DATE '2001-07-22' AND count_if(implausible) = 0 AND count_if(jumped) <= 0),
    b AS (SELECT series, arg_min(provider, priority) AS provider FROM v GROUP BY 1) SELECT p.series, p.provider, p.obs_date, p.value FROM prices p JOIN b USING (series, provider)""",
)
def _(spark, sf):
    chosen = series.provider_fallback(prices(spark, sf), "2001-08-01 00:00:00", 100, lo=0, hi=1000000, jump=150.0)
    return chosen.select("series", "provider", "obs_date", "value")


@query(
    "best_provider",
    f"""WITH prices AS ({_PRICES}), n AS (SELECT series, provider, priority, count(*) AS n FROM prices GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY n DESC, priority) AS rn FROM n)
    SELECT p.series, p.provider, p.obs_date, p.value FROM prices p JOIN r USING (series, provider) WHERE rn = 1""",
)
def _(spark, sf):
    return series.best_provider(prices(spark, sf)).select("series", "provider", "obs_date", "value")


_CLOSES = "closes AS (SELECT series, arg_max(value, (obs_date, event_id)) AS last_close, max(obs_date) AS last_date FROM obs WHERE tier < 2 GROUP BY 1)"
_QUOTES = "quotes AS (SELECT series, round(arg_max(value, (ts, event_id)), 4) AS price, max(ts) AS quote_ts FROM obs WHERE tier = 2 AND value IS NOT NULL GROUP BY 1)"


def quotes(spark, sf):
    bars = observations(spark, sf).filter("tier = 2")
    return ranking.latest_valid_bar(bars, ["series"], "value", "ts").withColumnRenamed("price_ts", "quote_ts")


@query(
    "latest_valid_bar",
    f"""{WITH_OBS} SELECT series, round(arg_max(value, (ts, event_id)), 4) AS price, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS price_ts FROM obs WHERE k % 3 <> 0 GROUP BY 1""",
)
def _(spark, sf):
    bars = observations(spark, sf).withColumn("value", F.when(F.col("k") % 3 != 0, F.col("value")))
    out = ranking.latest_valid_bar(bars, ["series"], "value", "ts")
    return out.select("series", "price", F.date_format("price_ts", "yyyy-MM-dd HH:mm:ss").alias("price_ts"))


@query(
    "quote_divergence",
    f"""{WITH_OBS}, {_CLOSES}, {_QUOTES} SELECT series, price, last_close, round(abs(price / last_close - 1), 6) AS divergence, abs(price / last_close - 1) > 0.12 AS rejected FROM quotes JOIN closes USING (series)""",
)
def _(spark, sf):
    out = series.quote_divergence(quotes(spark, sf), observations(spark, sf).filter("tier < 2"))
    return out.select("series", "price", "last_close", F.round("divergence", 6).alias("divergence"), "rejected")


@query(
    "quote_change_pct",
    f"""{WITH_OBS}, {_CLOSES}, {_QUOTES} SELECT series, price, last_close, round((price / last_close - 1) * 100, 6) AS change_pct FROM quotes JOIN closes USING (series)""",
)
def _(spark, sf):
    out = series.quote_change_pct(quotes(spark, sf), observations(spark, sf).filter("tier < 2"))
    return out.select("series", "price", "last_close", F.round("change_pct", 6).alias("change_pct"))


@query(
    "stale_quote_keep",
    f"""{WITH_OBS}, o AS (SELECT user_id, arg_max(value, (ts, event_id)) AS old FROM obs WHERE tier < 2 GROUP BY 1), n AS (SELECT user_id, arg_max(value, (ts, event_id)) AS fresh FROM obs WHERE tier = 2 AND k > 60 GROUP BY 1)
    SELECT CAST(coalesce(o.user_id, n.user_id) AS VARCHAR) AS series, round(coalesce(fresh, old), 4) AS price, CASE WHEN fresh IS NOT NULL THEN 'FRESH' ELSE 'STALE_STORED_QUOTE' END AS quote_status
    FROM o FULL JOIN n ON o.user_id = n.user_id""",
)
def _(spark, sf):
    obs = observations(spark, sf).withColumn("series", F.col("user_id").cast("string"))
    latest = lambda df: ranking.latest_valid_bar(df, ["series"], "value", "ts").withColumnRenamed("price_ts", "quote_ts")
    out = series.stale_quote_keep(latest(obs.filter("tier < 2")), latest(obs.filter("tier = 2 AND k > 60")))
    return out.select("series", "price", "quote_status")


@query("min_rows_guard", f"{WITH_OBS} SELECT series, count(*) AS n, 2000 AS required, count(*) >= 2000 AS ok FROM obs GROUP BY 1")
def _(spark, sf):
    return series.min_rows_guard(observations(spark, sf), 2000)


_D_CELLS = "SELECT l_suppkey AS page_id, l_orderkey, l_linenumber, CASE WHEN l_suppkey % 2 = 0 THEN l_quantity * 3 ELSE l_discount * 10 + 1 END AS value, CASE WHEN l_suppkey % 5 = 0 THEN 'cents per gallon' WHEN l_suppkey % 5 = 1 THEN 'dollars per gallon' ELSE 'spot price' END AS page_text FROM lineitem"


@query(
    "unit_convert",
    f"""WITH cells AS ({_D_CELLS}), m AS (SELECT page_id, quantile_disc(value, 0.5 ORDER BY value DESC) AS med, any_value(page_text) AS t FROM cells GROUP BY 1),
    u AS (SELECT page_id, CASE WHEN t = 'cents per gallon' THEN 'cents' WHEN t = 'dollars per gallon' THEN 'dollars' WHEN med > 10 THEN 'cents' ELSE 'dollars' END AS unit FROM m),
    c AS (SELECT l_orderkey, l_linenumber, page_id, unit, round_even(CASE WHEN unit = 'cents' THEN value * 42 / 100 ELSE value * 42 END, 2) AS value FROM cells JOIN u USING (page_id))
    SELECT l_orderkey, l_linenumber, unit, value FROM c WHERE value BETWEEN 10 AND 500""",
)
def _(spark, sf):
    key = F.col("l_suppkey")
    text = F.when(key % 5 == 0, F.lit("cents per gallon")).when(key % 5 == 1, F.lit("dollars per gallon")).otherwise(F.lit("spot price"))
    value = F.when(key % 2 == 0, F.col("l_quantity") * 3).otherwise(F.col("l_discount") * 10 + 1)
    cells = table(spark, sf, "lineitem").select(key.alias("page_id"), "l_orderkey", "l_linenumber", value.alias("value"), text.alias("page_text"))
    return series.convert_units(cells).select("l_orderkey", "l_linenumber", "unit", "value")


@query(
    "sink_if_changed",
    f"""{WITH_OBS}, s AS (SELECT series, obs_date, max(value) AS value FROM obs WHERE tier < 2 GROUP BY 1, 2), f AS (SELECT series, obs_date, max(value) AS value FROM obs GROUP BY 1, 2)
    SELECT *, true AS first, false AS again, EXISTS (FROM f EXCEPT ALL FROM s) OR EXISTS (FROM s EXCEPT ALL FROM f) AS changed FROM f""",
)
def _(spark, sf):
    top = lambda df: df.groupBy("series", "obs_date").agg(F.max("value").alias("value"))
    obs = observations(spark, sf)
    path = f"{shared_dir(spark).rstrip('/')}/newsgrid-series-{uuid.uuid4().hex}"
    stored, fresh = top(obs.filter("tier < 2")), top(obs)
    told = {name: F.lit(sinks.write_if_changed(df, path)).alias(name) for name, df in (("first", stored), ("again", stored), ("changed", fresh))}
    return sinks.read_written(spark, path, fresh.schema).select("*", *told.values())
