"""Price pages, files and payloads to observation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgrid.functions.dates import as_of_lit, epoch_ms_date, epoch_s_date, local_time, make_ts, month_no, parse_day
from newsgrid.functions.frames import staged
from newsgrid.functions.numbers import parse_number
from newsgrid.functions.text import strip_tags, ws_clean
from newsgrid.operators.dedupe import first_per_key

# How a page's embedded JSON writes a dated price, date first or price first.
JSON_DATE_FIRST = (
    r"""["']date["']\s*:\s*["'](\d{4}-\d{2}-\d{2})["'][^{}]{0,180}?["'](?:mid|value|price)["']\s*:\s*["']?([0-9]+(?:\.[0-9]+)?)"""
)
JSON_PRICE_FIRST = (
    r"""["'](?:mid|value|price)["']\s*:\s*["']?([0-9]+(?:\.[0-9]+)?)["']?[^{}]{0,180}?["']date["']\s*:\s*["'](\d{4}-\d{2}-\d{2})["']"""
)
_CELL = r"(?is)<(?:td|th)\b[^>]*>(.*?)(?=</(?:td|th)>|<(?:td|th|tr)\b|</tr>|</table>|$)"


def _all(text, pattern: str, group: int = 0):
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def price_rows(pages: DataFrame, lo: float = 20, hi: float = 500, key: str = "page_id") -> DataFrame:
    """Dated mid prices of each page: table rows, then embedded JSON; the later mention wins.

    One pass over the text: a page becomes its tables and JSON mentions, a table its rows, and each of
    these one date and value.
    """
    found = [_all(F.col("html"), r"(?is)<table\b.*?</table>"), _all(F.col("html"), "(?i)" + JSON_DATE_FIRST), _all(F.col("html"), "(?i)" + JSON_PRICE_FIRST)]
    phased = lambda k: lambda t, n: F.struct(F.lit(k).alias("phase"), n.alias("part"), t.alias("t"))
    parts = F.concat(*[F.transform(x, phased(k)) for k, x in enumerate(found)])
    in_table = F.col("phase") == 0
    headers = F.when(in_table, F.transform(_all(F.col("t"), r"(?is)<th\b[^>]*>(.*?)</th>", 1), lambda h: F.lower(strip_tags(h))))
    headed = pages.select(key, F.inline(parts)).select(key, "phase", "part", "t", headers.alias("headers"))  # before the rows, so once per table
    pieces = F.when(in_table, _all(F.col("t"), r"(?is)<tr\b.*?(?:</tr>|$)")).otherwise(F.array("t"))
    rows = headed.select(key, "phase", "part", "headers", F.posexplode(pieces).alias("row_no", "r"))
    rows = staged(rows, {"cells": F.when(in_table, F.transform(_all(F.col("r"), _CELL, 1), strip_tags))})
    mid = F.array_position(F.transform("headers", lambda h: (h == "mid") | h.contains("average mid")), True)
    cell = lambda n: F.get("cells", n)
    in_rows = F.coalesce(F.when(mid > 0, parse_number(cell((mid - 1).cast("int")), lo, hi)), parse_number(cell(F.lit(1)), lo, hi))
    json = lambda first, second: F.when(F.col("phase") == 1, F.regexp_extract("r", "(?i)" + JSON_DATE_FIRST, first)).otherwise(F.regexp_extract("r", "(?i)" + JSON_PRICE_FIRST, second))
    day = F.when(in_table, parse_day(cell(F.lit(0)))).otherwise(json(1, 2).try_cast("date"))
    value = F.when(in_table, in_rows).otherwise(parse_number(json(2, 1), lo, hi))
    read = staged(rows.filter(~in_table | (F.size("cells") >= 2)), {"obs_date": day, "value": value})
    kept = read.filter(F.col("obs_date").isNotNull() & F.col("value").isNotNull())
    last = first_per_key(kept, [key, "obs_date"], [F.desc("phase"), F.desc("part"), F.desc("row_no")])
    return last.select(key, "obs_date", F.bround("value", 2).alias("value"))


_WEEK = r"(?i)(\d{4})\s+([A-Za-z]{3})-\s*(\d{1,2})\s+to\s+([A-Za-z]{3})-\s*(\d{1,2})"


def week_grid_rows(grid: DataFrame, label: str = "label", cells: str = "cells") -> DataFrame:
    """Week label plus five cells to one dated row per readable cell."""
    text = ws_clean(label)
    start = make_ts(F.regexp_extract(text, _WEEK, 1), month_no(F.regexp_extract(text, _WEEK, 2)), F.regexp_extract(text, _WEEK, 3))
    kept = [c for c in grid.columns if c not in (label, cells)]
    read = F.transform(F.slice(cells, 1, 5), lambda c, i: F.struct(i.alias("day"), parse_number(c, 0.01, 1000).alias("value")))
    # One generator for the label, one for the cells: a filter cannot be pushed below them and parse the text again.
    weeks = staged(grid, {"_start": start.cast("date")}).filter("_start IS NOT NULL")
    rows = weeks.select(*kept, "_start", F.inline(read))
    return rows.filter("value IS NOT NULL").select(*kept, F.date_add("_start", F.col("day")).alias("obs_date"), "value")


def monthly_rows(lines: DataFrame, first: str = "1990-01", last: str = "2021-09", floor: float = 100) -> DataFrame:
    """Monthly averages from (Date, Price) text rows: months in range, numeric prices above the floor."""
    month, price = F.trim("Date"), F.col("Price").try_cast("double")
    ok = month.between(first, last) & (price > floor) & month.rlike(r"^\d{4}-\d{2}$")
    kept = [c for c in lines.columns if c not in ("Date", "Price")]
    return lines.filter(ok).select(
        *kept, F.concat(month, F.lit("-01")).cast("date").alias("obs_date"), month.alias("period"), F.bround(price, 2).alias("value"),
        F.lit("monthly_average").alias("frequency"),
    )


def monthly_csv(spark: SparkSession, path: str, **limits) -> DataFrame:
    return monthly_rows(spark.read.csv(path, schema="Date string, Price string", header=True), **limits)


def monthly_guard(rows: DataFrame, min_rows: int, start: str) -> DataFrame:
    """One row: count, first date, and whether the history is long and old enough to use."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min("obs_date").alias("first_date")).withColumn(
        "ok", (F.col("n") >= min_rows) & (F.col("first_date") == F.lit(start).cast("date"))
    )


def zip_arrays(payloads: DataFrame, as_of: str, floor: float = 100) -> DataFrame:
    """Parallel timestamp and price arrays to daily rows; empty closes and the running day are dropped."""
    arrays = ["timestamp", "open", "high", "low", "close"]
    kept = [c for c in payloads.columns if c not in arrays]
    rows = payloads.select(*kept, F.posexplode(F.arrays_zip(*arrays)).alias("pos", "b"))
    out = rows.select(
        *kept, "pos", epoch_s_date(F.col("b.timestamp")).alias("obs_date"), F.col("b.close").alias("_close"),
        *[F.bround(f"b.{n}", 2).alias(n) for n in ("open", "high", "low")],
    )
    today = as_of_lit(as_of).cast("date")
    return out.filter((F.col("_close") > floor) & (F.col("obs_date") < today)).withColumn("value", F.bround("_close", 2)).drop("_close")


def pairs_rows(payloads: DataFrame, column: str, keys, order) -> DataFrame:
    """JSON text of [[epoch ms, value], …] to dated rows; unreadable pairs skipped, the last of a date wins."""
    pairs = F.from_json(F.col(column), "array<array<string>>")
    rows = payloads.select(*keys, *order, F.posexplode(pairs).alias("pos", "p"))
    ms, value = F.get("p", F.lit(0)).try_cast("double"), F.get("p", F.lit(1)).try_cast("double")
    read = rows.select(*keys, *order, "pos", epoch_ms_date(ms).alias("obs_date"), value.alias("value"))
    ok = read.filter(F.col("obs_date").isNotNull() & F.col("value").isNotNull())
    return first_per_key(ok, [*keys, "obs_date"], [*[F.desc(o) for o in order], F.desc("pos")]).drop("pos", *order)


def closed_bars(payloads: DataFrame, as_of: str, floor: float = 100) -> DataFrame:
    """Bar structs (bar_start, close, is_closed, open, high, low; prices as text) to finished daily rows."""
    kept = [c for c in payloads.columns if c != "bars"]
    rows = payloads.select(*kept, F.posexplode("bars").alias("pos", "b"))
    day, close = F.substring("b.bar_start", 1, 10).try_cast("date"), F.col("b.close").try_cast("double")
    finished = F.coalesce(F.col("b.is_closed"), F.lit(True)) & (day < as_of_lit(as_of).cast("date")) & (close > floor)
    return rows.filter(finished).select(
        *kept, "pos", day.alias("obs_date"), F.bround(close, 2).alias("value"),
        *[F.bround(F.col(f"b.{n}").try_cast("double"), 2).alias(n) for n in ("open", "high", "low")],
    )


def completed_bars(bars: DataFrame, as_of: str, zone: str = "America/New_York", close_hour: int = 18) -> DataFrame:
    """Daily closes up to the last finished trading day: today once the local close hour has passed."""
    local = local_time(as_of_lit(as_of), zone)
    done = F.when(F.hour(local) >= close_hour, local.cast("date")).otherwise(F.date_sub(local.cast("date"), 1))
    return bars.filter(F.col("close").isNotNull() & (F.col("obs_date") <= done)).withColumn("value", F.bround("close", 2))
