"""Costly expressions stand once in a plan: written twice, they are worked out twice a row, or once more an element."""

from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.dates import month_no
from newsgrid.functions.text import contains_any, distinct_ci
from newsgrid.operators.classify import extract_terms
from newsgrid.sources import disclosures, prices


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_patterns_are_sought_once_a_text(spark):
    texts = spark.range(1).select(F.concat(F.lit("AIRBUS, airbus and Boeing "), F.col("id")).alias("t"))
    found = texts.select(extract_terms("t", F.lit("")).alias("x"))
    assert plan(found).count("regexp_extract_all") == len(dims.ENTITY_PATTERNS)
    assert found.first()["x"] == ["AIRBUS", "Boeing"]


def test_first_spellings(spark):
    rows = spark.createDataFrame([(["b", None, "A", "a", "B", "c"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in rows.select(distinct_ci("v")).collect()] == [["b", "A", "c"], [], None]


def test_a_term_within_another_is_asked_alone(spark):
    low = spark.createDataFrame([("sale-leaseback",), ("a loan",), ("",)], "t string")
    told = low.select(contains_any("t", ["sale-leaseback", "lease", "leasing", "loan"]).alias("x"))
    assert plan(told).lower().count("contains(") + plan(told).lower().count("sale-leaseback") <= 4
    assert [r["x"] for r in told.collect()] == [True, True, False]


def test_disclosures_clean_and_read_a_text_once(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.lit("u").alias("url"), F.concat(F.lit("singapore kerosene "), F.col("id")).alias("text"))
    told = plan(disclosures.disclosed_averages(docs, disclosures.CARRIER_ARCHIVE))
    assert told.count("<template") == 1 and told.count("Range (") == 1


def test_a_months_name_is_read_once(spark):
    names = spark.createDataFrame([("Jan.",), ("december",), ("x",), (None,)], "t string")
    told = names.select(month_no(F.regexp_extract("t", "[A-Za-z.]+", 0)).alias("m"))
    assert plan(told).count("regexp_extract") <= 1
    assert [r["m"] for r in told.collect()] == [1, 12, None, None]


def test_week_labels_are_parsed_once_a_row(spark):
    grid = spark.createDataFrame([(1, "2024 Jan- 1 to Jan-05", ["1.5", " - ", "2,000", "3", "n/a", "9"]), (2, "no week", ["1"]), (3, None, None)], "k int, label string, cells array<string>")
    rows = prices.week_grid_rows(grid)
    assert plan(rows).count("make_timestamp") <= 1
    assert [(r["k"], str(r["obs_date"]), r["value"]) for r in rows.orderBy("obs_date").collect()] == [(1, "2024-01-01", 1.5), (1, "2024-01-04", 3.0)]
