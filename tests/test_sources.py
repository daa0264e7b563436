"""Files, pages and feeds that the registered queries cannot show."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgrid.sources import disclosures, envelope, feeds, listing, prices, sinks

ROW = T.StructType([T.StructField("id", T.StringType())])


def test_envelope_files(spark, tmp_path):
    assert envelope.read_envelope(spark, str(tmp_path / "none"), ROW).count() == 0
    (tmp_path / "a.json").write_text('{"schema_version": 1,\n "items": [{"id": "x"}, {"id": "y", "z": 1}]}')
    (tmp_path / "b.json").write_text('{"schema_version": 1, "items": [{"id": ')
    assert sorted(r["id"] for r in envelope.read_envelope(spark, str(tmp_path), ROW).collect()) == ["x", "y"]


def test_csv_file(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Date,Price\n1990-01,410.119\n1990-02,n/a\n1989-12,400\n2021-09,99\n2021-10,1800\n")
    rows = prices.monthly_csv(spark, str(tmp_path / "m.csv"))
    assert [(r["obs_date"], r["value"]) for r in rows.collect()] == [(dt.date(1990, 1, 1), 410.12)]
    assert prices.monthly_guard(rows, 2, "1990-01-01").first()["ok"] is False


LISTING = """<html><body><a href="/article/top-story">Top story of the day</a>
<div class="card"><h3><a href="/article/one?utm_source=x">Lessor orders ten jets</a></h3>
<a href="/category/eu">Europe</a><a href="/category/lease">Leasing</a><a href="/category/all">All News</a>
<p>By Jane Doe 11th September 2026</p><p>A long paragraph that tells more about the order of ten jets.</p></div>
<div><a href="/article/one">Lessor orders ten jets again</a><a href="/article/two">short</a><a href="/other/x">Not an article here</a></div></body></html>"""


def test_listing(spark):
    pages = spark.createDataFrame([(1, "https://N.example.org/list?page=1", LISTING)], "page_id long, url string, html string")
    rows = {r["url"]: r for r in listing.listing_items(pages, "Src", "chan").collect()}
    assert set(rows) == {"https://n.example.org/article/top-story", "https://n.example.org/article/one"}
    one = rows["https://n.example.org/article/one"]
    assert one["title"] == "Lessor orders ten jets"
    assert one["published_date"] == dt.date(2026, 9, 11)
    assert one["author"] == "Jane Doe"
    assert one["region_raw"] == "Europe"
    assert one["categories_raw"] == ["Europe", "Leasing"]
    assert one["summary"].startswith("A long paragraph")


def test_rdf_feed(spark):
    xml = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
    <item><title>Orders &amp; deals</title><link>https://a.org/1</link><dc:date>2024-01-02</dc:date><dc:creator>Ann</dc:creator></item></rdf:RDF>"""
    df = spark.createDataFrame([(1, "Name", "chan", xml), (2, "Name", "chan", "<rss><oops")], "feed_id long, name string, channel string, xml string")
    rows = feeds.rss_items(df).collect()
    assert [(r["title"], r["author"], r["published_date"], r["source"]) for r in rows] == [("Orders & deals", "Ann", dt.date(2024, 1, 2), "Name")]


def test_disclosures(spark):
    text = (
        "Fuel surcharge notice 2024.06.10. The rate follows the average price being USD$95.58/bbl for the period of 1May-31May2024. "
        "Earlier the two-month average price of Singapore kerosene for December and January 2015 was US$ 75.50."
    )
    docs = spark.createDataFrame([(1, "https://x/en/release/201503/1.html", text)], "doc_id long, url string, text string")
    docs = docs.withColumn("text", F.concat("text", F.lit(" See average price of jet fuel.")))
    cargo = disclosures.disclosed_averages(docs, disclosures.CARGO).collect()
    assert (dt.date(2024, 5, 31), 95.58) in [(r["period_end"], r["value"]) for r in cargo]
    two = [r for r in disclosures.disclosed_averages(docs, disclosures.CARRIER_ARCHIVE).collect() if r["observation_type"] == "two_month_average"]
    assert [(r["period_start"], r["period_end"], r["value"]) for r in two] == [(dt.date(2014, 12, 1), dt.date(2015, 1, 31), 75.5)]


def test_write_if_changed(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sinks.write_if_changed(df, out) is True
    assert sinks.write_if_changed(spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string"), out) is False
    assert sinks.write_if_changed(df.limit(1), str(tmp_path / "t2")) is True
