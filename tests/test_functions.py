"""Edge cases of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions import dates, numbers, text, urls
from newsgrid.operators.score import recency_score


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "given,want",
    [
        ("HTTPS://News.Example.COM/A?utm_source=x&b=&Ref=1&a=1%20b#top", "https://news.example.com/A?b=&a=1+b"),
        ("https://x.org/p?q=%7Eu*&flag", "https://x.org/p?q=~u%2A&flag="),
        ("", ""),
        ("/only/path?utm_a=1", "/only/path"),
    ],
)
def test_canonical_url(spark, given, want):
    assert one(spark, urls.canonical_url("u"), u=given) == want


def test_redirect_takes_first_listed_key(spark):
    u = "https://www.bing.com/x?r=http%3A%2F%2Fb.org&u=ftp%3A%2F%2Fz&url=https%3A%2F%2Fa.org%2F%253Fq"
    assert one(spark, urls.unwrap_redirect("u", "bing.com"), u=u) == "https://a.org/?q"


def test_archive_link(spark):
    u = "/web/20251231000000id_/https://press.example.org/en/release/201509/1.html?x=1"
    assert one(spark, urls.unwrap_archive("u", "https://press.example.org"), u=u) == "https://press.example.org/en/release/201509/1.html"


def test_set_page(spark):
    assert one(spark, urls.set_page("u", F.lit(3)), u="https://a.org/x?page=1&b=2&page=9#f") == "https://a.org/x?page=3&b=2#f"


@pytest.mark.parametrize(
    "given,want",
    [
        ("Thu, 10 Sep 2026 23:30:00 -0130", dt.datetime(2026, 9, 11, 1, 0)),
        ("10 Sep 2026 08:00 EST", dt.datetime(2026, 9, 10, 13, 0)),
        ("seen 1st January 2024 here", dt.datetime(2024, 1, 1)),
        ("2024-02-30", None),
        ("Sept 1, 2024", None),
        ("September 1, 2024", dt.datetime(2024, 9, 1)),
        ("&lt;b&gt;11 Sep 2026&lt;/b&gt;", dt.datetime(2026, 9, 11)),
        (None, None),
    ],
)
def test_parse_date_multi(spark, given, want):
    assert one(spark, dates.parse_date_multi(F.col("d").cast("string")), d=given) == want


def test_text(spark):
    assert one(spark, text.ws_clean("s"), s="  a \t b\n\x1fc ") == "a b c"
    assert one(spark, text.strip_html("s"), s="A &amp;amp; B<script>x</script> &#8364;&hellip; <i>c</i>d") == "A & B €… c d"
    assert one(spark, text.truncate("s", 6), s="abcd  efgh") == "abcd…"
    assert one(spark, text.alias_match("s", "SAS"), s="sasquatch and sas2") is False
    assert one(spark, text.alias_match("s", "SAS"), s="flights (sas) resume") is True
    assert one(spark, text.alias_match("s", "国航"), s="今天国航a320") is True
    assert one(spark, F.array_join(text.distinct_ci(F.array(F.lit("A"), F.lit("b"), F.lit("a"))), "|")) == "A|b"


def test_numbers(spark):
    assert one(spark, numbers.clamp_int(F.lit("2.5"))) == 2
    assert one(spark, numbers.clamp_int(F.lit("3.5"))) == 4
    assert one(spark, numbers.clamp_int(F.lit(None).cast("string"), 0, 100, 55)) == 55
    assert one(spark, numbers.parse_number(F.lit("-1,234.5 up"), -2000, 0)) == -1234.5
    assert one(spark, numbers.pct_change(F.lit(1.0), F.lit(0.0))) is None


def test_recency(spark):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    score = lambda s: one(spark, recency_score(at(s), "2024-01-10 00:00:00"))
    assert score("2024-01-12 00:00:00") == 100
    assert score("2024-01-08 00:00:00") == 85
    assert score("2023-01-01 00:00:00") == 35
    assert score(None) == 45


def test_config_reads_json(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"entities": [{"canonical": "X", "type": "T", "aliases": ["x1"]}], "macro_topics": [{"tag": "G", "terms": ["g"]}], "macro_relevance_floor": 70}')
    config = dims.PriorityConfig.from_json(str(path))
    assert config.entities[0].aliases == ("x1",) and config.topics == {"G": ["g"]} and config.macro_floor == 70
