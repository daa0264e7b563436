"""Archive conversion of pages that share an id, have no html, or repeat."""

import hashlib

from newsgrid.llm import llm_queries


def test_one_result_a_row(spark, tmp_path):
    long = "x" * 2000
    rows = [(1, "http://a/1", long), (5, "http://a/5", long), (5, "http://a/5", long), (5, "http://a/5b", "other"), (7, None, None), (8, "http://a/8", "é" * 500)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, llm_queries.QUERIES["op4_arc_to_warc"](spark, str(tmp_path)).collect()), key=str)
    digest = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    want = [(i, len((h or "").encode()), digest(h), "revisit" if i == 1 else "response", 5 if i == 1 else None) for i, _, h in rows]
    assert got == sorted(want, key=str)
