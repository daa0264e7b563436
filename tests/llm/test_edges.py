"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsgrid.llm import arc, hashing_search, licenses, line_chunks, line_frequency, llm_queries, packing, pfair, pii_crf, simhash, toxicity

TYPES = "doc_id long, text string, lang string, source string, n_chars long, score string, block string"
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (1, "a b c d\n" + PASSAGE + "\nend of one", "en", "s", 9, "x", "y"),
    (2, "first line here\n" + PASSAGE, None, "s", 9, None, None),
    (3, None, None, None, None, None, None),
    (4, "", "en", "s", 0, "x", "y"),
    (5, "a b c d\n" + PASSAGE + "\nend of one", "en", "s", 9, "x", "y"),
    (5, "a b c d\n" + PASSAGE + "\nend of one", "en", "s", 9, "x", "y"),
    (None, "mail me@host.org or call +49 30 1234567, cc by", "en", None, 9, "x", "y"),
    (6, "7" * 30_000 + " " + "z" * 30_000, "en", "s", 9, "x", "y"),
]
OPS = {
    "line_frequency": line_frequency.line_frequency,
    "line_chunks": line_chunks.line_chunk_dedup,
    "mix": pfair.mix,
    "mixed": pfair.mixed,
    "near_duplicates": simhash.near_duplicates,
    "keep_one": simhash.keep_one,
    "pack": lambda d: packing.pack(d, llm_queries.tokenizer_path()),
    "licenses": licenses.scan_licenses,
    "pii": pii_crf.find_pii,
    "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.learn_lexicon(d, d.select("doc_id", F.lit(1).alias("toxic")))),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, TYPES)


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, name):
    assert OPS[name](spark.createDataFrame([], TYPES)).collect() == []


@pytest.mark.parametrize("name", sorted(set(OPS) - {"line_chunks", "keep_one", "pack"}))
def test_every_row_has_a_result(docs, name):
    assert OPS[name](docs).count() == len(ROWS)


def test_repeated_passage_stays_once(docs):
    got = line_chunks.line_chunk_dedup(docs).collect()
    assert sorted(r.doc_id or 0 for r in got if "shared7" in (r.text or "")) == [1]
    assert {r.doc_id for r in got} >= {1, 2, 3, 4, None, 6}


def test_one_of_each_group(docs):
    got = sorted((r.doc_id or 0) for r in simhash.keep_one(docs).collect())
    assert got == [0, 1, 2, 3, 6]


def test_spans_reach_repeats():
    text = "Call +49 30 1234567 now, or mail someone.else@host.org; again: someone.else at 49301234567."
    base = pii_crf.base_spans(text)
    assert base["email"] == [(text.index("someone"), text.index(";"))]
    assert len(base["phone"]) == 1


def test_period_meets_every_deadline():
    counts = pfair.whole_counts({"a": 5.0, "b": 3.0, "c": 1.0}, 64)
    order, seen = pfair.one_period(counts), dict.fromkeys("abc", 0)
    assert sum(counts.values()) == len(order) == 64
    for slot, s in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[x] - slot * counts[x] / 64) < 1 for x in seen)


def test_bucket_comparison():
    import numpy as np

    codes = np.random.default_rng(1).integers(0, 1 << 63, 300, np.uint64)
    codes[7], codes[200] = codes[3] ^ np.uint64(7), codes[3] ^ np.uint64(15)
    for radius in (1, 3):
        want = [i for i, c in enumerate(codes) if int(c ^ codes[3]).bit_count() <= radius]
        assert simhash.Planes(codes).within(int(codes[3]), radius).tolist() == want


def test_arc_versions_and_broken_tail():
    v2 = b"filedesc://x 0.0.0.0 20000101000000 text/plain 6\n2 0 x\n\nhttp://a/ 1.2.3.4 20000102030405 text/html 200 - - 0 f 3\nabc\n"
    v1 = b"filedesc://x 0.0.0.0 20000101000000 text/plain 6\n1 0 x\n\nhttp://b/ 1.2.3.4 20000102030405 text/html 9\nabc"
    assert [(r["url"], r["payload"], r["version"]) for r in arc.arc_records(v2)] == [("http://a/", b"abc", "2")]
    assert "breaks off" in list(arc.arc_records(v1))[0]["error"]


def test_vectors_without_a_direction(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [1.0, 1.0]), (None, [1.0, 1.0])]
    got = hashing_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 4)]
    assert hashing_search.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(3).permutation(60).tolist()
    pairs = [(max(a, b), min(a, b)) for a, b in zip(order, order[1:], strict=False)] + [(101, 100)]
    got = {r.node: r.component for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(1, 60), 0) | {101: 100}


def test_passage_of_short_lines_goes(spark):
    lines = lambda name, n: [f"{name} line {i} says something plain" for i in range(n)]
    shared = lines("shared", 12)
    rows = [(i, "\n".join([*lines(f"own{i}", 3 + i), *shared, *lines(f"end{i}", 4)])) for i in range(3)]
    got = {r.doc_id: r.text.split("\n") for r in line_chunks.line_chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "\n".join(got[0]) == rows[0][1]
    for i in (1, 2):
        assert [x for x in got[i] if x not in shared] == [*lines(f"own{i}", 3 + i), *lines(f"end{i}", 4)]
        assert sum(x in shared for x in got[i]) <= 6


def test_every_block_within_one_of_its_share(spark):
    rows = [(i, "abbcccc"[i % 7], f"text {i}") for i in range(700)]
    made = pfair.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), {"a": 1, "b": 2, "c": 4}, block=2, period=70)
    slots = sorted({(r.slot, r.queue) for r in made.collect()})
    assert len(slots) == 350
    for t in range(350):
        for s, w in (("a", 1 / 7), ("b", 2 / 7), ("c", 4 / 7)):
            assert abs(sum(q == s for _, q in slots[: t + 1]) - w * (t + 1)) < 1
