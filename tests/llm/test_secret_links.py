"""Secret scan: base spans by their plain patterns, links against comparing all parts."""

import hashlib
import random
import re

from newsgrid.llm import llm_queries
from newsgrid.llm import secret_links as S
from newsgrid.llm.common import table


def plain_base(text):
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([*map(letters, ["password", "passwd", "secret", "token"]), letters("api") + "_?" + letters("key")])
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(spans)]


def plain_links(text):
    """Every weak part with its complements in reach, by looking at all parts of the scope."""
    base = S.base_spans(text)
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    parts = [(S.ROLES[k], k, s, e, sum(b <= s for b in breaks)) for k, s, e in [*base, *S.weak_parts(text, base)]]
    near = lambda p, role: any(o[0] == role and o[4] == p[4] and max(o[2] - p[3], p[2] - o[3]) <= S.REACH for o in parts)
    needs = {"key_id": ["credential"], "credential": ["key_id"], "endpoint": ["key_id", "credential"]}
    return {(k, s, e) for r, k, s, e, c in parts if k in S.WEAK and all(near((r, k, s, e, c), n) for n in needs[r])}


def test_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    rows = llm_queries.QUERIES["op13_secret_links"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and {r.doc_id for r in rows} == set(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        told = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in base) for x in S.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(","))


def test_base_patterns_on_odd_strings():
    rng = random.Random(4)
    bits = ["password", "PassWd", "toKen", "secret", "api_key", "APIKEY", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "abc", "AKIA", "A" * 9, "0af9", "f" * 20, "-", "é", "\n", "."]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert S.base_spans(text) == plain_base(text), text


SETUP = """service notes
user: alice
pass = hunter2hunter
host: db.example.org

user: bob

see https://svc:Pa55w0rdX@api.example.org/v1 there
"""


def spans(spark, texts):
    rows = S.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans} for r in rows}


def test_weak_parts_need_their_complements(spark):
    alone = ["user: alice and host: db.example.org", "pwd: 1234567 on host: db", "user: alice" + " " * 400 + "pwd: 1234567", "user: alice\n\npwd: 1234567", "see https://example.org/a"]
    got = spans(spark, [SETUP, *alone])
    kinds = lambda i, text: sorted((k, text[s:e]) for k, s, e in got[i])
    assert kinds(0, SETUP) == [
        ("credential", "Pa55w0rdX"), ("credential", "pass = hunter2hunter"), ("endpoint", "host: db.example.org"),
        ("endpoint", "https://svc:Pa55w0rdX@api.example.org/v1"), ("key_id", "svc"), ("key_id", "user: alice"),
    ]
    assert all(got[i] == set() for i in range(1, 6))


def test_base_spans_complete_weak_parts(spark):
    text = "client_id=42-xyz and token = abcdef123456"
    assert {k for k, _, _ in spans(spark, [text])[0]} == {"assign", "key_id"}


def test_links_against_all_parts(spark):
    rng = random.Random(9)
    bits = ["user: ab1 ", "pwd=1234567 ", "host: x.org ", "http://u:pw@h/p ", "AKIA" + "B" * 16 + " ", "Zx9" * 8 + "-q ", "token=abcdefgh ", "word " * 15, "\n", "\n\n", "\n \n", " ", "x" * 90 + " "]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(150)]
    got = spans(spark, texts)
    for i, text in enumerate(texts):
        assert got[i] == set(S.base_spans(text)) | plain_links(text)


def test_odd_rows(spark):
    """Null and empty texts, repeated rows and ids, a long text, clashing names, an empty table."""
    long = "user: abc pwd: 1234567 " * 20_000 + "a" * 200_000
    rows = [(1, SETUP), (1, SETUP), (None, SETUP), (1, "user: x"), (2, None), (3, ""), (None, None), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 `row`", "2 base", "3 spans", "4 kind", "5 added")
    got = S.find_secrets(docs).collect()
    assert sorted((r.doc_id or 0, len(r.spans)) for r in got) == sorted([(1, 6), (1, 6), (0, 6), (1, 0), (2, 0), (3, 0), (0, 0), (4, 40_001)])
    assert all(r.base == [] for r in got if r.doc_id == 2)
    assert S.find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []
