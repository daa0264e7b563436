"""The filter audit against walking every order document by document."""

import itertools
import re
from collections import Counter

import pytest

from newsgrid.llm import filter_audit, llm_queries
from newsgrid.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def plain(docs, labels):
    """{(part, order, step): (counts..., shapley)} from (doc_id, text, source) and (doc_id, quality, toxic) rows."""
    first, good, toxic = {}, set(), set()
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, q, t in labels:
        good |= {i} if q == 1 and i is not None else set()
        toxic |= {i} if t == 1 and i is not None else set()
    cells = Counter()
    for i, text, source in docs:
        text = text or ""
        w = WORD.findall(text)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and first[text] < i,
        }
        cells[source or "", "".join(f for f in "ABCDE" if fails[f]), i in good, i in toxic] += 1
    out = {}
    for part in {c[0] for c in cells}:
        mine = [(set(f), g, t, n) for (p, f, g, t), n in cells.items() if p == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            there = list(mine)
            for step, f in enumerate(order, 1):
                lost = [c for c in there if f in c[0]]
                there = [c for c in there if f not in c[0]]
                total = lambda cs: sum(c[3] for c in cs)
                gone = total(c for c in mine if f in c[0]) - total(lost)
                out[part, "".join(order), step] = [
                    total(there), total(lost), gone, total(c for c in mine if c[0] == {f}), total(c for c in lost if c[1]), total(c for c in lost if c[2])
                ]
                shapley[f] += total(lost)
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def told(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in (*COUNTS, "shapley")) for r in rows}
    assert len(got) == len(rows)
    return got


def test_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").collect()]
    assert told(llm_queries.QUERIES["op11_filter_audit"](spark, sf_dir)) == plain(docs, labels)


LONG = " ".join(f"w{i}" for i in range(250))
DOCS = [
    (1, LONG, "s"), (2, LONG, "s"), (3, LONG, None), (3, LONG, ""), (4, None, "s"), (5, "", "s"), (None, LONG, "s"), (None, None, None), (6, "A B # A", "t"),
    (7, "same " * 400, "s"), (7, "same " * 400, "s"), (8, "   x" * 9000, "s"), (1, LONG, "s"), (9, LONG.upper() + " |", "s"), (-4, "éİ " * 300, "t"),
]
LABELS = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, 1), (4, 1, None), (None, 1, 1), (9, 0, 1), (77, 1, 1)]


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, clashing names."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    if extra:
        for name in ("part", "mask", "n", "good", "toxic", "digest", "id", "words", "step"):
            docs = docs.selectExpr("*", f"'x' {name}")
    assert told(filter_audit.audit(docs, labels)) == plain(DOCS, LABELS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "x", "s")], docs.schema)
    assert told(filter_audit.audit(one, labels)) == plain([(1, "x", "s")], [])


def test_a_text_in_most_rows_is_no_hot_key(spark):
    """Copies of one text meet their first one on (digest, id): each copy's key is its own."""
    docs = spark.range(5000).selectExpr("id doc_id", "if(id % 3 = 0, 'the same', cast(id as string)) text", "'s' source")
    cells = {r["mask"]: r["n"] for r in filter_audit.mask_cells(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    assert cells == {1: 5000 - 1666, 1 + 16: 1666}
