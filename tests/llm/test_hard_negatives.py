"""Hard-negative mining against scoring every pair."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsgrid.llm import hard_negatives as H
from newsgrid.llm import llm_queries
from newsgrid.llm.common import table

TYPES = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    held = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        held.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, q))
    out = []
    for at, (i, label, q) in enumerate(held):
        if i is None or i % 100:
            continue
        ranked = sorted(((sum(map(int.__mul__, q, o[2])), o[0], o[1]) for k, o in enumerate(held) if k != at and len(o[2]) == len(q)), key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        for p in [x for x in ranked if x[2] == label][:5]:
            fit = [x for x in ranked if x[2] != label and 30 * p[0] <= 100 * x[0] <= 90 * p[0]][:10]
            out += [(i, p[1], k, x[1], p[0], x[0]) for k, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(df):
    moved = F.expr("if(vec_id % 7 = 0, (cast(label as long) + 1) % 10, cast(label as long))")
    return sorted((tuple(r) for r in H.mine(df, F.col("id") % 100 == 0, moved).select(COLUMNS).collect()), key=str)


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, sf_dir, "embeddings").collect()]
    got = llm_queries.QUERIES["op12_hard_negatives"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_clustered_vectors_in_many_blocks(spark, monkeypatch):
    """Several blocks, rounds and chunks; ties by repeated vectors."""
    monkeypatch.setattr(H, "ROWS", (40, 65_536))
    monkeypatch.setattr(H, "ASKS", 3)
    monkeypatch.setattr(H, "WIDER", 2)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24)) + 0.4
    rows = [(k, list(map(float, (centres[k % 6] + rng.normal(size=24) * rng.choice([0, 0.2, 1])) / 4)), int(rng.integers(0, 4))) for k in range(700)]
    got = mined(spark.createDataFrame(rows, TYPES))
    assert got == plain(rows) and len({r[0] for r in got}) > 3


def test_odd_rows(spark):
    """Nulls, non-finite components, other lengths, repeated ids and rows, ties, clashing names."""
    nan, inf = float("nan"), float("inf")
    vectors = [
        (100, [1.0, 0.5], 1), (100, [0.25, 1.0], 1), (200, None, 1), (300, [1.0, None], 2), (400, [nan, 1.0], 2), (500, [1.0, inf], 2), (600, [1.0, 0.5], None), (700, [1.0, 1.0], 9),
        (800, [0.0, 0.0], 1), (900, [], 1), (901, [], 1), (902, [], 2), (1000, [1.0, 1.0, 1.0], 1), (1001, [1.0, 1.0, 0.9], 1), (1002, [0.6, 0.6, 0.6], 3), (None, [0.5, 0.5], 2),
        *[(k, [0.5, 0.4], 2) for k in range(1, 40)], *[(k, [1.0, 0.9], 1) for k in range(41, 49)], (3, [0.5, 0.4], 2), (3, [0.5, 0.4], 2), (-100, [-1.0, 0.3], 1),
    ]
    df = spark.createDataFrame(vectors, TYPES)
    got = mined(df)
    assert got == plain(vectors)
    assert mined(df.selectExpr("*", "1 uid", "2 dim", "'x' q", "3 id", "4 ord")) == got


def test_no_rows_and_no_anchors(spark):
    assert mined(spark.createDataFrame([], TYPES)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], TYPES)) == []


@pytest.mark.parametrize("segments", [1, 4, 16])
def test_bounds_hold_and_narrow(segments):
    rng = np.random.default_rng(segments)
    x, y = rng.integers(-300, 300, (50, 21)).astype(float), rng.integers(-300, 300, (60, 21)).astype(float)
    (mx, dx), (my, dy) = H.summaries(x, segments), H.summaries(y, segments)
    score, middle, spread = x @ y.T, mx @ my.T, dx @ dy.T
    assert (np.abs(score - middle) <= spread + 1e-6).all()
    if segments > 1:
        (m1, d1), (n1, e1) = H.summaries(x, 1), H.summaries(y, 1)
        assert (middle + spread <= m1 @ n1.T + d1 @ e1.T + 1e-6).all()


def test_filter_spares_exact_scores(monkeypatch):
    """On vectors with structure most pairs are ruled out by their summaries."""
    rng = np.random.default_rng(5)
    shape = np.repeat(rng.normal(size=(8, 16)), 4, axis=1)
    q = np.floor(256 * (shape[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 64)) * 0.05)).astype(np.int64)
    side, asks = H.Side(q), H.Side(q[:20])
    scores = q[:20] @ q.T
    low = np.sort(scores, axis=1)[:, -40]
    seen = []
    monkeypatch.setattr(H, "exact", lambda a, b: seen.append(len(a) * len(b)) or a @ b.T)
    i, j, told = H.scored(asks, side, low, np.full(20, H.FAR), np.ones(scores.shape, bool))
    assert {(a, b) for a, b in zip(i, j, strict=True)} == set(zip(*np.nonzero(scores >= low[:, None]), strict=True))
    assert not seen  # too few pairs left for a whole matrix
