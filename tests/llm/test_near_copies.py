"""The near-copy stage against comparing all sets of runs, and rows that share an id."""

import itertools
import random

import pytest

from newsgrid.llm import near_copies


def plain_components(rows, similarity=0.8):
    """{(id, text): least id reachable}, from all pairs of rows with an id."""
    nodes = sorted({(i, t or "") for i, t in rows if i is not None})
    sets = [set(near_copies.run_hashes(t).tolist()) for _, t in nodes]
    head = list(range(len(nodes)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in itertools.combinations(range(len(nodes)), 2):
        x, y = sets[a], sets[b]
        if x == y or (x and y and len(x & y) >= similarity * len(x | y) - 1e-9):
            i, j = sorted((top(a), top(b)))
            head[j] = i
    return {n: nodes[top(k)][0] for k, n in enumerate(nodes)}


def family(draw, size, words, edits, name):
    base = [f"{name}{draw.randrange(9000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for at in draw.sample(range(words), edits):
            copy[at] = f"new{draw.randrange(10**9)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    """Families around the threshold, where buckets are shared but most pairs fail."""
    draw = random.Random(seed)
    texts = [t for k, edits in enumerate((2, 3, 4, 5, 6)) for t in family(draw, 25, 150, edits, f"f{k}w")]
    texts += family(draw, 40, 60, 1, "short") + ["", "one", "one", "two words", "passage " * 30] * 2
    rows = list(enumerate(texts))
    got = near_copies.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components(rows)
    assert {r.doc_id: r.component_id for r in got} == {i: c for (i, _), c in want.items()}


def test_many_look_alikes_below_the_threshold_make_few_pairs(spark):
    """A family whose pairs are at about 0.7 shares buckets; runs of one class only rule its pairs out."""
    draw = random.Random(3)
    rows = list(enumerate(family(draw, 400, 200, 8, "w")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = near_copies.run_sets(docs, 5, False).selectExpr("xxhash64(digest) node", "runs")
    pairs = near_copies.prefix_pairs(sets.selectExpr("node", "node at"), sets, 0.8)
    close = {r.node: set(r.runs) for r in sets.collect()}
    want = {(a, b) for a, b in itertools.permutations(close, 2) if a > b and len(close[a] & close[b]) >= 0.8 * len(close[a] | close[b])}
    got = {(r.a, r.b) for r in pairs.collect()}
    assert want <= got and len(got) < 0.05 * len(rows) ** 2


def test_rows_of_one_id_are_told_apart_by_text(spark):
    other = " ".join(f"x{k}" for k in range(40))
    text = " ".join(f"y{k}" for k in range(40))
    rows = [(1, text, "a"), (1, other, "b"), (1, other, "c"), (2, text.upper(), "d"), (3, None, "e"), (4, "", "f"), (None, text, "g"), (None, text, "h"), (5, other + " tail", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 node", "2 mark", "3 digest", "4 n")
    got = near_copies.keep_dissimilar(docs)
    assert got.columns == docs.columns
    kept = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    assert kept == sorted([(1, text), (1, other), (3, ""), (0, text), (0, text)])
    assert near_copies.keep_dissimilar(docs.where("false")).collect() == []


def test_long_texts(spark):
    words = [f"w{k}" for k in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:59_000])), (3, " ".join(words[:30_000])), (4, "z" * 500_000)]
    got = near_copies.keep_dissimilar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [1, 3, 4]


def test_simhash_joins_the_classes_it_can_reach(spark):
    """Fingerprints of runs within three bits are pairs of the first step; unrelated texts are not."""
    draw = random.Random(5)
    long = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(long), " ".join([*long[:-1], "end"]), " ".join([*long, "tail"]), " ".join(f"x{k}" for k in range(300)), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = near_copies.run_sets(docs, 5, True).collect()
    near = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= near_copies.RADIUS
    assert near(told[0].fp, told[1].fp) and near(told[0].fp, told[2].fp) and not near(told[0].fp, told[3].fp)
    classes = spark.createDataFrame([(r.doc_id, r.fp) for r in told], "node long, fp long")
    joined = {n for r in near_copies.fingerprint_pairs(classes).collect() for n in r}
    assert joined == {0, 1, 2}
