"""Hard negatives: for each anchor and each of its nearest rows of the same label, the best rows of other
labels whose score lies in a band below that positive's. Exact, with segment summaries as the filter.

A vector's components are cut into segments; a segment is summed up by its mean and deviation. For two
vectors x and y the segment's share of the inner product is at most size * (mean x * mean y + dev x * dev y)
and at least size * (mean x * mean y - dev x * dev y), so sums over segments bound the score from both sides.
Rows of a chunk are bounded together first, then one by one at 1, 4 and 16 segments, and only
pairs whose bounds still meet the wanted band are scored exactly.

Anchors and rows are hashed into blocks of bounded size, also within one label, and meet by an equi-join
on (block of anchors, block of rows). Row blocks are searched in rounds, each ``WIDER`` times as many
as before; the k-th best score so far is the next round's lower limit, so that a round adds about
``WIDER * k`` candidates an ask however many rows there are.

Rows with a null label, a null vector or a null or non-finite component take no part; nor do vectors whose
integer norm reaches 2**59, as scores would not fit a long. Vectors of different lengths never meet; empty
ones score 0. Repeated rows and repeated ids are rows of their own: each such anchor has its own
lists, each can be another's positive. Rows without id are no anchors and come last among ties. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsgrid.llm.common import cut_lineage

SEGMENTS = (1, 4, 16)
ASKS = 4096  # anchors in a block
ROWS = (1024, 65_536)  # least and most rows in a block
WIDER = 8
CHUNK = 2048  # rows bounded and scored at once, against ASK_CHUNK anchors
ASK_CHUNK = 128
DENSE = 0.15  # share of pairs left from which a whole matrix is cheaper than single pairs
FAR = 1 << 62
NORM_LIMIT = float(1 << 59)


def summaries(q: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments, both times the root of the segment's size."""
    starts = np.linspace(0, q.shape[1], segments, endpoint=False).astype(int)
    sizes = np.diff(np.append(starts, q.shape[1]))
    means = np.add.reduceat(q, starts, axis=1) / sizes
    spread = np.add.reduceat((q - np.repeat(means, sizes, axis=1)) ** 2, starts, axis=1)
    return means * np.sqrt(sizes), np.sqrt(spread)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of both; through doubles where these are exact."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * float(a.shape[1]) >= 2**53:
        return a @ b.T
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64)


class Side:
    """Vectors of one side with their summaries at every level."""

    def __init__(self, q: np.ndarray):
        self.q = q
        real = q.astype(float)
        self.levels = [summaries(real, s) for s in SEGMENTS if s < q.shape[1]]
        self.norm = np.sqrt((real**2).sum(1))

    def part(self, at) -> Side:
        made = object.__new__(Side)
        made.q, made.norm = self.q[at], self.norm[at]
        made.levels = [(m[at], d[at]) for m, d in self.levels]
        return made


def within_chunk(asks: Side, rows: Side, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which asks can have any row of the chunk in their band, by the range of the chunk's summaries."""
    if not rows.levels:
        return low <= high
    (ma, da), (mr, dr) = asks.levels[-1], rows.levels[-1]
    least, most = mr.min(0), mr.max(0)
    spread = da @ dr.max(0)
    slack = 1e-9 * asks.norm * rows.norm.max() + 1e-6
    upper = np.maximum(ma * least, ma * most).sum(1) + spread + slack
    lower = np.minimum(ma * least, ma * most).sum(1) - spread - slack
    return (upper >= low) & (lower <= high)


def scored(asks: Side, rows: Side, low: np.ndarray, high: np.ndarray, open_: np.ndarray):
    """(ask, row, score) of the pairs that are ``open_`` and score from ``low`` to ``high`` of the ask."""
    for (ma, da), (mr, dr) in zip(asks.levels, rows.levels, strict=True):
        share = np.count_nonzero(open_) / max(1, open_.size)
        if share == 0:
            break
        if share >= DENSE:
            middle, spread = ma @ mr.T, da @ dr.T + 1e-9 * np.outer(asks.norm, rows.norm) + 1e-6
            open_ = open_ & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
        else:
            i, j = np.nonzero(open_)
            middle = np.einsum("ij,ij->i", ma[i], mr[j])
            spread = np.einsum("ij,ij->i", da[i], dr[j]) + 1e-9 * asks.norm[i] * rows.norm[j] + 1e-6
            meets = (middle + spread >= low[i]) & (middle - spread <= high[i])
            open_ = np.zeros_like(open_)
            open_[i[meets], j[meets]] = True
    if np.count_nonzero(open_) >= DENSE * open_.size:
        all_scores = exact(asks.q, rows.q)
        i, j = np.nonzero(open_ & (all_scores >= low[:, None]) & (all_scores <= high[:, None]))
        return i, j, all_scores[i, j]
    i, j = np.nonzero(open_)
    told = np.einsum("ij,ij->i", asks.q[i], rows.q[j])
    meets = (told >= low[i]) & (told <= high[i])
    return i[meets], j[meets], told[meets]


def first(k: int, score: np.ndarray, order: np.ndarray) -> np.ndarray:
    return np.lexsort((order, -score))[:k]


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.int64).reshape(len(vectors), -1)


def cell_search(k: int, same_label: bool):
    """The search of one cell: each slot's first ``k`` rows of the block in its band."""

    def run(_key, asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("uid", "slot", "row", "ord", "known", "score")}
        if len(asks) and len(rows):
            whole = Side(matrix(rows["q"]))
            if whole.levels:  # chunks of rows with like means have narrow ranges
                by = np.argsort(whole.levels[0][0][:, 0], kind="stable")
                whole, rows = whole.part(by), rows.iloc[by]
            uid, order, known, label = (rows[c].to_numpy() for c in ("uid", "ord", "known", "label"))
            for at in range(0, len(asks), ASK_CHUNK):
                held = asks.iloc[at : at + ASK_CHUNK]
                side, own, own_label = Side(matrix(held["ask_q"])), held["ask"].to_numpy(), held["ask_label"].to_numpy()
                slots = [[[s["slot"], s["lo"], s["hi"], np.zeros(0, np.int64), np.zeros(0, np.int64)] for s in x] for x in held["slots"]]
                for start in range(0, len(rows), CHUNK):
                    cut = slice(start, start + CHUNK)
                    low = np.array([min(s[1] for s in x) for x in slots])
                    high = np.array([max(s[2] for s in x) for x in slots])
                    part = whole.part(cut)
                    open_ = (own_label[:, None] == label[None, cut]) == same_label
                    open_ &= own[:, None] != uid[None, cut]
                    open_ &= within_chunk(side, part, low, high)[:, None]
                    i, j, score = scored(side, part, low, high, open_)
                    ends = np.searchsorted(i, np.arange(len(held) + 1))
                    for a in np.flatnonzero(np.diff(ends)):
                        mine, told = j[ends[a] : ends[a + 1]] + start, score[ends[a] : ends[a + 1]]
                        for s in slots[a]:
                            fit = (told >= s[1]) & (told <= s[2])
                            if fit.any():
                                at_rows, at_scores = np.append(s[3], mine[fit]), np.append(s[4], told[fit])
                                best = first(k, at_scores, order[at_rows])
                                s[3], s[4] = at_rows[best], at_scores[best]
                                if len(best) == k:
                                    s[1] = max(s[1], int(s[4][-1]))
                for u, x in zip(own, slots, strict=True):
                    for slot, _, _, at_rows, at_scores in x:
                        n = len(at_rows)
                        out["uid"] += [u] * n
                        out["slot"] += [slot] * n
                        out["row"] += list(uid[at_rows])
                        out["ord"] += list(order[at_rows])
                        out["known"] += list(known[at_rows])
                        out["score"] += list(at_scores)
        return pd.DataFrame(out)

    return run


FOUND = "uid long, slot int, row long, ord long, known boolean, score long"


def blocked(df: DataFrame, group: list[str], size: int, salt: int, block: str, blocks: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the hashed block of each row, and the number of blocks of each group."""
    counts = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(blocks))
    return df.join(counts, group).withColumn(block, F.pmod(F.xxhash64("uid", F.lit(salt)), F.col(blocks)).cast("int")).drop(blocks), counts


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each ask's slot, numbered from 1: higher scores, then smaller ids."""
    place = F.row_number().over(Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "ord", "row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(asks: DataFrame, rows: DataFrame, k: int, same_label: bool, size: int) -> DataFrame:
    """(uid, slot, row, ord, known, score, rank) of each ask's slots; a slot has a band from ``lo`` to ``hi``."""
    group = ["dim", "label"] if same_label else ["dim"]
    row_blocks, row_counts = blocked(rows, group, size, 1, "block", "blocks")
    ask_blocks, ask_counts = blocked(asks, group, ASKS, 2, "a", "many")
    sizes = row_counts.join(ask_counts, group)
    last = sizes.agg(F.max("blocks").alias("n")).collect()[0]["n"] or 0
    cell = [*group, "a", "block"]
    key = [F.col(c).alias(f"k_{c}") for c in cell]
    best, low, high = None, 0, 1
    while low < last or best is None:
        spread_rows = row_blocks.where(F.col("block").between(low, high - 1)).join(sizes, group).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
        now = ask_blocks if best is None else raised(ask_blocks, best, k)
        upto = F.least(F.lit(high), F.col("blocks")) - 1
        spread_asks = now.join(sizes.where(F.col("blocks") > low), group).withColumn("block", F.explode(F.sequence(F.lit(low), upto)))
        left = spread_asks.select(*key, F.col("uid").alias("ask"), F.col("label").alias("ask_label"), F.col("q").alias("ask_q"), "slots").groupBy(*[f"k_{c}" for c in cell])
        right = spread_rows.select(*key, F.col("uid").alias("uid"), F.col("ord").alias("ord"), F.col("known").alias("known"), F.col("label").alias("label"), F.col("q").alias("q")).groupBy(*[f"k_{c}" for c in cell])
        found = left.cogroup(right).applyInPandas(cell_search(k, same_label), FOUND)
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = cut_lineage(ranked(found, k))
        low, high = high, high * WIDER
    return best


def raised(asks: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Asks whose slots that are full start at the last score of their list."""
    full = best.where(F.col("rank") == k).groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("full"))
    lifted = lambda s: F.struct(s["slot"].alias("slot"), F.greatest(s["lo"], F.coalesce(F.element_at("full", s["slot"]), s["lo"])).alias("lo"), s["hi"].alias("hi"))
    met = asks.join(full, "uid", "left")
    return met.withColumn("slots", F.when(F.col("full").isNull(), F.col("slots")).otherwise(F.transform("slots", lifted))).drop("full")


def prepared(table: DataFrame, relabel: Column | None = None) -> DataFrame:
    """One row per vector that takes part: uid, id, label, dim and the integer components."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    scaled = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    label = F.col("label").cast("long")
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.lit(256) * F.abs(x.cast("double")) + 1, F.lit(2.0)))
    held = table.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite).where(norm < NORM_LIMIT)
    held = held.select(
        F.col("vec_id").cast("long").alias("id"), (label if relabel is None else relabel).alias("label"), F.size("embedding").alias("dim"), F.transform(scaled, lambda x: x.cast("int")).alias("q")
    )
    order = [F.coalesce("id", F.lit((1 << 63) - 1)).alias("ord"), F.col("id").isNotNull().alias("known")]
    return cut_lineage(held.select(F.monotonically_increasing_id().alias("uid"), "*", *order))


def mine(vectors: DataFrame, anchors: Column, relabel: Column | None = None, positives: int = 5, negatives: int = 10, band: tuple[int, int, int] = (3, 9, 10)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on ``id``; ``band`` the least and largest tenths (over its third number)
    of the positive's score a negative may have.
    """
    rows = prepared(vectors, relabel)
    n = rows.count()
    size = min(ROWS[1], max(ROWS[0], -(-n // 64)))
    asks = rows.where(anchors).select("uid", "id", "label", "dim", "q")
    slots = lambda slot, lo, hi: F.struct(slot.cast("int").alias("slot"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    open_ = asks.withColumn("slots", F.array(slots(F.lit(0), F.lit(-FAR), F.lit(FAR))))
    near = search(open_, rows, positives, True, size).select(
        "uid", F.col("rank").alias("slot"), F.when(F.col("known"), F.col("ord")).alias("positive_id"), F.col("score").alias("positive_score")
    )
    low = -whole_div(-band[0] * F.col("positive_score"), band[2])
    bands = near.select("uid", "slot", low.alias("lo"), whole_div(band[1] * F.col("positive_score"), band[2]).alias("hi")).where("lo <= hi")
    wanted = bands.groupBy("uid").agg(F.collect_list(slots(F.col("slot"), F.col("lo"), F.col("hi"))).alias("slots"))
    hard = search(asks.join(wanted, "uid"), rows, negatives, False, size)
    named = hard.join(near, ["uid", "slot"]).join(asks.select("uid", F.col("id").alias("anchor_id")), "uid")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("known"), F.col("ord")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def whole_div(x: Column, by: int) -> Column:
    """Floor of x / by in whole numbers."""
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by))
