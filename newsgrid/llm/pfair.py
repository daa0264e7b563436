"""Sources interleaved to target weights by Pfair scheduling.

Block j (from 1) of a source with weight w is released at floor((j - 1) / w) and due at ceil(j / w);
the earliest deadline among released blocks goes first, so each source stays within one block of its
share. Weights are exact fractions, and the schedule of all blocks is made from a table of sources in
one task, one block a source in memory. When a source runs out, the rest go on by their renewed
weights (a new phase).

Every row gets a place, every source has a queue, a null source too. Repeated rows are rows; an empty table gives no rows; other columns pass,
those named like a result are replaced, names with a leading underscore are reserved.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import cut_lineage, ranked_within

def whole_counts(weights: dict[str, float], period: int) -> dict[str, int]:
    """Slots of each source in one period: its exact share rounded down or up (largest remainders), at least one."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    counts = {s: max(1, math.floor(x + 1e-9)) for s, x in exact.items()}
    while (spare := period - sum(counts.values())) > 0:
        for s in sorted(exact, key=lambda s: (counts[s] - exact[s], s))[:spare]:
            counts[s] += 1
    while sum(counts.values()) > period:  # made up for sources raised to one slot
        counts[max((s for s in counts if counts[s] > 1), key=lambda s: (counts[s] - exact[s], counts[s], s))] -= 1
    return counts


def one_period(counts: dict[str, int]) -> list[str]:
    """The source of each slot; among released blocks the earliest deadline, ties by name."""
    period = sum(counts.values())
    waiting = [(0, -(-period // c), s, 1) for s, c in counts.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, due, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, j))
        _, s, j = heapq.heappop(ready)
        out.append(s)
        if j < counts[s]:
            heapq.heappush(waiting, (j * period // counts[s], -(-(j + 1) * period // counts[s]), s, j + 1))
    return out


def slot_order(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int]]:
    """(source, block) of every slot by exact shares; when a source runs out, the others start a new phase.

    Weights are taken as the fractions that they are, so releases and deadlines have no rounding. Only one
    block a source is held.
    """
    left, done, start = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0
    exact = {s: Fraction(weights[s]) for s in left}
    common = math.lcm(*(f.denominator for f in exact.values()))
    whole = {s: int(f * common) for s, f in exact.items()}
    while left:
        total = sum(whole[s] for s in left)
        waiting = [(0, -(-total // whole[s]), s, 1) for s in left]
        heapq.heapify(waiting)
        ready: list[tuple[int, str, int]] = []
        for slot in itertools.count():
            while waiting and waiting[0][0] <= slot:
                _, due, s, j = heapq.heappop(waiting)
                heapq.heappush(ready, (due, s, j))
            _, s, j = heapq.heappop(ready)
            yield s, done[s]
            done[s] += 1
            left[s] -= 1
            if not left[s]:
                del left[s]
                break
            heapq.heappush(waiting, (j * total // whole[s], -(-(j + 1) * total // whole[s]), s, j + 1))


def slots_of(sources: DataFrame, batch: int) -> DataFrame:
    """(_source, _block, slot) of every block of ``sources`` (_source, n_blocks, weight); one task, as each slot follows from those before."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told = pd.concat(list(frames) or [pd.DataFrame({"_source": [], "n_blocks": [], "weight": []})])
        order = slot_order(dict(zip(told["_source"], told["n_blocks"].map(int), strict=True)), dict(zip(told["_source"], told["weight"], strict=True)))
        at = 0
        while rows := list(itertools.islice(order, batch)):
            out = pd.DataFrame(rows, columns=["_source", "_block"])
            out["slot"] = range(at, at + len(rows))
            at += len(rows)
            yield out

    return sources.coalesce(1).mapInPandas(run, "_source string, _block long, slot long")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, block: int = 16, period: int = 1024) -> DataFrame:
    """``docs`` with ``queue``, ``block``, ``slot`` and ``in_block``; (slot, in_block) is the mixed order.

    ``weights`` are target weights by source, above 0; sources without one get their row count to ``power``.
    ``period`` is the number of slots handed on at a time and has no effect on the result.
    """
    named = F.coalesce("source", F.lit("\x00null"))
    queued = docs.withColumn("queue", named)
    sizes = queued.groupBy(F.col("queue").alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    own = F.pow(F.col("n"), F.lit(power))
    if weights:
        given = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "_source string, _given double")
        sizes, own = sizes.join(given, "_source", "left"), F.coalesce("_given", own)
    sources = cut_lineage(sizes.select("_source", F.ceil(F.col("n") / block).cast("long").alias("n_blocks"), own.cast("double").alias("weight")))
    slots = cut_lineage(slots_of(sources, period))
    order = ["doc_id", F.xxhash64("text")]
    placed = ranked_within(queued, "queue", order, "_rank").withColumn("block", F.floor(F.col("_rank") / block)).withColumn("in_block", (F.col("_rank") % block).cast("int"))
    out = placed.drop("slot").join(slots, (F.col("queue") == F.col("_source")) & (F.col("block") == F.col("_block")))
    return out.select(*[c for c in docs.columns if c not in ("queue", "block", "slot", "in_block")], "queue", "block", "slot", "in_block")


def mixed(docs: DataFrame, block: int = 16, **settings) -> DataFrame:
    """The rows of ``docs`` in mixed order, one range of it per partition, with their place in it as ``mix_position``."""
    whole = docs.drop("mix_position").select("doc_id", "source", "text", F.struct("*").alias("_row"))
    place = (F.col("slot") * block + F.col("in_block")).cast("long").alias("mix_position")
    return mix(whole, block=block, **settings).orderBy("slot", "in_block").select("_row.*", place)
