"""Nearest neighbours by multi-index hashing over learned binary codes.

A rotation learned on a bounded sample turns each vector into 64 sign bits. Codes are cut into
substrings, each with its own bucket index; a code within radius r of a query lies within
floor(r / parts) of it in some substring, so probing those buckets finds every such code. The
survivors are ranked by exact cosine. Null, empty, zero and non-finite vectors, those of another
length than the sample's, and rows without id take no part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 4
ONES = np.array([bin(x).count("1") for x in range(1 << 16)], np.uint8)


def learn_rotation(sample: np.ndarray, bits: int = 64, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection whose signs are the code: principal axes, rotated towards their own signs."""
    centre = sample.mean(0)
    spread = sample - centre
    axes = np.linalg.svd(spread, full_matrices=False)[2][:bits].T
    projected = spread @ axes
    turn = np.linalg.qr(np.random.default_rng(0).normal(size=(projected.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = vt.T @ u.T
    return centre, axes @ turn


def codes_of(unit: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """(rows, 4) words of 16 bits; missing bits are 0."""
    bits = np.zeros((len(unit), PARTS * 16), np.uint8)
    made = (unit - centre) @ projection > 0
    bits[:, : made.shape[1]] = made
    return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


class Index:
    """The substring indexes of one block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.parts = codes, []
        for p in range(PARTS):
            order = np.argsort(codes[:, p], kind="stable")
            keys, starts = np.unique(codes[order, p], return_index=True)
            self.parts.append((order, keys, starts, np.append(starts[1:], len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of every code within ``radius`` bits."""
        seen = np.zeros(len(self.codes), bool)
        for p, (order, keys, starts, ends) in enumerate(self.parts):
            near = ONES[keys ^ code[p]] <= radius // PARTS
            edge = np.zeros(len(order) + 1, np.int32)
            np.add.at(edge, starts[near], 1)
            np.add.at(edge, ends[near], -1)
            seen[order[np.cumsum(edge)[:-1] > 0]] = True
        found = np.flatnonzero(seen)
        return found[ONES[self.codes[found] ^ code].sum(1) <= radius]


def matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column], float)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, radius: int = 30, sample: int = 20_000, block: int = 32_768, queries_block: int = 4_096) -> DataFrame:
    """The ``k`` nearest of each row whose ``vec_id`` is divisible by ``every``, among all other rows.

    At most ``sample`` rows train the rotation. Rows are dealt into blocks of about ``block``; each
    task holds one block of the index and one of queries. Where fewer than ``k`` codes of a block lie
    within the radius, it widens until ``k`` do or every code is reached.
    """
    spark = vectors.sparkSession
    ok = F.size("embedding") > 0
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ok & whole).select("vec_id", "embedding")
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    schema = "query_id long, vec_id long, score double"
    if not len(taken):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(taken["embedding"].map(len).mode()[0])
    kept = matrix(taken["embedding"][taken["embedding"].map(len) == width])
    centre, projection = learn_rotation(kept / np.linalg.norm(kept, axis=1)[:, None])
    rows = rows.where(F.size("embedding") == width)
    n = rows.count()
    n_index, n_query = max(1, -(-n // block)), max(1, -(-n // every // queries_block))
    hashed = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = rows.withColumn("ib", hashed(n_index)).withColumn("qb", every_block(n_query))
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("qb", hashed(n_query)).withColumn("ib", every_block(n_index))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(left) and len(right):
            x, q, ids = matrix(left["embedding"]), matrix(right["embedding"]), left["vec_id"].to_numpy()
            length, q_length = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
            made = Index(codes_of(x / length[:, None], centre, projection))
            codes = codes_of(q / q_length[:, None], centre, projection)
            for i, own in enumerate(right["vec_id"].to_numpy()):
                r = radius
                while True:
                    found = made.within(codes[i], r)
                    found = found[ids[found] != own]
                    if len(found) >= k or r >= 16 * PARTS:
                        break
                    r = min(r + PARTS, 16 * PARTS)
                score = (x[found] * q[i]).sum(1) / (length[found] * q_length[i])
                best = np.lexsort((ids[found], -score))[:k]
                out += [(int(own), int(ids[found[b]]), float(score[b])) for b in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    hits = index.groupBy("ib", "qb").cogroup(asked.groupBy("ib", "qb")).applyInPandas(probe, schema)
    each = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))).alias("a"))
    return each.select("query_id", F.posexplode(F.slice("a", 1, k)).alias("p", "x")).select("query_id", (F.col("p") + 1).alias("rank"), "x.vec_id", "x.score")
