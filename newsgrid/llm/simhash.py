"""SimHash near-duplicates: equal fingerprints are one class, classes within 3 bits are linked.

Fingerprints that agree on half of six bit groups meet in a bucket (any two within 3 bits do so in
one of the 20 choices). A bucket is compared bit-sliced: one word array per bit position, distances
to one fingerprint kept in carry-save counters, whole blocks left once all lanes are over the radius.
Each bucket gives stars that join its groups, and components come from star contraction.

Null text has no words and the fingerprint zero, as empty text has; rows without id get a fingerprint
and no component. Rows that share an id are one node per fingerprint. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import cut_lineage
from newsgrid.llm.line_frequency import WORD

LOWER = {c: c + 32 for c in range(65, 91)}
GROUPS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
MASKS = [sum((((1 << n) - 1) << s) for s, n in c) for c in itertools.combinations(GROUPS, 3)]
LANES = 4096


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 8192):
        h = np.array([xxhash.xxh64_intdigest(s, seed=42) for s in shingles[at : at + 8192]], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def folded(hashes: np.ndarray) -> int:
    """The fingerprint of a set of 64-bit hashes: each bit set if it is set in over half of them."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).astype(np.int64))

    return docs.select("doc_id", of(F.col(text)).alias("fp"))


class Planes:
    """Fingerprints stored by bit: plane b holds bit b of 64 fingerprints per word."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        bits = np.zeros((64, -(-self.n // 64) * 64), np.uint8)
        bits[:, : self.n] = np.unpackbits(codes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T
        self.planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def within(self, code: int, radius: int) -> np.ndarray:
        """Positions whose distance to ``code`` is at most ``radius`` (3 at most)."""
        one, two, over = (np.zeros(self.planes.shape[1], np.uint64) for _ in range(3))
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        for b in range(64):
            differs = self.planes[b] ^ full if (code >> (63 - b)) & 1 else self.planes[b]
            carry = one & differs
            one = one ^ differs
            over = over | (two & carry)
            two = two ^ carry
            if b % 16 == 15 and (over == full).all():
                return np.zeros(0, np.int64)
        for count in range(radius + 1, 4):
            over = over | ((one if count & 1 else ~one) & (two if count & 2 else ~two))
        return np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little")[: self.n])


def linked_groups(codes: np.ndarray, radius: int) -> list[list[int]]:
    """Positions that steps of at most ``radius`` bits join within one bucket, groups of two or more."""
    todo, groups = np.ones(len(codes), bool), []
    blocks = [(at, Planes(codes[at : at + LANES])) for at in range(0, len(codes), LANES)]
    for root in range(len(codes)):
        if not todo[root]:
            continue
        todo[root] = False
        group = front = [root]
        while front:
            found = []
            for i in front:
                for at, planes in blocks:
                    near = planes.within(int(codes[i]), radius) + at
                    near = near[todo[near]]
                    todo[near] = False
                    found += near.tolist()
            group, front = group + found, found
        if len(group) > 1:
            groups.append(group)
    return groups


def fingerprint_links(classes: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b) heads, a > b, enough to join all classes (fp, head) whose ``fp`` are within ``radius`` bits.

    Each group found in a bucket is a star around its smallest head, so that groups met in one bucket only,
    or alike in all, need no further contraction.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for i, m in enumerate(MASKS)])
    told = classes.select("fp", "head", F.explode(keys).alias("k")).select("k.t", "k.key", "fp", "head").repartition("t", "key").sortWithinPartitions("t", "key")

    def links_of(t: np.ndarray, key: np.ndarray, fp: np.ndarray, head: np.ndarray) -> pd.DataFrame:
        cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(t))
        out = []
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
            codes = fp[a:b].view(np.uint64)
            if b - a == 2:  # the usual bucket
                groups = [[0, 1]] if int(codes[0] ^ codes[1]).bit_count() <= radius else []
            else:
                groups = linked_groups(codes, radius)
            for group in groups:
                heads = head[a:b][group]
                out += [(int(h), int(heads.min())) for h in heads if h != heads.min()]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] | None = None
        for frame in frames:
            cols = [frame[c].to_numpy() for c in ("t", "key", "fp", "head")]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            t, key, *_ = held
            same = np.flatnonzero((t != t[-1]) | (key != key[-1])) if len(t) else []
            upto = int(same[-1]) + 1 if len(same) else 0  # the last bucket may go on in the next batch
            yield links_of(*[x[:upto] for x in held])
            held = [x[upto:] for x in held]
        if held is not None and len(held[0]):
            yield links_of(*held)

    return told.mapInPandas(run, "a long, b long").distinct()


def unsettled(edges: DataFrame) -> bool:
    """Whether some node has two links downwards, or one downwards and one upwards; no star forest then."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))).alias("e")).select("e.*")
    seen = ends.groupBy("node").agg(F.sum("down").alias("downs"), F.min("down").alias("least"))
    return not seen.where("downs > 1 or (downs = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node ``a`` of ``edges`` (a > b, distinct) but the smallest of each component.

    Large-star and small-star steps by turns until the edges are a star forest; each step's table is
    written to the shared folder, and only a yes or no reaches the driver.
    """

    def large(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = pairs.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    now = cut_lineage(edges)
    while unsettled(now):
        now = cut_lineage(small(cut_lineage(large(now))))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """Per row: ``doc_id``, ``fp`` (64 bits as a long) and ``component_id``."""
    told = cut_lineage(fingerprints(docs, text, width))
    classes = cut_lineage(told.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").cast("long").alias("head")))
    links = fingerprint_links(classes, radius)
    found = classes.join(components(links), F.col("head") == F.col("node"), "left").select(F.col("fp"), F.coalesce("component", "head").alias("component_id"))
    joined = told.join(found, "fp", "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose id leads its component; rows without id stay. Repeated ids keep one row."""
    heads = near_duplicates(docs, **settings).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)
