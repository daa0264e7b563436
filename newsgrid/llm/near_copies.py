"""Near copies by the similarity of their word runs: documents whose five-word runs have a Jaccard
similarity of 0.8 or more are linked, and one row of each component stays.

SimHash comes first: classes whose fingerprints, folded from the hashes of their runs, are within ``RADIUS``
bits meet by the operator's bit groups (``simhash.fingerprint_links``). A pair at 0.8 differs in ten bits on
average, so min-wise bands then look for what SimHash cannot reach, among classes it has not joined.
A pair of similarity s shares one of ``BANDS`` bands of ``ROWS`` hashes with probability
1 - (1 - s ** ROWS) ** BANDS: 0.9993 at 0.8. Every pair of either step that decides a link is verified on the
whole sets of runs.

Documents with equal sets are one class. The classes of a bucket meet one of them, by another order each
round until a round adds no link, so that a large family is joined by stars. Classes that share a bucket
across components then meet by a prefix filter, which is exact: with the runs of each set ordered from rare
to common, two sets of n and m runs at the wanted similarity share one of their first
n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1 runs, at places that leave room for the overlap they need.
A run of one component only is no key, a run of many classes is salted.

Fewer than ``width`` words are one run; texts without words are equal. Rows without id stay. Rows are
told apart by id and text: rows with one id and different texts are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgrid.llm.common import column_map, cut_lineage
from newsgrid.llm.line_frequency import WORD
from newsgrid.llm.simhash import LOWER, components, fingerprint_links, folded

RADIUS = 3  # bits two fingerprints may differ in
BANDS, ROWS = 24, 6
STARS = 4  # most rounds in which a bucket's classes meet one of them only
A_SALT = 64  # pairs of one class that are verified in one task
A_KEY = 512  # classes of one run that meet the others in one task
_RANDOM = np.random.default_rng(42)
FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
ADDED = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def run_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    return np.array(sorted({xxhash.xxh64_intdigest(" ".join(words[i : i + width])) for i in range(max(1, len(words) - width + 1))}), np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band, made of its smallest hashes under ``ROWS`` orders."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        mixed = hashes[at : at + 4096, None] * FACTORS + ADDED
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(0))
    return [xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), seed=b) - (1 << 63) for b in range(BANDS)]


def marked(docs: DataFrame) -> DataFrame:
    """``docs`` that have an id, with the digest of their text."""
    return docs.where("doc_id is not null").withColumn("__mark", F.md5(F.coalesce("text", F.lit(""))))


def run_sets(docs: DataFrame, width: int, banded: bool) -> DataFrame:
    """(doc_id, mark, digest of the set) with the set's size, fingerprint and the keys of its bands, or else its runs."""
    types = "doc_id long, mark string, digest string, " + ("n int, fp long, bands array<long>" if banded else "runs array<long>")

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [run_hashes(t, width) for t in frame["text"]]
        out = {"doc_id": frame["doc_id"], "mark": frame["mark"], "digest": [xxhash.xxh128_hexdigest(s.tobytes()) for s in sets]}
        more = {"n": list(map(len, sets)), "fp": np.array([folded(s) for s in sets], np.uint64).view(np.int64), "bands": list(map(band_keys, sets))} if banded else {"runs": [s.view(np.int64) for s in sets]}
        return pd.DataFrame(out | more)

    held = marked(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__mark").alias("mark"), "text")
    return held.mapInPandas(column_map(of), types)


def fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """(a, b) of the classes (node, fp) that SimHash joins: stars of equal fingerprints and of those within ``RADIUS`` bits."""
    heads = cut_lineage(classes.groupBy("fp").agg(F.min("node").alias("head")))
    equal = classes.join(heads, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return equal.unionByName(fingerprint_links(heads, RADIUS)).distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b, ok): whether the sets of both have that Jaccard similarity. A class in many pairs meets them in many tasks."""
    often = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / A_SALT).cast("int").alias("salts"))
    ones = sets.select(F.col("node").alias("a"), F.col("runs").alias("x"))
    others = often.join(sets, F.col("b") == F.col("node")).select("b", "salts", F.col("runs").alias("y"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).drop("salts")
    spread = pairs.join(often, "b").withColumn("salt", F.pmod(F.xxhash64("a"), "salts").cast("int")).drop("salts")
    shared = F.size(F.array_intersect("x", "y"))
    return spread.join(ones, "a").join(others, ["b", "salt"]).select("a", "b", (shared >= similarity * (F.size("x") + F.size("y") - shared) - 1e-9).alias("ok"))


def prefix_pairs(places: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of the classes (node, at) of different components that may reach the similarity, a > b."""
    runs = sets.join(places, "node").select("node", "at", F.size("runs").cast("int").alias("n"), F.explode("runs").alias("run"))
    often = runs.groupBy("run").agg(F.count(F.lit(1)).alias("f"), (F.min("at") < F.max("at")).alias("mixed")).where("f > 1")
    common = runs.join(often, "run").groupBy("node", "at", "n").agg(F.sort_array(F.collect_list(F.struct("f", "run", "mixed"))).alias("common"))
    own = F.col("n") - F.size("common")  # runs of no other class come first
    first = F.col("n") - F.ceil(similarity * F.col("n") - 1e-9).cast("int") + 1
    keys = common.where(own < first).select("node", "at", "n", own.alias("own"), F.posexplode(F.slice("common", F.lit(1), first - own)).alias("i", "c")).where("c.mixed")
    keys = keys.select("node", "at", "n", (F.col("own") + F.col("i") + 1).alias("place"), F.col("c.run").alias("run"), F.ceil(F.col("c.f") / A_KEY).cast("int").alias("salts"))
    left = keys.withColumn("salt", F.pmod(F.xxhash64("node"), "salts").cast("int")).drop("salts")
    right = keys.select("run", F.col("node").alias("b"), F.col("at").alias("there"), F.col("n").alias("m"), F.col("place").alias("spot"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    met = left.join(right, ["run", "salt"]).where((F.col("at") != F.col("there")) & (F.col("node") > F.col("b")))
    sized = F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-9
    room = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("spot")) + 1 >= similarity / (1 + similarity) * (F.col("n") + F.col("m")) - 1e-9
    return met.where(sized & room).select(F.col("node").alias("a"), "b").distinct()


def similar_components(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, mark, component_id, lead) of every row with an id; ``lead`` marks the component's least (id, text)."""
    told = cut_lineage(run_sets(docs, width, True))
    classes = told.groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("head"), F.min("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    # A repeated id may lead several classes, so a class is named by its digest's hash.
    classes = cut_lineage(classes.withColumn("node", F.xxhash64("digest")))
    keys = classes.select("node", "n", F.posexplode("bands").alias("t", "key"))
    shared = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("t", "key")
    buckets = cut_lineage(keys.join(shared, ["t", "key"]))
    near = cut_lineage(fingerprint_pairs(classes.select("node", "fp")))
    # Runs are made again for the classes that meet others only, as they take more room than texts.
    meeting = buckets.select("node").unionByName(near.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    met = cut_lineage(classes.join(meeting, "node").select("node", "digest", F.col("head.doc_id").alias("doc_id"), F.col("head.mark").alias("mark")))
    again = docs.join(met.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = cut_lineage(run_sets(again, width, False).join(met, ["doc_id", "mark", "digest"]).select("node", "runs").dropDuplicates(["node"]))

    def placed(linked: DataFrame | None) -> DataFrame:
        if linked is None:
            return buckets.withColumn("at", F.col("node"))
        return buckets.join(linked.withColumnRenamed("component", "at"), "node", "left").withColumn("at", F.coalesce("at", "node"))

    def joined(found: DataFrame, linked: DataFrame | None) -> DataFrame:
        if linked is not None:
            found = found.unionByName(linked.select(F.col("node").alias("a"), F.col("component").alias("b")))
        return cut_lineage(components(found.distinct()))

    def links_of(pairs: DataFrame) -> DataFrame:
        return cut_lineage(verified(pairs, sets, similarity).where("ok").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    alike = links_of(near)
    links, tested = None if alike.isEmpty() else joined(alike, None), near
    for turn in range(STARS):
        now = placed(links)
        heads = now.groupBy("t", "key").agg(F.min_by(F.struct("node", "n", "at"), F.xxhash64(F.lit(turn), "node")).alias("h"))
        pairs = now.join(heads, ["t", "key"]).where("at <> h.at").where(F.least("n", "h.n") >= similarity * F.greatest("n", "h.n") - 1e-9)
        pairs = pairs.select(F.col("node").alias("a"), F.col("h.node").alias("b")).distinct()
        pairs = cut_lineage(pairs.join(tested, ["a", "b"], "left_anti"))
        found = links_of(pairs)
        if found.isEmpty():
            break
        tested = tested.unionByName(pairs)
        links = joined(found, links)
    now = placed(links)
    mixed = now.groupBy("t", "key").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).where("lo < hi").select("t", "key")
    places = cut_lineage(now.join(mixed, ["t", "key"]).select("node", "at").distinct())
    links = joined(links_of(cut_lineage(prefix_pairs(places, sets, similarity))), links)
    heads = classes.select("node", "digest", "head").join(links, "node", "left").select("digest", "head", F.coalesce("component", "node").alias("at"))
    least = heads.groupBy("at").agg(F.min("head").alias("least"))
    named = heads.join(least, "at").select("digest", "least")
    rows = told.select("doc_id", "mark", "digest").join(named, "digest")
    return rows.select("doc_id", "mark", F.col("least.doc_id").alias("component_id"), (F.struct("doc_id", "mark") == F.col("least")).alias("lead"))


def keep_dissimilar(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The row of ``docs`` with the least id, then text digest, of each component; rows without id stay.

    Of rows equal in id and text the one with the least hash of its other columns stays.
    """
    names = docs.columns
    leads = similar_components(docs, width, similarity).where("lead").select(F.col("doc_id").alias("__lead"), F.col("mark").alias("__lead_mark")).distinct()
    kept = marked(docs).join(leads, (F.col("doc_id") == F.col("__lead")) & (F.col("__mark") == F.col("__lead_mark")))
    others = [F.col(f"`{c}`") for c in names if c not in ("doc_id", "text")]
    place = F.row_number().over(Window.partitionBy("__lead", "__lead_mark").orderBy(F.xxhash64(F.lit(0), *others)))
    kept = kept.withColumn("__place", place).where("__place = 1")
    return kept.select(*names).unionByName(docs.where("doc_id is null").select(*names))
