"""Quality rules: lines that many documents of one host share are removed, depleted documents rejected.

Null or empty text has no words and is rejected; a null host is a host of its own. Rows that share a
``doc_id`` count as one document per line, a row without id as a document of its own, and each row gets
its own verdict. Lines without a word are never counted. Other columns of the input are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import column_map, cut_lineage, salted

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words covered by a ``window``-word run that stands twice or more; runs are compared exactly by doubling."""
    if len(words) <= window:
        return 0
    ids: dict[str, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    span, counts = 1, None
    while span < window:
        code, counts = np.unique(code[: len(code) - span] * (code.max() + 1) + code[span:], return_inverse=True, return_counts=True)[1:]
        span *= 2
        if counts.max() < 2:
            return 0
    starts = np.flatnonzero(counts[code] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def base_counts(text: str | None) -> tuple[list[int], tuple[int, int, int, int, int]]:
    """Words of each line, and the five counts of the whole text."""
    text = text or ""
    lines = text.split("\n")
    found = [WORD.findall(x) for x in lines]
    words = [w for x in found for w in x]
    held = [x for x, w in zip(lines, found, strict=True) if w]
    symbols = sum(map(text.count, SYMBOLS))
    return list(map(len, found)), (len(words), sum(map(len, words)), symbols, len(held) - len(set(held)), repeated_words(words))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def line_key(line):
    """Lower case, each run of anything but letters as one space; a line without letters as it stands, trimmed."""
    letters = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))
    return F.xxhash64(F.when(letters == "", F.trim(line)).otherwise(letters))


def frequent_lines(lined: DataFrame, max_docs: int, salts: int = 32) -> DataFrame:
    """(host, hash, n_docs) of lines in more than ``max_docs`` documents of the host.

    Rows are at least as many as documents, so only lines in more rows than that have their ids told apart.
    """
    own = F.when(F.col("doc_id").isNull(), F.col("_row"))  # a row without id is a document of its own
    each = lined.select("_row", "doc_id", own.alias("_own"), "host", F.explode(F.array_distinct("hashes")).alias("hash"))
    many = salted(each.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_docs).select(F.col("host").alias("_host"), F.col("hash").alias("_hash")), salts)
    salt = F.pmod(F.col("_row"), F.lit(salts)).cast("int")
    held = each.withColumn("_s", salt).join(many, F.col("host").eqNullSafe(F.col("_host")) & (F.col("hash") == F.col("_hash")) & (F.col("_s") == F.col("_salt")))
    once = held.groupBy("host", "hash", "doc_id", "_own").agg(F.lit(1).alias("one"))
    return once.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > max_docs)


def line_frequency(docs: DataFrame, text: str = "text", host: str = "source", max_docs: int = 20, min_left: float = 0.5, salts: int = 32) -> DataFrame:
    """Per row: its base counts, how many lines and words stand above the limit, and whether it is kept.

    A document is depleted when fewer than ``min_left`` of its words stay. Hot lines meet the table of
    frequent lines in ``salts`` tasks a line, and only ids, hashes and counts are shuffled.
    """
    keyed = docs.withColumn("_row", F.monotonically_increasing_id())
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    flat = keyed.select("_row", "doc_id", F.col(text).alias("_text"), F.col(host).alias("host"), F.transform(lines, line_key).alias("hashes"))

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        told = [base_counts(x) for x in frame["_text"]]
        held = [np.array(w, np.int64) for w, _ in told]
        out = frame[["_row", "doc_id", "host"]].reset_index(drop=True)
        out["hashes"] = [np.asarray(h, np.int64)[w > 0] for h, w in zip(frame["hashes"], held, strict=True)]
        out["line_words"] = [w[w > 0] for w in held]
        return pd.concat([out, pd.DataFrame([c for _, c in told], columns=COUNTS)], axis=1)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema if f.name != "_text")
    stored = cut_lineage(flat.mapInPandas(column_map(counted), f"{types}, line_words array<long>" + "".join(f", {c} long" for c in COUNTS)))
    frequent = salted(frequent_lines(stored, max_docs, salts).select(F.col("host").alias("_host"), F.col("hash").alias("_hash")), salts)
    each = stored.select("_row", "host", F.explode(F.arrays_zip(F.col("hashes").alias("hash"), F.col("line_words").alias("words"))).alias("line")).withColumn("_s", F.pmod(F.col("_row"), F.lit(salts)).cast("int"))
    hit = each.join(frequent, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line.hash") == F.col("_hash")) & (F.col("_s") == F.col("_salt")))
    removed = hit.groupBy("_row").agg(F.count(F.lit(1)).alias("n_removed_lines"), F.sum("line.words").alias("n_removed_words"))
    out = stored.drop("hashes", "line_words", "host").join(removed, "_row", "left").drop("_row").na.fill(0, ["n_removed_lines", "n_removed_words"])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & left)
