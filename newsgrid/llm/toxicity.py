"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts to Latin ones and digits and signs
inside words to the letters they stand for. The lexicon holds folded words with weights learned from
labelled rows; exception phrases (a lexicon word with a neighbour, mostly seen in clean texts) take
their match back. The score is a logistic function of the weights found per root of the length.

Null and empty texts have no words and the score of a text without matches. Labels, language, source
and id never enter a score. Without labels of both kinds the lexicon is empty and nothing is toxic.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import column_map

# Letters of other scripts and signs that look like a Latin letter.
LOOK_ALIKE = dict(zip("авекмнорстухіјѕԁɡοαενικρτυχ", "abekmhopctyxijsdgoaevikptux", strict=True))
DIGITS = dict(zip("0134578@$", "oieastbas", strict=True))
PLAIN = str.maketrans(LOOK_ALIKE)
INSIDE = str.maketrans(DIGITS)
WORD = re.compile(r"[^\W_]+(?:[@$][^\W_]+)*")
ZERO_WIDTH = re.compile("[​-‍⁠﻿­]")


def folded(text: str | None) -> list[str]:
    """The folded words of a text."""
    text = (text or "").lower()
    if not text.isascii():
        text = ZERO_WIDTH.sub("", unicodedata.normalize("NFKC", text)).translate(PLAIN)
    words = WORD.findall(text)
    return [w if w.isalpha() else w.translate(INSIDE) if re.search(r"[a-z]", w) else w for w in words]


def stems(words: list[str]) -> set[str]:
    """What a text offers to the lexicon: its words, and their beginnings of five to seven letters, marked."""
    return {*words, *(w[:k] + "*" for w in {*words} for k in (5, 6, 7) if len(w) > k)}


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    bias: float = -4.0
    scale: float = 1.0

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for word, weight in self.weights.items():
            pattern = " " + (word[:-1] if word.endswith("*") else word + " ")
            made.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (len(phrase) + 2, None))
        made.make_automaton()
        return made

    def found(self, text: str | None, automaton) -> float:
        """Weights found outside exception phrases, the largest at each word, against the length."""
        words = folded(text)
        if not self.weights or not words:
            return 0.0
        best: dict[int, float] = {}
        taken = []
        for end, (size, weight) in automaton.iter(" " + " ".join(words) + " "):
            at = end - size + 1
            if weight is None:
                taken.append((at, end))
            else:
                best[at] = max(best.get(at, 0.0), weight)
        for a, b in taken:
            for at in [x for x in best if a <= x < b]:
                del best[at]
        return min(20.0, sum(best.values()) / (1 + len(words) / 1000) ** 0.5)

    def score(self, text: str | None, automaton) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.scale * self.found(text, automaton)))))


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[float, float]:
    """Bias and scale of a logistic function by Newton's steps, with a little ridge."""
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (y - p) - 0.01 * beta
        beta = beta + np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), slope)
    return float(beta[0]), float(beta[1])


def learn_lexicon(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, max_words: int = 500, evidence: float = 12.0) -> Lexicon:
    """A lexicon from at most ``train_rows`` labelled rows that are not held out.

    Words and neighbours are counted by documents in Spark; an entry needs a likelihood ratio of
    ``evidence`` nats against the common toxic share. The driver sees at most ``max_words`` words, as
    many phrases and two numbers a training row.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    taken = F.broadcast(known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))  # bounded by train_rows
    rows = docs.select("doc_id", "text").where(~held_out()).join(taken, "doc_id").select((F.col("toxic") > 0).cast("long").alias("toxic"), "text")

    def offered(of):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            out = [(t, w) for t, x in zip(frame["toxic"], frame["text"], strict=True) for w in of(folded(x))]
            return pd.DataFrame(out, columns=["toxic", "word"])

        return rows.mapInPandas(column_map(run), "toxic long, word string").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad"))

    size, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < size:
        return Lexicon()
    share = bad / size
    part = lambda k, m, p: F.when(k > 0, k * F.log(k / m / p)).otherwise(0.0)
    n, b = F.col("n"), F.col("bad")
    ratio = part(b, n, share) + part(n - b, n, 1 - share)
    top = offered(stems).where((b / n >= 0.5) & (ratio >= evidence)).orderBy(F.desc(ratio), "word").limit(max_words).collect()
    prior = 10
    weight = lambda r: float(np.log((r["bad"] + prior * share) / (r["n"] - r["bad"] + prior * (1 - share))) - np.log(share / (1 - share)))
    lexicon = Lexicon({r["word"]: weight(r) for r in top})
    plain = {w for w in lexicon.weights if not w.endswith("*")}
    if not plain:
        return lexicon

    def phrases(words: list[str]) -> set[str]:
        return {f"{x} {y}" for x, y in zip(words, words[1:], strict=False) if x in plain or y in plain}

    clean = offered(phrases).where((n >= 4) & (b / n <= share)).orderBy(F.desc("n"), "word").limit(max_words)
    lexicon.exceptions = [r["word"] for r in clean.collect()]

    def measured(frame: pd.DataFrame) -> pd.DataFrame:
        made = lexicon.automaton()
        return pd.DataFrame({"toxic": frame["toxic"], "x": [lexicon.found(t, made) for t in frame["text"]]})

    told = rows.mapInPandas(column_map(measured), "toxic long, x double").toPandas()  # at most train_rows pairs of numbers
    lexicon.bias, lexicon.scale = fitted(told["x"].to_numpy(float), told["toxic"].to_numpy(float))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        made = lexicon.automaton()
        return pd.Series([lexicon.score(t, made) for t in texts], dtype=float)

    return docs.withColumn(name, of(F.col("text")))
