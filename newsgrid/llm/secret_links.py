"""Secret scan: exact base spans, and weak parts of credentials that are told only where they complete each other.

One pass over each text finds the base spans (assignments, access keys, long hex) and weak parts: key
identifiers (user names, client ids, short keys), credentials (values of vaguer names, random-looking
words, the password of an address) and endpoints (addresses, hosts). A weak part alone is no finding.
Parts meet by an interval join: same document and scope (lines up to the next blank one), at most
``REACH`` code points between them. An identifier needs a credential, a credential an identifier, an
endpoint needs both; base spans count as parts (access as identifier, assign and hex as credential).

The join is on (row, scope, bin of ``REACH`` code points). Of the parts that touch a bin only the least start
and the largest end of each role are kept; as a widened interval is over two bins long, this decides
exactly whether any part is in reach, so parts that crowd in one scope never meet in pairs.

Null text is empty and has no spans. Weak parts that overlap a base span are dropped, the span stays.
Rows are told apart by themselves: rows with one id, with none, or repeated rows have a result each.
An empty table gives no rows. Columns beyond doc_id and the text are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import column_map, cut_lineage

REACH = 160
KINDS = ["assign", "access", "hex"]
WEAK = ["key_id", "credential", "endpoint"]
ROLES = {"assign": "credential", "access": "key_id", "hex": "credential"} | {k: k for k in WEAK}

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # runs are whole, so shorter ones need no match
BLANK = re.compile(r"\n[\x20\t\r]*\n")

# Names that stand before a value, and what the value is.
NAMED = {
    "key_id": re.compile(r"""(?ai)(?<![a-z0-9])(?:user_?name|user_?id|user|login|account|client_?id|access_?key_?id|access_?key|key_?id)["']?\x20*[:=]\x20*["']?([a-z0-9@._+/-]{3,})"""),
    "credential": re.compile(r"""(?ai)(?<![a-z0-9])(?:pwd|pass|pass_?phrase|credentials?|private_?key|auth|bearer|signature)["']?\x20*[:=]\x20*["']?([^\s"',;]{6,})"""),
    "endpoint": re.compile(r"""(?ai)(?<![a-z0-9])(?:host|host_?name|endpoint|server|base_?url|bucket|region)["']?\x20*[:=]\x20*["']?([a-z0-9._:/-]{3,})"""),
}
HINTS = {
    "key_id": ("user", "login", "account", "client", "key"),
    "credential": ("pwd", "pass", "credential", "private", "auth", "bearer", "signature"),
    "endpoint": ("host", "endpoint", "server", "url", "bucket", "region"),
}
SHORT_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA|AIza|ghp_|sk_live_|xox[bp]-)[A-Za-z0-9_-]{8,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
ADDRESS = re.compile(r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,30}://(?:([^\s/@:"'<>]{1,256}):([^\s/@"'<>]{1,256})@)?[^\s"'<>]+""")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    out = []
    if has_any(text.lower(), ("passw", "secret", "token", "apikey", "api_key")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def has_any(lowered: str, hints: tuple[str, ...]) -> bool:
    return any(h in lowered for h in hints)


def looks_random(word: str, least_bits: float = 3.5) -> bool:
    """At least three classes of characters, and many different ones."""
    classes = sum(any(test(c) for c in word) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if classes < 3:
        return False
    counts = Counter(word).values()
    return -sum(n * math.log2(n / len(word)) for n in counts) / len(word) >= least_bits


def weak_parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak parts that overlap no base span; of one role they do not overlap each other."""
    lowered, found = text.lower(), {k: [] for k in WEAK}
    for role, pattern in NAMED.items():
        if has_any(lowered, HINTS[role]):
            found[role] += [m.span() for m in pattern.finditer(text)]
    found["key_id"] += [m.span() for m in SHORT_KEY.finditer(text)]
    if "://" in text:
        for m in ADDRESS.finditer(text):
            found["endpoint"].append(m.span())
            if m[1]:
                found["key_id"].append(m.span(1))
                found["credential"].append(m.span(2))
    starts = [s for _, s, _ in base]
    ends = running_max([e for _, _, e in base])
    out = []
    for role in WEAK:
        free = 0
        for s, e in sorted(found[role], key=lambda x: (x[0], -x[1])):
            before = bisect_left(starts, e)  # base spans that start before this part ends
            if s >= free and not (before and ends[before - 1] > s):
                out.append((role, s, e))
                free = e
    return out


def running_max(values: list[int]) -> list[int]:
    out, most = [], 0
    for v in values:
        most = max(most, v)
        out.append(most)
    return out


SPAN = "kind:string,start:long,end:long"


def scanned(docs: DataFrame, text: str) -> DataFrame:
    """(row, doc_id, base spans, parts with their scope), one row per row of ``docs``; only parts leave the texts."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        bases, parts = [], []
        for value in frame["_text"]:
            value = value or ""
            base = base_spans(value)
            weak = weak_parts(value, base)
            breaks = [m.start() for m in BLANK.finditer(value)] if weak else []
            bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            parts.append([{"kind": k, "start": s, "end": e, "scope": bisect_right(breaks, s)} for k, s, e in [*base, *weak]] if weak else [])
        return pd.DataFrame({"row": frame["row"], "doc_id": frame["doc_id"], "base": bases, "parts": parts})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    held = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(text).alias("_text"))
    return held.mapInPandas(column_map(of), f"row long, doc_id {id_type}, base array<struct<{SPAN}>>, parts array<struct<{SPAN},scope:int>>")


def bins(low, high):
    return F.explode(F.sequence(F.floor(low / REACH), F.floor(high / REACH)))


def linked(parts: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the weak parts whose complements are in reach."""
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    placed = parts.withColumn("role", role[F.col("kind")]).withColumn("bin", bins(F.col("start"), F.col("end")))
    ranges = placed.groupBy("row", "scope", "bin").agg(
        *[f(F.when(F.col("role") == r, F.col(c))).alias(f"{n}_{r}") for r in WEAK[:2] for n, f, c in (("from", F.min, "start"), ("upto", F.max, "end"))]
    )
    weak = parts.where(F.col("kind").isin(WEAK)).select("row", "scope", "kind", "start", "end")
    probes = weak.withColumn("bin", bins(F.col("start") - REACH, F.col("end") + REACH))
    near = lambda r: F.max(F.coalesce((F.col(f"from_{r}") <= F.col("end") + REACH) & (F.col(f"upto_{r}") >= F.col("start") - REACH), F.lit(False))).alias(f"near_{r}")
    met = probes.join(ranges, ["row", "scope", "bin"]).groupBy("row", "kind", "start", "end").agg(*[near(r) for r in WEAK[:2]])
    whole = F.when(F.col("kind") == "key_id", F.col("near_credential")).when(F.col("kind") == "credential", F.col("near_key_id")).otherwise(F.col("near_key_id") & F.col("near_credential"))
    return met.where(whole).select("row", "kind", "start", "end")


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` with its base spans and all spans (kind, start, end), by start, then kind."""
    told = cut_lineage(scanned(docs, text))
    parts = told.where(F.size("parts") > 0).select("row", F.inline("parts"))
    added = linked(parts).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    place = F.create_map(*[x for i, k in enumerate([*KINDS, *WEAK]) for x in (F.lit(k), F.lit(i))])
    keyed = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), place[x["kind"]].alias("place"), x["kind"].alias("kind"), x["end"].alias("end")))
    both = F.array_sort(keyed(F.concat("base", F.coalesce("added", F.array().cast(f"array<struct<{SPAN}>>")))))
    spans = F.transform(both, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return told.join(added, "row", "left").select("doc_id", "base", spans.alias("spans"))
