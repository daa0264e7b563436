"""Personal data: exact base spans, widened by a skip-chain conditional random field.

Tokens (runs without white space, or several of digits and signs only, one space apart) that hold a
digit or '@' are nodes with a label each: none, email, ip, card, phone. Unary scores come from weights
learned from base spans of a bounded sample; neighbours in the text share potentials, and all tokens of
the same or a similar form (see ``forms``) share a hub, so any two are two hops apart. Tokens of one
form without a base span weigh as one together. Loopy max-free message passing settles the labels of
every document. A token that takes a kind without a base span becomes a span of that kind.

Null and empty texts have no spans. Offsets are code points of the whole text, ends exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import column_map

KINDS = ["email", "ip", "card", "phone"]
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Where a run of digits starts is the only place at which these two can match.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"\+?[0-9(][0-9().-]*(?: [0-9(][0-9().-]*)*[,;:!?]*(?!\S)|\S+")
NODE = re.compile(r"[0-9@]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each '@' outwards in linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {k: [] for k in KINDS}
    out["email"] = emails(text)
    out["ip"] = [m.span() for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    out["card"] = [m.span() for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def features(token: str) -> list[str]:
    digits = len(digits_of(token))
    return [
        f"digits{min(digits, 20)}", f"dots{min(token.count('.'), 4)}", f"dashes{min(token.count('-'), 4)}", f"at{token.count('@') > 0}",
        f"plus{token[:1] == '+'}", f"letters{any(c.isalpha() for c in token)}", f"share{10 * digits // len(token)}",
    ]


def form(token: str) -> str:
    """What similar tokens have in common: letters and digits only, lower case."""
    return re.sub(r"[\W_]+", "", token.lower())


def forms(token: str) -> list[str]:
    """Keys of the hubs of a token: its form, and a similar one.

    Dotted quads go by their four numbers; digits with signs by all digits and, from seven on, by the last
    seven (with or without prefixes); others by letters and digits, addresses also by the part before '@'.
    """
    if quad := IP.search(token):
        return ["ip:" + ".".join(p.lstrip("0") or "0" for p in quad[0].split("."))]
    if not any(c.isalpha() for c in token) and "@" not in token:
        digits = digits_of(token)
        return ["number:" + digits] + ["tail:" + digits[-7:]] * (len(digits) >= 7)
    whole, local = form(token), form(token.partition("@")[0])
    return ["word:" + x for x in dict.fromkeys([whole, local]) if x]


def nodes_of(text: str, base: dict[str, list[tuple[int, int]]]):
    """(spans of nodes, their observed label, with 0 for none)."""
    spans = [m.span() for m in TOKEN.finditer(text) if NODE.search(m[0])] if NODE.search(text) else []
    seen = np.zeros(len(spans), int)
    starts = np.array([s for s, _ in spans])
    for k, kind in enumerate(KINDS, 1):
        for s, e in base[kind]:
            i = max(0, np.searchsorted(starts, s, "right") - 1)
            while i < len(spans) and spans[i][0] < e:
                if spans[i][1] > s:
                    seen[i] = k
                i += 1
    return spans, seen


def learn(texts: list[str], smooth: float = 1.0) -> dict[str, np.ndarray]:
    """Log weight of each feature under each label against its share, from the base spans of a sample."""
    counts: dict[str, np.ndarray] = {}
    total = np.full(len(KINDS) + 1, smooth)
    for text in texts:
        spans, seen = nodes_of(text, base_spans(text))
        for (s, e), label in zip(spans, seen, strict=True):
            total[label] += 1
            for f in features(text[s:e]):
                counts.setdefault(f, np.full(len(KINDS) + 1, smooth))[label] += 1
    out = {f: np.log(c / (total + 2 * smooth)) for f, c in counts.items()}
    out[""] = np.log(total / total.sum())
    out["?"] = np.log(np.full(len(KINDS) + 1, smooth) / (total + 2 * smooth))
    return out


def messages(unary: np.ndarray, edges: np.ndarray, same: np.ndarray, rounds: int) -> np.ndarray:
    """Beliefs after loopy sum-product; ``same`` is the log potential of equal labels on each edge."""
    if not len(edges):
        return unary
    a, b = np.concatenate([edges, edges[:, ::-1]]).T
    gain = np.exp(np.concatenate([same, same]))[:, None] - 1
    back = (np.arange(len(a)) + len(edges)) % len(a)
    sent = np.zeros((len(a), unary.shape[1]))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, b, sent)
        out = belief[a] - sent[back]
        p = np.exp(out - out.max(1, keepdims=True))
        new = np.log(p.sum(1, keepdims=True) + gain * p)
        new -= new.max(1, keepdims=True)
        if np.abs(new - sent).max() < 1e-4:
            break
        sent = 0.5 * sent + 0.5 * new
    belief = unary.copy()
    np.add.at(belief, b, sent)
    return belief


def added_spans(text: str, base, weights: dict[str, np.ndarray], chain: float = 0.2, skip: float = 4.0, seen_skip: float = 8.0, seen_at: float = 12.0, rounds: int = 20) -> list[tuple[str, int, int]]:
    spans, seen = nodes_of(text, base)
    if not spans:
        return []
    unary = np.array([weights[""] + 0.5 * sum(weights.get(f, weights["?"]) for f in features(text[s:e])) for s, e in spans])
    unary -= unary.max(1, keepdims=True)
    unary[seen > 0, seen[seen > 0]] += seen_at
    edges, same, alike = [], [], {}
    for i, (s, e) in enumerate(spans):
        if i and s - spans[i - 1][1] <= 1:
            edges.append((i - 1, i))
            same.append(chain)
        for key in forms(text[s:e]):
            alike.setdefault(key, []).append(i)
    alike = list({tuple(members) for members in alike.values() if len(members) > 1})
    shared = np.ones(len(spans))
    for hub, members in enumerate(alike, len(spans)):
        edges += [(i, hub) for i in members]
        same += [seen_skip if seen[i] else skip for i in members]  # a base span outweighs the doubt of its form
        shared[list(members)] = np.maximum(shared[list(members)], len(members))
    unary[seen == 0] /= shared[seen == 0, None]
    unary = np.vstack([unary, np.zeros((len(alike), unary.shape[1]))])
    belief = messages(unary, np.array(edges).reshape(-1, 2).astype(int), np.array(same), rounds)
    label = belief[: len(spans)].argmax(1)
    return [(KINDS[k - 1], *spans[i]) for i, k in enumerate(label) if k and not seen[i]]


SPANS = "base array<struct<kind:string,start:long,end:long>>, spans array<struct<kind:string,start:long,end:long>>"


def find_pii(docs: DataFrame, text: str = "text", train_rows: int = 2_000) -> DataFrame:
    """``doc_id`` with its base spans and all spans (kind, start, end), by kind, then start.

    The weights come from at most ``train_rows`` rows, those with the smallest hash of text and id.
    """
    sample = docs.where(F.col(text).rlike("[0-9@]")).select(text, F.xxhash64("doc_id").alias("h")).orderBy("h", F.length(text)).limit(train_rows)
    weights = learn([r[0] for r in sample.toLocalIterator()])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        base_out, all_out = [], []
        for value in frame["_text"]:
            value = value or ""
            base = base_spans(value)
            told = [(k, s, e) for k in KINDS for s, e in base[k]]
            more = added_spans(value, base, weights)
            base_out.append(told)
            all_out.append(sorted({*told, *more}, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))
        as_rows = lambda a: [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in a]
        return pd.DataFrame({"doc_id": frame["doc_id"], "base": as_rows(base_out), "spans": as_rows(all_out)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("_text")).mapInPandas(column_map(run), f"doc_id {id_type}, {SPANS}")
