"""Packing documents into token sequences by minimum bin slack.

Each document is cut into full windows and one rest. A window's content is chosen by subset sum over
the multiset of remaining lengths: a bitset of reachable sums per length, the sum closest to the
capacity, and the counts traced back. The chosen multiset is repeated as often as the counts allow,
so at most one pattern a length is needed and the driver sees a histogram of ``capacity`` entries.
Pieces find their sequence by their rank among equal lengths.

With a ``mix_position`` column the order of the rows counts: pieces of equal length go to sequences by
position, and sequences are numbered by the first position they hold.

Null text is empty: one end token. Rows that repeat an id are packed each; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import column_map, cut_lineage, ranked_by_position, ranked_within

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


POSITION = "mix_position"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece of each document's token ids, with the document's ``mix_position`` where there is one."""
    placed = POSITION in docs.columns

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        words = Words(tokenizer)
        out = []
        for doc_id, text, *place in zip(frame["doc_id"], frame["text"], *([frame[POSITION]] if placed else []), strict=True):
            ids = words.ids("" if pd.isna(text) else text) + end_id.to_bytes(4, "little")
            key, n = None if pd.isna(doc_id) else int(doc_id), len(ids) // 4
            out += [(key, i, min(capacity, n - i), zlib.crc32(ids[4 * i : 4 * (i + capacity)]), n, *place) for i in range(0, n, capacity)]
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *[POSITION] * placed]).astype({"doc_id": "Int64"})

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[POSITION] * placed)
    return read.mapInPandas(column_map(cut), PIECE + f", {POSITION} long" * placed)


_LOADED: dict = {}
# Letters that neither normalization nor neighbours change except for their case, then signs without an apostrophe.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Words:
    """A tokenizer that drops white space, so the ids of a text are those of its parts between spaces and line feeds.

    A plain word and the signs after it go to the tokenizer's model as they stand after lower-casing; every other
    part takes the whole way. Ids are kept as bytes for reuse in two tables of at most ``most`` parts: when the
    younger is full it becomes the older, and parts still met move up.
    """

    def __init__(self, path: str, most: int = 400_000, longest: int = 64):
        if path not in _LOADED:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            _LOADED[path] = Tokenizer.from_file(path), {}, {}
        self.path, self.most, self.longest = path, most, longest
        self.tokenizer, self.young, self.old = _LOADED[path]
        self.model, self.letters = self.tokenizer.model, {b: x for b, x in byte_letters().items() if x != chr(b)}

    def modelled(self, run: str) -> bytes:
        """Ids of one run of letters or of signs, kept if it is short."""
        ids = self.young.get(run) or self.old.get(run)
        if ids is None:
            mapped = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(run) <= self.longest:
                self.young[run] = ids
        return ids

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of parts that the younger table lacks; short ones enter it."""
        told, rest, plain, old = {}, [], PLAIN.fullmatch, self.old
        for part in parts:
            if part in old:
                told[part] = old[part]
            elif found := plain(part):
                core, tail = found.groups()
                told[part] = self.modelled(core.lower()) + (self.modelled(tail) if tail else b"")
            else:
                rest.append(part)
        for part, made in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            told[part] = array("I", made.ids).tobytes()
        self.young.update((p, i) for p, i in told.items() if len(p) <= self.longest)
        return told

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        parts = text.replace("\n", " ").split(" ")
        known = self.young
        told = self.learn([p for p in {*parts} if p not in known])
        out = b"".join([known[p] if p in known else told[p] for p in parts] if any(len(p) > self.longest for p in told) else map(known.__getitem__, parts))
        if len(known) > self.most:
            self.young, self.old = {}, known
            _LOADED[self.path] = self.tokenizer, self.young, self.old
        return out


def best_multiset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Copies of each length (largest first) whose sum comes closest to ``capacity``; the largest length is in."""
    lengths = sorted(counts, reverse=True)
    first, rest = lengths[0], capacity - lengths[0]
    full = (1 << (rest + 1)) - 1
    reach, steps = 1, []
    for size in [x for x in lengths if x <= rest]:
        copies = min(counts[size] - (size == first), rest // size)
        k = 1
        while copies > 0:  # copies in lots of 1, 2, 4, ...
            lot = min(k, copies)
            steps.append((reach, size, lot))
            reach |= (reach << (size * lot)) & full
            copies, k = copies - lot, 2 * k
        if reach >> rest & 1:
            break
    at, chosen = reach.bit_length() - 1, {first: 1}
    for before, size, lot in reversed(steps):
        if not before >> at & 1:
            chosen[size] = chosen.get(size, 0) + lot
            at -= size * lot
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Rows (length, from_rank, upto_rank, copies, first_sequence, first_offset): one per pattern and length."""
    left, used, sequence, rows = dict(counts), dict.fromkeys(counts, 0), 0, []
    while left:
        chosen = best_multiset(left, capacity)
        times = min(left[s] // n for s, n in chosen.items())
        offset = 0
        for size, n in sorted(chosen.items(), reverse=True):
            rows.append((size, used[size], used[size] + times * n, n, sequence, offset))
            offset += size * n
            used[size] += times * n
            left[size] -= times * n
            if not left[size]:
                del left[size]
        sequence += times
    return pd.DataFrame(rows, columns=["_length", "from_rank", "upto_rank", "copies", "first_sequence", "first_offset"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    told = cut_lineage(pieces(docs, tokenizer, capacity, end_id))
    counts = {r["length"]: r["count"] for r in told.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = docs.sparkSession.createDataFrame(patterns(counts, capacity), "_length long, from_rank long, upto_rank long, copies long, first_sequence long, first_offset long")
    order = ["doc_id", "start", "ids_crc32"]
    placed = POSITION in told.columns
    ranked = ranked_by_position(told, "length", POSITION, ["start"], "_rank") if placed else ranked_within(told, "length", order, "_rank")
    inside = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("upto_rank"))
    at = F.col("_rank") - F.col("from_rank")
    out = ranked.join(F.broadcast(plan), inside)
    out = out.withColumn("sequence_id", (F.col("first_sequence") + F.floor(at / F.col("copies"))).cast("long"))
    out = out.withColumn("offset", (F.col("first_offset") + (at % F.col("copies")) * F.col("length")).cast("long"))
    if placed:
        out = cut_lineage(out.select(*told.columns, "sequence_id", "offset"))
        firsts = cut_lineage(out.groupBy("sequence_id").agg(F.min(POSITION).alias("_first")).withColumn("_all", F.lit(0)))
        numbers = ranked_by_position(firsts, "_all", "_first", ["sequence_id"], "_number").select("sequence_id", "_number")
        out = out.join(numbers, "sequence_id").withColumn("sequence_id", F.col("_number").cast("long"))
    return out.select(*[c for c in told.columns if c != POSITION], "sequence_id", "offset")
