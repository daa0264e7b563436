"""Each dealt query against a plain version of its contract, on the given tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from newsgrid.llm import llm_queries
from newsgrid.llm.common import table

Q = llm_queries.QUERIES
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_op1_base(spark, sf_dir, docs):
    got = by_id(Q["op1_line_frequency"](spark, sf_dir))
    assert set(got) == set(docs)
    for i, text in docs.items():
        w = WORD.findall(text)
        runs = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        often = Counter(runs)
        covered = {k + j for k, r in enumerate(runs) if often[r] > 1 for j in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_op2_recall(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    got = {}
    for r in Q["op2_multi_index_hashing"](spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    found = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[q]
        score[q] = -9
        want = set(ids[np.lexsort((ids, -score))[:5]])
        mine = [got[ids[q]][k] for k in range(1, 6)]
        assert [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
        found, total = found + len(want & {v for v, _ in mine}), total + 5
    assert found >= 0.9 * total


def test_op4_records(spark, sf_dir):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(spark, sf_dir, "pages").collect()}
    heads = {}
    for i, b in pages.items():
        if len(b) >= 1000:
            heads[b] = max(heads.get(b, i), i)
    got = by_id(Q["op4_arc_to_warc"](spark, sf_dir), "page_id")
    assert set(got) == set(pages)
    for i, b in pages.items():
        head = heads.get(b, i)
        assert tuple(got[i]) == (i, len(b), hashlib.sha1(b).hexdigest(), "response" if head == i else "revisit", None if head == i else head)


def test_op5_deviation(spark, sf_dir):
    rows = Q["op5_pfair_mixing"](spark, sf_dir).collect()
    assert len({(r.slot, r.in_block) for r in rows}) == len(rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_op6_components(spark, sf_dir, docs):
    got = by_id(Q["op6_simhash"](spark, sf_dir))
    prints = {}
    for i, text in docs.items():
        w = WORD.findall(text.translate(LOWER))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), seed=42) for k in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    head = {i: i for i in docs}

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in itertools.combinations(sorted(docs), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((top(a), top(b)))
            head[y] = x
    assert {i: r.component_id for i, r in got.items()} == {i: top(i) for i in docs}


def test_op7_round_trip(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(llm_queries.tokenizer_path())
    rows = Q["op7_packing"](spark, sf_dir).collect()
    own, seqs = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    assert set(own) == set(docs)
    for i, text in docs.items():
        ids = np.array([*made.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(own[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for part in seqs.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert sum(r.length for r in rows) > 0.99 * 4096 * (len(seqs) - 1)


def test_op8_base(spark, sf_dir, docs):
    got = by_id(Q["op8_license_rules"](spark, sf_dir))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for i, text in docs.items():
        w = word.findall(text.translate(LOWER))
        hits = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        starts = [k for k, _ in hits]
        base = sorted({label for _, label in hits})
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(base))
        assert set(base) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_op9_base(spark, sf_dir, docs):
    got = by_id(Q["op9_skip_chain_crf"](spark, sf_dir))

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    for i, text in docs.items():
        spans = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text) if ok(m[0])] for k, p, ok in kinds}
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k, _, _ in kinds]
        every = [x for k, _, _ in kinds for x in spans[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(every).encode()).hexdigest()
        assert set(every) <= set(r.spans.split(","))


def test_op10_held_out(spark, sf_dir):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    got = by_id(Q["op10_toxicity"](spark, sf_dir))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    right = [(got[i].predicted == t) for i, t in labels.items() if i in got and got[i].held_out]
    assert sum(right) >= 0.8 * len(right)
