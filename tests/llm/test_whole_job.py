"""Parts of the job that smaller rules would leave out."""

import itertools
import random

import corpus_pipeline
from newsgrid.llm import line_chunks, line_frequency, near_copies, packing, pfair, pii_crf
from newsgrid.llm.common import table
from newsgrid.llm.llm_queries import tokenizer_path

STAGE = dict(corpus_pipeline.STAGES)


def five_word_runs(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copy_stage_takes_five_words_and_four_fifths(spark):
    draw = random.Random(7)
    rows = []
    for family in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(300)]
        rows.append((len(rows), " ".join(base)))
        for n in (3, 5, 6, 40):
            copy = list(base)
            for at in draw.sample(range(4, 296), n):
                copy[at] = f"new{draw.randrange(10**9)}"
            rows.append((len(rows), " ".join(copy)))
    head = list(range(len(rows)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = five_word_runs(rows[a][1]), five_word_runs(rows[b][1])
        if len(x & y) >= 0.8 * len(x | y):
            i, j = sorted((top(a), top(b)))
            head[j] = i
    want = sorted({top(i) for i in range(len(rows))})
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(want) < len(rows) - 12
    assert sorted(r.doc_id for r in STAGE["simhash"](spark, docs, "").collect()) == want


def test_similar_documents_of_the_table_meet(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("doc_id is not null")
    sets = {r.doc_id: near_copies.run_hashes(r.text).tolist() for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.component_id for r in near_copies.similar_components(docs).collect()}
    for (a, x), (b, y) in itertools.combinations(((i, set(s)) for i, s in sets.items()), 2):
        if x and len(x & y) >= 0.8 * len(x | y):
            assert got[a] == got[b]


def test_packing_follows_the_mixed_order(spark):
    rows = [(i, "abc"[i % 3], " ".join(["word"] * (20 + i % 5))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")

    def packed(frame):
        return sorted((r.sequence_id, r.offset, r.doc_id) for r in packing.pack(frame, tokenizer_path(), capacity=200).collect())

    mixed = pfair.mixed(docs, weights={"a": 8, "b": 1, "c": 1}, block=2).localCheckpoint()
    made = packed(mixed)
    assert made != packed(docs)
    assert made != packed(pfair.mixed(docs, weights={"a": 1, "b": 1, "c": 8}, block=2))
    at = {r.doc_id: r.mix_position for r in mixed.collect()}
    firsts = {}
    for s, _, i in made:
        firsts[s] = min(firsts.get(s, at[i]), at[i])
    assert [firsts[s] for s in sorted(firsts)] == sorted(firsts.values())
    source = dict(r[:2] for r in rows)
    early = [source[i] for s, _, i in made if s < len(firsts) // 4]
    assert early.count("a") > 2 * early.count("c")


def test_lines_count_by_distinct_documents(spark):
    text = "\n".join(" ".join(f"{w}{x}" for x in "abcdefghij") for w in ("one", "two", "three"))
    rows = [(1, "s", text)] * 30
    rows += [(100 + i, "s", "\n".join(f"{i}{k} | 12.{i}{k}" for k in range(15))) for i in range(30)]
    rows += [(200 + i, "s", "\n".join([f"own{'x' * i} " * 25, "12.5 | 30"])) for i in range(25)] + [(None, "t", "no id but shared line\n" + text)] * 25
    got = line_frequency.line_frequency(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert {r.n_removed_lines for r in got if r.doc_id == 1} == {0} and all(r.kept for r in got if r.doc_id == 1)
    assert all(r.kept and not r.n_removed_lines for r in got if 100 <= (r.doc_id or 0) < 200)
    assert {r.n_removed_lines for r in got if (r.doc_id or 0) >= 200} == {1}
    assert {r.n_removed_lines for r in got if r.doc_id is None} == {4}


def test_shares_that_divide_no_period_hold_at_every_slot(spark):
    weights = {f"s{k:02d}": (k + 1) ** 0.5 for k in range(90)}
    total, seen, n = sum(weights.values()), dict.fromkeys(weights, 0), 20_000
    for t, (s, _) in enumerate(itertools.islice(pfair.slot_order(dict.fromkeys(weights, 10**6), weights), n), 1):
        seen[s] += 1
        assert abs(seen[s] - weights[s] / total * t) < 1
        if t % 500 == 0:
            assert all(abs(seen[x] - weights[x] / total * t) < 1 for x in seen)


def test_every_source_has_its_own_queue_and_weight(spark):
    rows = [(i, f"s{i % 100:02d}", f"text {i}") for i in range(1000)]
    made = pfair.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), {"s99": 60.0, "s98": 30.0}, block=1).collect()
    assert len({r.slot for r in made}) == 1000 and {r.queue for r in made} == {r.source for r in made}
    assert sum(r.queue == "s99" for r in made if r.slot < 20) >= 2


def test_passages_on_few_lines_go_whole(spark):
    rows, want = [], {}
    for n in (2, 3, 4, 5, 6, 7):
        for case in range(6):
            shared = [" ".join(f"p{n}c{case}l{k}w{w}" for w in range(60 // n + 1)) for k in range(n)]
            for copy in range(2):
                own = [[f"own {part} {n} {case} {copy} line {k}" for k in range(2 + case)] for part in "ab"]
                i = len(rows)
                rows.append((i, "\n".join(own[0] + shared + own[1])))
                want[i] = rows[i][1] if copy == 0 else "\n".join(own[0] + own[1])
    got = {r.doc_id: r.text for r in line_chunks.line_chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_copies_go_whole_and_a_repeating_text_keeps_its_first_place(spark):
    short = "one line alone\nanother line\na third one"
    long = "\n".join(" ".join(f"l{k}w{w}" for w in range(12)) for k in range(9))
    again = "\n".join(["a b c d e f g h i j", "k l m n o p q r s t"] * 12)
    rows = [(0, short), (1, short), (2, long), (3, long), (4, again), (5, "single line"), (6, "single line")]
    got = {r.doc_id: r.text for r in line_chunks.line_chunk_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {0, 2, 4, 5, 6}
    assert got[0] == short and got[2] == long and len(got[4].split("\n")) >= 5 and again.startswith(got[4])


def test_one_sign_of_a_kind_reaches_a_hundred_repeats():
    learnt = [f"Call +49 30 {n} or 49 30 in {n % 90} days, see 10.0.{n % 250}.1, a{n}@host.org and item {n}" for n in range(1234567, 1234867)]
    weights = pii_crf.learn(learnt)
    for first, again, kind in (("+49 30 1234567", "49301234567", "phone"), ("+49 30 7654321", "030 7654321", "phone")):
        text = f"call {first} now. " + f"or {again} later then and so on. " * 100
        more = pii_crf.added_spans(text, pii_crf.base_spans(text), weights)
        assert sum(k == kind and text[s:e] == again for k, s, e in more) == 100
    assert pii_crf.forms("10.0.0.1,") == pii_crf.forms("10.0.00.1") and pii_crf.forms("10.0.0.1") != pii_crf.forms("10001")
    assert not pii_crf.added_spans("in 2020 3 people bought 12 things, 12 of them new", {k: [] for k in pii_crf.KINDS}, weights)
