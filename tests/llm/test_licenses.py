"""License detections, suppression and score against trying every rule at every place."""

import random
import re

from newsgrid.llm import licenses
from newsgrid.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    norm = f" {' '.join(words)} "
    found = [(m.start(), m.end(), n, label) for k, p, label, n in licenses.rules() if k in words for m in re.finditer(rf"(?<= )(?:{p})(?= )", norm)]
    inside = lambda x, y: y[0] <= x[0] and y[1] >= x[1] and (y[2] > x[2] or (y[2] == x[2] and y[1] - y[0] > x[1] - x[0]))
    kept = sorted(x for x in found if not any(inside(x, y) for y in found))
    covered = len({at for s, e, _, _ in kept for at in range(s, e)})
    base = {label for phrase, label in licenses.BASE.items() if f" {phrase} " in norm}
    return kept, sorted(base | {x[3] for x in kept}), covered / max(1, len(norm))


def compare(df, texts):
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        kept, labels, score = plain(text)
        assert [tuple(d) for d in got[i].detections] == kept
        assert got[i].labels == labels and abs(got[i].score - score) < 1e-12


def test_given_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    compare(docs, {r.doc_id: r.text for r in docs.collect()})


def test_mixed_phrases(spark):
    rng = random.Random(2)
    bits = [re.sub(r"\(\?:|\)\??|\|.*?(?=\))|\[sc\]|\.\{1,80\}\?|[?]", lambda m: "s" if m[0] == "[sc]" else "", p) for _, p, _, _ in licenses.rules()]
    bits += ["or any later version", "version", "2 0", "MIT License", "mit", "word", "©", "\n", "GPLv3", "all rights reserved", "cc by nc sa 4 0", "The", "Apache-2.0"]
    texts = {i: rng.choice([" ", ", ", " - "]).join(rng.choices(bits, k=rng.randint(0, 25))) for i in range(120)}
    compare(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_hundreds_of_rules_each_named_by_its_keyword():
    rules = licenses.rules()
    assert len(rules) > 400
    assert all(re.search(rf"(?<![a-z0-9]){k}(?![a-z0-9])", p) for k, p, _, _ in rules)


def test_long_texts_stay_linear(spark):
    """Some 12,000 overlapping detections in one text, and one word of a million characters."""
    text = "Licensed under the MIT License. " * 6_000
    rows = [(1, text), (2, "z" * 1_000_000), (3, None)]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got[1].detections) == 12_000 and got[1].labels == ["mit"]
    assert got[2].detections == [] and got[2].n_words == 1 and got[3].n_words == 0
