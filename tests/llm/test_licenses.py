"""Licence scans: planted templates, whole and changed, and a search of every window by definition."""

import random
import re

import pyarrow as pa

from helixframe.llm import licenses as C
from helixframe.llm.license_texts import TEMPLATES

DOCS = "/root/testdata/sf0.01/documents.parquet"


def words(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def holds(text, template, containment=0.8):
    """Whether any stretch of the text holds the template, by definition."""
    s, t = shingles(text), shingles(template)
    want, slack = set(t), len(t) // 5 + 2
    return any(len(want & set(s[max(0, p - slack) : p + len(t) + slack])) >= containment * len(want) for p in range(-slack, len(s)))


def test_planted_templates():
    rng, index = random.Random(4), C.Index(TEMPLATES)
    filler = [f"f{k}" for k in range(500)]
    texts, names = [], []
    for name, versions in TEMPLATES.items():
        for text in versions:
            for _ in range(3):
                w = text.split()
                if len(w) > 100:
                    w[rng.randrange(len(w))] = "changed"
                    w.insert(rng.randrange(len(w)), "added")
                pad = lambda: " ".join(rng.choice(filler) for _ in range(rng.randint(0, 60)))
                texts.append(f"{pad()}\n{' '.join(w).upper() if rng.random() < 0.3 else ' '.join(w)} {pad()}")
                names.append(name)
    for name, text, found in zip(names, texts, index.matches(pa.array(texts), 0.8), strict=True):
        assert name in {m[0] for m in found}, (name, found)
        for n, s, e, share in found:
            assert any(holds(text[s:e], v) for v in TEMPLATES[n]) and share >= 0.8


def test_documents_match_definition(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(DOCS).collect()]
    found = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in C.find_licenses(spark.read.parquet(DOCS)).collect()}
    short = {n: [v for v in versions if len(words(v)) < 20] for n, versions in TEMPLATES.items()}
    for i, text in docs:
        want = {n for n, versions in short.items() for v in versions if holds(text, v)} if "icense" in text else set()
        assert found[i] <= want and (bool(found[i]) == bool(want)), (i, found[i], want)
    assert sum(map(bool, found.values())) > 15


def test_odd_rows(spark):
    mit = TEMPLATES["MIT"][1]
    docs = spark.createDataFrame([(1, None, "z"), (None, "é — " + mit, "z"), (2, "", None), (3, mit, "a"), (3, mit, "a"), (4, "w " * 300_000 + mit, "a")], "doc_id long, text string, licenses string")
    rows = sorted((r.doc_id or 0, r.n_matches, r.matches) for r in C.find_licenses(docs).collect())
    assert rows == [(0, 1, "MIT:4:34:1.000"), (1, 0, ""), (2, 0, ""), (3, 1, "MIT:0:30:1.000"), (3, 1, "MIT:0:30:1.000"), (4, 1, "MIT:600000:600030:1.000")]
    assert C.find_licenses(docs.limit(0)).count() == 0


def test_adjacent_licences_are_all_found():
    index = C.Index(TEMPLATES)
    longest = {name: max(texts, key=len) for name, texts in TEMPLATES.items()}
    for names in (("MIT", "ISC"), ("ISC", "MIT"), ("GPL-3.0", "AGPL-3.0"), ("MIT", "MIT"), ("MIT", "ISC", "MIT")):
        for gap in ("\n", "\nthird party notice for some library\n"):
            texts = [longest[n] for n in names]
            found = index.matches(pa.array([gap.join(texts)]), 0.8)[0]
            assert [m[0] for m in found] == list(names), (names, found)
            assert all(a[2] <= b[1] for a, b in zip(found, found[1:], strict=False)), found


def test_texts_that_hold_most_of_another_are_told_apart():
    index = C.Index(TEMPLATES)
    longest = {name: max(texts, key=len) for name, texts in TEMPLATES.items()}
    for name, text in longest.items():
        found = index.matches(pa.array([f"some words before it\n{text}\nand some behind"]), 0.8)[0]
        assert [m[0] for m in found] == [name], (name, found)
