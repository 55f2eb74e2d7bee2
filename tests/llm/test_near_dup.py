"""Near duplicates against all pairs by definition, in documents and in planted groups."""

import random
import re

import numpy as np

from helixframe.llm import common as C
from helixframe.llm import near_dup as N

DOCS = "/root/testdata/sf0.001/documents.parquet"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def expected(rows, percent=85):
    rows = [(i, shingles(t)) for i, t in rows]
    group = {i: i for i, _ in rows if i is not None}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    of = {}
    for k, (_, s) in enumerate(rows):
        for x in s:
            of.setdefault(x, []).append(k)
    for k, (i, s) in enumerate(rows):
        near = {j for x in s for j in of[x] if j > k}
        for j in near:
            o, t = rows[j]
            if i is not None and o is not None and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(i), find(o)))
                group[b] = a
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(rng, base, n, least, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(least, most)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_documents(spark):
    docs = spark.read.parquet(DOCS)
    assert result(N.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_of_copies_and_near_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = near_copies(rng, base, 120, 0, 6) + [" ".join(base)] * 80 + [" ".join(base).upper()] * 5
    chain = [" ".join(f"c{i}" for i in range(k * 9, k * 9 + 200)) for k in range(12)]
    texts += chain + ["one two", "One two", "one two three four five", "five words are just this one", "é É", "É é"]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(N.near_duplicates(docs)) == expected(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text), (5, text), (4, text), (4, text), (4, "other words stand here today"), (8, "other words stand here today"), (8, "and these are yet some more"), (7, None), (6, ""), (9, " \n"), (10, "x " * 150_000), (11, "x " * 100_000)]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, id string, n long")
    got = result(N.near_duplicates(docs))
    want = []
    for i, t in rows:
        c = {None: None, 5: 4, 4: 4, 8: 4, 11: 10}.get(i, i)
        want.append((i, len(shingles(t)), c, c == i))
    assert got == sorted(want, key=str)
    assert N.near_duplicates(docs.limit(0)).count() == 0
    one = N.deduplicated(docs)
    assert one.columns == docs.columns and sorted(((r.doc_id, r.n) for r in one.collect()), key=str) == sorted([(None, 1), (None, 1), (4, 1), (6, 1), (7, 1), (9, 1), (10, 1)], key=str)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    for n in (1, 3, 50, 2000):
        common, a, b = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n * 3, n, n))
        x, y = N.sketches([np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))])
        assert (x != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and abs((x == y).mean() - 0.6) < (0.12 if n > 10 else 0.45)


def test_pairs_at_a_lower_threshold_are_linked(spark):
    rows = []
    for k in range(400):  # 80 of 100 shingles each
        w = [f"p{k}w{i}" for i in range(94)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:84] + [x + "x" for x in w[84:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(N.near_duplicates(docs, percent=80)) == expected(rows, 80)
    assert result(N.near_duplicates(docs)) == expected(rows)
    assert N.banding(85) == (8, 48) and N.least_agree(85) == 292


def test_a_pair_is_given_in_the_first_band_it_really_shares(spark):
    """Eight bits of every coordinate agree in band 0, whose keys differ; the pair meets in band 1 alone."""
    bands = [[k, 100, *range(k * 1000, k * 1000 + 46)] for k in (1, 2)]
    rows = [(100, 1, 2, k + 1, 50, k + 1, bytes(N.T), bands[k]) for k in (0, 1)]
    crowd = spark.createDataFrame(rows, "key long, band int, members long, id long, n long, c long, sketch binary, bands array<long>")
    assert result(N.candidates(crowd, False, 85)) == [(1, 2)]


def test_large_lookups_and_texts_of_many_pairs(spark, monkeypatch):
    """The ways beyond the broadcast bounds give the same groups."""
    rng = random.Random(4)
    base, other = [f"w{i}" for i in range(150)], [f"v{i}" for i in range(90)]
    texts = near_copies(rng, base, 60, 0, 9) + [" ".join(base)] * 40 + near_copies(rng, other, 30, 0, 12) + [None, "", "a b"]
    rows = [(None if k % 31 == 30 else k // 2 if k % 17 == 0 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = result(N.near_duplicates(docs))
    assert want == expected(rows)
    monkeypatch.setattr(C, "BROADCAST_IDS", 3)
    monkeypatch.setattr(N, "BROADCAST_IDS", 3)
    monkeypatch.setattr(C, "HEAVY", 4)
    monkeypatch.setattr(N, "PAIRS_PER_COPY", 3)
    monkeypatch.setattr(N, "BLOCK", 8)
    assert result(N.near_duplicates(docs)) == want
