"""Length buckets: boundaries against all choices, batches by definition."""

import itertools
import random
import re
from collections import Counter, defaultdict

from helixframe.llm import packing as P

DOCS = "/root/testdata/sf0.001/documents.parquet"


def padding(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= v) - v) for v, n in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(500):
        x = rng.sample(range(40), rng.randint(1, 8))
        c = [rng.randint(1, 9) for _ in x]
        k = rng.randint(1, 5)
        best = min(padding(x, c, {*s, max(x)}) for r in range(min(k, len(x))) for s in itertools.combinations(x, r))
        got = P.boundaries(x, c, k)
        assert len(got) <= k and padding(x, c, got) == best


def check(rows, texts, max_length, buckets, budget):
    want = Counter()
    for i, t in texts:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        want.update((i, p, min(max_length, n - p * max_length)) for p in range(max(1, -(-n // max_length))))
    assert Counter((r.doc_id, r.piece, r.length) for r in rows) == want
    sizes = Counter(r.length for r in rows)
    bounds = sorted({r.bucket_length for r in rows})
    assert len(bounds) <= buckets and all(r.bucket_length == min(b for b in bounds if b >= r.length) and r.padding == r.bucket_length - r.length for r in rows)
    chosen = P.boundaries(list(sizes), list(sizes.values()), buckets)
    assert padding(list(sizes), list(sizes.values()), chosen) == sum(r.padding for r in rows)
    batches = defaultdict(list)
    for r in rows:
        batches[r.batch].append(r)
    short = Counter()
    for group in batches.values():
        bound = group[0].bucket_length
        room = max(1, budget // max(bound, 1))
        assert {r.bucket_length for r in group} == {bound} and sorted(r.place for r in group) == list(range(len(group))) and len(group) <= room
        short[bound] += len(group) < room
    assert max(short.values(), default=0) <= 1


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(P, "RANGE_ROWS", 7)
    docs = spark.read.parquet(DOCS)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    for size, buckets, budget in ((8192, 16, 65536), (300, 4, 1500)):
        one, two = (P.pack(docs, max_length=size, buckets=buckets, token_budget=budget).collect() for _ in range(2))
        check(one, texts, size, buckets, budget)
        assert sorted(one) == sorted(two)


def test_odd_rows(spark):
    texts = [(1, None), (None, "a b"), (2, ""), (3, "w " * 50_000), (4, "x y z"), (4, "x y z"), (None, "a b")]
    docs = spark.createDataFrame([(*t, "q") for t in texts], "doc_id long, text string, length string")
    check(P.pack(docs).collect(), texts, P.MAX_LENGTH, P.BUCKETS, P.TOKEN_BUDGET)
    assert P.pack(docs.limit(0)).count() == 0
    assert {r.batch for r in P.pack(docs.filter("doc_id = 2")).collect()} == {"0-0"}


def test_crowds_of_equal_rows_are_numbered_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(P, "RANGE_ROWS", 10)
    texts = [(None, "w x y z")] * 300 + [(k, f"a{k} " * (k % 9)) for k in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    check(P.pack(docs, max_length=50, buckets=3, token_budget=40).collect(), texts, 50, 3, 40)
