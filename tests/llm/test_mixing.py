"""Pareto order sampling: targets by definition, sizes near them, certain copies and reruns."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helixframe.llm import mixing as X

DOCS = "/root/testdata/sf0.01/documents.parquet"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """By definition: share by weight, stop at twice the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, done = 1.5 * sum(sizes.values()), {}
    while len(done) < len(names):
        left, free = total - sum(done.values()), [s for s in names if s not in done]
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * sizes[s]]
        if not over:
            return done | {s: left * weight[s] / w for s in free}
        done |= {s: 2 * sizes[s] for s in over}
    return done


def check(rows, texts):
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += size(t)
    want = targets(sizes)
    assert sorted((str(r.doc_id), r.size, str(r.source)) for r in rows) == sorted((str(i), size(t), str(s)) for i, t, s in texts)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r.size and 0 <= r.copies <= 2
        assert int(r.expected_copies) <= r.copies <= -(-r.expected_copies // 1)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_documents(spark):
    docs = spark.read.parquet(DOCS)
    rows = X.pareto_mix(docs).collect()
    check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert sorted(rows) == sorted(X.pareto_mix(docs.repartition(5)).collect())
    # longer documents are expected more often, and some are certain
    assert any(0 < r.expected_copies < 1 for r in rows) and any(r.copies == 2 for r in rows)
    # over seeds, a document is taken about as often as its inclusion probability says
    one = [r for r in rows if 0.3 < r.expected_copies < 0.7][:40]
    times = defaultdict(int)
    for seed in range(6):
        for r in X.pareto_mix(docs, seed=seed).filter(f"doc_id in ({','.join(str(r.doc_id) for r in one)})").collect():
            times[r.doc_id] += r.copies
    assert sum(times.values()) == pytest.approx(6 * sum(r.expected_copies for r in one), rel=0.25)


def test_odd_rows(spark):
    texts = [(1, None, "a"), (2, "", "b"), (None, "x y", None), (3, "x " * 90_000, "a"), (4, "w w w", "é"), (4, "w w w", "é"), (4, "w w w", "é"), (4, "w w w", "é"), (5, "q", "\U0001f600"), (6, "q", "￮")]
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, source string, size long")
    check(X.pareto_mix(docs).collect(), texts)
    assert X.pareto_mix(docs.limit(0)).count() == 0
    assert X.pareto_mix(docs.filter("doc_id <= 2")).filter("taken > 0").count() == 0
    mixed = X.mixed(docs)
    assert mixed.columns == docs.columns and mixed.filter("doc_id = 3").count() >= 1


def test_mixed_rows_are_the_decisions(spark):
    docs = spark.read.parquet(DOCS)
    copies = {r.doc_id: r.copies for r in X.pareto_mix(docs).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in X.mixed(docs).groupBy("doc_id").count().collect()} == copies


def test_repeated_rows_draw_apart_and_come_near_the_target(spark):
    """100 equal rows without an id, in several parts of the table: as many words as the target asks, in both forms."""
    texts = [(None, "w " * 4, "a")] * 100 + [(k, f"v{k} " * 8, "b") for k in range(20)]
    docs = spark.createDataFrame([(*t, k % 3) for k, t in enumerate(texts)], "doc_id long, text string, source string, n_chars int").repartition(7)
    rows = X.pareto_mix(docs).collect()
    check(rows, texts)
    out = X.mixed(docs)
    assert out.columns == docs.columns
    count = lambda df: {(r.doc_id, r.source): r.n for r in df.collect()}
    assert count(out.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("n"))) == count(X.pareto_mix(docs).groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).filter("n > 0"))
