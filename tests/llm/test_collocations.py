"""Phrases against counts made place by place."""

import random
import re
from collections import Counter

import duckdb
import pytest

from helixframe.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def by_hand(rows, longest, least, inside=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang, text = "und" if lang is None else lang, "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    may = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    most = Counter()
    for (lang, words), a in may.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                most[lang, words[i : i + k]] = max(most[lang, words[i : i + k]], a)
    out = []
    for (lang, words), a in may.items():
        if 100 * most[lang, words] >= inside * a:
            continue
        cuts = [(10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(words), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    rank, found = Counter(), []
    for x in out:
        rank[x[0]] += 1
        if rank[x[0]] <= top:
            found.append((x[0], rank[x[0]], *x[1:]))
    return found


def result(spark, rows, **settings):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, C.collocations(docs, **settings).collect()), key=lambda x: (x[0], x[1]))


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_counts_by_hand(spark, longest):
    rng = random.Random(longest)
    words = ["a", "b", "Cc", "d\x01", "é", "Éx", "#f", "g"]
    rows = [(k, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n"]) for _ in range(rng.randint(0, 90))), rng.choice(["en", "de", None, "und"])) for k in range(40)]
    rows += [(100 + k, "one long unary path of words that always stand together here. x", "en") for k in range(6)]
    rows += [(200, None, "fr"), (201, "", "fr"), (None, "a b a b a b a b a b", None), (201, "a b a b a b a b a b", None)]
    got = result(spark, rows, longest=longest, least=4)
    assert got == by_hand(rows, longest, 4) and len(got) > 20
    assert result(spark, rows, longest=longest, least=4, top=3) == by_hand(rows, longest, 4, top=3)


def test_paths_are_compacted(spark):
    rows = [(k, "one long unary path of words. a long road; a long road", "en") for k in range(5)]
    paths, edges = C.compacted(C.counts(spark.createDataFrame(rows, SCHEMA), 3, 2), 3)
    found = {(r["phrase"], r["f"]) for r in paths.collect()}
    # "a long road" is a path of its own; "one long unary path of words" is one row
    assert found == {("one long unary path of words", 5), ("a long road", 10)}
    assert edges.isEmpty()


def test_rare_words_and_pairs_are_cut_before_the_shuffle(spark):
    rows = [(k, f"same words rare{k} same words", "en") for k in range(8)] + [(9, "words words same. same words", "en")]
    docs = C.rows_of(spark.createDataFrame(rows, SCHEMA), "text", "lang")
    out = C.grams(docs, 3, C.frequent(docs, 3, 9)).groupBy("node", "last").sum("n").collect()
    assert {tuple(r) for r in out} == {("same words", None, 17), ("words", None, 19), ("same", None, 1), ("", None, 8)}


def test_a_task_sends_a_row_for_each_bucket(spark):
    def exchanges(node):
        below = [node.children().apply(k) for k in range(node.children().size())]
        return [node] * node.nodeName().startswith("Exchange") + [x for y in below for x in exchanges(y)]

    # 20,000 nodes in one task, all of them frequent
    text = "; ".join(f"first{k % 200} second{k // 200} third" for k in range(20_000))
    rows = C.rows_of(spark.createDataFrame([(1, text, "en"), (2, text, "en")], SCHEMA).coalesce(1), "text", "lang")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = C.grams(rows, 3, C.frequent(rows, 3, 2))
        found = {(r["node"], r["last"]): r["n"] for r in out.collect()}
        sent = exchanges(out._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sum(f == "third" and n == 2 for (_, f), n in found.items()) == 20_000
    assert all(n == 2 for (node, _), n in found.items() if node.startswith("first"))
    written = [x.metrics().apply("shuffleRecordsWritten").value() for x in sent]
    assert len(written) == 1 and written[0] <= C.BUCKETS


def test_large_numbers_are_exact(spark):
    a, l, r = 9_999_999_999_999, 10_000_000_000_000, 9_999_999_999_999
    row = spark.sql(f"SELECT div(1000000 * (CAST({a} AS decimal(20,0)) * CAST({a} AS decimal(20,0))), CAST({l} AS decimal(20,0)) * CAST({r} AS decimal(20,0))) AS q").first()
    assert row["q"] == 10**6 * a * a // (l * r)


def test_odd_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None, None), (2, "", "en")]) == []
    long = "word " * 40_000
    assert result(spark, [(1, long, "en")]) == by_hand([(1, long, "en")], 3, 10)
    clash = spark.createDataFrame([(k, "p q", "en", 1, "x", 2) for k in range(10)], "doc_id long, text string, lang string, n long, phrase string, key long")
    assert [tuple(r) for r in C.collocations(clash).collect()] == [("en", 1, "p q", 10, 10, 10, 20, 10**6)]


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(C.ORACLE_SQL).fetchall())
    assert sorted(map(tuple, C.collocations(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect())) == want
