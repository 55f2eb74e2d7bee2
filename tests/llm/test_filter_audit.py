"""Filter interactions against counts made mask by mask."""

import math
import random
from itertools import permutations

import duckdb

from helixframe.llm import filter_audit as A

DOCS, LABELS = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def by_hand(part, counts, names):
    out, shapley = {}, dict.fromkeys(names, 0)
    total = lambda test, k=0: sum(c[k] for m, c in counts.items() if test(m))
    for order in permutations(names):
        before = 0
        for step, x in enumerate(order, 1):
            bit = 1 << names.index(x)
            here = lambda m, before=before, bit=bit: not m & before and m & bit
            kept = total(lambda m: not m & (before | bit))
            removed = total(here)
            out["".join(order), step] = [part, "".join(order), step, kept, removed, total(lambda m: m & before and m & bit), total(lambda m: m == bit), total(here, 1), total(here, 2)]
            shapley[x] += removed
            before |= bit
    return {(*row, shapley[order[step - 1]]) for (order, step), row in out.items()}


def test_swaps_lead_through_all_orders():
    for n in range(1, 7):
        order = list(range(n))
        seen = [tuple(order)]
        for k in A.adjacent_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(n)


def test_diagrams_share_nodes_and_keep_weights():
    counts = {m: (1, 0, 0) for m in range(32)}
    diagram = A.Diagram(counts, 5)
    # each level has one node, as all masks weigh the same
    assert len(diagram.nodes) - 1 == 6
    for k in (0, 3, 2, 1):
        diagram.swap(k)
        assert diagram.weights[diagram.root] == (32, 0, 0)


def test_audit_equals_counts_by_mask(spark):
    rng, names = random.Random(5), "ABCDE"
    parts = {p: {m: (rng.randint(1, 9), rng.randint(0, 3), rng.randint(0, 2)) for m in range(32) if rng.random() < 0.5 or m == 0} for p in ("", "x", "y")}
    rows = [(p, m, *c) for p, counts in parts.items() for m, c in counts.items()]
    split = rows + [("x", 0, 5, 1, 0)]
    n, g, t = parts["x"][0]
    parts["x"][0] = (n + 5, g + 1, t)
    got = A.audit(spark.createDataFrame(split, "part string, mask int, n long, good long, toxic long"), names)
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == set().union(*(by_hand(p, c, names) for p, c in parts.items()))


def test_failure_masks(spark):
    many = " ".join(f"w{k}" for k in range(200))
    rows = [(1, many, "a"), (2, many, "a"), (1, many, "a"), (None, many, "a"), (3, "x " * 300, "a"), (4, "XYZ# " * 300, "b"), (5, None, None), (6, "", ""), (7, "ÉÉ", "b")]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, 1, 0), (6, None, 1)]
    got = {tuple(r) for r in A.failure_masks(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).select("part", "mask", "n", "good", "toxic").collect()}
    # 2 repeats 1; a null id repeats nothing; the two rows of 1 don't repeat each other; 6 repeats 5, which is empty as well
    assert got == {("a", 0, 3, 2, 2), ("a", 16, 1, 0, 0), ("a", 2, 1, 0, 0), ("b", 2 + 4 + 8, 1, 0, 0), ("", 1, 1, 1, 0), ("", 17, 1, 0, 1), ("b", 1, 1, 0, 0)}


def test_odd_tables(spark):
    empty = A.audit_documents(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert empty.columns == COLUMNS and empty.isEmpty()
    docs = spark.createDataFrame([(1, "word " * 100_000, "s", 7, 8)], "doc_id long, text string, source string, mask int, n int")
    rows = A.audit_documents(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == 600 and {r["removed"] for r in rows if r["filter_order"][r["step"] - 1] == "B"} == {1}


def test_equals_sql(spark):
    con, at = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    got = A.audit_documents(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))
    assert sorted(map(tuple, got.select(COLUMNS).collect())) == sorted(con.execute(A.ORACLE_SQL).fetchall())
