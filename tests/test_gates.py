"""Gates with their usual limits at hand-computed points, runs that start anew, and components of all edges."""

from pyspark.sql import functions as F

from helixframe.operators import gates as G
from helixframe.operators import graph as GR


def test_insertions_go_for_the_first_reason(spark):
    rows = [(99, 0.0, 2.0, 0.0), (30_001, 0.0, 2.0, 0.0), (100, 0.21, 0.5, 0.9), (100, 0.2, 0.99, 0.9), (100, 0.2, 1.0, 0.71), (100, 0.2, 1.0, 0.7), (30_000, 0.0, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "length int, n_share double, h1 double, dust double")
    got = [r[0] for r in df.select(G.first_reason(G.insertion_rules())).collect()]
    assert got == ["short", "long", "high_n", "low_entropy", "high_dust", None, None]
    below = [r[0] for r in df.limit(1).withColumn("h1", F.lit(0.8)).select(G.first_reason(G.insertion_rules(least_length=50))).collect()]
    assert below == [None]


def test_load_and_validity(spark):
    df = spark.createDataFrame([(50, 0.2, 0.1), (49, 0.0, 0.5), (50_000, 0.0, 0.9), (50_001, 0.0, 0.5), (80, 0.21, 0.5), (80, 0.0, 0.09)], "length int, n double, gc double")
    assert [r[0] for r in df.select(G.loadable(F.col("length"), F.col("n"), F.col("gc"))).collect()] == [True, False, True, False, False, False]
    df = spark.createDataFrame([(50, 0.14, 0.11, 0.19, 0.81), (49, 0.15, 0.1, 0.2, 0.8), (20_001, 0.0, 0.9, 0.0, 2.0)], "length int, n double, gc double, a double, h double")
    checks = G.validity_checks(*(F.col(c) for c in ("length", "n", "gc", "a", "h")))
    assert [tuple(r) for r in df.select(*(c.alias(k) for k, c in checks.items())).collect()] == [(True,) * 5, (False,) * 5, (False, False, True, True, True)]


def test_recall_and_flanks(spark):
    rows = [(4, 0.31, 2), (4, 0.30, 2), (5, 0.9, 9), (1, None, 2), (2, None, 2), (1, 0.9, 1)]
    df = spark.createDataFrame(rows, "n int, spread double, expected int")
    assert [r[0] for r in df.select(G.recall_eligible(F.col("n"), F.col("spread"), F.col("expected"))).collect()] == [True, False, False, True, False, False]
    rows = [(1, 120), (30, 148), (31, 160), (1, 280), (1, 279), (281, 400), (252, 370), (30, 309), (1, 119), (100, 380)]
    df = spark.createDataFrame(rows, "s int, e int")
    first, last = G.flank_kept(F.col("s"), F.col("e"), F.lit(400))
    got = [tuple(r) for r in df.select(first, last).collect()]
    # 0.3 of 400 is 120, 0.7 is 280; 100 must be left; a span at neither or both ends stays
    assert got == [(121, 400), (1, 400), (1, 400), (1, 400), (280, 400), (1, 280), (1, 400), (1, 400), (1, 400), (1, 400)]


def test_even_stride_and_outliers(spark):
    rows = [(1, k, 100) for k in range(300)] + [(1, 300, 501), (2, 0, 10), (2, 1, 9000), (3, 0, 1), (3, 1, 1), (3, 2, 1)]
    df = spark.createDataFrame(rows, "fam int, o int, n int")
    got = G.even_stride(df, "fam", ["o"], "n").collect()
    assert sorted(r["o"] for r in got if r["fam"] == 1) == list(range(0, 300, 2))
    assert sorted(r["o"] for r in got if r["fam"] == 2) == [0, 1] and sum(r["fam"] == 3 for r in got) == 3


def test_runs_that_pass_the_limit_start_anew(spark):
    steps = [(1, False, 50), (1, False, 60), (1, False, 200), (1, False, 150), (1, True, 9), (1, False, 20), (1, True, 9), (1, False, 100), (2, False, 100), (3, True, 5)]
    df = spark.createDataFrame([(p, k, b, n) for k, (p, b, n) in enumerate(steps)], "path long, place long, breaks boolean, length long")
    got = {tuple(r) for r in GR.bounded_runs(df, 100, 300).collect()}
    # 50 + 60 + 200 is too long: the 200 goes, and 150 is a run of its own; 20 is too short
    assert got == {(1, 1, 1, 150), (1, 3, 1, 100), (2, 0, 1, 100)}
    assert GR.bounded_runs(df.limit(0), 100, 300).isEmpty()


def test_components_of_a_star_and_a_path(spark):
    edges = [(0, k) for k in range(1, 3000)] + [(5000 + k, 5001 + k) for k in range(60)] + [(9000, 9000)]
    df = spark.createDataFrame(edges, "a long, b long")
    nodes = df.select(F.col("a").alias("id")).union(df.select("b")).distinct()
    found = {r["id"]: r["component"] for r in GR.components(df, nodes).collect()}
    assert {found[k] for k in range(3000)} == {0} and {found[5000 + k] for k in range(61)} == {5000} and found[9000] == 9000
    table = spark.createDataFrame([(k, -k, 5000 if k == 1 else 1) for k in range(20)], "k long, v long, n long")
    rows = spark.createDataFrame([(1,)] * 30 + [(k,) for k in range(22)], "k long")
    assert sorted(map(tuple, GR.lookup(rows, table, "k", "n", most=5).collect()), key=str) == sorted(map(tuple, GR.lookup(rows, table, "k", "n").collect()), key=str)
