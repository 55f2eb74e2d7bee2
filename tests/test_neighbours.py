"""Nearest neighbours against all distances."""

import random

from helixframe.operators import neighbours as N

SCHEMA = "id long, x array<double>, label string"


def by_hand(queries, points, k):
    out = []
    for q, x, _ in queries:
        far = sorted((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) ** 0.5, p) for p, y, _ in points if p != q)
        out += [(q, r, p, round(d, 9)) for r, (d, p) in enumerate(far[:k], 1)]
    return sorted(out)


def test_equal_to_all_distances(spark):
    rng = random.Random(1)
    points = [(k, [rng.randint(-3, 3) + rng.choice([0.0, 1e6]) for _ in range(4)], rng.choice("ab")) for k in range(300)]
    points += [(300 + k, points[k][1], "c") for k in range(40)]
    queries = [p for p in points if p[0] % 9 == 0]
    a, b = spark.createDataFrame(queries, SCHEMA), spark.createDataFrame([*points, (None, [0.0] * 4, "n"), (999, None, "n")], SCHEMA)
    want = by_hand(queries, points, 7)
    for block in (4096, 50):
        got = [(r["id"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in N.nearest(a, b, 7, block).collect()]
        assert sorted(got) == want


def test_few_points_and_votes(spark):
    points = spark.createDataFrame([(1, [0.0], "b"), (2, [1.0], "a"), (3, [3.0], "a"), (4, [9.0], "b")], SCHEMA)
    found = N.nearest(points, points, 5)
    assert found.count() == 12
    assert {r["id"]: r["label"] for r in N.voted(N.nearest(points, points, 2), points).collect()} == {1: "a", 2: "a", 3: "a", 4: "a"}
    # of two labels with as many votes, the smaller
    assert {r["id"]: r["label"] for r in N.voted(found, points).collect()} == {1: "a", 2: "b", 3: "b", 4: "a"}
    assert N.nearest(points.limit(0), points).isEmpty() and N.nearest(points, points.limit(0)).isEmpty()
