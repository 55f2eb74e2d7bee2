"""Axes cut into bins against plain loops: islands, places, neighbours, depth; nulls, ties and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import intervals as I


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(rng.choice(["x", "y", None]), s := rng.randrange(3000), s + rng.choice([1, 5, 40, 700]), k) for k in range(400)]
    return out + [("z", 10, 2900, 400), ("z", 2950, 2990, 401), ("z", 20, 30, 402), ("z", 20, 30, 403)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "c string, s long, e long, id long")


@pytest.mark.parametrize(("gap", "strict"), [(0, False), (0, True), (25, False)])
def test_islands(spark, rows, gap, strict):
    want = []
    for c in {r[0] for r in rows}:
        reach = None
        for _, s, e, _ in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2])):
            if reach is None or not (s < reach + gap if strict else s <= reach + gap):
                want.append([c, s, e, 0])
                reach = e
            reach = max(reach, e)
            want[-1][2], want[-1][3] = reach, want[-1][3] + 1
    want = sorted((str(c), s, e, n) for c, s, e, n in want)
    for width in (None, 64, 1000, 1 << 20):
        got = I.merged(frame(spark, rows), ["c"], "s", "e", [F.count(F.lit(1)).alias("n")], gap, strict, width)
        assert sorted((str(r.c), r.s, r.e, r.n) for r in got.collect()) == want
    assert I.merged(frame(spark, []), ["c"], "s", "e", [], width=64).count() == 0


def test_places_and_neighbours(spark, rows):
    order = {c: sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2], r[3])) for c in {r[0] for r in rows}}
    place = {r[3]: k for c in order for k, r in enumerate(order[c], 1)}
    got = I.next_rows(frame(spark, rows), ["c"], ["s", "e", "id"], ["id"], 3, width=100, block=8).collect()
    assert len(got) == len(rows) and {r.id: r.k for r in got} == place
    for r in got:
        later = order[r.c][r.k : r.k + 3]
        assert [(x.d, x.id) for x in r["__next"]] == [(d, x[3]) for d, x in enumerate(later, 1)]
    before = I.with_previous(frame(spark, rows), ["c"], ["s", "e", "id"], "e", "prev", width=100).collect()
    for r in before:
        k = place[r.id] - 1
        assert r.prev == (order[r.c][k - 1][2] if k else None)


def test_depth(spark, rows):
    got = sorted((str(r.c), r.position, r.until, r.depth) for r in I.depth(frame(spark, rows), ["c"], "s", "e", width=50).collect())
    want = []
    for c in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == c]
        marks = sorted({x for r in mine for x in r[1:3]})
        want += [(str(c), a, b, sum(r[1] <= a < r[2] for r in mine)) for a, b in zip(marks, marks[1:], strict=False)]
    assert got == sorted(want)
