"""Order-dependent kernels against plain versions."""

import random
from collections import Counter

import numpy as np

from helixframe.operators import kernels as K


def test_dust_matches_definition():
    rng = random.Random(2)
    for n in (10, 64, 65, 200):
        for letters in ("ACGT", "AC", "A", "ACGTN"):
            s = "".join(rng.choice(letters) for _ in range(n))
            scores = []
            for i in range(n - 63):
                c = Counter(t for k in range(62) if "N" not in (t := s[i + k : i + k + 3]))
                scores.append(sum(v * (v - 1) / 2 for v in c.values()) / 1891)
            want = (min(1, 7 * sum(scores) / len(scores)), sum(x > 0.1 for x in scores[::64]) / len(scores[::64])) if scores else (0, 0)
            assert np.allclose(K.dust(s), want)


def test_affine_score_matches_recursion():
    def plain(a, b, match=1, mismatch=-1, opening=-2, extension=-0.5):
        inf = float("-inf")
        m = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
        x, y = [r[:] for r in m], [r[:] for r in m]
        m[0][0] = 0
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                if i:
                    x[i][j] = max(max(m[i - 1][j], y[i - 1][j]) + opening, x[i - 1][j] + extension)
                if j:
                    y[i][j] = max(max(m[i][j - 1], x[i][j - 1]) + opening, y[i][j - 1] + extension)
                if i and j:
                    m[i][j] = max(m[i - 1][j - 1], x[i - 1][j - 1], y[i - 1][j - 1]) + (match if a[i - 1] == b[j - 1] else mismatch)
        return max(m[-1][-1], x[-1][-1], y[-1][-1])

    rng = random.Random(3)
    for _ in range(60):
        a, b = ("".join(rng.choice("ACGT") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert abs(K.affine_score(a, b) - plain(a, b)) < 1e-9, (a, b)


def test_average_linkage():
    d = np.array([[0, 0.1, 0.5, 0.9], [0.1, 0, 0.3, 0.9], [0.5, 0.3, 0, 0.9], [0.9, 0.9, 0.9, 0]])
    assert K.average_linkage(d, 0.3) == [1, 1, 2, 3] and K.average_linkage(d, 0.4) == [1, 1, 1, 2] and K.average_linkage(d, 1) == [1, 1, 1, 1]


def test_greedy_links_are_the_sequential_pass(spark):
    rng = random.Random(4)
    edges = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(60)})
    rows = [(u, v, rng.randrange(5)) for u, v in edges if u != v]
    rights, lefts, want = set(), set(), set()
    for u, v, _ in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if u not in rights and v not in lefts:
            rights.add(u)
            lefts.add(v)
            want.add((u, v))
    df = spark.createDataFrame(rows, "u long, v long, w long")
    from pyspark.sql import functions as F

    assert {(r.u, r.v) for r in K.greedy_links(df, [F.desc("w")]).collect()} == want
    assert K.greedy_links(df.limit(0), [F.desc("w")]).count() == 0


def test_masklevel_chains_and_packing(spark):
    hits = spark.createDataFrame([(1, "a", 1, 100, 9.0), (1, "b", 10, 90, 8.0), (1, "c", 90, 200, 7.0), (2, "d", 1, 5, 1.0)], "q long, id string, s long, e long, score double")
    assert sorted(r.id for r in K.masklevel(hits).collect()) == ["a", "c", "d"] and K.masklevel(hits, 101).count() == 4
    rows = [("q", "t", "+", k * 30_000, k * 30_000 + 25_000, k * 30_000, k * 30_000 + 25_000) for k in range(4)] + [("q", "t", "+", 10**9, 10**9 + 5, 0, 5)]
    chains = K.collinear_chains(spark.createDataFrame(rows, "q string, t string, strand string, qs long, qe long, ts long, te long")).collect()
    assert [(r.n, r.span) for r in chains] == [(4, 100_000)]
    items = spark.createDataFrame([(0, i, n) for i, n in enumerate([50, 40, 30, 200, 10])], "part long, id long, length long")
    assert {r.id: r.scaffold for r in K.packed(items, "part", 5, 100).collect()} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3}


def test_masklevel_in_rounds_is_the_sequential_pass(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2]), f"h{k}", s := rng.randrange(1, 300), s + rng.randrange(1, 80), float(rng.randrange(20))) for k in range(300)]
    kept = []
    for q, i, s, e, score in sorted(rows, key=lambda r: (-r[4], r[3] - r[2], r[1])):
        share = lambda a, b: 100 * (1 - max(0, min(b, e) - max(a, s) + 1) / (e - s + 1))  # noqa: B023, E731
        if not any(x[0] == q and int(share(x[2], x[3]) + 0.5) <= 20 for x in kept):
            kept.append((q, i, s, e, score))
    df = spark.createDataFrame(rows, "q long, id string, s long, e long, score double")
    for chunk in (7, 20_000):
        assert sorted(r.id for r in K.masklevel(df, chunk=chunk).collect()) == sorted(k[1] for k in kept)
    assert K.masklevel(df.limit(0)).count() == 0


def test_chains_of_stretches_are_those_of_the_whole_group(spark):
    rng = random.Random(8)
    rows = [("q", rng.choice("tu"), rng.choice("+-"), qs := rng.randrange(4000), qs + 50, ts := rng.randrange(6000), ts + 50) for _ in range(250)]
    want = []
    for key in {r[:3] for r in rows}:
        chains = []
        for r in sorted((r for r in rows if r[:3] == key), key=lambda r: (r[5], r[6], r[3], r[4])):
            for c in chains:
                p = c[-1]
                if -20 <= r[5] - p[6] <= 60 and -20 <= (r[3] - p[4] if key[2] == "+" else p[3] - r[4]) <= 60:
                    c.append(r)
                    break
            else:
                chains.append([r])
        want += [(*key, len(c)) for c in chains if len(c) >= 2]
    df = spark.createDataFrame(rows, "q string, t string, strand string, qs long, qe long, ts long, te long")
    got = K.collinear_chains(df, 20, 60, 2, 0).collect()
    assert sorted((r.q, r.t, r.strand, r.n) for r in got) == sorted(want)


def test_descent_stops_at_a_node_that_is_more_probable_itself(spark):
    from helixframe.operators.graph import descended

    children = spark.createDataFrame([("r", "a", 0.5, 0.1), ("r", "b", 0.5, 0.1), ("a", "a1", 0.2, 0.3), ("b", "b1", 0.9, 0.1)], "node string, child string, p double, own double")
    starts = spark.createDataFrame([(1, "r"), (2, "b"), (3, "z")], "id long, node string")
    assert sorted(tuple(r) for r in descended(starts, children, 3).collect()) == [(1, "a", True), (2, "b1", False), (3, "z", False)]


def test_fragments_are_rejoined_where_they_meet(spark):
    # consensus spans in order: the second goes on 4 behind the first, the third starts elsewhere, the fourth ends where the third began
    rows = [("a", 1, 100, 150), ("a", 2, 154, 200), ("a", 3, 400, 450), ("a", 4, 350, 404), ("b", 1, 405, 500)]
    # another element between two fragments; the first begun of two chains that fit; a fragment without a place
    rows += [("c", 1, 10, 50), ("c", 2, 900, 950), ("c", 3, 51, 80), ("d", 1, 10, 50), ("d", 2, 60, 50), ("d", 3, 50, 90), ("e", 1, 5, 9), ("e", 2, None, 9), ("e", 3, 9, 12), (None, 1, 1, 2), (None, 2, 2, 3)]
    df = spark.createDataFrame(rows, "n string, k long, ss long, se long")
    got = {(r.n, r.k): r.chain for r in K.rejoined(df, ["n"], ["k"], "ss", "se").collect()}
    want = {"a": [1, 1, 2, 2], "b": [1], "c": [1, 2, 1], "d": [1, 2, 1], "e": [1, 2, 1], None: [1, 1]}
    assert got == {(n, k): c for n, chains in want.items() for k, c in enumerate(chains, 1)}
    assert K.rejoined(df.limit(0), ["n"], ["k"], "ss", "se").count() == 0


def test_rejoining_is_the_pass_over_what_is_left(spark):
    rng = random.Random(12)
    rows = [(rng.choice("xy"), k, s := rng.randrange(120), s + rng.randrange(30)) for k in range(400)]
    want = {}
    for n in "xy":
        left, chain = [r for r in rows if r[0] == n], 0
        while left:
            chain, last, rest = chain + 1, left[0], []
            want[left[0][1]] = chain
            for r in left[1:]:
                if abs(r[2] - last[3]) < 5 or abs(r[3] - last[2]) < 5:
                    want[r[1]], last = chain, r
                else:
                    rest.append(r)
            left = rest
    df = spark.createDataFrame(rows, "n string, k long, ss long, se long")
    assert {r.k: r.chain for r in K.rejoined(df, ["n"], ["k"], "ss", "se").collect()} == want


def test_dominated_hits_are_those_of_all_pairs(spark):
    rng = random.Random(13)
    span = lambda: (rng.choice([1, 2]), s := rng.randrange(1, 300), s + rng.choice([0, 1, 5, 40, 200]))
    hits, kept = [span() for _ in range(150)], [span() for _ in range(40)]
    a, b = (spark.createDataFrame(x, "q long, s long, e long") for x in (hits, kept))
    for level in (0, 1, 30, 50, 80, 100):
        share = lambda h, k: 100 * (1 - max(0, min(h[2], k[2]) - max(h[1], k[1]) + 1) / (h[2] - h[1] + 1))
        want = {h for h in hits if any(h[0] == k[0] and int(share(h, k) + 0.5) <= 100 - level for k in kept)}
        assert {tuple(r) for r in K.dominated(a, b, level, 16).collect()} == want, level
