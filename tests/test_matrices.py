"""Lambda against plain bisection, families that share keys, and results without their optional fields."""

import math

from helixframe.operators import matrices as M
from helixframe.sources import records as R


def plain_lambda(cells):
    total = lambda x: sum(f * g * math.exp(x * s) for f, g, s in cells)
    hi = 0.5
    while total(hi) < 1:
        hi *= 2
    lo = hi / 2 if hi > 0.5 else 0.0
    at = hi
    while hi - lo > 1e-5:
        at = (lo + hi) / 2
        lo, hi = (lo, at) if total(at) >= 1 else (at, hi)
    return at


def test_lambda(spark):
    make = lambda match, miss: [("ACGT"[i], "ACGT"[j], 0.25, 0.25, match if i == j else miss) for i in range(4) for j in range(4)]
    data = {1: make(5, -4), 2: make(1, -1), 3: make(1, -40), 4: make(-1, -1)}
    rows = [(k, *c) for k, cells in data.items() for c in cells]
    found = dict(M.with_lambda(spark.createDataFrame(rows, "m int, row string, col string, freq_row double, freq_col double, score int"), "m").collect())
    for k in (1, 2, 3):
        assert abs(found[k] - plain_lambda([c[2:] for c in data[k]])) < 1e-12
    assert found[4] is None


def test_store_takes_a_key_once(spark, tmp_path):
    store = str(tmp_path / "store")
    df = lambda rows: spark.createDataFrame(rows, "accession string, name string")
    assert R.append_families(df([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z")]), store).count() == 2
    assert R.append_families(df([("c", "new"), ("d", "z"), ("e", "w")]), store).count() == 1
    assert sorted(map(tuple, spark.read.parquet(store).collect())) == [("a", "x"), ("c", "z"), ("e", "w")]


def test_crossmatch_forms(spark, tmp_path):
    path = tmp_path / "out.cat"
    path.write_text("  463  1.3 0.6 1.7 chr1 10001 10468 (24) (CCCTAA)n#Simple_repeat 1 463 (0) m_b1s1i0\n  chr1 10001 ACGT 10004\n 20 0 0 0 q 1 5 (0) C L1 (7) 9 5\nTotal 4\n")
    rows = [tuple(r) for r in R.read_crossmatch(spark, str(path)).select("score", "strand", "name", "class", "sstart", "send", "sleft", "id").collect()]
    assert rows == [(463, "+", "(CCCTAA)n", "Simple_repeat", 1, 463, 0, "m_b1s1i0"), (20, "-", "L1", None, 5, 9, 7, None)]
