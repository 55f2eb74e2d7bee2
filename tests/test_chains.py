"""Chains, chimeras, reassignment and extension on small cases."""

import numpy as np

from helixframe.operators import kernels as K
from helixframe.operators.graph import linear_chains


def test_chains_and_rings(spark):
    links = [(1, 2), (2, 3), (3, 4), (3, 5), (5, 6), (20, 21), (21, 22), (22, 20), (30, 99), (40, 41), (42, 41)]
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 20, 21, 22, 30, 40, 41, 42)], "id long")
    found = {r.id: (r.chain, r.place) for r in linear_chains(nodes, spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (4, 0), 5: (5, 0), 6: (5, 1), 20: (20, 0), 21: (20, 1), 22: (20, 2), 30: (30, 0), 40: (40, 0), 41: (41, 0), 42: (42, 0)}


def test_chimera_spans():
    left, right = ["A" * 60 + "-" * 66] * 4, ["-" * 66 + "C" * 60] * 4
    assert K.chimera_spans(left + right) == [(0, 63), (63, 126)]
    assert K.chimera_spans(["A" * 126] * 8) == [(0, 126)]
    assert K.chimera_spans((left + right)[:4]) == [(0, 126)]


def test_reassigned():
    d = np.array([[0, 0.1, 0.1, 0.9, 0.4], [0.1, 0, 0.1, 0.9, 0.4], [0.1, 0.1, 0, 0.9, 0.4], [0.9, 0.9, 0.9, 0, 0.9], [0.4, 0.4, 0.4, 0.9, 0]])
    assert K.reassigned(d, [1, 1, 1, 2, 3], 3, 0.5) == [1, 1, 1, 1, 1]
    assert K.reassigned(d, [1, 1, 1, 2, 3], 1, 0.5) == [1, 1, 1, 2, 3]
    assert K.reassigned(d, [1, 2, 3, 4, 5], 2, 0.5) == [1] * 5


def test_extended():
    core = "ACGTTGCAAC" * 6
    assert K.extended(core, "GGGG" + core + "TTNN") == "GGGG" + core + "TT"
    assert K.extended("R" + core[1:], "GGGG" + core + "TT") == "GGGGR" + core[1:] + "TT"
    assert K.extended(core, "G" * 90) == core
    assert K.extended(core, core) == core
    assert K.extended("", core) == ""
