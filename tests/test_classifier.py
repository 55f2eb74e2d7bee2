"""Stacks on a hierarchy whose groups lie apart."""

import random

from pyspark.ml.linalg import Vectors

from helixframe.operators import classifier as C


def test_paths_of_separate_groups(spark):
    rng = random.Random(5)
    centres = {("a", "x"): (0, 0), ("a", "y"): (0, 9), ("a", "z"): (5, 20), ("b", "only"): (30, 3)}
    rows = [(k, Vectors.dense([c + rng.gauss(0, 0.8) for c in centres[p]]), list(p)) for k, p in enumerate(list(centres) * 25)]
    df = spark.createDataFrame(rows, ["id", "features", "path"])
    stacks = C.fit(df, "id", "path", folds=2, trees=5, depth=3)
    assert sorted(stacks) == ["", "a", "b"] and stacks["b"].top is None
    found = {r.id: r.path for r in C.classified(stacks, df, "id").collect()}
    assert sum(found[k] == ".".join(p) for k, _, p in rows) >= 98
