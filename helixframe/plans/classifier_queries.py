"""Stacked classifiers over a hierarchy (operators K1, K2)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import classifier as C
from helixframe.operators import neighbours as N
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table

BASES = "ACGT"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features, path): shares of the sixteen pairs of bases, and a two-step path by language; null where it isn't known."""
    seq = F.col("seq")
    shares = [F.regexp_count(seq, F.lit(f"{a}(?={b})")) / F.greatest(F.lit(1), F.length(seq) - 1) for a in BASES for b in BASES]
    langs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    group = F.when(F.ascii("lang") % 2 == 0, "even").otherwise("odd")
    return V.seqs(spark, sf_dir).join(langs, "id").select("id", array_to_vector(F.array(*shares)).alias("features"), F.when(F.col("lang").isNotNull(), F.array(group, F.col("lang"))).alias("path"))


@QUERIES.add("k2_stacked_classes")
def k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacks fitted on the sequences of known path whose id isn't 0 by 5 (K1); the path of every sequence."""
    rows = labelled(spark, sf_dir)
    stacks = C.fit(rows.filter("path is not null and id % 5 <> 0"), "id", "path", folds=2, trees=20, depth=6)
    return C.classified(stacks, rows, "id").select("id", "path", F.round("score", 4).alias("score"))


@QUERIES.add("k1_nearest_labels", """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL), d AS (SELECT q.id, p.id AS neighbour, p.label, list_distance(q.x, p.x) AS distance FROM v q JOIN v p ON q.id <> p.id WHERE q.id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(distance, 9), neighbour) AS rank FROM d), k AS (SELECT * FROM r WHERE rank <= 5), n AS (SELECT id, label, count(*) AS n FROM k GROUP BY id, label), w AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS place FROM n)
SELECT k.id, CAST(rank AS INT) AS rank, neighbour, round(distance, 6) AS distance, w.label FROM k JOIN w ON w.id = k.id AND place = 1""")
def k1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50, and the label they vote for."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"), "label")
    found = N.nearest(rows.filter("id % 50 = 0"), rows)
    return found.join(N.voted(found, rows), "id").select("id", "rank", "neighbour", F.round("distance", 6).alias("distance"), "label")
