"""Queries on tables that pass a bound which the small tables keep, and values that lie on a bound."""

import random

import duckdb
from pyspark.sql import functions as F

from helixframe.plans.registered import QUERIES


def test_more_families_than_the_bound_are_flagged(spark, tmp_path):
    spark.range(60_000).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    lines = spark.range(300_000).select((F.col("id") % 60_000).alias("l_partkey"), F.lit(10.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(f"SELECT id, members, length, within FROM ({QUERIES.sql['b11_discovery_gate']})").fetchall()
    got = QUERIES.queries["b11_discovery_gate"](spark, str(tmp_path)).select("id", "members", "length", "within").collect()
    assert len(want) > 30_000 and {r[3] for r in want} == {False}
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def documents(spark, path, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    return con


def same_rows(spark, path, con, name):
    got = QUERIES.queries[name](spark, str(path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({QUERIES.sql[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_likeness_between_two_roundings(spark, tmp_path):
    # 41, 323 and 333 of 640 end in a 5 at the seventh digit, and their doubles lie below it
    con = documents(spark, tmp_path, ["a" * 640, "a" * 41 + "b" * 599, "b" * 316 + "c" * 1 + "b" * 323, "b" * 333 + "d" * 307])
    same_rows(spark, tmp_path, con, "i9_positional_similarity")


def test_ends_alike_between_two_roundings(spark, tmp_path):
    # of a repeat of 640 bases, the longest of its 1600, 333 are equal: its score is the only one far from chance
    rng = random.Random(4)
    head, middle = [rng.choice("abcd") for _ in range(640)], [rng.choice("abcd") for _ in range(320)]
    tail = [x if i < 333 else rng.choice([y for y in "abcd" if y != x]) for i, x in enumerate(head)]
    con = documents(spark, tmp_path, ["".join(head + middle + tail), "abcd" * 100])
    want = con.execute(QUERIES.sql["i15_ltr_scores"]).fetchall()
    assert (640, 0.520312) in {(r[3], r[2]) for r in want}
    same_rows(spark, tmp_path, con, "i15_ltr_scores")
