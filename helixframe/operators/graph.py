"""Graphs as tables: edge gates, components, chains, closures and path reductions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir; in local mode, as in tests, one is set where none is."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, which ends its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gated_edges(directed: DataFrame, sizes: DataFrame, least_total: int, copy_ratio: float, direction: float, size_ratio: float) -> DataFrame:
    """Undirected edges (a < b) of directed counts (u, v, n) that pass all gates, with both directions' totals.

    Gates: total, total over the smaller size, share of the stronger direction, smaller over larger size.
    """
    forward = F.col("u") < F.col("v")
    both = directed.groupBy(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).agg(
        F.coalesce(F.sum(F.when(forward, F.col("n"))), F.lit(0)).alias("fwd"), F.coalesce(F.sum(F.when(~forward, F.col("n"))), F.lit(0)).alias("rev")
    )
    a, b = (sizes.select(F.col("id").alias(x), F.col("size").alias(f"size_{x}")) for x in "ab")
    rows = both.join(a, "a").join(b, "b").withColumn("total", F.col("fwd") + F.col("rev"))
    less, more = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    rows = rows.filter((F.col("total") >= least_total) & (F.col("total") / less >= copy_ratio) & (F.greatest("fwd", "rev") / F.col("total") >= direction) & (less / more >= size_ratio))
    return rows.select("a", "b", "fwd", "rev", "total", (F.col("total") / less).alias("ratio"), (F.col("fwd") >= F.col("rev")).alias("forward"))


def lookup(df: DataFrame, table: DataFrame, key: str, weight: str, most: int = 1_000_000) -> DataFrame:
    """df joined left with table, a row for each key, whose `weight` says how many rows of df have it.

    Up to `most` rows are broadcast; of more, only the keys with over a `most`-th of all rows and over 1000, of which there
    are `most` at most, and the other rows are joined by key.
    """
    rows, total = table.agg(F.count(F.lit(1)), F.sum(weight)).first()
    if rows <= most:
        return df.join(F.broadcast(table.drop(weight)), key, "left")
    heavy = F.col(weight) > max(1000, total // most)
    values = [c for c in table.columns if c not in (key, weight)]
    out = df.join(F.broadcast(table.filter(heavy).drop(weight).withColumn("__heavy", F.lit(True))), key, "left")
    rest = out.filter(F.col("__heavy").isNull()).drop("__heavy", *values).join(table.filter(~heavy).drop(weight), key, "left")
    return out.filter("__heavy").drop("__heavy").unionByName(rest)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, component) of nodes (id): the smallest id that edges (a, b) reach.

    Larger neighbours, then smaller ones, are linked to the smallest in turn until nothing changes; each round ends
    in a written table. The smallest node of a large component has most of its rows: they are looked up, not gathered.
    """

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both if larger else both.filter("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
        least = written(least, "components-least")
        out = lookup(both, least, "u", "n").filter("v > u" if larger else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return (out if larger else out.union(least.select("u", F.col("m").alias("v")))).distinct()

    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "components")
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return nodes.join(e, nodes["id"] == e["u"], "left").select("id", F.coalesce("v", "id").alias("component"))
        seen = now
        e = written(star(star(e, True), False), "components")


def closure(spark: SparkSession, parents: DataFrame, name: str = "parents") -> DataFrame:
    """(id, ancestor, depth) of a forest (id, parent): each node, and all above it."""
    parents.createOrReplaceTempView(f"__{name}")
    return spark.sql(f"""WITH RECURSIVE up(id, ancestor, depth) AS (
        SELECT id, id, 0 FROM __{name}
        UNION ALL SELECT up.id, p.parent, up.depth + 1 FROM up JOIN __{name} p ON p.id = up.ancestor WHERE p.parent IS NOT NULL
    ) SELECT id, ancestor, depth FROM up""")


def descended(starts: DataFrame, children: DataFrame, depth: int) -> DataFrame:
    """(id, node, stopped) of starts (id, node): from node to its most probable child, level by level, at most `depth` times.

    children are (node, child, p, own): a step stops where no child is more probable than the node's own label; the
    smaller name wins ties. Each level is a join with one row for each inner node.
    """
    ranked = children.withColumn("__k", F.row_number().over(W.partitionBy("node").orderBy(F.desc("p"), "child")))
    best = ranked.filter("__k = 1").drop("__k")
    rows = starts.select("id", "node", F.lit(False).alias("stopped"))
    for _ in range(depth):
        step = rows.join(best, "node", "left")
        goes = ~F.col("stopped") & F.col("child").isNotNull() & (F.col("p") > F.col("own"))
        rows = step.select("id", F.when(goes, F.col("child")).otherwise(F.col("node")).alias("node"), (F.col("stopped") | (F.col("child").isNotNull() & ~(F.col("p") > F.col("own")))).alias("stopped"))
    return rows


def runs(rows: DataFrame, by: list[str], order: list[str], breaks: Column, out: str = "run") -> DataFrame:
    """The rows between breaks, with the number of their run; the breaking rows go."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("__break", breaks).withColumn(out, F.sum(F.col("__break").cast("int")).over(w)).filter(~F.col("__break")).drop("__break")


def bounded_runs(steps: DataFrame, least: int, most: int) -> DataFrame:
    """(path, run, n, length) of steps (path, place, breaks, length): runs between breaks of at least so long.

    A step that would take its run past `most` is left out, and a new run starts after it. What runs on is carried from
    row to row: a task streams through its paths in order and holds three numbers.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, run, n, total, new = None, 0, 0, 0, True
        for batch in batches:
            out = []

            def ended() -> None:
                if n and total >= least:
                    out.append((path, run, n, total))  # noqa: B023

            for p, breaks, length in zip(*(batch.column(c).to_pylist() for c in ("path", "breaks", "length")), strict=True):
                if new or p != path:
                    ended()
                    path, run, n, total, new = p, 0, 0, 0, False
                if breaks:
                    ended()
                if breaks or total + length > most:
                    run, n, total = run + 1, 0, 0
                else:
                    n, total = n + 1, total + length
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], names=["path", "run", "n", "length"])
        if n and total >= least:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (path, run, n, total)], names=["path", "run", "n", "length"])

    rows = steps.select(F.col("path").cast("long").alias("path"), "place", F.col("breaks").cast("boolean").alias("breaks"), F.col("length").cast("long").alias("length"))
    return rows.repartition("path").sortWithinPartitions("path", "place").select("path", "breaks", "length").mapInArrow(step, "path long, run long, n long, length long")


def linear_chains(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, chain, place) of nodes (id) along links (u, v) between them: maximal walks without branches.

    A link counts if it is the only one out of u and into v. chain is the first node of the walk; a ring starts at its
    smallest node. Each round doubles the distance that a node has looked back, and ends in a written table.
    """
    inside = links.filter("u <> v").distinct().join(nodes.select(F.col("id").alias("u")), "u", "left_semi").join(nodes.select(F.col("id").alias("v")), "v", "left_semi")
    only = lambda x: inside.groupBy(x).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(x)
    back = written(inside.join(only("u"), "u").join(only("v"), "v").select(F.col("v").alias("id"), F.col("u").alias("up")), "links")

    def walked(back: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(id, head, place) of all, and (id, least) of those on rings."""
        at = written(nodes.distinct().join(back, "id", "left").select("id", F.coalesce("up", "id").alias("up"), F.col("up").isNotNull().cast("long").alias("d"), F.least("id", F.coalesce("up", "id")).alias("least")), "chains")
        size, span = nodes.count(), 1
        while span < size:
            far = at.select(F.col("id").alias("up"), F.col("up").alias("__up"), F.col("d").alias("__d"), F.col("least").alias("__least"))
            moved = written(at.join(far, "up").select("id", F.col("__up").alias("up"), (F.col("d") + F.col("__d")).alias("d"), F.least("least", "__least").alias("least")), "chains")
            same = moved.join(at.select("id", F.col("up").alias("was")), "id").filter("up <> was").isEmpty()
            at, span = moved, span * 2
            if same:
                break
        heads = at.filter("up = id and d = 0").select(F.col("id").alias("up"))
        return at.join(heads, "up").select("id", F.col("up").alias("chain"), F.col("d").alias("place")), at.join(heads, "up", "left_anti").select("id", "least")

    straight, rings = walked(back)
    rings = written(rings, "rings")
    if rings.isEmpty():
        return straight
    cut = back.join(rings.select(F.col("least").alias("id")).distinct(), "id", "left_anti")
    return walked(cut)[0]
