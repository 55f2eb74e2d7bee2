"""Interval algebra: islands, overlaps, look-ahead pairs and trims, as windows and bucketed joins.

Intervals are 0-based and half open unless a function says closed.

What runs along a whole axis is cut into bins of it: a task looks at one bin, and what comes before a bin (its rows, the
farthest end, the depth) is taken from one row for each bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Positions in a bin, unless a call says otherwise.
BIN = 1 << 18


def _binned(df: DataFrame, start: str, width: int) -> DataFrame:
    return df.withColumn("__bin", F.floor(F.col(start) / width))


def _before(bins: DataFrame, by: list[str], of: dict[str, Column]) -> DataFrame:
    """bins (by, __bin, ...) with what the bins before each come to, nulls for the first."""
    w = W.partitionBy(*by).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    return bins.select(*by, "__bin", *(c.over(w).alias(name) for name, c in of.items()))


def _carried(rows: DataFrame, carry: DataFrame, by: list[str]) -> DataFrame:
    """rows joined with one row for each bin; null keys are a group of their own."""
    right = carry.select(*(F.col(c).alias(f"__k_{c}") for c in [*by, "__bin"]), *(c for c in carry.columns if c not in (*by, "__bin")))
    same = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [*by, "__bin"]]
    out = rows.join(right, same)
    return out.drop(*(f"__k_{c}" for c in [*by, "__bin"]))


def with_island(df: DataFrame, by: list[str], start: str, end: str, gap: int = 0, strict: bool = False, out: str = "island", width: int | None = None) -> DataFrame:
    """df with the number of the island of each interval inside `by`: intervals join what ends at most `gap` before.

    strict: touching intervals stay apart. width: cuts axes that hold many intervals, as chromosomes do, into bins.
    """
    if width is None:
        order = W.partitionBy(*by).orderBy(start, end)
        reach = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
        joins = F.col(start) < reach + gap if strict else F.col(start) <= reach + gap
        return df.withColumn("__fresh", F.when(reach.isNull() | ~joins, 1).otherwise(0)).withColumn(out, F.sum("__fresh").over(order)).drop("__fresh")
    rows = _binned(df, start, width)
    tops = rows.groupBy(*by, "__bin").agg(F.max(end).alias("__top"))
    rows = _carried(rows, _before(tops, by, {"__far": F.max("__top")}), by)
    order = W.partitionBy(*by, "__bin").orderBy(start, end)
    reach = F.greatest(F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1)), F.col("__far"))
    joins = F.col(start) < reach + gap if strict else F.col(start) <= reach + gap
    rows = rows.withColumn("__fresh", F.when(reach.isNull() | ~joins, 1).otherwise(0)).withColumn("__here", F.sum("__fresh").over(order))
    counts = rows.groupBy(*by, "__bin").agg(F.sum("__fresh").alias("__count"))
    rows = _carried(rows, _before(counts, by, {"__islands": F.sum("__count")}), by)
    return rows.withColumn(out, F.col("__here") + F.coalesce("__islands", F.lit(0))).drop("__bin", "__far", "__fresh", "__here", "__islands")


def ranked(df: DataFrame, by: list[str], start: str, order: list[str], out: str, width: int = BIN) -> DataFrame:
    """df with the place of each row, from 1, inside `by` in the given order, which begins with start."""
    rows = _binned(df, start, width)
    counts = rows.groupBy(*by, "__bin").agg(F.count(F.lit(1)).alias("__count"))
    rows = _carried(rows, _before(counts, by, {"__rows": F.sum("__count")}), by)
    here = F.row_number().over(W.partitionBy(*by, "__bin").orderBy(*order))
    return rows.withColumn(out, (here + F.coalesce("__rows", F.lit(0))).cast("long")).drop("__bin", "__rows")


def merged(df: DataFrame, by: list[str], start: str, end: str, aggregates: list[Column], gap: int = 0, strict: bool = False, width: int | None = None) -> DataFrame:
    """One row for each island: by, start, end and the aggregates over its intervals."""
    islands = with_island(df, by, start, end, gap, strict, "__island", width)
    return islands.groupBy(*by, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), *aggregates).drop("__island")


def union_length(df: DataFrame, by: list[str], start: str, end: str, out: str, closed: bool = True) -> DataFrame:
    """by and the length of the union of its intervals; closed intervals that only touch are not merged."""
    spans = merged(df, by, start, end, [])
    width = F.col(end) - F.col(start) + (1 if closed else 0)
    return spans.groupBy(*by).agg(F.sum(width).cast("long").alias(out))


def overlapping(left: DataFrame, right: DataFrame, key: str, bin_width: int) -> DataFrame:
    """Rows of left and right on the same key whose half-open intervals overlap, each pair once.

    left has ls and le, right has rs and re. Both sides are dealt into bins of the key's axis, so the join is one of
    equal keys; a pair counts in the bin where its overlap starts.
    """
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bin_width), F.floor((F.greatest(F.col(e), F.col(s) + 1) - 1) / bin_width)))
    a = left.withColumn("__bin", bins("ls", "le"))
    b = right.withColumnRenamed(key, "__key").withColumn("__bin_r", bins("rs", "re"))
    pairs = a.join(b, (F.col(key) == F.col("__key")) & (F.col("__bin") == F.col("__bin_r")) & (F.col("ls") < F.col("re")) & (F.col("rs") < F.col("le")))
    return pairs.filter(F.floor(F.greatest("ls", "rs") / bin_width) == F.col("__bin")).drop("__bin", "__bin_r", "__key")


def overlap_length() -> Column:
    return F.greatest(F.lit(0), F.least("le", "re") - F.greatest("ls", "rs"))


def next_rows(df: DataFrame, by: list[str], order: list[str], columns: list[str], k: int, width: int = BIN, block: int = 4096) -> DataFrame:
    """df with its place `k` and `__next`, the structs of columns of up to k following rows, nearest first, with their distance `d`.

    Blocks of places are windows of their own; each also sees the first k rows of the next.
    """
    rows = ranked(df, by, order[0], order, "k", width)
    at = F.floor((F.col("k") - 1) / block)
    seen = F.when(((F.col("k") - 1) % block < k) & (at > 0), F.array(at, at - 1)).otherwise(F.array(at))
    rows = rows.withColumn("__own", at).withColumn("__block", F.explode(seen))
    w = W.partitionBy(*by, "__block").orderBy("k")
    ahead = [F.struct(F.lit(d).alias("d"), *(F.lead(c, d).over(w).alias(c) for c in columns)) for d in range(1, k + 1)]
    rows = rows.withColumn("__next", F.filter(F.array(*ahead), lambda x: x[columns[0]].isNotNull()))
    return rows.filter("__own = __block").drop("__own", "__block")


def with_previous(df: DataFrame, by: list[str], order: list[str], column: str, out: str, width: int = BIN) -> DataFrame:
    """df with `out`, the column of the row before in the given order; the last row of the bin before is one row for each bin."""
    rows = _binned(df, order[0], width)
    last = rows.groupBy(*by, "__bin").agg(F.max(F.struct(*order, F.col(column).alias("__value"))).alias("__row"))
    w = W.partitionBy(*by).orderBy("__bin")
    rows = _carried(rows, last.select(*by, "__bin", F.lag("__row").over(w)["__value"].alias("__carry")), by)
    here = F.lag(column).over(W.partitionBy(*by, "__bin").orderBy(*order))
    first = F.row_number().over(W.partitionBy(*by, "__bin").orderBy(*order)) == 1
    return rows.withColumn(out, F.when(first, F.col("__carry")).otherwise(here)).drop("__bin", "__carry")


def at_or_before(df: DataFrame, marks: DataFrame, by: list[str], position: str, value: str, out: str, width: int = BIN) -> DataFrame:
    """df with `out`, the value of the last of marks (by, position, value) at or before its position, or null.

    A bin's marks lie beside its rows; what the bins before it end with is one row for each bin.
    """
    points = marks.select(*by, F.col(position), F.col(value).alias("__value"), F.lit(True).alias("__mark"))
    rows = _binned(df.withColumns({"__value": F.lit(None).cast(marks.schema[value].dataType), "__mark": F.lit(False)}).unionByName(points, allowMissingColumns=True), position, width)
    last = rows.groupBy(*by, "__bin").agg(F.max(F.when(F.col("__mark"), F.struct(position, "__value"))).alias("__last"))
    rows = _carried(rows, _before(last, by, {"__carry": F.last("__last", ignorenulls=True)}), by)
    here = F.last("__value", ignorenulls=True).over(W.partitionBy(*by, "__bin").orderBy(position, F.desc("__mark")).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn(out, F.coalesce(here, F.col("__carry")["__value"])).filter(~F.col("__mark")).drop("__value", "__mark", "__bin", "__carry")


def running_sum(df: DataFrame, by: list[str], position: str, value: str, out: str, width: int = BIN) -> DataFrame:
    """df with the sum of a column over the rows up to it, in order of position, which is unique inside `by`."""
    rows = _binned(df, position, width)
    sums = rows.groupBy(*by, "__bin").agg(F.sum(value).alias("__sum"))
    rows = _carried(rows, _before(sums, by, {"__carry": F.sum("__sum")}), by)
    here = F.sum(value).over(W.partitionBy(*by, "__bin").orderBy(position).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn(out, here + F.coalesce("__carry", F.lit(0))).drop("__bin", "__carry")


def trimmed(df: DataFrame, by: list[str], order: list[str], start: str, end: str, out: str) -> DataFrame:
    """df with `out`: start moved behind the preceding row's end where they overlap, if something is left."""
    before = F.lag(end).over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn(out, F.when((before >= F.col(start)) & (before + 1 < F.col(end)), before + 1).otherwise(F.col(start)))


def contained_lower(df: DataFrame, by: str, start: str, end: str, score: str, bin_width: int) -> DataFrame:
    """df without the rows that lie inside another of a higher score: begun no earlier, ended earlier.

    The other row covers the row's start, so it is looked up in the bin of the row's start alone.
    """
    at = F.floor(F.col(start) / bin_width)
    bins = F.explode(F.sequence(at, F.floor(F.col(end) / bin_width)))
    over = df.select(F.col(by).alias("__by"), F.col(start).alias("__start"), F.col(end).alias("__end"), F.col(score).alias("__score"), bins.alias("__bin"))
    inside = (F.col(by) == F.col("__by")) & (F.col("__at") == F.col("__bin")) & (F.col(start) >= F.col("__start")) & (F.col(end) < F.col("__end")) & (F.col("__score") > F.col(score))
    return df.withColumn("__at", at).join(over, inside, "left_anti").drop("__at")


def depth(df: DataFrame, by: list[str], start: str, end: str, width: int = BIN) -> DataFrame:
    """(by, position, until, depth): coverage between events."""
    events = df.select(*by, F.explode(F.array(F.struct(F.col(start).alias("position"), F.lit(1).alias("step")), F.struct(F.col(end).alias("position"), F.lit(-1).alias("step")))).alias("x")).select(*by, "x.*")
    steps = _binned(events.groupBy(*by, "position").agg(F.sum("step").alias("step")), "position", width)
    bins = steps.groupBy(*by, "__bin").agg(F.sum("step").alias("__sum"), F.min("position").alias("__first"))
    after = F.lead("__first").over(W.partitionBy(*by).orderBy("__bin"))
    carry = bins.withColumn("__after", after)
    upto = W.partitionBy(*by).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    carry = carry.select(*by, "__bin", F.coalesce(F.sum("__sum").over(upto), F.lit(0)).alias("__depth"), "__after")
    w = W.partitionBy(*by, "__bin").orderBy("position")
    rows = _carried(steps, carry, by)
    until = F.coalesce(F.lead("position").over(w), F.col("__after"))
    return rows.select(*by, "position", until.alias("until"), (F.sum("step").over(w) + F.col("__depth")).cast("long").alias("depth")).filter("until is not null")
