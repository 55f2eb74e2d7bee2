"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sources, in code point order with null last, weigh `weights` in turn and share `share` of all words; a source's
target stops at `most` times its words, and what it can't take is shared again by weight. Inside a source, a
document of size z expects copies in proportion to z ** size_power, at most `most`, so that the expected words are
the target. The whole part of that number is certain; the fraction is an inclusion probability p. Documents are
ranked by Pareto order, (u / (1 - u)) / (p / (1 - p)) with u from a seeded hash, and taken in that order until the
source's words are reached, so the sample has a fixed size in words and each source comes within one document of
its target.

The ranking needs no sort of a whole source: a histogram of the order finds the bin in which the words run out,
and only that bin's rows are ordered. All tables joined back to the documents have one row for each source, or for
each source and size.

Defined results: null text or a text without words has size 0 and is taken 0 times; a null source is a source of
its own; rows that are equal in id, text and source get draws of their own, and which of them is taken makes no
difference; a null id is an id; an empty table gives an empty result; other columns of the documents are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.common import size_in_words, written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Tables of at most so many rows are broadcast to the documents; longer ones are joined by key.
BROADCAST_ROWS = 200_000
BINS = 1 << 14


def fill(groups: DataFrame, within: list[str], cap: Column, weight: Column, total: Column, out: str) -> DataFrame:
    """groups with `out`: the share of `total` that each gets by weight inside `within`, none above its cap.

    Groups are taken by cap over weight: while an even share of what is left exceeds a group's cap, the cap is
    its share; from the first group whose cap holds, all get the same share by weight.
    """
    by = W.partitionBy(*within) if within else W.partitionBy(F.lit(0))
    order = by.orderBy("__ratio", "__cap", "__weight")
    rows = groups.withColumns({"__cap": cap.cast("double"), "__weight": weight.cast("double"), "__total": total.cast("double")})
    rows = rows.withColumn("__ratio", F.when(F.col("__weight") > 0, F.col("__cap") / F.col("__weight")).otherwise(F.lit(0.0)))
    rows = rows.withColumns({
        "__left": F.col("__total") - F.coalesce(F.sum("__cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "__open": F.sum("__weight").over(order.rowsBetween(0, W.unboundedFollowing)),
    })
    rows = rows.withColumn("__level", F.when(F.col("__open") > 0, F.col("__left") / F.col("__open")))
    first = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__cap", "__weight", "__level"))).over(by)
    rows = rows.withColumn("__rate", first["__level"])
    share = F.least("__cap", F.coalesce(F.col("__rate") * F.col("__weight"), F.col("__cap")))
    return rows.withColumn(out, F.greatest(share, F.lit(0.0))).drop("__cap", "__weight", "__total", "__ratio", "__left", "__open", "__level", "__rate")


def is_small(df: DataFrame) -> bool:
    """Whether df is within BROADCAST_ROWS, which are counted."""
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(__source, __source_size, __target) from rows of (__source, __words)."""
    totals = sizes.groupBy("__source").agg(F.sum("__words").alias("__source_size"))
    place = F.row_number().over(W.orderBy(F.col("__source").asc_nulls_last())) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    totals = totals.withColumns({"__place": place, "__all": F.sum("__source_size").over(W.partitionBy(F.lit(0)))})
    totals = totals.withColumn("__share", F.element_at(listed, (F.col("__place") % len(weights) + 1).cast("int")))
    return fill(totals, [], F.col("__source_size") * most, F.col("__share"), F.col("__all") * share, "__target").select("__source", "__source_size", "__target")


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """__id, __source, __words and __key, which rows that are equal in id, text and source share, of each row."""
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), F.col(source_col))
    return docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), size_in_words(F.col(text_col)).alias("__words"), key.alias("__key"))


def drawn_apart(rows: DataFrame, name: str) -> DataFrame:
    """rows, written, with __u, the row's draw; rows of one key are numbered, so that they draw apart.

    A key may hold a third of all rows: its rows are numbered in each task's part of the table, and the parts that
    come before are added, one row for each part of a key that lies in several.
    """
    rows = written(rows.withColumn("__part", F.spark_partition_id()), name)
    parts = rows.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n"))
    several = parts.groupBy("__key").agg(F.count(F.lit(1)).alias("__parts")).filter("__parts > 1").select("__key")
    upto = W.partitionBy("__key").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = written(parts.join(several, "__key").select("__key", "__part", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before")), "mix-parts")
    before = F.broadcast(before) if is_small(before) else before
    numbered = rows.withColumn("__here", F.row_number().over(W.partitionBy("__key", "__part").orderBy("__words")))
    numbered = numbered.join(before, ["__key", "__part"], "left")
    number = F.col("__here") + F.coalesce("__before", F.lit(0))
    return numbered.withColumn("__u", unit(F.col("__key"), number)).drop("__key", "__part", "__here", "__before")


def unit(key: Column, number: Column) -> Column:
    """A draw between 0 and 1, neither included."""
    return (F.pmod(F.xxhash64(key, number.cast("int")), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20, **settings) -> DataFrame:
    """One row for each document: id_col, size, source, source_size, target, copies, taken, expected_copies."""
    slim = written(drawn_apart(keyed(docs, id_col, text_col, source_col, seed).drop("__row"), "mix-sizes"), "mix-draws")
    found = decided(slim, slim, **settings)
    return found.select(F.col("__id").alias(id_col), F.col("__words").alias("size"), F.col("__source").alias("source"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__copies").alias("copies"), (F.col("__copies") * F.col("__words")).alias("taken"), F.coalesce("__expected", F.lit(0.0)).alias("expected_copies"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20, **settings) -> DataFrame:
    """The rows of docs, each as often as pareto_mix takes it; whole rows are only shuffled where they are repeated."""
    rows = keyed(docs, id_col, text_col, source_col, seed)
    slim = written(rows.drop("__row"), "mix-keys")
    repeated = written(slim.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__key"), "mix-repeated")
    repeated = F.broadcast(repeated) if is_small(repeated) else repeated
    alone = lambda df: df.join(repeated, "__key", "left_anti").withColumn("__u", unit(F.col("__key"), F.lit(1))).drop("__key")
    again = lambda df: drawn_apart(df.join(repeated, "__key", "left_semi"), "mix-again")
    found = decided(written(alone(slim).unionByName(again(slim)), "mix-draws"), alone(rows).unionByName(again(rows)), **settings)
    return found.filter("__copies > 0").select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select("__row.*")


def decided(slim: DataFrame, rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, size_power: float = 0.5, bins: int = BINS) -> DataFrame:
    """rows with __copies, by the statistics of slim, which has their __id, __source, __words and __u."""
    groups = slim.groupBy("__source", "__words").agg(F.count(F.lit(1)).alias("__n"))
    targets = written(source_targets(groups.select("__source", (F.col("__words") * F.col("__n")).alias("__words")), weights, share, most), "mix-targets")
    few = is_small(targets)  # all tables by source have as many rows at most
    by_source = lambda df: F.broadcast(df) if few else df

    same = lambda a, b: a["__source"].eqNullSafe(b["__source"])
    joined = groups.filter("__words > 0").join(by_source(targets), same(groups, targets)).drop(targets["__source"])
    words = F.col("__words") * F.col("__n")
    rates = fill(joined, ["__source"], words * most, words * F.pow(F.col("__words").cast("double"), F.lit(size_power)), F.col("__target"), "__share")
    expected = F.round(F.col("__share") / words, 12)
    rates = rates.withColumn("__expected", expected).withColumn("__sure", F.floor("__expected")).withColumn("__p", F.col("__expected") - F.col("__sure"))
    sure = rates.groupBy("__source").agg(F.sum(F.col("__sure") * words).alias("__sure_words"))
    rates = rates.select(F.col("__source").alias("__s"), F.col("__words").alias("__w"), "__expected", "__sure", "__p")
    rates = written(rates, "mix-rates")
    rates = F.broadcast(rates) if is_small(rates) else rates

    def with_order(rows: DataFrame) -> DataFrame:
        ranked = rows.join(rates, rows["__source"].eqNullSafe(F.col("__s")) & (rows["__words"] == F.col("__w")), "left").drop("__s", "__w")
        odds = (F.col("__u") / (1 - F.col("__u"))) / (F.col("__p") / (1 - F.col("__p")))
        ranked = ranked.withColumn("__order", F.when(F.col("__p") > 0, odds))
        # odds / (1 + odds) lies between 0 and 1 and keeps the order
        return ranked.withColumn("__bin", F.floor(F.col("__order") / (1 + F.col("__order")) * bins).cast("int"))

    drawn = with_order(slim).filter("__p > 0")
    bars = drawn.groupBy("__source", "__bin").agg(F.sum("__words").alias("__bar"))
    upto = W.partitionBy("__source").orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    bars = bars.withColumn("__before", F.coalesce(F.sum("__bar").over(upto), F.lit(0)))
    need = targets.join(sure, same(targets, sure), "left").select(targets["__source"].alias("__s"), targets["__source_size"], "__target", (F.col("__target") - F.coalesce("__sure_words", F.lit(0))).alias("__need"))
    last = bars.join(by_source(need), bars["__source"].eqNullSafe(need["__s"])).filter("__before < __need and __before + __bar >= __need").select("__s", F.col("__bin").alias("__last"), "__before", "__need")
    last = written(last, "mix-last")

    # only the rows of the bin in which a source's words run out are put in order
    inside = drawn.join(by_source(last), drawn["__source"].eqNullSafe(last["__s"]) & (drawn["__bin"] == last["__last"]))
    in_order = W.partitionBy("__s").orderBy("__order", "__id", "__words").rowsBetween(W.unboundedPreceding, 0)
    inside = inside.withColumn("__upto", F.col("__before") + F.sum("__words").over(in_order) - F.col("__words") / 2).filter("__upto <= __need")
    cut = inside.groupBy("__s").agg(F.max(F.struct("__order", "__id", "__words")).alias("__cut"))
    limits = need.join(last.select(F.col("__s").alias("__l"), "__last"), F.col("__s").eqNullSafe(F.col("__l")), "left").drop("__l")
    limits = limits.join(cut.withColumnRenamed("__s", "__c"), F.col("__s").eqNullSafe(F.col("__c")), "left").drop("__c")

    ranked = with_order(rows)
    found = ranked.join(by_source(limits), ranked["__source"].eqNullSafe(F.col("__s")), "left")
    here = F.struct("__order", "__id", "__words")
    drawn_copy = (
        F.when(F.coalesce("__p", F.lit(0.0)) <= 0, 0)
        .when(F.col("__last").isNull(), F.when(F.col("__need") > 0, 1).otherwise(0))
        .when(F.col("__bin") < F.col("__last"), 1)
        .when((F.col("__bin") == F.col("__last")) & (here <= F.col("__cut")), 1)
        .otherwise(0)
    )
    return found.withColumn("__copies", (F.coalesce("__sure", F.lit(0)) + drawn_copy).cast("long"))
