"""Substitution matrices as tables, and scores of alignments under them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def probabilities(counts: DataFrame, by: list[str]) -> DataFrame:
    """counts (by, row, col, n) with p, each cell's share of its row."""
    return counts.withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy(*by, "row")))


def log_ratios(front: DataFrame, back: DataFrame, by: list[str], scale: float) -> DataFrame:
    """(by, row, col, score): round((ln p - ln p of the background) * scale), where both are above 0."""
    rows = probabilities(front, by).join(probabilities(back, []).select("row", "col", F.col("p").alias("q")), ["row", "col"])
    return rows.filter("p > 0 and q > 0").select(*by, "row", "col", F.round((F.log("p") - F.log("q")) * scale).cast("long").alias("score"))


def with_lambda(matrix: DataFrame, by: str, precision: float = 1e-5) -> DataFrame:
    """(by, lambda): where the sum of f f' exp(lambda score) over a matrix (by, freq_row, freq_col, score) is 1, by bisection.

    Null where no score is above 0: the sum then stays below 1.
    """
    cells = matrix.groupBy(by).agg(F.collect_list(F.struct((F.col("freq_row") * F.col("freq_col")).alias("f"), F.col("score").cast("double").alias("s"))).alias("__cells"))
    total = lambda x: F.aggregate("__cells", F.lit(0.0), lambda a, c: a + c["f"] * F.exp(x * c["s"]))
    start = F.struct(F.when(F.col("__top") > 0.5, F.col("__top") / 2).otherwise(0.0).alias("lo"), F.col("__top").alias("hi"), F.col("__top").alias("at"))

    def step(x: Column, _: Column) -> Column:
        half = (x["lo"] + x["hi"]) / 2
        over = total(half) >= 1
        next_ = F.struct(F.when(over, x["lo"]).otherwise(half).alias("lo"), F.when(over, half).otherwise(x["hi"]).alias("hi"), half.alias("at"))
        return F.when(x["hi"] - x["lo"] > precision, next_).otherwise(x)

    usable = F.exists("__cells", lambda c: (c["s"] > 0) & (c["f"] > 0))
    found = cells.withColumn("__top", F.when(usable, F.try_element_at(F.filter(F.array(*(F.lit(0.5 * 2**k) for k in range(12))), lambda x: total(x) >= 1), F.lit(1))))
    return found.select(by, F.when(F.col("__top").isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, step)["at"]).alias("lambda"))


def rescored(pairs: Column, query: Column, subject: Column, scores: dict[str, float], opening: float, extension: float) -> Column:
    """The sum of scores by pair of letters (0 if unknown), less affine gaps: a run of n costs opening + (n - 1) * extension.

    pairs is an array of struct(q, s), query and subject the rows as strings.
    """
    table = F.create_map(*(F.lit(x) for kv in scores.items() for x in kv))
    score = F.aggregate(pairs, F.lit(0.0), lambda a, c: a + F.coalesce(F.try_element_at(table, F.concat(c["q"], c["s"])), F.lit(0.0)))
    runs = F.regexp_count(query, F.lit("-+")) + F.regexp_count(subject, F.lit("-+"))
    gaps = F.regexp_count(query, F.lit("-")) + F.regexp_count(subject, F.lit("-"))
    return score - runs * opening - (gaps - runs) * extension


def complexity_adjusted(raw: Column, counts: list[Column], freqs: list[float], lam: float) -> Column:
    """The raw score less what a skewed composition explains: floor(raw + sum / lambda + 0.999), not below 0."""
    some = lambda c, x: F.when(c > 0, x).otherwise(0.0)
    total = sum(counts[1:], counts[0])
    factor = sum((some(c, c * F.log(c)) for c in counts), F.lit(0.0)) - some(total, total * F.log(total))
    composed = sum((some(c, c * F.log(F.lit(f))) for c, f in zip(counts, freqs, strict=True)), F.lit(0.0)) - factor
    return F.greatest(F.lit(0), F.floor(raw + F.round(composed, 9) / lam + 0.999))


def bits(raw: Column, lam: float, mu: float) -> Column:
    return (raw * lam - F.log(F.lit(mu))) / F.log(F.lit(2.0))
