"""Packing by optimal length buckets.

Documents are cut into pieces of at most `max_length` words. A global histogram of the pieces' lengths, one row for
each length, goes to the driver: it has at most `max_length` rows. Dynamic programming over it chooses at most
`buckets` boundaries that minimise the padding when each piece is padded to its bucket's boundary. Inside a bucket,
pieces are shuffled by a seeded hash and cut into batches of `token_budget` // boundary pieces.

Places in a bucket are counted without sorting it in one task: the hash deals its pieces into ranges of about
RANGE_ROWS, each range is numbered by itself, and the ranges' sizes, known from one aggregate, are added. Equal rows have
equal hashes; a range that they crowd is numbered part by part of the written pieces.

Defined results: null text or a text without words is one piece of length 0, which the smallest bucket takes; a null
id stays; equal rows are pieces of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.common import at_most, size_in_words, written

MAX_LENGTH, BUCKETS, TOKEN_BUDGET = 8192, 16, 65536
RANGE_ROWS = 50_000
#: A range of more than so many times its share of rows is crowded.
CROWD = 4


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most `buckets` ascending boundaries with the least padding; the last is the longest length.

    cost[k][j] is the least padding of the first j lengths in k buckets. With boundary x, all earlier boundaries are
    lines in x whose slopes fall, so the best one is at the front of a queue of lines and moves on as x grows.
    """
    order = np.argsort(lengths)
    x = [int(lengths[i]) for i in order]
    c = np.concatenate([[0], np.cumsum([int(counts[i]) for i in order])]).tolist()
    s = np.concatenate([[0], np.cumsum([int(counts[i]) * int(lengths[i]) for i in order])]).tolist()
    n = len(x)
    if not n:
        return []
    cost = [x[j - 1] * c[j] - s[j] if j else 0 for j in range(n + 1)]
    cuts = []
    for _ in range(min(buckets, n) - 1):
        line = lambda i: (-c[i], cost[i] + s[i])  # noqa: B023, E731
        queue: list[tuple[int, int, int]] = []
        at, new, cut = 0, cost[:], [0] * (n + 1)
        for j in range(1, n + 1):
            slope, start = line(j - 1)
            while len(queue) - at >= 2:
                (m1, b1, _), (m2, b2, _) = queue[-2:]
                # the middle line is never the lowest
                if (start - b1) * (m1 - m2) <= (b2 - b1) * (m1 - slope):
                    queue.pop()
                else:
                    break
            if len(queue) > at and queue[-1][0] == slope:
                if queue[-1][1] > start:
                    queue[-1] = (slope, start, j - 1)
            else:
                queue.append((slope, start, j - 1))
            v = x[j - 1]
            while at + 1 < len(queue) and queue[at][0] * v + queue[at][1] >= queue[at + 1][0] * v + queue[at + 1][1]:
                at += 1
            m, b, i = queue[at]
            value = m * v + b + v * c[j] - s[j]
            if value < new[j]:
                new[j], cut[j] = value, i
        cost = new
        cuts.append(cut)
    out, j = [x[n - 1]], n
    for cut in reversed(cuts):
        j = cut[j]
        if not j:
            break
        out.append(x[j - 1])
    return sorted(out)


def pieces(docs: DataFrame, id_col: str, text_col: str, max_length: int, seed: int) -> DataFrame:
    """(id, piece, length, hash), a row for each piece of a document."""
    size = size_in_words(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), size.alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("seed"))
    last = F.greatest(F.ceil(F.col("size") / max_length), F.lit(1)) - 1
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    length = F.least(F.lit(max_length).cast("long"), F.col("size") - F.col("piece") * max_length)
    return rows.select("id", "piece", length.alias("length"), F.xxhash64("seed", "piece").alias("hash"))


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, seed: int = 7) -> DataFrame:
    """One row for each piece: id_col, piece, length, bucket_length, batch, place in the batch, padding."""
    rows = written(pieces(docs, id_col, text_col, max_length, seed).withColumn("part", F.spark_partition_id()), "pack-pieces")
    histogram = sorted((r.length, r.n) for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect())
    bounds = boundaries([h[0] for h in histogram], [h[1] for h in histogram], buckets) or [0]
    held = [sum(n for v, n in histogram if lo < v <= hi) for lo, hi in zip([-1, *bounds[:-1]], bounds, strict=True)]
    by_bound = F.create_map(*(x for b, n in zip(bounds, held, strict=True) for x in (F.lit(b).cast("long"), F.lit(max(1, -(-n // RANGE_ROWS))).cast("long"))))
    bound = F.coalesce(*(F.when(F.col("length") <= b, F.lit(b).cast("long")) for b in bounds))
    rows = rows.withColumn("bound", bound)
    unsigned = F.shiftrightunsigned("hash", 33)
    rows = rows.withColumn("range", F.floor(unsigned * by_bound[F.col("bound")] / F.lit(1 << 31)).cast("long"))

    crowded = written(rows.groupBy("bound", "range").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD * RANGE_ROWS).select("bound", "range", F.lit(True).alias("crowded")), "pack-crowded")
    rows = rows.join(F.broadcast(crowded) if at_most(crowded) else crowded, ["bound", "range"], "left").withColumn("sub", F.when(F.col("crowded"), F.col("part")).otherwise(-1))

    # one row for each range of each bucket, and for each part of a crowded one
    before = rows.groupBy("bound", "range", "sub").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("bound").orderBy("range", "sub").rowsBetween(W.unboundedPreceding, -1)
    before = before.select(F.col("bound").alias("b"), F.col("range").alias("r"), F.col("sub").alias("s"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    here = F.row_number().over(W.partitionBy("bound", "range", "sub").orderBy("hash", "id", "piece")) - 1
    rows = rows.withColumn("here", here).join(before, (F.col("bound") == F.col("b")) & (F.col("range") == F.col("r")) & (F.col("sub") == F.col("s")))
    place = F.col("before") + F.col("here")
    room = F.greatest(F.floor(F.lit(token_budget) / F.greatest("bound", F.lit(1))), F.lit(1)).cast("long")
    batch = F.concat_ws("-", F.col("bound"), F.floor(place / room).cast("long"))
    return rows.select(F.col("id").alias(id_col), "piece", "length", F.col("bound").alias("bucket_length"), batch.alias("batch"), (place % room).alias("place"), (F.col("bound") - F.col("length")).alias("padding"))
