"""Structure of elements: target-site duplications, terminal repeats, edges, breakpoints; no shuffle but where rows of a family meet."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import seq as S


def flank_duplication(seq: Column, flank: int = 30, least: int = 4, most: int = 20, mismatches: int = 1) -> Column:
    """struct(length, mismatches, place) of the best site duplication between the two flanks of a sequence, or null.

    The left copy ends the left flank, the right one starts within its length in the right flank. The most equal bases
    win, then the shorter, then the earlier.
    """
    left, right = F.left(seq, F.lit(flank)), F.right(seq, F.lit(flank))
    choices = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(i).alias("i")) for n in range(least, min(most, flank) + 1) for i in range(min(n, flank - n + 1))))

    def tried(ends: Column, c: Column) -> Column:
        same = S.identical_positions(F.right(ends["left"], c["n"]), F.substring(ends["right"], c["i"] + 1, c["n"]))
        return F.struct(same.alias("same"), (-c["n"]).alias("n"), (-c["i"]).alias("i"))

    def best(ends: Column) -> Column:
        found = F.filter(F.transform(choices, lambda c: tried(ends, c)), lambda x: -x["n"] - x["same"] <= mismatches)
        return F.array_max(found)

    top = S.let(F.struct(left.alias("left"), right.alias("right")), best)
    found = S.let(top, lambda x: F.when(x.isNotNull(), F.struct((-x["n"]).alias("length"), (-x["n"] - x["same"]).alias("mismatches"), (-x["i"]).alias("place"))))
    return F.when(F.length(seq) >= 2 * flank + least, found)


def duplication_bounds(seq: str, start: int, end: int, least: int = 4, most: int = 20, slack: int = 15, least_element: int = 50) -> tuple[int, int] | None:
    """(b5, b3) of the element that the longest exact duplication near both junctions, start and end, leaves.

    A duplication of one letter, or with an N, doesn't count. Among equal lengths the nearest to the junctions wins,
    then the smaller bounds. Longer ones are tried first.
    """
    n = len(seq)
    fives = range(max(most, start - slack), min(n, start + slack) + 1)
    threes = range(max(0, end - slack), min(n - least, end + slack) + 1)
    if len(fives) < 2 or len(threes) < 2:
        return None
    for k in range(most, least - 1, -1):
        places: dict[str, list[int]] = {}
        for b3 in threes:
            if b3 + k <= n:
                places.setdefault(seq[b3 : b3 + k], []).append(b3)
        copies = ((b5, seq[b5 - k : b5]) for b5 in fives)
        found = [(abs(b5 - start) + abs(b3 - end), b5, b3) for b5, w in copies if "N" not in w and w.strip(w[0]) for b3 in places.get(w, ()) if b3 - b5 >= least_element]
        if found:
            return min(found)[1:]
    return None


def with_duplication_bounds(rows: DataFrame, key: str, seq: str, start: int, from_end: int) -> DataFrame:
    """(key, b5, b3) of the sequences with a duplication near the junctions at `start` and `from_end` before the end."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            found = [(k, *b) for k, s in pairs if (b := duplication_bounds(x := s.as_py() or "", start, len(x) - from_end))]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)], names=["key", "b5", "b3"])

    return rows.select(F.col(key).cast("long").alias("key"), F.col(seq).alias("seq")).mapInArrow(step, "key long, b5 long, b3 long").withColumnRenamed("key", key)


def edge_quality(seq: Column) -> Column:
    """0 to 1: how little the ends differ from the middle in GC, and how few N they have more; 0.5 below 100 bases."""
    n = F.length(seq)
    edge = F.least(F.lit(50), F.floor(n / 10).cast("int"))
    first, past = F.floor(n / 4).cast("int"), F.floor(3 * n / 4).cast("int")
    parts = F.struct(F.left(seq, edge).alias("l"), F.right(seq, edge).alias("r"), F.substring(seq, first + 1, past - first).alias("m"))

    def score(p: Column) -> Column:
        gc = F.abs(S.fraction(p["l"], "GC") - S.fraction(p["m"], "GC")) + F.abs(S.fraction(p["r"], "GC") - S.fraction(p["m"], "GC"))
        unknown = S.fraction(p["l"], "N") + S.fraction(p["r"], "N") - S.fraction(p["m"], "N")
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.6 * F.greatest(F.lit(0.0), 1 - gc * 5) + 0.4 * F.greatest(F.lit(0.0), 1 - unknown)))

    return F.when(n < 100, 0.5).otherwise(S.let(parts, score))


def length_completeness(length: Column) -> Column:
    """0 to 1: 1 from 100 to 5000 bases, less outside, 0 below 50, 0.5 above 20000."""
    return F.when(length < 50, 0.0).when(length > 20_000, 0.5).when(length < 100, length / 100).when(length <= 5000, 1.0).otherwise(F.greatest(F.lit(0.5), 1 - (length - 5000) / 15_000))


def terminal_repeats(hits: DataFrame, inverted: int = 10, direct: int = 50, most: float = 0.5, edge: float = 0.2) -> DataFrame:
    """(q, signals): the sorted tags `ltr` and `tir` of sequences whose self hits (q, strand, qstart, qend, sstart, send, qlen, length) join opposite ends."""
    boundary = F.greatest(F.lit(1), F.floor(F.col("qlen") * edge))
    head = lambda a, b: F.least(a, b) <= boundary
    tail = lambda a, b: F.greatest(a, b) >= F.col("qlen") - boundary
    opposite = (head("qstart", "qend") & tail("sstart", "send")) | (tail("qstart", "qend") & head("sstart", "send"))
    least = F.when(F.col("strand") == "-", inverted).otherwise(direct)
    kept = hits.filter((F.col("length") >= least) & (F.col("length") <= F.col("qlen") * most) & opposite)
    return kept.groupBy("q").agg(F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("strand") == "-", "tir").otherwise("ltr")))).alias("signals"))


def ltr_pairs(hits: DataFrame, similarity: float = 0.7, least: int = 100, most: int = 5000) -> DataFrame:
    """(q, similarity, ltr5_start, ltr5_end, ltr3_start, ltr3_end) of self hits (q, qstart, qend, sstart, send, qlen, pident, length).

    Two hits at least; one joins the first third to the last. The most similar wins, then the longest, then the smaller
    coordinates; if it fails the limits there is no pair.
    """
    qs, qe, ss, se = F.least("qstart", "qend"), F.greatest("qstart", "qend"), F.least("sstart", "send"), F.greatest("sstart", "send")
    third = F.col("qlen") / 3
    ahead, back = (qs < third) & (ss > third * 2), (ss < third) & (qs > third * 2)
    spans = [F.when(ahead, a).otherwise(b) for a, b in ((qs, ss), (qe, se), (ss, qs), (se, qe))]
    pair = F.struct((F.col("pident") / 100).alias("similarity"), F.col("length").alias("length"), *((-x).alias(n) for x, n in zip(spans, ("a", "b", "c", "d"), strict=True)))
    found = hits.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(ahead | back, pair)).alias("p")).filter("n >= 2 and p is not null")
    found = found.select("q", "p.similarity", (-F.col("p.a")).alias("ltr5_start"), (-F.col("p.b")).alias("ltr5_end"), (-F.col("p.c")).alias("ltr3_start"), (-F.col("p.d")).alias("ltr3_end"))
    five, three = F.col("ltr5_end") - F.col("ltr5_start"), F.col("ltr3_end") - F.col("ltr3_start")
    return found.filter((F.col("similarity") >= similarity) & five.between(least, most) & three.between(least, most))


def seed_breakpoints(loci: DataFrame, component: int = 80, side: int = 4, span: float = 0.15, disjoint: float = 0.8, margin: int = 30, step: int = 20, most: int = 3) -> DataFrame:
    """(fam, breakpoints): where the copies' footprints (fam, qstart, qend, qlen) on a seed fall into two groups.

    Every `step` bases: few footprints span the place, enough lie on both sides, and few on both at once. The places
    of highest score are taken, the later on ties, `component` bases apart. Counts are combined before the shuffle.
    """
    place = F.explode(F.sequence(F.lit(component), F.col("qlen") - component - 1, F.lit(step)))
    rows = loci.filter(F.col("qlen") >= 2 * component + 1).select("fam", "qstart", "qend", place.alias("p"))
    p, s, e = F.col("p"), F.col("qstart"), F.col("qend")
    left, right = (e < p + margin) & (s < p), (s > p - margin) & (e > p)
    counted = rows.groupBy("fam", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((s <= p - margin) & (e >= p + margin)).alias("spanning"), F.count_if(left).alias("left"), F.count_if(right).alias("right"), F.count_if(left & right).alias("both"),
        (F.count_if((s <= p - margin) & (e >= p - margin)) + F.count_if((s <= p + margin) & (e >= p + margin))).alias("depth"),
    )
    less, depth = F.least("left", "right"), F.greatest(F.lit(1), F.floor(F.col("depth") / 2))
    share, apart = F.col("spanning") / depth, 1 - F.col("both") / F.greatest(F.lit(1), less)
    good = counted.filter((F.col("n") >= 2 * side) & (less >= side) & (share <= span) & (apart >= disjoint))
    ranked = good.groupBy("fam").agg(F.reverse(F.array_sort(F.collect_list(F.struct(F.round((1 - share) * apart * less / depth, 9).alias("score"), F.col("p"))))).alias("c"))
    clear = lambda a, x: F.forall(a, lambda y: F.abs(y - x["p"]) >= component) & (F.size(a) < most)
    chosen = F.aggregate("c", F.array().cast("array<bigint>"), lambda a, x: F.when(clear(a, x), F.concat(a, F.array(x["p"].cast("bigint")))).otherwise(a))
    return ranked.select("fam", F.array_sort(chosen).alias("breakpoints"))


def internal_repeat_cuts(hits: DataFrame, identity: float = 80, least: int = 100, segment: int = 500) -> DataFrame:
    """(q, segment, s, e): sequences cut after the inner copies of their head's repeat.

    hits (q, qlen, sstart, send, pident, length) are those of the head, a fifth of the sequence and at most 1000 bases,
    against the whole; sequences of under 2000 bases stay whole.
    """
    head = F.least(F.lit(1000), F.floor(F.col("qlen") * 0.2))
    inner = hits.filter((F.col("qlen") >= 2000) & (F.col("pident") >= identity) & (F.col("length") >= least) & (F.col("sstart") >= head) & (F.col("send") <= F.col("qlen") - 100))
    ends = inner.groupBy("q", "qlen").agg(F.array_sort(F.collect_set(F.col("send").cast("long"))).alias("ends"))
    far = lambda a, x: (x - F.element_at(a, -1) > segment) & (F.col("qlen") - x > segment)
    cuts = F.aggregate("ends", F.array(F.lit(0).cast("long")), lambda a, x: F.when(far(a, x), F.concat(a, F.array(x))).otherwise(a))
    rows = ends.select("q", F.concat(cuts, F.array(F.col("qlen").cast("long"))).alias("cuts")).filter(F.size("cuts") > 2)
    parts = F.posexplode(F.arrays_zip(F.slice("cuts", F.lit(1), F.size("cuts") - 1).alias("s"), F.slice("cuts", F.lit(2), F.size("cuts") - 1).alias("e")))
    return rows.select("q", parts.alias("place", "x")).select("q", (F.col("place") + 1).alias("segment"), "x.s", "x.e")
