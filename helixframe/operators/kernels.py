"""Order-dependent algorithms: numpy inside tasks, on groups or slices that Spark deals out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from helixframe.functions.seq import kmers
from helixframe.operators.graph import written
from helixframe.operators.intervals import BIN, with_island
from helixframe.operators.passes import steps

WINDOW = 64
#: Bits of the bitmap of k-mers that a search asks for: 32 MB.
FILTER_BITS = 1 << 28


def dust(seq: str) -> tuple[float, float]:
    """(score, fraction): the mean over all windows of 64 bases, times 7 and at most 1; the share of separate windows above 0.1.

    A window's score counts pairs of equal triplets; pairs are summed by their distance, so a base costs 61 steps.
    """
    codes = np.full(256, -1, np.int64)
    codes[[65, 67, 71, 84]] = range(4)
    x = codes[np.frombuffer(seq.encode(), np.uint8)]
    if len(x) < WINDOW:
        return 0.0, 0.0
    known = (x[:-2] >= 0) & (x[1:-1] >= 0) & (x[2:] >= 0)
    t = np.where(known, x[:-2] * 16 + x[1:-1] * 4 + x[2:], -1 - np.arange(len(x) - 2))
    n = len(x) - WINDOW + 1
    pairs = np.zeros(n, np.int64)
    for d in range(1, WINDOW - 2):
        same = np.concatenate([[0], np.cumsum(t[:-d] == t[d:])])
        inside = WINDOW - 2 - d
        pairs += same[inside : inside + n] - same[:n]
    scores = pairs / (62 * 61 / 2)
    return min(1.0, float(scores.mean()) * 7), float((scores[::WINDOW] > 0.1).mean())


def with_dust(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, dust, dust_fraction)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [dust(s.as_py() or "") for s in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64())], names=["key", "dust", "dust_fraction"])

    return rows.select(F.col(key).cast("long").alias("key"), F.col(seq).alias("seq")).mapInArrow(step, "key long, dust double, dust_fraction double").withColumnRenamed("key", key)


def dominated(hits: DataFrame, kept: DataFrame, level: int, width: int) -> DataFrame:
    """(q, s, e) of the hits (q, s, e) whose % outside some kept hit (q, s, e) rounds to 100 - level at most; equal spans once.

    Such a kept hit covers more than a share of level - 0.5 % of the hit, so it covers one of the points that lie so far
    apart in it: hits come by their points, one above a level of 50, kept hits by the bins that they reach into.
    """
    spans = hits.select("q", "s", "e").distinct()
    over = kept.select(F.col("q").alias("__q"), F.col("s").alias("__s"), F.col("e").alias("__e")).distinct()
    overlap = F.greatest(F.lit(0), F.least("e", "__e") - F.greatest("s", "__s") + 1)
    inside = (F.col("q") == F.col("__q")) & (F.floor(100 * (1 - overlap / (F.col("e") - F.col("s") + 1)) + 0.5) <= 100 - level)
    if level < 1:
        return spans.join(over, inside, "left_semi")
    step = F.greatest(F.lit(1), F.floor((F.col("e") - F.col("s") + 1) * (2 * level - 1) / 200))
    points = spans.withColumn("__p", F.explode(F.sequence(F.col("s") + step - 1, F.col("e"), step))).withColumn("__bin", F.floor(F.col("__p") / width))
    bins = over.withColumn("__b", F.explode(F.sequence(F.floor(F.col("__s") / width), F.floor(F.col("__e") / width))))
    return points.join(bins, inside & (F.col("__bin") == F.col("__b")), "left_semi").select("q", "s", "e").distinct()


def masklevel(hits: DataFrame, level: int = 80, chunk: int = 20_000, width: int = 10_000) -> DataFrame:
    """hits (q, id, s, e, score) that no better hit of their query dominates; closed intervals.

    By score, the shorter first on ties: a hit goes if round(% of it outside some accepted hit) <= 100 - level. A query's
    first `chunk` hits by rank are settled in a task; what they dominate goes by a join on bins of `width` before the next
    round looks at the rest, so no task holds more than that of a query, however many hits it has.
    """
    columns = ["q", "id", "s", "e", "score"]
    if level >= 101:
        return hits.select(*columns)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(width=group.e - group.s + 1).sort_values(["score", "width", "id"], ascending=[False, True, True], kind="stable")
        s, e, keep = group.s.to_numpy(), group.e.to_numpy(), []
        for i in range(len(group)):
            overlap = np.maximum(0, np.minimum(e[keep], e[i]) - np.maximum(s[keep], s[i]) + 1) if keep else np.zeros(0)
            outside = np.floor(100 * (1 - overlap / (e[i] - s[i] + 1)) + 0.5)
            if not (outside <= 100 - level).any():
                keep.append(i)
        return group.iloc[keep][columns]

    rank = [F.desc("score"), F.col("e") - F.col("s"), F.col("id")]
    left, kept = hits.select(*columns).withColumn("part", F.pmod(F.xxhash64("id", "s", "e"), F.lit(64))), None
    while True:
        # the first of a query are among the first of its parts
        parts = left.withColumn("__k", F.row_number().over(W.partitionBy("q", "part").orderBy(*rank)))
        ranked = written(parts, "hits")
        first = ranked.filter(F.col("__k") <= chunk).withColumn("__k", F.row_number().over(W.partitionBy("q").orderBy(*rank)))
        new = written(first.filter(F.col("__k") <= chunk).select(*columns).groupBy("q").applyInPandas(one, "q long, id string, s long, e long, score double"), "kept")
        kept = new if kept is None else kept.unionByName(new)
        rest = ranked.filter(F.col("__k") > chunk).drop("__k").unionByName(first.filter(F.col("__k") > chunk).drop("__k"))
        left = written(rest.join(dominated(rest, new, level, width), ["q", "s", "e"], "left_anti").select(*columns, "part"), "hits")
        if left.isEmpty():
            return kept


def first_fit(rows: DataFrame, by: list[str], order: list[str], reads: list[str], chains: Callable[[], Callable[..., int]], out: str) -> DataFrame:
    """rows with `out`, the number of the chain that each row joins inside `by`, in the given order.

    chains() begins a group: what it gives takes the columns `reads` of one row after the other and says the row's chain. A
    task streams through its sorted groups and holds what that function holds, never a group's rows.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, place = None, chains()
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in by), strict=True)
            values = zip(*(batch.column(c).to_pylist() for c in reads), strict=True)
            found = []
            for key, row in zip(keys, values, strict=True):
                if key != group:
                    group, place = key, chains()
                found.append(place(*row))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, out])

    schema = StructType([*rows.schema.fields, StructField(out, LongType())])
    return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(step, schema)


def collinear_chains(alignments: DataFrame, back: int = 200, ahead: int = 500_000, least: int = 3, least_span: int = 60_000) -> DataFrame:
    """(q, t, strand, chain, n, span) of alignments (q, t, strand, qs, qe, ts, te) in collinear order.

    By tstart, an alignment joins the first chain that it can follow: gaps from -back to ahead on both sides, the query's
    counted against the strand. Where no alignment reaches to within `ahead` of the next, chains end, so each stretch
    between such gaps is chained by itself, in bins of the target. A task holds the last alignment of the chains that
    may go on, also where a stretch has no such gap.
    """
    by = ["q", "t", "strand"]

    def chains() -> Callable[..., int]:
        going: dict[int, tuple[int, int, int]] = {}
        begun = 0

        def place(strand: str, qs: int, qe: int, ts: int, te: int) -> int:
            nonlocal begun
            ended = []
            for k, (last_qs, last_qe, last_te) in going.items():
                t_gap, q_gap = ts - last_te, qs - last_qe if strand == "+" else last_qs - qe
                if t_gap > ahead:
                    # targets' starts don't go back
                    ended.append(k)
                elif -back <= t_gap and -back <= q_gap <= ahead:
                    break
            else:
                k, begun = begun, begun + 1
            for gone in ended:
                del going[gone]
            going[k] = (qs, qe, te)
            return k

        return place

    rows = with_island(alignments.select(*by, "qs", "qe", "ts", "te"), by, "ts", "te", gap=ahead, out="stretch", width=BIN)
    rows = first_fit(rows, [*by, "stretch"], ["ts", "te", "qs", "qe"], ["strand", "qs", "qe", "ts", "te"], chains, "chain")
    found = rows.groupBy(*by, "stretch", "chain").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("te") - F.col("ts")).alias("span"))
    number = F.row_number().over(W.partitionBy(*by).orderBy("stretch", "chain")) - 1
    return found.withColumn("chain", number.cast("long")).filter((F.col("n") >= least) & (F.col("span") >= least_span)).select(*by, "chain", "n", "span")


def rejoined(df: DataFrame, same: list[str], order: list[str], start: str, end: str, slack: int = 5, out: str = "chain") -> DataFrame:
    """df with `out`, the number of the fragment chain inside `same`: what was cut goes on where it ended, on either strand.

    `same` names all that fragments of one alignment share: hit and sequence name, score, divergence, lineage. In order, a
    fragment joins the first begun of the chains whose last fragment it meets, whatever lies between them. A task holds
    two numbers for each chain of a group.
    """

    def chains() -> Callable[..., int]:
        lasts: dict[int, tuple[int, int]] = {}
        by_end: tuple[dict[int, set[int]], dict[int, set[int]]] = ({}, {})

        def near(held: dict[int, set[int]], at: int, which: int) -> Iterator[int]:
            for b in range((at - slack) // slack, (at + slack) // slack + 1):
                yield from (k for k in held.get(b, ()) if abs(lasts[k][which] - at) < slack)

        def place(s: int | None, e: int | None) -> int:
            s, e = (np.inf, np.inf) if s is None or e is None else (s, e)
            known = np.isfinite(s)
            k = min([*near(by_end[1], s, 1), *near(by_end[0], e, 0)], default=None) if known else None
            if k is None:
                k = len(lasts) + 1
            else:
                for held, at in zip(by_end, lasts[k], strict=True):
                    held[at // slack].discard(k)
            lasts[k] = (s, e)
            if known:
                for held, at in zip(by_end, (s, e), strict=True):
                    held.setdefault(at // slack, set()).add(k)
            return k

        return place

    return first_fit(df, same, order, [start, end], chains, out)


def greedy_links(edges: DataFrame, rank: list[Column]) -> DataFrame:
    """The edges (u, v) that a greedy pass in the order of rank accepts: one right link for u, one left link for v.

    An edge that comes first at both of its ends is accepted by any such pass; these go with all that they exclude,
    and what is left is looked at again. Each round ends in a written table.
    """
    first = lambda by: F.row_number().over(W.partitionBy(by).orderBy(*rank, "u", "v"))
    left, chosen = written(edges, "links"), None
    while not left.isEmpty():
        best = written(left.withColumns({"__u": first("u"), "__v": first("v")}).filter("__u = 1 and __v = 1").drop("__u", "__v"), "links")
        chosen = best if chosen is None else chosen.unionByName(best)
        left = written(left.join(best.select("u"), "u", "left_anti").join(best.select("v"), "v", "left_anti").select(edges.columns), "links")
    return edges.limit(0) if chosen is None else chosen


def average_linkage(distance: np.ndarray, cut: float) -> list[int]:
    """Cluster numbers by average linkage up to `cut`; larger clusters first, then the smaller first index."""
    n = len(distance)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, members = np.ones(n), [[i] for i in range(n)]
    alive = np.ones(n, bool)
    while alive.sum() > 1:
        i, j = np.unravel_index(np.argmin(np.where(alive[:, None] & alive[None, :], d, np.inf)), d.shape)
        if not d[i, j] <= cut:
            break
        i, j = min(i, j), max(i, j)
        d[i] = d[:, i] = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i, i] = np.inf
        size[i] += size[j]
        members[i] += members[j]
        alive[j] = False
    order = sorted((m for i, m in enumerate(members) if alive[i]), key=lambda m: (-len(m), min(m)))
    out = [0] * n
    for k, m in enumerate(order, 1):
        for i in m:
            out[i] = k
    return out


def reassigned(distance: np.ndarray, labels: list[int], least: int, identity: float) -> list[int]:
    """Cluster numbers after small or loose clusters have given their members, in turn, to the nearest good one.

    A good cluster has at least `least` members of mean identity at least `identity`; it grows as it takes members. If
    none is good all form one cluster. Larger clusters first, then the smaller first index.
    """
    groups: dict[int, list[int]] = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, []).append(i)

    def alike(m: list[int]) -> float:
        return 1.0 if len(m) < 2 else 1 - float(distance[np.ix_(m, m)].sum()) / (len(m) * (len(m) - 1))

    good = [m for _, m in sorted(groups.items()) if len(m) >= least and alike(m) >= identity]
    if not good:
        return [1] * len(labels)
    placed = {i for m in good for i in m}
    for _, m in sorted(groups.items()):
        for i in (i for i in m if i not in placed):
            min(good, key=lambda g: round(float(distance[i, g].mean()), 12)).append(i)
    out = [0] * len(labels)
    for k, m in enumerate(sorted(good, key=lambda m: (-len(m), min(m))), 1):
        for i in m:
            out[i] = k
    return out


def jaccard_distances(seqs: list[str], k: int) -> np.ndarray:
    sets = [{s[i : i + k] for i in range(len(s) - k + 1)} for s in seqs]
    d = np.zeros((len(sets), len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            d[i, j] = d[j, i] = 1 - len(sets[i] & sets[j]) / union if union else 0.0
    return d


def clustered(members: DataFrame, cut: float = 0.3, k: int = 5, least: int = 1, identity: float = 0.0) -> DataFrame:
    """(fam, id, cluster) of families (fam, id, seq) by average linkage of k-mer Jaccard distances; a family is small.

    Clusters of fewer than `least` members or less mean identity than `identity` are reassigned.
    """

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        d = jaccard_distances(list(group.seq), k)
        return pd.DataFrame({"fam": group.fam, "id": group.id, "cluster": reassigned(d, average_linkage(d, cut), least, identity)})

    return members.select("fam", "id", "seq").groupBy("fam").applyInPandas(one, "fam long, id long, cluster long")


def chimera_spans(rows: list[str], least_rows: int = 5, least_width: int = 50, ratio: float = 0.5, valley: int = 3, side: float = 0.2, across: float = 0.5, depth: int = 2) -> list[tuple[int, int]]:
    """The column spans that an alignment falls into: one, or more where its rows part at an inner valley.

    A valley is the longest inner run of at least `valley` columns of less than ratio * the median occupancy. The rows
    part there if a share `side` ends before it, as many start after it, and at most `across` reach over it. Fragments
    of under `least_width` occupied columns go; at most `depth` cuts follow each other.
    """
    filled = np.array([[c not in "-. " for c in r] for r in rows], bool)

    def cut(lo: int, hi: int, level: int) -> list[tuple[int, int]]:
        f, width = filled[:, lo:hi], hi - lo
        if level >= depth or len(f) < least_rows or width < 2 * least_width:
            return [(lo, hi)]
        occupied = f.mean(axis=0)
        low = occupied < ratio * np.median(occupied)
        low[:valley] = low[width - valley :] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[0], low.astype(int), [0]])))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts) or (ends - starts).max() < valley:
            return [(lo, hi)]
        best = int(np.argmax(ends - starts))
        v = int(starts[best] + (ends[best] - starts[best]) // 2)
        some = f.any(axis=1)
        first, last = f.argmax(axis=1)[some], width - 1 - f[:, ::-1].argmax(axis=1)[some]
        n = len(f)
        left, right = ((last < v + valley) & (first < v)).sum() / n, ((first > v - valley) & (last > v)).sum() / n
        if left < side or right < side or ((first <= v - valley) & (last >= v + valley)).sum() / n > across:
            return [(lo, hi)]
        kept = [p for p in ((lo, lo + v), (lo + v, hi)) if filled[:, p[0] : p[1]].any(axis=0).sum() >= least_width]
        return [x for p in kept for x in cut(*p, level + 1)] or [(lo, hi)]

    return cut(0, filled.shape[1] if filled.ndim == 2 else 0, 0)


def with_chimera_spans(alignments: DataFrame, **limits: float) -> DataFrame:
    """(fam, fragment, s, e) of aligned rows (fam, turn, seq), padded to the longest; a family is small."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        rows = list(group.sort_values(["turn", "seq"]).seq)
        width = max(map(len, rows))
        spans = chimera_spans([r.ljust(width, "-") for r in rows], **limits)
        return pd.DataFrame([(group.fam.iloc[0], k, s, e) for k, (s, e) in enumerate(spans, 1)], columns=["fam", "fragment", "s", "e"])

    return alignments.select("fam", "turn", "seq").groupBy("fam").applyInPandas(one, "fam long, fragment long, s long, e long")


#: The bases of each IUPAC code, as bits of A, C, G and T.
CODES = {"A": 1, "C": 2, "G": 4, "T": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}


def extended(consensus: str, longer: str, least: float = 0.8, most: int = 500, exact: bool = True) -> str:
    """The consensus with up to `most` bases a side of the longer copy, where it lies in it with at least `least` agreement.

    Two codes agree if they are equal, one is a base that the other stands for, or one is N. Places are tried in steps
    of 1, of a 500th of the range from 1000 on, or all of them if `exact`; one whose first 100 bases agree in less than
    60% is left out; the first best place counts.
    """
    n, spots = len(consensus), len(longer) - len(consensus) + 1
    if not n or spots <= 1:
        return consensus
    code = np.zeros(256, np.uint8)
    for letter, bits in CODES.items():
        code[ord(letter)] = code[ord(letter.lower())] = bits
    raw = [np.frombuffer(x.upper().encode("latin-1", "replace"), np.uint8) for x in (consensus, longer)]
    (a, b), single = (code[x] for x in raw), np.isin(np.arange(16), [1, 2, 4, 8])
    best, place, head = 0.0, -1, min(100, n)

    def agreement(i: int, upto: int) -> float:
        x, y = a[:upto], b[i : i + upto]
        same = (raw[0][:upto] == raw[1][i : i + upto]) | (x == 15) | (y == 15) | (((x & y) > 0) & (single[x] | single[y]))
        return float(same.sum()) / upto

    for i in range(0, spots, 1 if exact or spots < 1000 else max(1, spots // 500)):
        if agreement(i, head) >= 0.6 and (score := agreement(i, n)) > best:
            best, place = score, i
    if place < 0 or best < least:
        return consensus
    return (longer[max(0, place - most) : place] + consensus + longer[place + n : place + n + most]).strip("N")


def with_extension(pairs: DataFrame, key: str, consensus: str, longer: str) -> DataFrame:
    """(key, seq): each consensus, extended where its longer copy supports it."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grown = [extended(x or "", y or "") for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grown, pa.string())], names=["key", "seq"])

    return pairs.select(F.col(key).cast("long").alias("key"), F.col(consensus).alias("a"), F.col(longer).alias("b")).mapInArrow(step, "key long, seq string").withColumnRenamed("key", key)


def affine_score(a: str, b: str, match: float = 1, mismatch: float = -1, opening: float = -2, extension: float = -0.5) -> float:
    """The score of the best global alignment with affine gaps, row by row."""
    x, n = np.frombuffer(b.encode("utf-32-le"), np.uint32), len(b)
    gaps = np.concatenate([[0.0], opening + extension * np.arange(n)])
    best, down = gaps.copy(), np.full(n + 1, -np.inf)
    for i, c in enumerate(a, 1):
        down = np.maximum(best + opening, down + extension)
        diagonal = best[:-1] + np.where(x == ord(c), match, mismatch)
        start = opening + extension * (i - 1)
        row = np.concatenate([[start], np.maximum(diagonal, down[1:])])
        # a gap to the right from any earlier cell: the running maximum of what opens there
        places = np.arange(n + 1)
        opened = np.maximum.accumulate(row - extension * places)
        right = np.concatenate([[-np.inf], opened[:-1] + extension * (places[1:] - 1) + opening])
        best = np.maximum(row, right)
    return float(best[-1])


def with_alignment_score(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, score) of pairs of short sequences."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [affine_score(x or "", y or "") for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["key", "score"])

    return pairs.select(F.col(key).cast("long").alias("key"), F.col(a).alias("a"), F.col(b).alias("b")).mapInArrow(step, "key long, score double").withColumnRenamed("key", key)


def packed(items: DataFrame, by: str, spacer: int, most: int) -> DataFrame:
    """items (by, id, length) with `scaffold`: in order of id, a new one starts when the next item would pass `most`.

    A budget that runs on is a sequence: a task streams through its groups in order and holds three numbers.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number, filled = None, 0, 0
        for batch in batches:
            out = []
            for g, length in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if out == [] and group is None or g != group:
                    group, number, filled = g, 0, 0
                more = filled + (spacer if filled else 0) + length
                if filled and more > most:
                    number, more = number + 1, length
                filled = more
                out.append(number)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())], names=[by, "id", "scaffold"])

    rows = items.select(F.col(by).cast("long").alias(by), F.col("id").cast("long").alias("id"), F.col("length").cast("long").alias("length"))
    return rows.repartition(by).sortWithinPartitions(by, "id").mapInArrow(step, f"{by} long, id long, scaffold long")


def kmer_places(text: str, k: int) -> np.ndarray:
    """Three places in a bitmap of FILTER_BITS for each k-mer of any letters, a row for each of the three."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(code) < k:
        return np.zeros((3, 0), np.int64)
    one, size = code, 1
    power = lambda m: np.uint64(pow(0x9E3779B97F4A7C15, m, 1 << 64))
    for bit in f"{k:b}"[1:]:
        code, size = code[:-size] * power(size) + code[size:], 2 * size
        if bit == "1":
            code, size = code[:-1] * power(1) + one[size:], size + 1
    code = (code ^ code >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    other = (code ^ code >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return np.stack([code >> np.uint64(36), other >> np.uint64(36), other & np.uint64(FILTER_BITS - 1)]).astype(np.int64)


def kmer_filter(texts: DataFrame, k: int) -> np.ndarray:
    """The bytes of a bitmap in which all k-mers of texts (seq) are set; its size is fixed, FILTER_BITS."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "seq"):
            found = [kmer_places(t or "", k).ravel() for t in part.column("seq").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)) + 1 if found else np.zeros(0, np.int64))], names=["place"])

    places = texts.select("seq").mapInArrow(step, "place long")
    rows = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    held = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        held[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return held


def kmers_in(texts: DataFrame, name: str, k: int, bitmap: np.ndarray) -> DataFrame:
    """(name, p_name, kmer) of texts (id, seq): the k-mers that the bitmap has, all of those that it was made of and few others."""
    held = texts.sparkSession.sparkContext.broadcast(bitmap)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for part in steps(batches, "seq"):
            ids, spots, words = [], [], []
            for i, text in zip(part.column("id").to_pylist(), part.column("seq").to_pylist(), strict=True):
                places = kmer_places(text or "", k)
                at = np.arange(places.shape[1])
                for row in places:
                    p = row[at]
                    at = at[bits[p >> 3] >> (p & 7).astype(np.uint8) & 1 == 1]
                ids.append(np.full(len(at), i, np.int64))
                spots.append(at)
                words += [text[p : p + k] for p in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(spots), pa.int32()), pa.array(words, pa.string())], names=[name, f"p_{name}", "kmer"])

    return texts.select(F.col("id").cast("long").alias("id"), "seq").mapInArrow(step, f"{name} long, p_{name} int, kmer string")


def seed_hits(queries: DataFrame, targets: DataFrame, k: int, band: int, least: int) -> DataFrame:
    """(q, t, diagonal, seeds, qstart, qend): bands of diagonals with at least so many shared k-mers.

    queries and targets are (id, seq). Equal k-mers meet by an equal-key join; a band takes `band` diagonals. A target's k-mers
    that no query has stay in its task, by a bitmap of fixed size that never drops one that some query has.
    """
    asked = queries.select(F.col("id").alias("q"), F.posexplode(kmers(F.col("seq"), k)).alias("p_q", "kmer"))
    rows = asked.join(kmers_in(targets, "t", k, kmer_filter(queries, k)), "kmer").filter("q <> t")
    found = rows.groupBy("q", "t", F.floor((F.col("p_t") - F.col("p_q")) / band).alias("diagonal"))
    return found.agg(F.count(F.lit(1)).alias("seeds"), F.min("p_q").cast("long").alias("qstart"), (F.max("p_q") + k).cast("long").alias("qend")).filter(F.col("seeds") >= least)
