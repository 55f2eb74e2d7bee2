"""MinHash near-deduplication with fast similarity sketching.

A document's set is its distinct shingles of `width` words, lower-cased in A-Z. A sketch of T coordinates is filled in
rounds: in each of the first T rounds every shingle is hashed to a bin and a value; in each of the next T rounds all
shingles go to the bin of that round. The smallest value stays, earlier rounds before later ones, and filling stops
when no bin is empty, which the second half guarantees. Two sets agree in a coordinate with a chance of their Jaccard
similarity, with bounds as sharp as for independent hashes, at about one hash for each shingle.

Bands of coordinates make candidates, as wide as lets a pair at the threshold miss all of them with a chance of at most
MISS (`banding`: 48 of 8 at 85 per cent, 64 of 6 at 80). Sizes and sketches drop pairs that can't reach the threshold
(`least_agree`: so few equal coordinates have a chance of at most MISS at the threshold), and the others are confirmed
on the full sets, read from the texts again.

The work never lists all pairs of a group. Documents with equal sets are one class, and only its smallest id goes on.
A bucket is cut into blocks of about BLOCK classes, and tasks compare sketches block by block. First each class is
linked with its most similar partner alone; the confirmed links make components, which take in nearly all of a group
of near copies at about one link for each. Then only classes of different components are compared: in each bucket, all
classes but those of its largest component visit every block, so no link between components is lost, and a bucket's
rows grow with the classes that are still apart, not with the square of its size.

Joins by a key that many rows share (a set that is copied, a text that many are compared with, the smallest node of a
component) broadcast a counted small table, or else deal the key's rows out (`common.lookup`, `salted`).

Defined results: null text or a text without words has an empty set and is linked with nothing; a row with a null id
is linked with nothing, has a null component and is kept; rows that repeat an id are one node; equal rows get equal
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.common import BROADCAST_IDS, Words, at_most, lookup, slices, utf8, written

WIDTH, T = 5, 384
#: Chances of a pair at the threshold to be lost, by all bands and by its sketch.
MISS = 1.5e-6
PERCENT, BLOCK = 85, 512
#: A text is sent once for each so many pairs that it leads.
PAIRS_PER_COPY = 1024
U = np.uint64
#: Odd multipliers, one for each place in a shingle and each coordinate in a band.
PLACE = np.array([xxhash.xxh3_64_intdigest(f"place {k}") | 1 for k in range(64 + T)], U)
ROUND = np.array([xxhash.xxh3_64_intdigest(f"round {k}") for k in range(2 * T)], U)


@cache
def banding(percent: int) -> tuple[int, int]:
    """(rows, bands): the widest bands that all miss a pair of this similarity with a chance of at most MISS."""
    for rows in range(64, 0, -1):
        if (1 - (percent / 100) ** rows) ** (T // rows) <= MISS:
            return rows, T // rows
    raise ValueError(f"{T} coordinates can't find pairs of similarity {percent} per cent")


@cache
def least_agree(percent: int) -> int:
    """The most coordinates that a pair of this similarity falls short of with a chance of at most MISS."""
    j, below = percent / 100, 0.0
    for k in range(T):
        below += comb(T, k) * j**k * (1 - j) ** (T - k)
        if below > MISS:
            return k
    return T


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The set of each text as sorted distinct 64-bit hashes."""
    data, starts = utf8(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    words = Words(data, starts)
    number, distinct = words.numbers()
    value = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], U)[number] if len(number) else np.zeros(0, U)
    n = len(value)
    whole = np.zeros(max(n - width + 1, 0), U)
    for k in range(width):
        whole += value[k : n - width + 1 + k] * PLACE[k] if len(whole) else whole
    whole = mixed(whole)
    out = []
    for a, b in zip(words.at[:-1].tolist(), words.at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            out.append(mixed(np.array([(value[a:b] * PLACE[: b - a]).sum(dtype=U) + U(b - a)], U)))
        else:
            out.append(np.zeros(0, U))
    return out


def sketches(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """A row of t coordinates for each set; an empty set's are all the largest number."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    x = np.concatenate(sets) if n else np.zeros(0, U)
    row = np.repeat(np.arange(n), size)
    empty = U(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * t, empty, U)
    for k in range(2 * t):
        if not len(x):
            break
        v = mixed(x ^ ROUND[k])
        place = row * t + (((v >> U(32)) * U(t)) >> U(32)).astype(np.int64) if k < t else row * t + (k - t)
        np.minimum.at(out, place, (U(k) << U(32)) | (v & U(0xFFFFFFFF)))
        if k < 12 or k % 8 == 7 or k >= t:
            unfilled = (out.reshape(n, t) == empty).any(axis=1)
            stay = unfilled[row]
            x, row = x[stay], row[stay]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    parts = sketch[:, : rows * bands].reshape(len(sketch), bands, rows)
    return mixed((mixed(parts) * PLACE[:rows]).sum(axis=2, dtype=U) + PLACE[64 : 64 + bands])


SIGNATURE = "id long, n long, set_hash binary, bands array<long>, sketch binary"


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """id, set size, a 128-bit hash of the set, band keys, and 8 bits of each coordinate of the sketch."""
    per_band, bands = banding(percent)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), width)
            sketch = sketches(sets)
            keys = band_keys(sketch, per_band, bands).astype(np.int64)
            low = mixed(sketch).astype(np.uint8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), lists, pa.array([r.tobytes() for r in low], pa.binary())],
                names=["id", "n", "set_hash", "bands", "sketch"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, SIGNATURE)


def partners(n: np.ndarray, c: np.ndarray, visits: np.ndarray, sketch: np.ndarray, keys: np.ndarray | None, band: int, best: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of one block that may be linked; with best, each row and its most similar partner alone.

    Without best, those that visit the block are compared with those that live there, and a pair is given only in the
    first band that it shares, by the whole keys of the bands: 8 bits of a coordinate may agree by chance.
    """
    left, right, least = [], [], least_agree(percent)
    for i in range(len(n)) if best else np.flatnonzero(visits).tolist():
        may = (c != c[i]) & ~visits & (np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent)
        j = np.flatnonzero(may)
        if not len(j):
            continue
        same = sketch[j] == sketch[i]
        agree = same.sum(axis=1)
        if best:
            j = j[[agree.argmax()]] if agree.max() >= least else j[:0]
        else:
            enough = agree >= least
            j = j[enough]
            j = j[(keys[j] == keys[i]).argmax(axis=1) == band]
        left += [i] * len(j)
        right += j.tolist()
    return np.array(left, np.int64), np.array(right, np.int64)


def candidates(crowd: DataFrame, best: bool, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of rows (key, band, members, id, n, c, sketch, bands) that share a key, differ in c and may be linked.

    Without best, the rows may tell in `largest` the component that most of their bucket's rows have, which stay in
    their blocks; all others visit all blocks.
    """
    width = banding(percent)[1]
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = crowd.withColumns({"block": F.pmod(F.xxhash64("id", "key"), blocks.cast("long")).cast("int"), "visits": F.lit(False)})
    if not best:
        largest = F.col("largest") if "largest" in crowd.columns else F.lit(None)
        apart = rows.filter(~F.col("c").eqNullSafe(largest)).withColumns({"block": F.explode(F.sequence(F.lit(0), blocks - 1)), "visits": F.lit(True)})
        rows = rows.unionByName(apart)
    rows = rows.select("key", "band", "block", "visits", "id", "n", "c", "sketch", *([] if best else ["bands"])).repartition("key", "block").sortWithinPartitions("key", "block", "id")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _then_none(batches):
            if batch is None:
                whole, end = held, held.num_rows if held is not None else 0
            else:
                whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                end = -1
            if whole is None or not whole.num_rows:
                continue
            key, band, block, visits, ids, n, c = (whole.column(k).to_numpy(zero_copy_only=False) for k in ("key", "band", "block", "visits", "id", "n", "c"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(key)] if end >= 0 else []]).astype(np.int64)
            sketch = np.frombuffer(b"".join(whole.column("sketch").slice(0, bounds[-1]).to_pylist()), np.uint8).reshape(-1, T)
            keys = None if best else whole.column("bands").slice(0, bounds[-1]).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            found = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if hi - lo > 1:
                    x, y = partners(n[lo:hi], c[lo:hi], visits[lo:hi], sketch[lo:hi], None if best else keys[lo:hi], int(band[lo]), best, percent)
                    found.append((ids[lo + x], ids[lo + y]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            held = whole.slice(int(bounds[-1])) if end < 0 else None

    return rows.mapInArrow(step, "a long, b long").distinct()


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets have the similarity. docs: (id, text)."""
    needed = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id")
    if at_most(needed):
        needed = F.broadcast(needed)
    texts = written(docs.join(needed, "id", "left_semi"), "near-texts")
    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t_{x}"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t_b"):
            a = part.column("t_a").dictionary_encode()
            sets_a, sets_b = shingle_sets(a.dictionary, width), shingle_sets(part.column("t_b"), width)
            keep = []
            for i, y in zip(a.indices.to_pylist(), sets_b, strict=True):
                common = len(np.intersect1d(sets_a[i], y, assume_unique=True))
                keep.append(100 * common >= percent * (len(sets_a[i]) + len(y) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # members first: their texts are as many as the pairs, the leaders' are few
    both = salted(salted(pairs, pairs, side("b"), "b", "a"), pairs, side("a"), "a", "b")
    return both.select("a", "b", "t_a", "t_b").mapInArrow(step, "a long, b long")


def salted(rows: DataFrame, pairs: DataFrame, texts: DataFrame, key: str, other: str) -> DataFrame:
    """rows, those of pairs and more, joined with texts by key; a text that is in many pairs comes once for each PAIRS_PER_COPY."""
    heavy = pairs.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_COPY).cast("int").alias("copies")).filter("copies > 1")
    heavy = written(heavy, "near-heavy")
    if heavy.isEmpty():
        return rows.join(texts, key)
    heavy = F.broadcast(heavy) if at_most(heavy) else heavy
    copies = F.coalesce("copies", F.lit(1))
    dealt = rows.join(heavy, key, "left").withColumn("copy", F.pmod(F.xxhash64(other), copies).cast("int")).drop("copies")
    sent = texts.join(heavy, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    return dealt.join(sent, [key, "copy"]).drop("copy")


def components(edges: DataFrame, name: str = "near") -> DataFrame:
    """(node, component) of all nodes that are not the smallest of their component. edges: (a, b).

    Alternates two steps until nothing changes: every larger neighbour of a node, then the node and its smaller
    neighbours, are linked to the smallest of them. Each round ends in a written table.
    """

    def star(e: DataFrame, larger: bool, few: bool) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not larger:
            both = both.filter("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
        least = least if few else written(least, f"{name}-least")
        out = (both.join(F.broadcast(least.drop("n")), "u") if few else lookup(both, least, "u", "n")).filter("v > u" if larger else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            out = out.union(least.select("u", F.col("m").alias("v")))
        return out.distinct()

    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
        few = 2 * now[0] <= BROADCAST_IDS  # nodes, each of them at an end of an edge
        e = written(star(star(e, True, few), False, few), name)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One row for each document: id_col, n_shingles, component_id (the smallest id reachable), kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sig = written(signatures(rows, id_col="id", percent=percent, width=width), "near-signatures")
    usable = sig.filter("n > 0 and id is not null")
    copied = written(usable.groupBy("set_hash").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "near-copied")
    # rows that repeat an id with other words tie their classes together
    split = written(usable.groupBy("id").agg(F.min("set_hash").alias("lo"), F.max("set_hash").alias("hi")).filter("lo < hi").select("id"), "near-split")
    classes = written(lookup(usable, copied, "set_hash", "copies").filter("first is null or first = id").select("id", "n", "bands", "sketch"), "near-classes")
    buckets = classes.select("id", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    crowd = written(buckets.join(shared, "key"), "near-buckets")
    sketch = written(classes.select("id", "n", "sketch", "bands").join(crowd.select("id").distinct(), "id", "left_semi"), "near-sketches")

    first = written(candidates(crowd.join(sketch.drop("bands"), "id").withColumn("c", F.col("id")), True, percent), "near-pairs")
    labels = components(confirmed(first, rows, percent, width))

    # what this hasn't joined: classes of different components that share a bucket
    crowd = crowd.join(labels, crowd["id"] == labels["node"], "left").select("key", "band", "members", "id", F.coalesce("component", "id").alias("c"))
    most = crowd.groupBy("key", "c").agg(F.count(F.lit(1)).alias("here")).groupBy("key").agg(F.max_by("c", F.struct("here", "c")).alias("largest"), F.count(F.lit(1)).alias("apart"))
    torn = crowd.join(most.filter("apart > 1").drop("apart"), "key").join(sketch, "id")
    rest = candidates(torn, False, percent).join(first, ["a", "b"], "left_anti")
    more = confirmed(written(rest, "near-pairs"), rows, percent, width)
    links = labels.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more)
    if not split.isEmpty():
        ties = lookup(usable.join(split, "id", "left_semi"), copied, "set_hash", "copies").filter("first is not null")
        links = links.union(ties.select(F.col("first").alias("a"), F.col("id").alias("b")))
    labels = components(links)

    out = lookup(sig.select("id", "n", "set_hash"), copied, "set_hash", "copies")
    out = out.withColumn("class", F.when(F.col("n") > 0, F.coalesce("first", "id")).otherwise(F.col("id")))
    named = copied.groupBy(F.col("first").alias("class")).agg(F.sum("copies").alias("copies")).join(labels.withColumnRenamed("node", "class"), "class")
    alone = labels.join(copied.select(F.col("first").alias("node")).distinct(), "node", "left_anti").select(F.col("node").alias("class"), F.lit(1).cast("long").alias("copies"), "component")
    out = lookup(out, written(named.unionByName(alone), "near-named"), "class", "copies")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """docs with one row of each group of near duplicates, that of the smallest id; all columns as they are."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **settings)
    dropped = written(found.filter(~F.col("kept")).select(id_col).distinct(), "near-dropped")
    if at_most(dropped):
        dropped = F.broadcast(dropped)
    left = docs.join(dropped, id_col, "left_anti")
    repeated = left.groupBy(id_col).agg(F.count(F.lit(1)).alias("rows")).filter(f"rows > 1 and {id_col} is not null").select(id_col)
    if repeated.isEmpty():
        return left.select(docs.columns)
    names = docs.columns
    rows = left.join(repeated, id_col, "left_semi").select(F.struct(*names).alias("row"), F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    one = rows.withColumn("place", F.row_number().over(W.partitionBy("key").orderBy("text"))).filter("place = 1").select("row.*")
    return left.join(repeated, id_col, "left_anti").select(names).union(one)
