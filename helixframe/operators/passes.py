"""One Arrow pass over each text, where Spark's expressions would need a string or a regular expression for each base.

All work is a row's own, so nothing is shuffled; counts over all rows are added up before they leave a task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a step works on, whatever an Arrow batch holds; a longer text is a step of its own.
STEP_BYTES = 1 << 20
BASES = "ACGT"
CODES = np.full(256, 4, np.uint8)
for _k, _b in enumerate(BASES):
    CODES[[ord(_b), ord(_b.lower())]] = _k
#: Kinds of a pair of bases, 0 equal, 1 transition (A and G, C and T), 2 transversion; 3 where either is no base.
KIND = np.full((5, 5), 2, np.uint8)
KIND[range(4), range(4)] = 0
KIND[[0, 2, 1, 3], [2, 0, 3, 1]] = 1
KIND[4], KIND[:, 4] = 3, 3
#: Stop codons TAA, TAG and TGA, as base codes in base 4.
STOPS = np.isin(np.arange(64), [3 * 16, 3 * 16 + 2, 3 * 16 + 2 * 4])


def steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows of the batches, cut where a column has reached STEP_BYTES."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at = to


def codes(text: str | None) -> np.ndarray:
    return CODES[np.frombuffer((text or "").encode("latin-1", "replace"), np.uint8)]


def words(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The code in base 4 of each window of k bases, and whether it is of bases alone."""
    n = len(x) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    code, good = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(k):
        code = code * 4 + x[j : j + n]
        good &= x[j : j + n] < 4
    return code, good


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all texts, a break after each, and the text of each code."""
    parts = [np.append(codes(t), np.uint8(4)) for t in texts.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def over(rows: DataFrame, key: str, texts: list[str], schema: str, of: Callable[[list[pa.Array]], list[np.ndarray]]) -> DataFrame:
    """(key, ...): what `of` gives for the text columns of each step, as columns of schema."""
    names = [c.split()[0] for c in schema.split(", ")]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "t0"):
            found = of([part.column(f"t{k}") for k in range(len(texts))])
            yield pa.RecordBatch.from_arrays([part.column("key"), *(c if isinstance(c, pa.Array) else pa.array(c) for c in found)], names=["key", *names])

    slim = rows.select(F.col(key).cast("long").alias("key"), *(F.col(t).cast("string").alias(f"t{k}") for k, t in enumerate(texts)))
    return slim.mapInArrow(step, f"key long, {schema}").withColumnRenamed("key", key)


def entropy(counts: np.ndarray) -> np.ndarray:
    """Shannon's entropy in bits of each row of counts; 0 without any."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    return -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1) + 0.0


def with_entropies(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, h1, h2): entropies of bases and of overlapping pairs of bases."""

    def of(texts: list[pa.Array]) -> list[np.ndarray]:
        x, text = joined(texts[0])
        n, out = len(texts[0]), []
        for k in (1, 2):
            code, good = words(x, k)
            counts = np.bincount(text[: len(code)][good] * 4**k + code[good], minlength=n * 4**k).reshape(n, 4**k)
            out.append(entropy(counts))
        return out

    return over(rows, key, [seq], "h1 double, h2 double", of)


def kmer_totals(rows: DataFrame, seq: str, sizes: tuple[int, ...]) -> DataFrame:
    """(kmer, n) over all rows, for k-mers of bases of each size; small sizes, whose counts are arrays of 4 ** k."""
    names = {k: ["".join(BASES[(c >> 2 * (k - 1 - j)) & 3] for j in range(k)) for c in range(4**k)] for k in sizes}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros(4**k, np.int64) for k in sizes}
        for part in steps(batches, "seq"):
            x, _ = joined(part.column("seq"))
            for k in sizes:
                code, good = words(x, k)
                totals[k] += np.bincount(code[good], minlength=4**k)
        found = [(names[k][c], int(totals[k][c])) for k in sizes for c in np.flatnonzero(totals[k])]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["kmer", "n"])

    return rows.select(F.col(seq).alias("seq")).mapInArrow(step, "kmer string, n long").groupBy("kmer").agg(F.sum("n").alias("n"))


def kmer_sets(rows: DataFrame, key: str, seq: str, k: int, canonical: bool) -> DataFrame:
    """(key, kmers): the distinct k-mers of bases of each sequence as ascending numbers in base 4 (A, C, G, T); k up to 31.

    canonical: of a k-mer and its reverse complement, the smaller.
    """

    def of(texts: list[pa.Array]) -> list[pa.Array]:
        sets = []
        for t in texts[0].to_pylist():
            x = codes(t)
            code, good = words(x, k)
            if canonical and len(code):
                other, _ = words(3 - np.minimum(x, 3)[::-1], k)
                code = np.minimum(code, other[::-1])
            sets.append(np.unique(code[good]))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]), pa.int32()), pa.array(flat))]

    return over(rows, key, [seq], "kmers array<long>", of)


def kmer_profiles(rows: DataFrame, key: str, seq: str, k: int) -> DataFrame:
    """(key, counts, norm): how often each of the 4 ** k k-mers of bases occurs, and the root of the sum of squares; small k."""

    def of(texts: list[pa.Array]) -> list[pa.Array]:
        x, text = joined(texts[0])
        n = len(texts[0])
        code, good = words(x, k)
        counts = np.bincount(text[: len(code)][good] * 4**k + code[good], minlength=n * 4**k)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 4**k, pa.int32()), pa.array(counts, pa.int64()))
        return [lists, pa.array(np.sqrt((counts.reshape(n, 4**k).astype(float) ** 2).sum(axis=1)))]

    return over(rows, key, [seq], "counts array<long>, norm double", of)


def with_divergence(pairs: DataFrame, key: str, query: str, subject: str) -> DataFrame:
    """(key, sites, transitions, transversions, cpg_sites, cpg_transitions) of aligned pairs over the shorter length.

    Columns in which the subject has a gap are left out. Sites are columns of two bases. cpg_transitions counts, of the
    transitions at a C and G that follow each other in the subject, two as one and one alone as a tenth.
    """

    def of(texts: list[pa.Array]) -> list[np.ndarray]:
        rows = []
        for q, s in zip(*(t.to_pylist() for t in texts), strict=True):
            n = min(len(q or ""), len(s or ""))
            x, y = codes((q or "")[:n]), codes((s or "")[:n])
            if "-" in (s or ""):
                present = np.frombuffer(s[:n].encode("latin-1", "replace"), np.uint8) != ord("-")
                x, y = x[present], y[present]
            kind = KIND[x, y]
            moved = kind == 1
            at = np.flatnonzero((y[:-1] == 1) & (y[1:] == 2))
            both = moved[at].astype(np.int64) + moved[at + 1]
            rows.append((int((kind < 3).sum()), int(moved.sum()), int((kind == 2).sum()), len(at), float(moved.sum() - both.sum() + (both == 2).sum() + 0.1 * (both == 1).sum())))
        return [pa.array([r[k] for r in rows], pa.int64() if k < 4 else pa.float64()) for k in range(5)]

    return over(pairs, key, [query, subject], "sites long, transitions long, transversions long, cpg_sites long, cpg_transitions double", of)


def offset_identity(a: str | None, b: str | None, exact: bool = False) -> float:
    """The best share of equal letters of the shorter text at an offset into the longer.

    Offsets go in steps of a hundredth of their range; exact: one by one.
    """
    short, long = sorted((np.frombuffer((t or "").encode("latin-1", "replace"), np.uint8) for t in (a, b)), key=len)
    if not len(short):
        return 0.0
    spots = len(long) - len(short) + 1
    return max(int((short == long[i : i + len(short)]).sum()) for i in range(0, spots, 1 if exact else max(1, spots // 100))) / len(short)


def with_offset_identity(pairs: DataFrame, key: str, a: str, b: str, exact: bool = False) -> DataFrame:
    """(key, identity) of offset_identity."""

    def of(texts: list[pa.Array]) -> list[np.ndarray]:
        return [pa.array([offset_identity(x, y, exact) for x, y in zip(*(t.to_pylist() for t in texts), strict=True)], pa.float64())]

    return over(pairs, key, [a, b], "identity double", of)


def with_terminal_repeat(rows: DataFrame, key: str, seq: str, shares: tuple[float, ...], least: int, most: int) -> DataFrame:
    """(key, similarity, repeat_length): the most alike head and tail among those of these shares of a sequence's length.

    Alike means equal letter by letter. Heads of less than `least` or more than `most` letters are not tried; the
    shorter wins ties.
    """

    def of(texts: list[pa.Array]) -> list[np.ndarray]:
        found = []
        for t in texts[0].to_pylist():
            x = np.frombuffer((t or "").encode("latin-1", "replace"), np.uint8)
            best = (0.0, 0)
            for share in shares:
                n = int(len(x) * share)
                if least <= n <= most and n and (alike := float((x[:n] == x[len(x) - n :]).mean())) > best[0]:
                    best = (alike, n)
            found.append(best)
        return [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())]

    return over(rows, key, [seq], "similarity double, repeat_length long", of)


def longest_open_frame(seq: str | None) -> int:
    """Bases of the longest run of whole codons without a stop in any of the six frames."""
    x, best = codes(seq), 0
    for strand in (x, np.where(x < 4, 3 - x, 4)[::-1]):
        code, good = words(strand, 3)
        stop = good & STOPS[np.where(good, code, 0)]
        for frame in range(3):
            cuts = np.concatenate([[-1], np.flatnonzero(stop[frame::3]), [len(stop[frame::3])]])
            best = max(best, 3 * int(np.diff(cuts).max() - 1))
    return best


def with_open_frame(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, open_frame) of longest_open_frame."""
    return over(rows, key, [seq], "open_frame long", lambda texts: [pa.array([longest_open_frame(t) for t in texts[0].to_pylist()], pa.int64())])


#: Runs that are simple (five equal bases, four equal pairs), and tandem repeats of units of 3 to 6, or 2 to 50.
SIMPLE = re.compile(r"A{5,}|C{5,}|G{5,}|T{5,}|N{5,}|(?:AT){4,}|(?:TA){4,}|(?:GC){4,}|(?:CG){4,}|(?:AC){4,}|(?:CA){4,}|(?:GT){4,}|(?:TG){4,}|(?:AG){4,}|(?:GA){4,}|(?:CT){4,}|(?:TC){4,}")
SHORT_UNITS, LONG_UNITS = range(3, 7), range(2, 51)


def tandem_cover(seq: str, units: range, times: int = 3) -> int:
    """Letters that lie in `times` or more equal copies in a row of a unit of one of these lengths; units with N don't count.

    A letter that equals the one a unit's length before it goes on with a repeat; runs of such letters that are long
    enough, with the unit before them, are repeats.
    """
    x = np.frombuffer(seq.upper().encode("latin-1", "replace"), np.uint8)
    covered = np.zeros(len(x) + 1, np.int64)
    for u in units:
        if len(x) < u * times:
            break
        same = (x[u:] == x[:-u]) & (x[u:] != ord("N"))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        start, end = edges[::2], edges[1::2]
        far = end - start >= u * (times - 1)
        np.add.at(covered, start[far], 1)
        np.add.at(covered, end[far] + u, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def with_repeats(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, simple, tandem, tandem_long): shares of a sequence in simple runs, and in tandem repeats of short and of any units."""

    def of(texts: list[pa.Array]) -> list[np.ndarray]:
        found = []
        for t in texts[0].to_pylist():
            t = (t or "").upper()
            n = max(len(t), 1)
            covered, at = 0, 0
            for s, e in sorted(m.span() for m in SIMPLE.finditer(t)):
                covered += max(0, e - max(s, at))
                at = max(at, e)
            found.append((covered / n, tandem_cover(t, SHORT_UNITS) / n, tandem_cover(t, LONG_UNITS) / n))
        return [pa.array([f[k] for f in found], pa.float64()) for k in range(3)]

    return over(rows, key, [seq], "simple double, tandem double, tandem_long double", of)


def has_terminal_repeat(seq: str | None, least: int = 80, most: int = 500, identity: float = 0.75) -> bool:
    """Whether some head of least..min(most, a third) letters is alike to the tail of its length, letter by letter."""
    x = np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)
    return any(float((x[:n] == x[len(x) - n :]).mean()) >= identity for n in range(least, min(most, len(x) // 3) + 1))


def with_terminal_flags(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, ltr) of has_terminal_repeat."""
    return over(rows, key, [seq], "ltr boolean", lambda texts: [pa.array([has_terminal_repeat(t) for t in texts[0].to_pylist()], pa.bool_())])


def position_scores(query: str, subject: str, scores: np.ndarray, opening: float, extension: float) -> np.ndarray:
    """The score of an alignment up to each column; scores is a 256 by 256 table by query and subject letter."""
    q, s = (np.frombuffer(t.encode("latin-1", "replace"), np.uint8) for t in (query, subject))
    cost = lambda gap: np.where(np.concatenate([[False], gap[:-1]]), -extension, -opening)
    in_s, in_q = s == ord("-"), q == ord("-")
    return np.cumsum(np.select([in_s, in_q], [cost(in_s), cost(in_q)], scores[q, s]))


def x_drop_fragments(scores: list[float], drop: float, least: int = 5) -> list[tuple[int, int]]:
    """(first, last) columns of the parts that a search giving up `drop` below its best score would report.

    A part starts anew where its score falls under 0; what is left at the end counts if it spans more than `least`.
    """
    out, base, best, start, at = [], 0.0, 0.0, 0, 0
    for i, total in enumerate(scores):
        score = total - base
        if score < 0:
            base, start, score, best = total, i, 0.0, 0.0
        if score >= best:
            best, at = score, i
        elif best - score > drop:
            out.append((start, at))
            base, start, best, at = total, i + 1, 0.0, i + 1
    return [*out, (start, at)] if at - start > least else out


def with_x_drop(pairs: DataFrame, key: str, query: str, subject: str, scores: dict[str, float], opening: float, extension: float, drop: float) -> DataFrame:
    """(key, raw, fragments): the score of each alignment, and its x-drop fragments as structs of first and last column."""
    table = np.zeros((256, 256))
    for w, v in scores.items():
        table[ord(w[0]), ord(w[1])] = v

    def of(texts: list[pa.Array]) -> list[pa.Array]:
        raw, flat, sizes = [], [], []
        for q, s in zip(*(t.to_pylist() for t in texts), strict=True):
            upto = position_scores(q or "", s or "", table, opening, extension)
            found = x_drop_fragments(upto.tolist(), drop)
            raw.append(float(upto[-1]) if len(upto) else 0.0)
            flat += found
            sizes.append(len(found))
        parts = pa.StructArray.from_arrays([pa.array([f[k] for f in flat], pa.int64()) for k in (0, 1)], ["first", "last"])
        return [pa.array(raw), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), parts)]

    return over(pairs, key, [query, subject], "raw double, fragments array<struct<first:long,last:long>>", of)


def with_gap_counts(pairs: DataFrame, key: str, query: str, subject: str) -> DataFrame:
    """(key, columns, sites, transitions, transversions, gaps) of aligned pairs; gaps are columns in which one row alone has one."""

    def of(texts: list[pa.Array]) -> list[np.ndarray]:
        rows = []
        for q, s in zip(*(t.to_pylist() for t in texts), strict=True):
            a, b = (np.frombuffer((t or "").encode("latin-1", "replace"), np.uint8) for t in (q, s))
            kind = KIND[CODES[a], CODES[b]]
            gap_a, gap_b = a == ord("-"), b == ord("-")
            rows.append((len(b), int((kind < 3).sum()), int((kind == 1).sum()), int((kind == 2).sum()), int((gap_a ^ gap_b).sum())))
        return [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]

    return over(pairs, key, [query, subject], "columns long, sites long, transitions long, transversions long, gaps long", of)
