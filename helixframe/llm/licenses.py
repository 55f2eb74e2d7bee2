"""Licence scans: MinHash bands over overlapping windows, confirmed by exact containment of shingles.

Words are runs of letters and digits, lower-cased in A-Z; shingles are `WIDTH` of them. Texts are read in windows of
W shingles, each overlapping half of the next, for W of SIZES; templates of at least W + W // 2 - 1 shingles are
indexed by their windows of W shingles at every offset (each template by its largest such W). So an unchanged copy of
a template holds a window that equals one of the template's and collides for certain, and a window of similarity J
misses all bands with a chance of (1 - J ** ROWS) ** BANDS, under 3e-4 at 0.8.

A collision puts the template at a place in the text. There, in as many shingles as the template has and a fifth more
to both sides, at least `containment` of the template's distinct shingles must be found. A match spans those
of them that lie, but for that fifth, where the template has them from the place on that most agree on; only if these are too few, as in
a reordered text, it spans all. A match goes if most of its shingles are inside the spans of stronger ones.

Defined results: null text is empty and has no match; a null id stays; equal texts give equal results; an empty table
gives an empty result; other columns are not read. A template needs WIDTH words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Words, code_points, slices, utf8
from helixframe.llm.license_texts import TEMPLATES

WIDTH, SIZES, ROWS, BANDS, CONTAINMENT = 5, (1, 4, 16), 2, 8, 0.8
U = np.uint64
PLACE = np.array([xxhash.xxh3_64_intdigest(f"word {k}") | 1 for k in range(WIDTH)], U)
HASHES = np.array([xxhash.xxh3_64_intdigest(f"hash {k}") | 1 for k in range(ROWS * BANDS)], U)
LETTER = np.ones(256, bool)
LETTER[:128] = [chr(k).isalnum() for k in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bits of a table that most keys of texts fall through.
FILTER_BITS = 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x9FB21C651E98DF25)
    return x ^ (x >> U(32))


def shingled(texts: pa.Array) -> tuple[np.ndarray, Words, np.ndarray, np.ndarray]:
    """Shingles of all texts as hashes, their words, the first word of each shingle, and where each text's shingles start."""
    data, starts = utf8(texts)
    words = Words(np.where(LETTER[data], LOWER[data], np.uint8(32)), starts)
    number, distinct = words.numbers()
    value = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], U)[number] if len(number) else np.zeros(0, U)
    n = max(len(value) - WIDTH + 1, 0)
    hashes = np.zeros(n, U)
    for k in range(WIDTH):
        hashes += value[k : n + k] * PLACE[k]
    first = np.flatnonzero(words.text[:n] == words.text[WIDTH - 1 :]) if n else np.zeros(0, np.int64)
    counts = np.bincount(words.text[first], minlength=len(starts) - 1)
    return mixed(hashes[first]), words, first, np.concatenate([[0], np.cumsum(counts)])


def band_keys(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """BANDS keys for each window [start, start + size) of hashes; a window of one shingle has one key."""
    if size == 1:
        return mixed(hashes[starts] + U(1))[:, None]
    keys = np.zeros((len(starts), BANDS), U)
    for k, multiplier in enumerate(HASHES):
        value = mixed(hashes * multiplier)
        # minima of 2, 4, ... neighbours, as far as a window goes
        reach = 1
        while reach < size:
            value = np.minimum(value[:-reach], value[reach:])
            reach *= 2
        keys[:, k // ROWS] = keys[:, k // ROWS] * U(0x9E3779B97F4A7C15) + value[starts]
    return mixed(keys + np.arange(BANDS, dtype=U) * U(size * 2 + 1))


class Index:
    """Band keys of all windows of all templates."""

    def __init__(self, templates: dict[str, list[str]]) -> None:
        self.names = [(name, k) for name, texts in templates.items() for k in range(len(texts))]
        hashes, _, _, at = shingled(pa.array([t for texts in templates.values() for t in texts], pa.string()))
        self.shingles = [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.offsets: list[dict[int, list[int]]] = [defaultdict(list) for _ in self.shingles]
        for offsets, s in zip(self.offsets, self.shingles, strict=True):
            for k, h in enumerate(s.tolist()):
                offsets[h].append(k)
        self.sets = [frozenset(s.tolist()) for s in self.shingles]
        if not all(self.sets):
            raise ValueError(f"a template needs {WIDTH} words")
        found: dict[int, dict[int, list[tuple[int, int]]]] = {size: defaultdict(list) for size in SIZES}
        for t, s in enumerate(self.shingles):
            size = max(w for w in SIZES if len(s) >= w + w // 2 - 1 or w == 1)
            starts = np.arange(len(s) - size + 1)
            for offset, keys in zip(starts.tolist(), band_keys(s, starts, size).tolist(), strict=True):
                for key in keys:
                    found[size][key].append((t, offset))
        self.at = {size: dict(x) for size, x in found.items() if x}
        self.keys = {size: np.sort(np.array(list(x), U)) for size, x in self.at.items()}
        self.filters = {}
        for size, keys in self.keys.items():
            self.filters[size] = np.zeros(1 << FILTER_BITS, bool)
            self.filters[size][(keys >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def collisions(self, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, template, place) of all windows that share a band key with a template's; place is the template's first shingle."""
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        inside = np.arange(len(hashes)) - at[text]
        length = np.diff(at)[text]
        for size, known in self.at.items():
            step = max(1, size // 2)
            # windows at every step, and a last one that ends with the text
            starts = np.flatnonzero((inside + size <= length) & ((inside % step == 0) | (inside + size == length)))
            if not len(starts):
                continue
            keys = band_keys(hashes, starts, size)
            row, band = np.nonzero(self.filters[size][(keys >> U(64 - FILTER_BITS)).astype(np.int64)])
            for r, key in zip(row.tolist(), keys[row, band].tolist(), strict=True):
                for t, offset in known.get(key, ()):
                    yield int(text[starts[r]]), t, int(starts[r]) - offset

    def matches(self, texts: pa.Array, containment: float) -> list[list[tuple[str, int, int, float]]]:
        """For each text (name, start, end, containment) of what is found, by start; code points."""
        hashes, words, first, at = shingled(texts)
        found: dict[int, list] = defaultdict(list)
        seen: set[tuple[int, int, int]] = set()
        for i, t, place in self.collisions(hashes, at):
            n = len(self.shingles[t])
            slack = n // 5 + 2
            if (i, t, place // slack) in seen:
                continue
            seen.add((i, t, place // slack))
            lo, hi = max(int(at[i]), place - slack), min(int(at[i + 1]), place + n + slack)
            here = hashes[lo:hi].tolist()
            hits = [k for k, h in enumerate(here) if h in self.sets[t]]
            share = len({here[k] for k in hits}) / len(self.sets[t])
            if share >= containment:
                # the place that most hits agree on; the collision's may be off by a repeated phrase
                place = Counter(lo + k - o for k in hits for o in self.offsets[t][here[k]]).most_common(1)[0][0]
                own = [k for k in hits if any(abs(lo + k - o - place) <= slack for o in self.offsets[t][here[k]])]
                aligned = len({here[k] for k in own}) >= containment * len(self.sets[t])
                own = own if aligned else hits
                found[i].append((len({here[k] for k in own}), share, t, lo + own[0], lo + own[-1] + 1, [lo + k for k in own], not aligned))
        points = code_points(words.data)
        out: list[list[tuple[str, int, int, float]]] = []
        for i in range(len(at) - 1):
            kept: list[tuple] = []
            for m in sorted(found.get(i, ()), key=lambda m: (-m[0] * m[1], -m[1], m[6], m[2], m[3])):
                if 2 * sum(any(k[3] <= x < k[4] for k in kept) for x in m[5]) <= len(m[5]):
                    kept.append(m)
            base = int(points[words.starts[i]])
            spans = sorted((int(points[words.start[first[lo]]]) - base, int(points[words.end[first[hi - 1] + WIDTH - 1]]) - base, self.names[t][0], share) for _, share, t, lo, hi, *_ in kept)
            out.append([(name, s, e, share) for s, e, name, share in spans])
        return out


def find_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """One row for each text: id_col, n_matches, licenses (distinct, comma-joined), matches (name:start:end:containment, comma-joined)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for part in slices(batches, "text"):
            index = index or Index(templates)
            found = index.matches(part.column("text"), containment)
            columns = [pa.array([len(m) for m in found], pa.int64()), pa.array([",".join(sorted({x[0] for x in m})) for m in found], pa.string()), pa.array([",".join(f"{name}:{s}:{e}:{share:.3f}" for name, s, e, share in m) for m in found], pa.string())]
            yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", "n_matches", "licenses", "matches"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, "id long, n_matches long, licenses string, matches string").withColumnRenamed("id", id_col)
