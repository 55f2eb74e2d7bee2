"""Suffix-array repetition rules for texts.

The words of a text are the symbols; in scripts that put no spaces between words (UNSPACED), each code point is one
by itself, whatever the length of the run that it stands in. A suffix array over each text, built by prefix doubling,
gives the longest common prefixes of neighbouring suffixes; their intervals are the maximal repeated substrings. The
spans of those of at least `min_words` symbols are united, and a text fails if they cover more than `max_covered` of
its word characters or if the longest repeat has more than `max_longest` symbols.

Base rules, too: few words, or many words in repeated three-word windows.

Defined results: null text counts as text without words, which fails the base rules; a null id stays; equal rows
get equal results, each its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Words, code_points, slices, utf8

MIN_WORDS, MAX_COVERED, MAX_LONGEST = 10, 0.35, 120
#: First and last code points of scripts written without spaces (Thai and Lao, Burmese, Khmer, radicals,
#: kana, ideographs, compatibility and supplementary ideographs).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

SCHEMA = "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, repeat_chars long, repeat_share double, longest_repeat long, n_repeats long, spans array<struct<start: long, end: long>>"


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Positions in the order of their suffixes, their ranks, and the ranks by the first 1, 2, 4, ... symbols.

    Doubling sorts only positions whose prefix is not unique yet.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    value = symbols[order]
    fresh = np.concatenate([[True], value[1:] != value[:-1]]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    small = np.int32 if n < 1 << 31 else np.int64
    levels, width = [rank.astype(small)], 1
    while True:
        last = np.concatenate([fresh[1:], [True]]) if n else fresh
        open_at = np.flatnonzero(~(fresh & last))
        if not len(open_at):
            return order, rank, levels
        at = order[open_at]
        ahead = at + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        sub = np.lexsort((second, rank[at]))
        order[open_at] = at = at[sub]
        second, group = second[sub], rank[at]
        fresh[open_at[1:]] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        fresh[open_at[0]] = True
        starts = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[order[open_at]] = starts[open_at]
        levels.append(rank.astype(small))
        width *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """For each place in the order, the symbols that its suffix shares with the one before."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    at = np.arange(1, n)
    live = at[levels[0][order[1:]] == levels[0][order[:-1]]]
    a, b, got = order[live].copy(), order[live - 1].copy(), np.zeros(len(live), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(live), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = np.where(same, 1 << k, 0)
        a, b, got = a + step, b + step, got + step
    lcp[live] = got
    return lcp


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, symbols: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first place, last place) of each LCP interval of at least `least` symbols whose occurrences don't all follow the same symbol."""
    found, n = [], len(order)
    before = np.where(order > 0, symbols[order - 1], -1 - order)
    turn = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])]) if n else before
    deep = np.flatnonzero(lcp >= least)
    if not len(deep):
        return found
    breaks = np.flatnonzero(np.diff(deep) > 1)
    for lo, hi in zip(deep[np.concatenate([[0], breaks + 1])], deep[np.concatenate([breaks, [len(deep) - 1]])], strict=True):
        stack: list[tuple[int, int]] = []
        for i in range(lo, hi + 2):
            depth, left = (int(lcp[i]) if i <= hi else 0), i - 1
            while stack and stack[-1][0] > depth:
                length, left = stack.pop()
                if turn[left] != turn[i - 1]:
                    found.append((length, left, i - 1))
            if depth >= least and (not stack or stack[-1][0] < depth):
                stack.append((depth, left))
    return found


def unspaced(data: np.ndarray) -> np.ndarray:
    """Bytes at which a code point of UNSPACED starts."""
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return lead
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    tail = [padded[lead + k] & 0x3F for k in range(1, 4)]
    three = (padded[lead] & 0x0F) << 12 | tail[0] << 6 | tail[1]
    code = np.where(data[lead] < 0xF0, three, (padded[lead] & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2])
    return lead[np.any([(code >= a) & (code <= b) for a, b in UNSPACED], axis=0)]


def symbols_of(words: Words, data: np.ndarray) -> Words:
    """The symbols of the texts: words, cut before and after each code point of a script without spaces."""
    points = unspaced(data)
    if not len(points):
        return words
    after = points + np.where(data[points] < 0xF0, 3, 4)
    return Words(data, words.starts, np.union1d(points, after[after < len(data)]))


def own_symbols(number: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Symbols as small numbers that no two texts share, so that no repeat spans two texts."""
    _, value = np.unique(number, return_inverse=True)
    return text * (int(value.max(initial=0)) + 1) + value


def covered(start: np.ndarray, reach: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the spans of symbols [start, reach), sorted by start, text by text."""
    if not len(start):
        return start, reach
    upto = np.maximum.accumulate(reach)
    new = np.concatenate([[True], (start[1:] > upto[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    return start[first], upto[np.concatenate([first[1:] - 1, [len(start) - 1]])]


def repeated_words(number: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Which words are in a window of so many words that its text has twice or more."""
    n = len(number)
    hit = np.zeros(n, bool)
    if n < width:
        return hit
    key = own_symbols(number, text)
    whole = text[: n - width + 1] == text[width - 1 :]
    for k in range(1, width):
        _, key = np.unique(key[:-1] * (int(number.max()) + 1) + number[k:], return_inverse=True)
    starts = np.flatnonzero(whole)
    value, counts = key[starts], np.bincount(key[starts])
    again = starts[counts[value] > 1]
    for k in range(width):
        hit[again + k] = True
    return hit


def scan(ids: pa.Array, texts: pa.Array, min_words: int, max_covered: float, max_longest: int) -> pa.RecordBatch:
    data, starts = utf8(texts)
    n = len(starts) - 1
    words = Words(data, starts)
    points = code_points(data)
    per_text = lambda x, text: np.bincount(text, weights=x, minlength=n).astype(np.int64)
    n_words = words.count.astype(np.int64)
    word_chars = per_text(points[words.end] - points[words.start], words.text)
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    n_symbols = marks[starts[1:]] - marks[starts[:-1]]
    number, _ = words.numbers()
    n_repeat = per_text(repeated_words(number, words.text, 3), words.text)
    dup_lines = []
    for text in pc.fill_null(texts, "").to_pylist():
        lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
        dup_lines.append(len(lines) - len(set(lines)))

    symbols = symbols_of(words, data)
    start, end, text = symbols.start, symbols.end, symbols.text
    key = own_symbols(number if symbols is words else symbols.numbers()[0], text)
    order, _, levels = suffix_array(key)
    lcp = common_prefixes(order, levels)
    found = maximal_repeats(order, lcp, key, min_words)
    n_repeats, longest = np.zeros(n, np.int64), np.zeros(n, np.int64)
    reach = np.zeros(len(order), np.int64)
    if found:
        length, left, right = (np.array(x) for x in zip(*found, strict=True))
        of = text[order[left]]
        np.add.at(n_repeats, of, 1)
        np.maximum.at(longest, of, length)
        # the spans of all occurrences of all maximal repeats: each suffix reaches as far as its deepest interval
        deepest = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
        reach[order] = np.where(deepest >= min_words, deepest, 0)
    at = np.flatnonzero(reach)
    lo, hi = covered(at, at + reach[at], text[at])
    # a word's own characters count, white space between covered words does not
    size = np.concatenate([[0], np.cumsum(points[end] - points[start])])
    repeat_chars = per_text(size[hi] - size[lo], text[lo]) if len(lo) else np.zeros(n, np.int64)
    share = repeat_chars / np.maximum(word_chars, 1)
    base_failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~base_failed & (share <= max_covered) & (longest <= max_longest)

    base = points[starts[:-1]]
    of = text[lo] if len(lo) else np.zeros(0, np.int64)
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(points[start[lo]] - base[of], pa.int64()), pa.array(points[end[hi - 1]] - base[of], pa.int64())] if len(lo) else [pa.array([], pa.int64())] * 2, ["start", "end"]),
    )
    columns = [ids, n_words, word_chars, n_symbols, dup_lines, n_repeat, base_failed, kept, repeat_chars, share, longest, n_repeats, spans]
    names = [x.split()[0] for x in SCHEMA.split(", ")[:12]] + ["spans"]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)


def repetition(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row for each text: id_col, the counts, both verdicts, and `spans`, the united spans of its repeats in code points."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield scan(part.column("id").cast(pa.int64()), part.column("text"), min_words, max_covered, max_longest)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, SCHEMA).withColumnRenamed("id", id_col)
