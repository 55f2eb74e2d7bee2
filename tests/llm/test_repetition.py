"""Repetition rules against plain definitions."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from helixframe.llm import repetition as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text, min_words=10):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeat_chars, longest, n_repeats by definition."""
    text = text or ""
    found = list(WORD.finditer(text))
    w = [m[0] for m in found]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    hit, longest, repeats = set(), 0, 0
    n = len(w)
    substrings = {}
    for size in range(min_words, n):
        for i in range(n - size + 1):
            substrings.setdefault(tuple(w[i : i + size]), []).append(i)
    for x, at in substrings.items():
        if len(at) > 1:
            longest = max(longest, len(x))
            hit |= {i + k for i in at for k in range(len(x))}
            before = [w[i - 1] if i else None for i in at]
            after = [w[i + len(x)] if i + len(x) < n else None for i in at]
            differ = lambda side: len(set(side)) > 1 or side.count(None) > 1
            repeats += differ(before) and differ(after)
    return [n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again), sum(len(w[i]) for i in hit), longest, repeats]


def texts():
    rng = random.Random(1)
    out = [None, "", " \n\t", "a", "é ü\nß", "x y z x y z", "a " * 60, "a b " * 40, "\n".join(["same line here"] * 30)]
    for size in (5, 40, 80, 150):
        for letters in ("ab", "abcdef", "äöü#$é"):
            out.append(" ".join(rng.choice(letters) * rng.randint(1, 2) for _ in range(size)))
    block = [f"w{i}" for i in range(30)]
    out.append(" ".join(block + ["x"] + block + ["y"] + block[5:25] + ["z"] * 3))
    return out


def test_counts_and_repeats_match_definitions():
    rows = texts() + texts()[::-1]
    got = R.scan(pa.array(range(len(rows))), pa.array(rows, pa.string()), 10, 0.35, 120).to_pylist()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars", "longest_repeat", "n_repeats"]
    for text, row in zip(rows, got, strict=True):
        assert [row[k] for k in names] == plain(text), text
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert sum(len(WORD.sub(lambda m: m[0], (text or "")[s["start"] : s["end"]]).translate({32: None, 10: None, 9: None})) for s in row["spans"]) == row["repeat_chars"]


def test_text_without_white_space_is_scanned_by_code_points():
    block = "".join(chr(0x4E00 + i) for i in range(200))
    got = R.scan(pa.array([1, 2]), pa.array([block + "!" + block, block * 1], pa.string()), 10, 0.35, 120).to_pylist()
    assert got[0]["longest_repeat"] == 200 and got[0]["repeat_chars"] == 400 and got[0]["spans"] == [{"start": 0, "end": 200}, {"start": 201, "end": 401}]
    assert got[1]["n_repeats"] == 0


@pytest.mark.parametrize("length", [10, 64, 65, 1000])
def test_a_long_token_is_one_word_at_any_length(length):
    token = "".join(chr(97 + k * k % 23) for k in range(length))
    text = " ".join([*(f"word{i}" for i in range(60)), token, "between", token])
    got = R.scan(pa.array([1]), pa.array([text]), 10, 0.35, 120).to_pylist()[0]
    assert got["kept"] and got["longest_repeat"] == 0 and got["repeat_chars"] == 0
    # and its copies lie in repeats of words like any other word
    again = R.scan(pa.array([1]), pa.array([" ".join(text.split()[50:61]) + " " + text]), 10, 0.35, 120).to_pylist()[0]
    assert again["longest_repeat"] == 11


def test_unspaced_scripts_are_scanned_by_code_points_in_runs_of_any_length():
    block = "".join(chr(0x4E00 + i) for i in range(30))
    texts = [" ".join([*(f"w{i}" for i in range(60)), block, "x", block]), " ".join(["\u0e01\u0e02\U00020000\u3042" * 3, "é", "\uac00\uac01" * 40])]
    got = R.scan(pa.array([1, 2]), pa.array(texts), 10, 0.35, 120).to_pylist()
    assert got[0]["longest_repeat"] == 30 and got[0]["repeat_chars"] == 60
    assert got[1]["longest_repeat"] == 0 and R.scan(pa.array([1]), pa.array([texts[1]]), 8, 0.35, 120).to_pylist()[0]["longest_repeat"] == 8


@pytest.fixture
def odd(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("n_words", T.StringType())])
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, "x", None), (None, clean, None, "q"), (2, clean, "x", "q"), (2, clean, "x", "q"), (3, "b " * 200_000, "", ""), (4, "", None, None)]
    return spark.createDataFrame(rows, schema)


def test_nulls_long_texts_repeated_rows_and_empty_tables(odd):
    got = sorted((tuple(r) for r in R.repetition(odd).select("doc_id", "n_words", "base_failed", "kept").collect()), key=str)
    assert got == sorted([(1, 0, True, False), (None, 80, False, True), (2, 80, False, True), (2, 80, False, True), (3, 200_000, True, False), (4, 0, True, False)], key=str)
    assert R.repetition(odd.limit(0)).count() == 0
