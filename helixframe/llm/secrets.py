"""Secret scans: fixed patterns, and a battery of randomness tests over other tokens.

Tokens are runs of `[A-Za-z0-9+/_-]`, with the `=` that pad them where the run ends, of at least `least` characters
that no pattern covers; an `=` inside, as in NAME=VALUE, parts two tokens. Each token's encoding is
inferred from its characters (hex, base 32, base 36, letters, base 62, base 64), and three tests hold it against random
symbols of that alphabet: chi-squared uniformity, runs above and below the middle of the alphabet, and serial
correlation. A token that Fisher's combination of the three rejects at `alpha` isn't random.

Not being rejected proves little about a short token, so the finding itself is controlled by length: a weighted sum of
the three tests' deviates is held against what names made of words of the same length and alphabet give, in the style
that comes nearest (`words_null`, drawn from letter frequencies with a fixed seed), and how far it lies below that is
the p-value of a finding. All tokens of a text are one family; Benjamini and Hochberg's rule at `rate`, with weights in proportion to
length, decides which are secrets.

Spans are code points, end exclusive. Defined results: null text is empty and has no spans; a null id stays; equal
texts get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import slices

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of fewer hexadecimal digits are dropped anyway; the runs found are the same.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]+(?:=+\Z)?")
KINDS = ("assign", "access", "hex", "random")
LEAST, ALPHA, RATE = 20, 1e-4, 0.01
#: Names drawn for the law of a length, and the least spread that it may have. Names of more characters only lie
#: farther from random ones, so a longer token is held against those of LONGEST.
DRAWS, LEAST_SPREAD, LONGEST = 160, 0.5, 1024
#: Means of the deviates of random tokens.
RANDOM_MEANS = (0.0, 0.0, math.sqrt(2 / math.pi))

#: The alphabets of the encodings, each in its own order.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Per cent of English letters, a to z.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
SETS = [(name, frozenset(letters), {c: i for i, c in enumerate(letters)}) for name, letters in ALPHABETS.items()]


def upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(token: str) -> tuple[str, dict] | None:
    """The smallest alphabet that holds the token, which must have letters: digits alone are no key."""
    used = set(token)
    if not any(c.isalpha() for c in used):
        return None
    return next(((name, place) for name, letters, place in SETS if used <= letters), None)


def departures(x: list[int], size: int) -> tuple[float, float, float]:
    """How far two or more symbols below size are from random: chi-squared, runs and serial correlation as deviates.

    Chi-squared of the counts by Wilson and Hilferty's cube root; half of the alphabet is high, so a random token changes
    side with a chance of a half at each step, and too few runs are positive; serial correlation of either sign is positive.
    """
    n, df = len(x), size - 1
    counts: dict[int, int] = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    chi = max(0.0, sum(c * c for c in counts.values()) * size / n - n)
    high = [2 * v >= size for v in x]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    middle = sum(x) / n
    var = sum((v - middle) ** 2 for v in x)
    r = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:], strict=False)) / var if var else 1.0
    return ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)), (n + 1 - 2 * runs) / math.sqrt(n - 1), abs(r + 1 / n) * math.sqrt(n)


def three_tests(z: tuple[float, float, float]) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation from the deviates."""
    return upper_normal(z[0]), min(1.0, 2 * upper_normal(abs(z[1]))), min(1.0, 2 * upper_normal(z[2]))


def combined(tests: tuple[float, float, float]) -> float:
    """Fisher's statistic."""
    return -2 * sum(math.log(max(p, 1e-300)) for p in tests)


#: How people make names of words: in one piece, with capitals at their starts, or with joiners between them.
STYLES = ("plain", "titled", "joined")


def styles(name: str) -> list[str]:
    """Those that an alphabet has the letters for."""
    alphabet = ALPHABETS[name]
    both = any(c.islower() for c in alphabet) and any(c.isupper() for c in alphabet)
    return [s for s in STYLES if s == "plain" or s == "titled" and both or s == "joined" and not alphabet.isalnum()]


def drawn_name(name: str, style: str, n: int, rng: random.Random) -> str:
    """A name of n characters: letters by their use, in words of three to nine, and up to two digits at the end."""
    alphabet = ALPHABETS[name]
    letters = [c for c in alphabet if c.islower()] or [c for c in alphabet if c.isalpha()]
    joiners = [c for c in alphabet if not c.isalnum()]
    body = rng.choices(letters, [LETTERS[ord(c.lower()) - 97] for c in letters], k=n)
    start = 0
    while style != "plain" and start < n:
        if style == "titled":
            body[start] = body[start].upper()
        elif start:
            body[start] = rng.choice(joiners)
        start += rng.randint(3, 9)
    digits = [c for c in alphabet if c.isdigit()]
    tail = rng.choice((0, 0, 1, 2)) if digits else 0
    return "".join(body[: n - tail] + rng.choices(digits or letters, k=tail))


@lru_cache(maxsize=10_000)
def words_null(name: str, n: int) -> list[tuple[tuple[float, float, float], float, float]]:
    """For each style, weights of the deviates, and mean and spread of their weighted sum over drawn names of n characters.

    A deviate weighs as much as it tells names from random tokens: its mean over names less that over random ones, by
    its variance.
    """
    place, out = dict(zip(ALPHABETS[name], range(99), strict=False)), []
    for style in styles(name):
        rng = random.Random(f"{name} {style} {n}")
        drawn = [departures([place[c] for c in drawn_name(name, style, n, rng)], len(place)) for _ in range(max(32, min(DRAWS, (1 << 14) // n)))]
        laws = [mean_and_spread([z[k] for z in drawn]) for k in range(3)]
        weights = tuple((mean - usual) / spread**2 for (mean, spread), usual in zip(laws, RANDOM_MEANS, strict=True))
        out.append((weights, *mean_and_spread([weighed(weights, z) for z in drawn])))
    return out


def mean_and_spread(values: list[float]) -> tuple[float, float]:
    mean = sum(values) / len(values)
    return mean, max(LEAST_SPREAD, math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)))


def weighed(weights: tuple[float, float, float], z: tuple[float, float, float]) -> float:
    return sum(w * v for w, v in zip(weights, z, strict=True))


def battery(token: str) -> dict | None:
    """encoding, the three tests' p-values and their combination under randomness, and p_text, the finding's."""
    body = token.rstrip("=")
    kind = encoding(body)
    if kind is None or len(body) < 2:
        return None
    name, place = kind
    z = departures([place[c] for c in body], len(place))
    tests = three_tests(z)
    s = combined(tests)
    p_text = max(upper_normal((mean - weighed(weights, z)) / spread) for weights, mean, spread in words_null(name, min(len(body), LONGEST)))
    return {"encoding": name, "p_uniform": tests[0], "p_runs": tests[1], "p_serial": tests[2], "p_random": math.exp(-s / 2) * (1 + s / 2 + s * s / 8), "p_text": p_text}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(spans)


def discoveries(p_values: list[float], lengths: list[int], rate: float) -> list[int]:
    """Which hypotheses Benjamini and Hochberg's rule rejects, with weights in proportion to length whose mean is 1."""
    total, n = sum(lengths), len(lengths)
    order = sorted(range(n), key=lambda i: (p_values[i] * total / (n * lengths[i]), i))
    passed = max((k for k, i in enumerate(order, 1) if p_values[i] * total / (n * lengths[i]) <= rate * k / n), default=0)
    return order[:passed]


def random_spans(text: str, base: list[tuple[int, int, int]], least: int, alpha: float, rate: float) -> list[tuple[int, int, int]]:
    tested = []
    for run in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % least, text):
        for m in TOKEN.finditer(run[0]):
            start, end = run.start() + m.start(), run.start() + m.end()
            if end - start < least or any(s < end and start < e for s, _, e in base):
                continue
            if found := battery(m[0]):
                tested.append((start, end, found))
    kept = discoveries([f["p_text"] for _, _, f in tested], [e - s for s, e, _ in tested], rate)
    return [(s, 3, e) for s, e, f in (tested[k] for k in kept) if f["p_random"] >= alpha]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(text: str, least: int = LEAST, alpha: float = ALPHA, rate: float = RATE) -> tuple[int, int, int, str, str, int]:
    base = base_spans(text)
    extra = random_spans(text, base, least, alpha, rate)
    kinds = [k for _, k, _ in base]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + extra)), len(extra)


SCHEMA = "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, alpha: float = ALPHA, rate: float = RATE) -> DataFrame:
    """One row for each text: id_col, n_assign, n_access, n_hex, base_sha256, spans, n_random."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [scan(t, least, alpha, rate) for t in pc.fill_null(part.column("text"), "").to_pylist()]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c) for c in columns)], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, SCHEMA).withColumnRenamed("id", id_col)


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[{}]") -> DataFrame:
    """docs with each secret in text_col replaced by its kind; overlapping spans become one, named by the first."""

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        base = base_spans(text)
        for s, k, e in sorted(base + random_spans(text, base, LEAST, ALPHA, RATE)):
            if s >= at:
                out += [text[at:s], mark.format(KINDS[k])]
            at = max(at, e)
        return "".join([*out, text[at:]])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            k = part.schema.get_field_index(text_col)
            new = pa.array([clean(t) for t in part.column(k).to_pylist()], part.schema.field(k).type)
            yield part.set_column(k, part.schema.field(k), new)

    return docs.mapInArrow(step, docs.schema)
