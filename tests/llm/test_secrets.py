"""Secret scans: patterns by definition, planted keys, and clean text left alone."""

import itertools
import math
import random
import re
import string
from statistics import NormalDist

import numpy as np
import pytest

from helixframe.llm import secrets as S


def plain(text):
    out = []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_base_spans():
    rng = random.Random(5)
    parts = ["token", "SECRET", "api_key", "ApiKey", "passwd", '"', "'", " = ", ": ", "=", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "ſecret", "toKen", "x", "é", "\n", "abcdefgh"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert S.base_spans(text) == plain(text), text


def test_random_tokens_are_found_and_words_are_not():
    rng = random.Random(7)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(200)]
    assert sum(S.scan(f"the key is {k} here")[5] for k in keys) >= 190
    words = ["the", "of", "international", "response", "token", "line", "under", "alpha"]
    names = ["_".join(rng.choice(words) for _ in range(5)) + str(rng.randint(1, 99)) for _ in range(200)]
    assert sum(S.scan(f"call {k} here")[5] for k in names) <= 2
    assert S.scan("4785380592391139 1234567890123456789012345")[4] == ""
    assert S.scan("z" * 50 + "1")[4] == ""


def test_table(spark):
    docs = spark.createDataFrame([(1, None, "z"), (None, 'x token = "abcdefgh12" ' + "w " * 300_000, "z"), (2, "", None), (2, "", None)], "doc_id long, text string, spans string")
    rows = S.find_secrets(docs).collect()
    assert sorted((r.n_assign, r.spans) for r in rows) == [(0, ""), (0, ""), (0, ""), (1, "assign:2:21")]
    assert S.find_secrets(docs.limit(0)).count() == 0
    clean = S.redact(docs).collect()
    assert [r.spans for r in clean] == ["z", "z", None, None] and sorted(("?" if r.text is None else r.text)[:13] for r in clean) == ["", "", "?", 'x [assign]" w']


def test_values_after_equals_signs_and_keys_of_letters_are_found():
    rng = random.Random(11)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    mixed, found, letters = string.ascii_letters + string.digits, [0, 0, 0], 0
    for _ in range(200):
        key = draw(mixed, 40)
        for k, text in enumerate((f"export AWS_SECRET_ACCESS_KEY={key}\n", f"https://host/a?id=7&sig={key}==&x=2", f"KEY={key}")):
            at = text.index(key)
            found[k] += f"random:{at}:{at + 40 + 2 * (k == 1)}" in S.scan(text)[4].split(",")
        letters += S.scan(f"the key is {draw(string.ascii_letters, 40)} here")[5]
    assert min(found) >= 190 and letters >= 190, (found, letters)
    words = ["the", "of", "international", "response", "token", "line", "under", "alpha"]
    joins = ("_".join, "/".join, lambda w: "".join(x.title() for x in w))
    names = [join(rng.choice(words) for _ in range(5)) for join in joins for _ in range(200)]
    assert sum(S.scan(f"call {k} here")[5] for k in names) <= S.RATE * len(names)


def plain_tests(token, alphabet):
    """The battery from its textbook definitions, by counting over the alphabet."""
    n, size = len(token), len(alphabet)
    x = np.array([alphabet.index(c) for c in token], float)
    seen = np.array([token.count(c) for c in alphabet])
    chi = float((((seen - n / size) ** 2) / (n / size)).sum())
    z = ((chi / (size - 1)) ** (1 / 3) - (1 - 2 / (9 * (size - 1)))) / (2 / (9 * (size - 1))) ** 0.5
    tail = lambda v: 1 - NormalDist().cdf(v) if v < 5 else NormalDist().cdf(-v)
    side = "".join("h" if v >= size / 2 else "l" for v in x)
    runs = len([1 for _ in itertools.groupby(side)])  # 1 + a binomial count of n - 1 fair coins
    p_runs = min(1.0, 2 * tail(abs(runs - 1 - (n - 1) / 2) / ((n - 1) / 4) ** 0.5))
    d = x - x.mean()
    r = float((d[1:] * d[:-1]).sum() / (d * d).sum()) if (d * d).sum() else 1.0
    return tail(z), p_runs, min(1.0, 2 * tail(abs(r + 1 / n) * n**0.5))


def test_battery_matches_plain_definitions():
    rng = random.Random(3)
    for name, alphabet in S.ALPHABETS.items():
        for n in (20, 33, 64, 200):
            for _ in range(5):
                for token in ("".join(rng.choice(alphabet) for _ in range(n)), S.drawn_name(name, rng.choice(S.styles(name)), n, rng), alphabet[-1] * n):
                    got = S.three_tests(S.departures([alphabet.index(c) for c in token], len(alphabet)))
                    assert got == pytest.approx(plain_tests(token, alphabet), rel=1e-6, abs=1e-12), token
                    s = -2 * sum(math.log(max(p, 1e-300)) for p in got)
                    assert S.combined(got) == pytest.approx(s)


def test_the_finding_uses_all_three_tests():
    """Each test alone, made worse, makes the finding's p-value worse."""
    rng = random.Random(8)
    token = "".join(rng.sample(S.ALPHABETS["base62"], 40))
    ordered = "".join(sorted(token, key=S.ALPHABETS["base62"].index))  # the same counts: runs and serial correlation differ
    assert S.battery(token)["p_uniform"] == S.battery(ordered)["p_uniform"]
    assert S.battery(token)["p_text"] < 1e-3 < S.battery(ordered)["p_text"]
    # and the counts alone: the same sides and steps, fewer letters
    fewer = "".join("Aa"[c.islower()] if c.isalpha() else c for c in token)
    assert S.battery(fewer)["p_uniform"] < 1e-4 and S.battery(fewer)["p_text"] > S.battery(token)["p_text"]


def test_discoveries_match_the_rule_by_trying_all_cuts():
    rng = random.Random(12)
    for _ in range(300):
        n = rng.randint(0, 12)
        p, size = [rng.choice((rng.random(), rng.random() ** 8, 0.001)) for _ in range(n)], [rng.randint(20, 90) for _ in range(n)]
        weighted = [a / (b * n / sum(size)) for a, b in zip(p, size, strict=True)]
        cuts = [sum(w <= t for w in weighted) for t in weighted if t <= 0.05 * sum(w <= t for w in weighted) / n + 1e-15]
        assert len(S.discoveries(p, size, 0.05)) == max(cuts, default=0)
        assert all(weighted[i] <= weighted[j] for i in S.discoveries(p, size, 0.05) for j in range(n) if j not in S.discoveries(p, size, 0.05))


def test_false_findings_are_rare_at_every_length():
    rng = random.Random(21)
    for n in (20, 24, 40, 80):
        names = [S.drawn_name("base62", style, n, rng) for style in ("plain", "titled") for _ in range(250)]
        assert sum(S.scan(f"see {x} there")[5] for x in names) <= 0.02 * len(names)


def test_very_long_texts_and_tokens():
    rng = random.Random(2)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(50_000))
    text = "word " * 400_000 + key + " word" * 10
    assert S.scan(text)[4] == f"random:2000000:{2_000_000 + len(key)}"
    assert S.scan("internationalization" * 5000)[4] == ""
