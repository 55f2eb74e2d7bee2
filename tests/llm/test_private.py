"""Personal data against the patterns as they stand, and disclosing terms against counts made text by text."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from helixframe.llm import private as P

SCHEMA = "doc_id long, text string"
PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        total = 0
        for k, d in enumerate(reversed(digits)):
            v = int(d) * (2 if k % 2 else 1)
            total += v - 9 if v > 9 else v
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind != 3 or 8 <= len(digits) <= 15


def base_by_hand(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(k, m[0])]


def test_patterns_are_those_given():
    rng = random.Random(3)
    bits = ["a.b", "@", "x-1", ".", "..", "10", "255", "256", "4111 1111-1111 1111", "4111111111111111", "+1 (555) 010-9999", "+4", " ", "é", "%", "+", "-", "007", "1.2.3.4", "@a.b@c.d", "()", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    assert [[b[:3] for b in P.base_spans(t)] for t in texts] == [base_by_hand(t) for t in texts]
    assert sum(map(len, map(base_by_hand, texts))) > 3000


def test_long_runs_cost_their_length(spark):
    for run in ("a" * 200_000, "1" * 200_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000, "+1" + "(" * 200_000):
        P.base_spans(run)


def pairs_by_hand(texts, reach, support, alpha):
    """The disclosing (entity value, name): names are terms, and shapes after a tab."""
    in_docs, contexts, both = Counter(), defaultdict(set), Counter()
    for t in texts:
        base = [(k, s, e) for k, s, e in base_by_hand(t)]
        spans = [(s, e) for _, s, e in base]
        terms = [m for m in re.finditer("[A-Za-z0-9\x80-\U0010ffff]+", t) if len(m[0]) >= 3]
        in_docs.update({P.plain(m[0]) for m in terms} | {"\t" + P.shape(m[0]) for m in terms} | {""})
        free, here = [m for m in terms if not any(s < m.end() and m.start() < e for s, e in spans)], {}
        for k, s, e in base:
            value = t[s:e].lower() if k == 0 else t[s:e] if k == 1 else re.sub("[^0-9]", "", t[s:e])
            near = [m for m in free if m.start() < s][-reach:] + [m for m in free if m.start() > e][:reach]
            context = " ".join(P.plain(m[0]) for m in near)
            for m in near:
                here.setdefault(((k, value), P.plain(m[0]), P.shape(m[0])), context)
            here.setdefault(((k, value), "", ""), context)
        seen = {(c, n) for c, term, form in here for n in ([""] if not term else [term, "\t" + form])}
        for c, n in seen:
            both[c, n] += 1
        for (c, term, form), context in here.items():
            for n in [""] if not term else [term, "\t" + form]:
                contexts[c, n].add(context)
    out = set()
    for (c, n), k in both.items():
        content = math.log2(len(texts) / both[c, ""])
        if n and len(contexts[c, n]) >= support and content > 0 and math.log2(k * len(texts) / (both[c, ""] * in_docs[n])) >= content / alpha - 1e-9:
            out.add((c, n))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"word{chr(97 + k % 26)}{k}" for k in range(60)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [some(30) for _ in range(60)]
    texts += [f"{some(5)} Orlando {some(2)} mail orla@x.example.com now {some(9)}" for _ in range(6)]
    texts += [f"{some(5)} Berta {some(2)} +1 (555) 010-{1000 + k} now {some(4)}" for k in range(6)]
    texts += [f"{some(3)} id ZZ99zz {some(1)} 10.1.2.3 {some(6)}" for _ in range(5)] + [f"{some(4)} Orlando" for _ in range(2)]
    return texts + texts[60:62] * 3


def test_terms_equal_counts_by_hand(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for alpha in (1.0, P.ALPHA, 2.0):
        want = defaultdict(set)
        for c, n in pairs_by_hand(texts, P.REACH, P.SUPPORT, alpha):
            want[c].add(n)
        got = {r["doc_id"]: r["spans"] for r in P.find_private(docs, alpha=alpha).collect()}
        for k, t in enumerate(texts):
            base, marks = base_by_hand(t), {}
            for kind, s, e in base:
                value = t[s:e].lower() if kind == 0 else t[s:e] if kind == 1 else re.sub("[^0-9]", "", t[s:e])
                free = [m for m in re.finditer("[A-Za-z0-9\x80-\U0010ffff]+", t) if len(m[0]) >= 3 and not any(a < m.end() and m.start() < b for _, a, b in base)]
                for m in [m for m in free if m.start() < s][-P.REACH :] + [m for m in free if m.start() > e][: P.REACH]:
                    if P.plain(m[0]) in want[kind, value]:
                        marks[m.start(), m.end()] = max(marks.get((m.start(), m.end()), 0), 5 if "\t" + P.shape(m[0]) in want[kind, value] else 4)
            assert got[k] == P.joined(base + sorted((kind, s, e) for (s, e), kind in marks.items())), t
        assert any("general" in s or "remove" in s for s in got.values())


def test_a_name_is_generalised_and_clean_texts_stay(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = P.find_private(docs, alpha=1.5).collect()
    named = [r for r in got if "orla@" in texts[r["doc_id"]]]
    assert all(any(texts[r["doc_id"]][int(s.split(":")[1]) : int(s.split(":")[2])] == "Orlando" for s in r["spans"].split(",") if s.startswith(("general", "remove"))) for r in named)
    assert all(r["spans"] == "" for r in got if not base_by_hand(texts[r["doc_id"]]))
    # each caller's number is another entity, so the name beside all of them gives none away
    assert not any("general" in r["spans"] or "remove" in r["spans"] for r in got if "Berta" in texts[r["doc_id"]])
    clean = {r["doc_id"]: r["text"] for r in P.sanitise(docs, alpha=1.5).collect()}
    assert all("orla@" not in t and ("[Aa]" in t or "Orlando" not in t) for k, t in clean.items() if "orla@" in texts[k])
    assert all(clean[k] == t for k, t in enumerate(texts) if not base_by_hand(t))


def test_an_entity_in_all_documents_reveals_nothing(spark):
    docs = spark.createDataFrame([(k, f"only here{k} a@b.cd Name") for k in range(5)], SCHEMA)
    assert {r["spans"].count(":") for r in P.find_private(docs).collect()} == {2}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (1, "é 10.0.0.1"), (1, "é 10.0.0.1"), (3, "x" * 300_000 + " 1.1.1.1")]
    got = sorted((tuple(r) for r in P.find_private(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(1, 0, 0, 0, 0, digest(""), ""), (2, 0, 0, 0, 0, digest(""), ""), (None, 1, 0, 0, 0, digest("email:0:6"), "email:0:6"), *[(1, 0, 1, 0, 0, digest("ip:2:10"), "ip:2:10")] * 2, (3, 0, 1, 0, 0, digest("ip:300001:300008"), "ip:300001:300008")]
    assert got == sorted(want, key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    assert P.find_private(empty).isEmpty() and P.sanitise(empty).isEmpty()
    clash = spark.createDataFrame([(1, "a@b.cd", "r", 4)], "doc_id long, text string, row string, hash int")
    assert [tuple(r) for r in P.sanitise(clash).collect()] == [(1, "[email]", "r", 4)]
