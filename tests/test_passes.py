"""Arrow passes, extraction and identity classes against plain definitions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe.operators import clusters as K
from helixframe.operators import extraction as E
from helixframe.operators import passes as P
from helixframe.sources import text as T

RC = str.maketrans("ACGTN", "TGCAN")


def turned(s):
    return s[::-1].translate(RC)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    return [None, "", "A", "AC", "ACGTN", "NNN", "acgt", *("".join(rng.choice("ACGTN" if k % 3 else "ACGT") for _ in range(rng.randint(3, 300))) for k in range(60))]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, seq string")


def windows(s, k):
    s = (s or "").upper()
    return [w for i in range(len(s) - k + 1) if set(w := s[i : i + k]) <= set("ACGT")]


def test_entropies_and_totals(spark, texts):
    def h(items):
        c, n = Counter(items), len(items)
        return -sum(v / n * math.log2(v / n) for v in c.values()) if n else 0.0

    got = {r.id: (r.h1, r.h2) for r in P.with_entropies(frame(spark, texts), "id", "seq").collect()}
    for k, t in enumerate(texts):
        assert got[k] == (pytest.approx(h(windows(t, 1)), abs=1e-12), pytest.approx(h(windows(t, 2)), abs=1e-12))
    want = Counter(w for t in texts for k in (2, 3) for w in windows(t, k))
    assert {r.kmer: r.n for r in P.kmer_totals(frame(spark, texts), "seq", (2, 3)).collect()} == want
    assert P.kmer_totals(frame(spark, []), "seq", (2,)).count() == 0


def test_kmer_sets_and_profiles(spark, texts):
    number = lambda w: sum("ACGT".index(c) * 4 ** (len(w) - 1 - i) for i, c in enumerate(w))
    for canonical in (False, True):
        got = {r.id: r.kmers for r in P.kmer_sets(frame(spark, texts), "id", "seq", 5, canonical).collect()}
        for k, t in enumerate(texts):
            assert got[k] == sorted({number(min(w, turned(w)) if canonical else w) for w in windows(t, 5)})
    got = {r.id: (r.counts, r.norm) for r in P.kmer_profiles(frame(spark, texts), "id", "seq", 2).collect()}
    for k, t in enumerate(texts):
        c = Counter(map(number, windows(t, 2)))
        assert got[k] == ([c[x] for x in range(16)], pytest.approx(math.sqrt(sum(v * v for v in c.values()))))


def plain_divergence(q, s):
    """Column by column, as the definition says."""
    turns, last, before = {"AG", "GA", "CT", "TC"}, 0.0, ""
    sites = moved = crossed = cpg = 0
    total = 0.0
    for a, b in zip(q, s, strict=False):
        if b == "-":
            continue
        good = a in "ACGT" and b in "ACGT"
        sites += good
        kind = 0 if not good or a == b else 1 if a + b in turns else 2
        moved += kind == 1
        crossed += kind == 2
        if before == "C" and b == "G":
            cpg += 1
            last += kind == 1
            last = {0: 0.0, 1: 0.1, 2: 1.0}[int(last)]
        else:
            total += last
            last = float(kind == 1)
        before = b
    return sites, moved, crossed, cpg, total + last


def test_divergence(spark):
    rng = random.Random(9)
    pairs = [(k, "".join(rng.choice("ACGT-N") for _ in range(80)), "".join(rng.choice("ACGT-") for _ in range(rng.choice([70, 80, 90])))) for k in range(40)]
    pairs += [(40, None, "ACGT"), (41, "", ""), (42, "TATATA", "CGCGCG"), (43, "CATG", "CGCG")]
    got = {r.key: tuple(r)[1:] for r in P.with_divergence(spark.createDataFrame(pairs, "key long, q string, s string"), "key", "q", "s").collect()}
    for k, q, s in pairs:
        want = plain_divergence(q or "", s or "")
        assert got[k][:4] == want[:4] and got[k][4] == pytest.approx(want[4]), k


def test_offsets_ends_and_frames(spark):
    assert P.offset_identity("ACGT", "TTACGTTT") == 1.0 and P.offset_identity("TTACGTTT", "ACGA") == 0.75 and P.offset_identity("", "A") == 0.0
    long = "C" * 637 + "ACGTACGTAA" + "C" * 200
    assert P.offset_identity(long, "ACGTACGTAA", exact=True) == 1.0 > P.offset_identity(long, "ACGTACGTAA")
    rows = [(1, "ACGTACGTAC" + "T" * 80 + "ACGTACGTAC"), (2, "A" * 50), (3, None)]
    got = {r.id: (r.similarity, r.repeat_length) for r in P.with_terminal_repeat(frame(spark, [r[1] for r in rows]), "id", "seq", (0.1, 0.4), 5, 1000).collect()}
    assert got == {0: (1.0, 10), 1: (1.0, 5), 2: (0.0, 0)}

    def frames(s):
        best = 0
        for x in (s, turned(s)):
            for f in range(3):
                run = 0
                for i in range(f, len(x) - 2, 3):
                    run = 0 if x[i : i + 3] in ("TAA", "TAG", "TGA") else run + 3
                    best = max(best, run)
        return best

    rng = random.Random(3)
    for s in ["", "AC", "TAA", "ATGTAA", *("".join(rng.choice("ACGTN") for _ in range(rng.randint(1, 400))) for _ in range(40))]:
        assert P.longest_open_frame(s) == frames(s), s


def test_padded_copies(spark):
    rng = random.Random(1)
    genome = {"c1": "".join(rng.choice("ACGT") for _ in range(1000)), "c2": "ACGTA", "c3": "ACGT" * 30}
    instances = [("c1", 100, 200, "+"), ("c1", 100, 200, "-"), ("c1", 10, 100, "-"), ("c1", 900, 990, "+"), ("c2", 0, 5, "-"), ("c9", 1, 2, "+"), ("c1", 500, 400, "+"), ("c1", 2000, 2100, "+"), ("c3", 31, 33, "+"), ("c1", 100, 200, "+")]
    df = spark.createDataFrame([(*i, k) for k, i in enumerate(instances)], "chrom string, s long, e long, strand string, id long")
    for pad in (0, 50, 100):
        got = {r.id: r for r in E.padded_copies(df, spark.createDataFrame(list(genome.items()), "chrom string, seq string"), F.lit(pad), width=64).collect()}
        want = {}
        for k, (c, s, e, strand) in enumerate(instances):
            if c in genome and (e1 := min(len(genome[c]), e + pad)) >= (s1 := max(1, s + 1 - pad)):
                cut = genome[c][s1 - 1 : e1]
                a, b = s - s1 + 1, e - s1 + 1
                if strand == "-":
                    cut, a, b = turned(cut), len(cut) - b, len(cut) - a
                want[k] = (s1, e1, cut, max(0, a), min(len(cut), b))
        assert {k: (r.s1, r.e1, r.seq, r.te_start, r.te_end) for k, r in got.items()} == want
        assert all(r.seq[r.te_start : r.te_end] == (turned(genome[r.chrom][r.s : r.e]) if r.strand == "-" else genome[r.chrom][r.s : r.e]) for r in got.values() if r.e <= len(genome[r.chrom]) and r.s < r.e)


def test_identity_classes(spark):
    rng = random.Random(13)
    draw = lambda n: "".join(rng.choice("ACGT") for _ in range(n))

    def changed(s, share):
        x = list(s)
        for i in rng.sample(range(len(x)), int(share * len(x))):
            x[i] = rng.choice([b for b in "ACGT" if b != x[i]])
        return "".join(x)

    seqs, family = [], []
    for f in range(8):
        base = draw(600)
        for s in [base, turned(base), base[:-30], *(changed(base, 0.01) for _ in range(4)), turned(changed(base, 0.01))]:
            seqs.append(s)
            family.append(f)
    seqs += [draw(500), draw(40), "", "ACG"]
    family += [90, 91, 92, 93]
    got = {r.id: r.representative for r in K.identity_classes(frame(spark, seqs), 0.95).collect()}
    assert len(got) == len(seqs)
    for f in set(family):
        mine = [i for i in range(len(seqs)) if family[i] == f]
        longest = min(mine, key=lambda i: (-len(seqs[i]), i))
        assert {got[i] for i in mine} == {longest}
    # far copies stay apart until a round is loose enough
    base = draw(900)
    far = [base, changed(base, 0.05), changed(base, 0.05)]
    assert len({r.representative for r in K.identity_classes(frame(spark, far), 0.98).collect()}) == 3
    rows = sorted((r.id, r.representative, r["round"]) for r in K.converged(frame(spark, far), floor=0.8, least_gain=-1.0).collect())
    assert [r[1] for r in rows] == [0, 0, 0] and rows[0][2] == 0 and all(r[2] > 1 for r in rows[1:])


def test_dialects_and_summaries(spark, tmp_path):
    def dialect(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return T.graph_dialect(spark, str(tmp_path / name)).first()[0]

    plain, ranked, path = "S\t1\tACGT", "S\t2\tAC\tSR:i:0", "P\tp\t1+\t*"
    assert dialect("a", ["H\tx", plain, ranked, path]) == "rGFA"
    assert dialect("b", [plain, path, ranked]) == "PGGB"
    assert dialect("c", [plain] * 50 + [ranked]) == "PGGB"
    assert dialect("d", [plain] * 49 + [ranked, path]) == "rGFA"
    assert dialect("e", ["H\tx", "L\t1\t+\t2\t+\t0M"]) is None
    assert dialect("f", [path]) == "PGGB"
    names = [("x.fa.gz",), ("Y.FASTA.bz2",), ("z.bed",), ("q.unknown",), ("noend",)]
    got = spark.createDataFrame(names, "n string").select(*T.sniffed(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("fasta", "gzip"), ("fasta", "bzip2"), ("bed", "none"), (None, "none"), (None, "none")]
    folder = tmp_path / "tbl"
    folder.mkdir()
    (folder / "x.tbl").write_text("file name: g.fa\nsequences:          12\ntotal length:  1000 bp  (900 bp excl N/X-runs)\nbases masked:  338 bp ( 33.83 %)\nUnclassified:   7   10 bp\n")
    (folder / "y.tbl").write_text("file name: h.fa\ntotal length:  1000 bp\n")
    assert [tuple(r) for r in T.read_masking_summaries(spark, str(folder)).collect()] == [("g.fa", 12, 1000, 338, 33.83, 7)]


def plain_tandem(s, units, times=3):
    hit = set()
    for u in units:
        for i in range(len(s) - u * times + 1):
            unit = s[i : i + u]
            if "N" not in unit and s[i : i + u * times] == unit * times:
                hit |= set(range(i, i + u * times))
    return len(hit)


def test_repeat_shares_and_terminal_repeats():
    rng = random.Random(5)
    for _ in range(60):
        s = "".join(rng.choice(["A", "C", "AT", "ACG" * 3, "N", "TTTTTT", "ACGTAC" * 3, "GG"]) for _ in range(rng.randint(0, 30)))
        for units in (P.SHORT_UNITS, P.LONG_UNITS):
            assert P.tandem_cover(s, units) == plain_tandem(s, units), s
    assert P.tandem_cover("ACGACGACG", P.SHORT_UNITS) == 9 and P.tandem_cover("ACGACGAC", P.SHORT_UNITS) == 0 and P.tandem_cover("NNNNNNNNN", P.LONG_UNITS) == 0
    base = "".join(rng.choice("ACGT") for _ in range(120))
    assert P.has_terminal_repeat(base + "A" * 300 + base) and not P.has_terminal_repeat(base + "A" * 90) and not P.has_terminal_repeat(None)


def test_x_drop_fragments():
    table = {a + b: 10.0 if a == b else -15.0 for a in "ACGT" for b in "ACGT"}
    lut = P.np.zeros((256, 256))
    for w, v in table.items():
        lut[ord(w[0]), ord(w[1])] = v
    # 10 equal columns, 5 unequal ones, 10 equal ones, a gap of 2 in the query and one in the subject
    q, s = "A" * 10 + "C" * 5 + "A" * 10 + "--" + "G", "A" * 10 + "G" * 5 + "A" * 10 + "CC" + "-"
    upto = P.position_scores(q, s, lut, 12.0, 4.0).tolist()
    assert upto[9] == 100 and upto[14] == 25 and upto[24] == 125 and upto[25:] == [113, 109, 97]
    assert P.x_drop_fragments(upto, 50) == [(0, 9), (14, 24)] and P.x_drop_fragments(upto, 75) == [(0, 24)]
    assert P.x_drop_fragments([], 5) == [] and P.x_drop_fragments([-1.0 * k for k in range(9)], 5) == []
