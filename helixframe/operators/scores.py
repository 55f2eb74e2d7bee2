"""Scores, expectations and size tiers of families, as column expressions with the usual limits as parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import seq as S
from helixframe.operators.gates import steps

#: Expected copies by length, scaled by the genome; the best identity by length; weights by length.
EXPECTED_COPIES, LONGEST_COPIES = [(300, 50.0), (800, 30.0), (3000, 20.0), (7000, 10.0)], 5.0
COPY_RAMP = [(0.0, 0.0), (0.25, 0.4), (0.5, 0.6), (1.0, 0.8), (1.5, 1.0)]
BEST_IDENTITY, LONGEST_IDENTITY = [(500, 65.0), (3000, 70.0)], 75.0
WEIGHTS = {"copy": (0.45, 0.35, 0.30), "identity": (0.20, 0.25, 0.30), "complexity": (0.20, 0.20, 0.15), "length": (0.10, 0.10, 0.10), "boundary": (0.05, 0.10, 0.15)}
#: Bases of a genome below which a seed needs so many copies, and windows so wide a stride.
SEED_COUNTS, MOST_SEEDS = [(300e6, 50), (1e9, 100), (3e9, 200), (10e9, 300)], 500
STRIDES, LONGEST_STRIDE = [(100e6, 50), (3e9, 100), (10e9, 200), (30e9, 500)], 1000


def ramp(value: Column, knots: list[tuple[float | Column, float]]) -> Column:
    """Linear between the knots (x, y), flat outside."""
    at = [x if isinstance(x, Column) else F.lit(float(x)) for x, _ in knots]
    out = F.when(value >= at[-1], F.lit(float(knots[-1][1])))
    for k in range(len(knots) - 1, 0, -1):
        low, high = knots[k - 1][1], knots[k][1]
        out = out.when(value >= at[k - 1], low + (high - low) * (value - at[k - 1]) / (at[k] - at[k - 1]))
    return out.otherwise(F.lit(float(knots[0][1])))


def copy_score(copies: Column, length: Column, genome_gb: float = 1.0, enough: int = 15, least: int = 3) -> Column:
    """Copies against what their length lets expect; `enough` is always full, under `least` is noise."""
    factor = F.log10(F.lit(genome_gb + 1)) + 1
    expected = F.greatest(F.lit(float(least)), F.least(F.lit(float(enough)), steps(length, EXPECTED_COPIES, LONGEST_COPIES) / factor))
    return F.when(copies >= enough, 1.0).when(copies < least, 0.01).otherwise(ramp(copies / expected, COPY_RAMP))


def identity_score(identity: Column, length: Column, copies: Column) -> Column:
    """Per cent of identity against the best that a length lets expect, 3 or 5 less for many copies."""
    best = steps(length, BEST_IDENTITY, LONGEST_IDENTITY) - F.when(copies > 100, 5.0).when(copies > 50, 3.0).otherwise(0.0)
    return ramp(identity, [(0.0, 0.0), (best - 30, 0.3), (best - 20, 0.6), (best - 10, 0.8), (best, 1.0)])


def length_score(length: Column, copies: Column) -> Column:
    short = F.when(length < 50, F.when(copies > 100, 0.1).otherwise(0.3)).when(length < 80, F.when(copies > 10, 0.5).otherwise(0.4)).when(length < 100, 0.7)
    usual = short.when(length <= 3000, 1.0).when(length <= 7000, 0.95).when(length <= 15_000, 0.85)
    return usual.when(length <= 20_000, F.when(copies >= 2, 0.7).otherwise(0.5)).otherwise(F.when(copies >= 3, 0.4).otherwise(0.2))


def final_score(length: Column, parts: dict[str, Column]) -> Column:
    """The weighted sum of copy, identity, complexity, length and boundary scores, by length class."""
    weight = lambda name: steps(length, list(zip((500, 3000), WEIGHTS[name], strict=False)), WEIGHTS[name][2])
    return sum(weight(name) * value for name, value in parts.items())


def class_cuts(median_length: Column, genome_gb: float = 1.0) -> tuple[Column, Column]:
    """The least scores of classes A and B, by the median length of all sequences and the genome."""
    a = steps(median_length, [(500, 0.60), (2000, 0.65)], 0.70)
    shift = -0.05 if genome_gb < 0.1 else 0.05 if genome_gb > 3 else 0.0
    return F.greatest(F.lit(0.5), a + shift), F.greatest(F.lit(0.3), a - 0.2 + shift)


def abundance(copies: Column, length_kb: Column, genome_gb: float, unit_kb: float = 3.0) -> Column:
    """Copies of unit length for each Gb of genome."""
    return copies * (length_kb / unit_kb) / genome_gb if genome_gb > 0 else F.lit(0.0)


def copy_cuts(length_kb: Column, genome_gb: float, unit_kb: float = 3.0, low: float = 5.0, high: float = 25.0) -> tuple[Column, Column]:
    """The least copies of the middle and upper tier for a length: abundances of `low` and `high`."""
    if genome_gb <= 0:
        return F.lit(2).cast("long"), F.lit(6).cast("long")
    least = lambda b, floor_: F.greatest(F.lit(floor_), F.ceil(F.lit(b * genome_gb) * (F.lit(unit_kb) / length_kb))).cast("long")
    one, two = least(low, 2), least(high, 4)
    two = F.when(two <= one, one + 2).otherwise(two)
    known = length_kb > 0
    return F.when(known, one).otherwise(2).cast("long"), F.when(known, two).otherwise(6).cast("long")


def seed_count(genome_bp: Column) -> Column:
    """The copies that a seed k-mer needs; the smallest tier where the genome is unknown."""
    return F.when(genome_bp <= 0, 50).otherwise(steps(genome_bp, SEED_COUNTS, MOST_SEEDS))


def window_stride(genome_bp: Column) -> Column:
    return F.when(genome_bp <= 0, 100).otherwise(steps(genome_bp, STRIDES, LONGEST_STRIDE))


def gc_matrix(gc_percent: Column) -> Column:
    """The matrix for a GC content: odd levels from 35 to 53, the nearest, the lower on ties; 41 where it is unknown."""
    level = F.greatest(F.lit(35), F.least(F.lit(53), 35 + 2 * F.ceil((gc_percent - 36) / 2)))
    return F.concat(F.when(gc_percent.isNull(), 41).otherwise(level).cast("int").cast("string"), F.lit("g"))


#: Ends of long terminal repeats with how far to trust them; what a primer binding site starts with;
#: motifs of both ends.
LTR_ENDS = [("TG", "CA", 1.0), ("CA", "CA", 0.8), ("TG", "TA", 0.8)]
PRIMER_SITES = ["TGGCG", "TGGCA", "TGGCC", "TGGCT", "TGGT", "TGGA"]


def boundary_confidence(seq: Column, strict: bool = False) -> Column:
    """How far a sequence's ends are those of a long terminal repeat; strict: TG and CA alone."""
    rules = [(a, b, c) for a, b, c in LTR_ENDS if c == 1.0 or not strict]
    out = F.when(F.length(seq) < 4, 0.0)
    for a, b, c in rules:
        out = out.when(seq.startswith(a) & seq.endswith(b), c)
    return out.otherwise(0.0)


def primer_site(seq: Column, repeat_length: Column, within: int = 20) -> Column:
    """Whether a primer binding site starts behind the left terminal repeat."""
    region = F.substring(seq, (repeat_length + 1).cast("int"), F.lit(within))
    found = [F.contains(region, F.lit(p)) for p in PRIMER_SITES]
    return F.coalesce(sum((f.cast("int") for f in found), F.lit(0)) > 0, F.lit(False))


def exact_duplication(seq: Column, least: int = 4, most: int = 9) -> Column:
    """Whether the first k letters are the last k for some k, in sequences of over 20."""
    same = [F.left(seq, F.lit(k)) == F.right(seq, F.lit(k)) for k in range(least, most + 1)]
    return (F.length(seq) > 20) & (sum((s.cast("int") for s in same), F.lit(0)) > 0)


def ltr_scores(rows: DataFrame, seq: str = "seq", similarity: str = "similarity", repeat_length: str = "repeat_length", complete: float = 0.35) -> DataFrame:
    """rows with `kind`, `total` and `category` of a candidate for a long terminal repeat.

    An element whose terminal repeats are alike enough is complete: likeness, site duplication, end motifs and primer
    site count. Any other is a single repeat: end motifs and length count, and weak motifs make it none.
    """
    s, alike, n = F.col(seq), F.col(similarity), F.length(seq)
    whole = (n >= 300) & (alike >= complete)
    motif = boundary_confidence(s) * 100
    single = F.when(motif < 80, 0.0).otherwise(motif * 0.7 + F.when(n.between(100, 1500), 100.0).otherwise(50.0) * 0.3)

    bands = F.when(alike >= 0.9, 100.0).when(alike >= 0.8, 95.0).when(alike >= 0.7, 85.0).when(alike >= 0.5, 70.0).when(alike >= 0.4, 50.0).otherwise(0.0)
    tsd, five, three = exact_duplication(s), s.startswith("TG"), s.endswith("CA")
    pbs = primer_site(s, F.col(repeat_length))
    ends = F.when(five & three, 100.0).when(five | three, 50.0).otherwise(0.0)
    total = 0.40 * bands + 0.30 * F.when(tsd, 80.0).otherwise(0.0) + 0.15 * ends + 0.15 * F.when(pbs, 100.0).otherwise(0.0)
    total = total * F.when((n < 2000) & ~(tsd | (five & three)), 0.5).otherwise(1.0) * F.when(tsd | five | three | pbs, 1.0).otherwise(0.4)
    rows = rows.withColumns({"kind": F.when(whole, "complete").otherwise("single"), "total": F.when(whole, total).otherwise(single)})
    t = F.col("total")
    of_whole = F.when(((t >= 70) & (alike >= 0.8)) | ((t >= 60) & (alike >= 0.7)), "confirmed").when((t >= 50) & (alike >= 0.45), "probable").when(t >= 35, "possible").otherwise("none")
    of_single = F.when(t >= 70, "confirmed").when(t >= 50, "probable").when(t >= 30, "possible").otherwise("none")
    return rows.withColumn("category", F.when(whole, of_whole).otherwise(of_single))


#: The most that each part of the structure score can give, and that each penalty can take.
STRUCTURE = {"terminal_pairs": 0.28, "terminal_motifs": 0.06, "coherence": 0.06, "tsd_rate": 0.12, "tsd_length": 0.08, "domains": 0.17, "open_frame": 0.08, "poly_a": 0.07, "primer": 0.08}
PENALTIES = {"low_complexity": 0.10, "host": 0.06, "conflict": 0.04}
#: tRNA primers, sought on both strands.
PRIMERS = ["TGGCGCCCGAACAG", "TGGTATCAGAGCGCC", "GCCCGGATAGCTCA"]


def terminal_pairs(seq: Column) -> Column:
    """Likeness of the ends, straight over 500 letters or turned over 100, at most a quarter of the length each."""
    quarter = F.floor(F.length(seq) / 4)

    def side(width: int, least: float, share: float, full: float, turned: bool) -> Column:
        w = F.least(F.lit(width), quarter).cast("int")
        tail = F.right(seq, w)
        same = S.identical_positions(F.left(seq, w), S.reverse_complement(tail) if turned else tail) / w * 100
        return F.when((w > 0) & (same >= least), F.least(F.lit(1.0), w * share / full) * same / 100).otherwise(0.0)

    return F.when(F.length(seq) < 200, 0.0).otherwise(F.greatest(side(500, 60, 0.5, 300.0, False), side(100, 70, 0.3, 40.0, True)) * STRUCTURE["terminal_pairs"])


def terminal_motifs(seq: Column) -> Column:
    ends = lambda a: seq.startswith(a) & seq.endswith(a)
    part = lambda c, v: F.when(c, v).otherwise(0.0)
    total = part(seq.startswith("TG"), 0.03) + part(seq.endswith("CA"), 0.03) + F.when(ends("TA"), 0.04).when(ends("TTAA"), 0.06).otherwise(0.0) + part(seq.startswith("TC"), 0.03) + part(seq.rlike("CT[AG][AG]$"), 0.03)
    return F.when(F.length(seq) < 50, 0.0).otherwise(F.least(F.lit(STRUCTURE["terminal_motifs"]), total))


def tail_score(seq: Column) -> Column:
    """A's in the last 30 letters, and ten of them in a row."""
    tail = F.right(seq, F.lit(30))
    score = F.when(S.count_of(tail, "A") / 30 >= 0.7, 0.05).otherwise(0.0) + F.when(F.contains(tail, F.lit("A" * 10)), 0.02).otherwise(0.0)
    return F.when(F.length(seq) < 30, 0.0).otherwise(score)


def primer_score(seq: Column) -> Column:
    """A tRNA primer in the second hundred letters, and T's before the last 120."""
    turned = [p[::-1].translate(str.maketrans("ACGT", "TGCA")) for p in PRIMERS]
    head, tract = F.substring(seq, 101, 100), F.left(F.right(seq, F.lit(150)), F.lit(30))
    score = F.when(head.rlike("|".join([*PRIMERS, *turned])), 0.04).otherwise(0.0) + F.when(S.count_of(tract, "T") / 30 >= 0.7, 0.04).otherwise(0.0)
    return F.when(F.length(seq) < 500, 0.0).otherwise(score)


def tsd_scores(rate: Column, length: Column, tsd: Column | None = None) -> tuple[Column, Column]:
    """How many copies have a site duplication of the usual length, and whether that length is one of a known class."""
    often = F.when(rate >= 0.6, 0.12).when(rate >= 0.4, 0.08).when(rate >= 0.25, 0.04).otherwise(0.0)
    bonus = F.when(tsd == "TA", 0.02).otherwise(0.0) if tsd is not None else F.lit(0.0)
    return often, F.when(length.between(4, 6), 0.06).when(length == 2, 0.06 + bonus).when(length.between(7, 20), 0.06).otherwise(0.0)


def domain_score(domains: Column) -> Column:
    """Hallmark domains among lower-case names; null, where they weren't sought, stays null."""
    has = lambda *parts: F.exists(domains, lambda d: F.rlike(d, F.lit("|".join(parts))))
    rt, rnase, integrase = has("rt", "reverse_transcriptase"), has("rnase"), has("integrase", "int")
    part = lambda c, v: F.when(c, v).otherwise(0.0)
    total = F.when(rt & rnase & integrase, 0.17).when(rt, 0.05).otherwise(0.0) + part(rnase, 0.05) + part(integrase, 0.05)
    total = total + part(has("endonuclease", "ape"), 0.05) + part(has("orf1", "rrm", "ccch"), 0.05) + part(has("transposase", "dde"), 0.10) + part(has("rephel", "helicase"), 0.12)
    return F.when(domains.isNotNull(), F.least(F.lit(STRUCTURE["domains"]), total))


def frame_score(open_frame: Column, length: Column, expected: int = 1200) -> Column:
    share = open_frame / expected
    return F.when(length < 300, 0.0).when(share >= 0.7, 0.08).when(share >= 0.5, 0.04).otherwise(0.0)


def penalties(seq: Column, complexity: Column, domains: Column) -> dict[str, Column]:
    gc, n = S.fraction(seq, "GC"), F.length(seq)
    trna = n.between(70, 90) & (gc > 0.55) & seq.startswith("GC") & seq.endswith("CCA")
    has = lambda *parts: F.exists(domains, lambda d: F.rlike(d, F.lit("|".join(parts))))
    conflict = has("rt", "reverse_transcriptase") & (has("transposase") | has("helicase", "rephel"))
    return {
        "low_complexity": F.when(complexity < 0.3, 0.10).when(complexity < 0.5, 0.05).otherwise(0.0),
        "host": F.when(trna, 0.06).otherwise(0.0),
        "conflict": F.when(F.coalesce(conflict, F.lit(False)), 0.04).otherwise(0.0),
    }


def structure_score(parts: dict[str, Column], taken: dict[str, Column], has_hits: Column, quality: Column, validation: Column) -> tuple[Column, Column]:
    """(score, tier): what the parts gave of what those that ran could give, less a fifth of the penalties' share.

    A part that is null did not run. Where the evidence is thin, three fifths of the score come from quality.
    """
    total = lambda found, of: (sum((F.coalesce(c, F.lit(0.0)) for c in found.values()), F.lit(0.0)), sum((F.when(c.isNotNull(), F.lit(of[k])).otherwise(0.0) for k, c in found.items()), F.lit(0.0)))
    got, could = total(parts, STRUCTURE)
    lost, most = total(taken, PENALTIES)
    share = lambda a, b: F.when(b > 0, F.least(F.lit(1.0), a / b)).otherwise(0.0)
    score = F.greatest(F.lit(0.0), share(got, could) - 0.2 * share(lost, most))
    thin = ((got < 0.15) | (could < 0.5) | ~has_hits) & ((quality > 0) | (validation > 0))
    score = F.when(thin, score * 0.4 + (quality * 0.8 + validation * 0.2) * 0.6).otherwise(score)
    return score, F.when(score >= 0.5, "Strong").when(score >= 0.4, "Medium").when(score >= 0.3, "Weak").otherwise("Poor")
