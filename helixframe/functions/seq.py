"""Column functions over sequences, all inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The complements of the IUPAC codes; codes that take an ambiguity to N when cleaned.
IUPAC, COMPLEMENTS = "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"
AMBIGUOUS = "WRMKYSHBVDX"


def reverse_complement(seq: Column) -> Column:
    """IUPAC-aware; other characters become N."""
    known = F.regexp_replace(F.upper(seq), f"[^{IUPAC}]", "N")
    return F.reverse(F.translate(known, IUPAC, COMPLEMENTS))


def clean(seq: Column) -> Column:
    """Upper case, ambiguity codes as N."""
    return F.translate(F.upper(seq), AMBIGUOUS, "N" * len(AMBIGUOUS))


def hard_masked(seq: Column) -> Column:
    """Soft-masked (lower-case) bases as N."""
    return F.regexp_replace(seq, "[acgtn]", "N")


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of seq are among letters."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def fraction(seq: Column, letters: str) -> Column:
    """Their share of the length; 0 for an empty sequence."""
    return F.when(F.length(seq) > 0, count_of(seq, letters) / F.length(seq)).otherwise(F.lit(0.0))


def gc_of_known(seq: Column) -> Column:
    """GC over A, C, G and T alone."""
    known = count_of(seq, "ACGT")
    return F.when(known > 0, count_of(seq, "CG") / known).otherwise(F.lit(0.0))


def rounded(value: Column, digits: int) -> Column:
    """A double rounded by its product with a power of ten, halves away from zero, as SQL engines round doubles.

    F.round looks at the shortest decimal instead: 41 of 640, 0.0640625, goes up there, but its product lies below 64062.5.
    """
    return F.round(value * 10.0**digits, 0) / 10.0**digits


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def entropy_of(counts: list[Column]) -> Column:
    """Shannon entropy in bits of the given counts."""

    def of(c: Column, total: Column) -> Column:
        terms = F.transform(F.filter(c, lambda n: n > 0), lambda n: -(n / total) * F.log2(n / total))
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    return let(F.array(*(n.cast("double") for n in counts)), lambda c: let(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), lambda total: of(c, total)))


def entropy1(seq: Column) -> Column:
    return entropy_of([count_of(seq, b) for b in "ACGT"])


def kmers(seq: Column, k: int) -> Column:
    """All overlapping k-mers in order, in one pass; none if the sequence is shorter."""
    return F.regexp_extract_all(seq, F.lit(f"(?=(.{{{k}}}))"), 1)


def identical_positions(a: Column, b: Column) -> Column:
    """Positions at which two sequences agree, over the shorter."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y) & (x != ""))
    return F.size(F.filter(same, lambda x: x))


def longest_homopolymer(seq: Column) -> Column:
    runs = F.regexp_extract_all(seq, F.lit("(A+|C+|G+|T+|N+)"), 1)
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def inverted_ends(seq: Column, least: int = 10, most: int = 40, mismatches: int = 2) -> Column:
    """Whether some head of least..min(most, length / 4) bases pairs with the tail's reverse complement."""
    limit = F.least(F.lit(most), F.floor(F.length(seq) / 4).cast("int"))
    tail = reverse_complement(F.right(seq, F.lit(most)))

    def apart(n: Column) -> Column:
        return n - identical_positions(F.substring(seq, F.lit(1), n), F.substring(tail, F.lit(1), n))

    return F.when(limit >= least, F.exists(F.sequence(F.lit(least), limit), lambda n: apart(n) <= mismatches)).otherwise(F.lit(False))
