"""Scores and tiers at hand-computed points, gates in their order, and verdicts one condition at a time."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators import consensus as C
from helixframe.operators import gates as G
from helixframe.operators import scores as S


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_copy_scores(spark):
    # a genome of 1 Gb: factor 1.30103, so 10 / 1.30103 = 7.68621 copies are expected from 3000 to 6999 bases, 3.84311 above
    rows = [(15, 100), (2, 100), (3, 5000), (4, 5000), (8, 5000), (12, 5000), (3, 9000), (4, 9000), (14, 100), (None, 100)]
    got = values(spark, rows, "c long, n long", S.copy_score(F.col("c"), F.col("n")))
    r = [3 / 7.686212, 4 / 7.686212, 8 / 7.686212, 12 / 7.686212, 3 / 3.843106, 4 / 3.843106]
    want = [1.0, 0.01, 0.4 + 0.2 * (r[0] - 0.25) / 0.25, 0.6 + 0.2 * (r[1] - 0.5) / 0.5, 0.8 + 0.2 * (r[2] - 1) / 0.5, 1.0, 0.6 + 0.2 * (r[4] - 0.5) / 0.5, 0.8 + 0.2 * (r[5] - 1) / 0.5, 0.6 + 0.2 * (14 / 15 - 0.5) / 0.5]
    assert [g[0] for g in got[:9]] == pytest.approx(want, abs=1e-6)


def test_identity_and_length_scores(spark):
    rows = [(70.0, 1000, 10), (65.0, 1000, 10), (50.0, 1000, 10), (45.0, 1000, 10), (20.0, 1000, 10), (60.0, 100, 101), (62.0, 100, 51), (-5.0, 100, 1)]
    got = values(spark, rows, "i double, n long, c long", S.identity_score(F.col("i"), F.col("n"), F.col("c")))
    assert [g[0] for g in got] == pytest.approx([1.0, 0.9, 0.6, 0.45, 0.15, 1.0, 1.0, 0.0])
    rows = [(40, 101), (40, 5), (60, 11), (60, 10), (99, 1), (100, 1), (200, 1), (3000, 1), (3001, 1), (7001, 1), (15_001, 2), (15_001, 1), (20_001, 3), (20_001, 2)]
    got = values(spark, rows, "n long, c long", S.length_score(F.col("n"), F.col("c")))
    assert [g[0] for g in got] == [0.1, 0.3, 0.5, 0.4, 0.7, 1.0, 1.0, 1.0, 0.95, 0.85, 0.7, 0.5, 0.4, 0.2]


def test_final_scores_and_class_cuts(spark):
    parts = {"copy": F.lit(1.0), "identity": F.lit(0.5), "complexity": F.lit(0.4), "length": F.lit(1.0), "boundary": F.lit(0.5)}
    got = values(spark, [(499,), (500,), (3000,)], "n long", S.final_score(F.col("n"), parts))
    assert [g[0] for g in got] == pytest.approx([0.45 + 0.1 + 0.08 + 0.1 + 0.025, 0.35 + 0.125 + 0.08 + 0.1 + 0.05, 0.3 + 0.15 + 0.06 + 0.1 + 0.075])
    for gb, shift in ((1.0, 0.0), (0.05, -0.05), (4.0, 0.05)):
        got = values(spark, [(499.0,), (1999.0,), (2000.0,)], "m double", *S.class_cuts(F.col("m"), gb))
        assert [x for g in got for x in g] == pytest.approx([0.6 + shift, 0.4 + shift, 0.65 + shift, 0.45 + shift, 0.7 + shift, 0.5 + shift])


def test_abundance_and_copy_cuts(spark):
    assert values(spark, [(10, 6.0)], "c long, kb double", S.abundance(F.col("c"), F.col("kb"), 2.0)) == [(10.0,)]
    got = values(spark, [(0.3,), (3.0,), (30.0,), (0.0,)], "kb double", *S.copy_cuts(F.col("kb"), 1.0))
    assert got == [(50, 250), (5, 25), (2, 4), (2, 6)]
    assert values(spark, [(3.0,)], "kb double", *S.copy_cuts(F.col("kb"), 0.0)) == [(2, 6)]


def test_size_tiers_and_matrices(spark):
    got = values(spark, [(0.0,), (99e6,), (100e6,), (300e6,), (1e9,), (3e9,), (10e9,), (30e9,)], "bp double", S.seed_count(F.col("bp")), S.window_stride(F.col("bp")))
    assert got == [(50, 100), (50, 50), (50, 100), (100, 100), (200, 100), (300, 200), (500, 500), (500, 1000)]
    got = values(spark, [(10.0,), (36.0,), (36.1,), (38.0,), (45.5,), (52.0,), (52.1,), (None,)], "gc double", S.gc_matrix(F.col("gc")))
    assert [g[0] for g in got] == ["35g", "35g", "37g", "37g", "45g", "51g", "53g", "41g"]


def test_long_terminal_repeats(spark):
    got = values(spark, [("TGAAAACA",), ("CAAAACA",), ("TGAAAATA",), ("CAAATG",), ("TGA",)], "s string", S.boundary_confidence(F.col("s")), S.boundary_confidence(F.col("s"), strict=True))
    assert got == [(1.0, 1.0), (0.8, 0.0), (0.8, 0.0), (0.0, 0.0), (0.0, 0.0)]
    got = values(spark, [("A" * 10 + "CCTGGTC" + "A" * 50, 10), ("A" * 40 + "TGGT", 10), ("TGGT" + "A" * 60, 10)], "s string, n long", S.primer_site(F.col("s"), F.col("n")))
    assert [g[0] for g in got] == [True, False, False]
    core = "TG" + "ACGTTGCA" * 20 + "CA"
    rows = [(core, 0.0, 0), ("AC" + core, 0.0, 0), ("TG" + "A" * 400 + "CA", 0.95, 60), ("GG" + "C" * 396 + "CT", 0.95, 60), ("TGCA" + "C" * 2500 + "TGCA", 0.75, 60)]
    got = [(r["kind"], round(r["total"], 6), r["category"]) for r in S.ltr_scores(spark.createDataFrame(rows, "seq string, similarity double, repeat_length long")).collect()]
    # motif 100 and a usual length; no motif; likeness and motifs; likeness alone in a short one, halved, then 0.4; likeness, TSD and motifs
    assert got == [("single", 100.0, "confirmed"), ("single", 0.0, "none"), ("complete", 55.0, "probable"), ("complete", 8.0, "none"), ("complete", 73.0, "confirmed")]


def test_structure_score(spark):
    tail = "ACGT" * 60 + "A" * 30
    assert values(spark, [(tail,), ("ACGT" * 10,), ("A" * 20,)], "s string", S.tail_score(F.col("s"))) == [(pytest.approx(0.07),), (0.0,), (0.0,)]
    got = values(spark, [(["rt", "rnase h", "integrase"],), (["rt"],), ([],), (None,), (["transposase", "helicase"],)], "d array<string>", S.domain_score(F.col("d")))
    assert [g[0] for g in got] == [0.17, 0.05, 0.0, None, 0.17]
    score, tier = S.structure_score({"terminal_pairs": F.lit(0.28), "domains": F.lit(None).cast("double"), "poly_a": F.lit(0.0)}, {"host": F.lit(0.06), "low_complexity": F.lit(0.0)}, F.lit(True), F.lit(0.0), F.lit(0.0))
    # 0.28 of 0.35, less a fifth of 0.06 of 0.16
    assert values(spark, [(1,)], "x long", score, tier) == [(pytest.approx(0.8 - 0.2 * 0.375), "Strong")]
    score, tier = S.structure_score({"poly_a": F.lit(0.0)}, {}, F.lit(False), F.lit(0.5), F.lit(1.0))
    assert values(spark, [(1,)], "x long", score, tier) == [(pytest.approx(0.6 * (0.4 + 0.2)), "Weak")]


def test_triage_reasons_come_in_order(spark):
    good = dict(topology="linear", length=500, copies=9, mdl=5.0, n_fraction=0.0, h1=1.9, dust=0.1, h2=3.5, simple_fraction=0.0)
    worse = [("topology", "cyclic", "cyclic_topology"), ("length", 49, "too_short"), ("copies", 1, "single_copy"), ("mdl", 0.0, "low_mdl"), ("n_fraction", 0.21, "high_n"), ("h1", 0.9, "low_entropy"), ("dust", 0.71, "dust"), ("h2", 1.5, "low_entropy2"), ("simple_fraction", 0.61, "simple_fraction")]
    rows = [good | {k: v for k, v, _ in worse[i:]} for i in range(len(worse))] + [good] + [good | dict(length=99, h1=0.85, h2=1.7)] + [good | dict(topology=None, mdl=None)]
    df = spark.createDataFrame(rows, "topology string, length long, copies long, mdl double, n_fraction double, h1 double, dust double, h2 double, simple_fraction double")
    assert [r[0] for r in df.select(G.first_reason(G.triage_rules())).collect()] == [w[2] for w in worse] + [None, None, None]
    last = spark.createDataFrame([good | dict(n_fraction=0.5, dust=0.9), good | dict(n_fraction=0.5)], df.schema)
    assert [r[0] for r in last.select(G.first_reason(G.final_rules())).collect()] == ["dust", "high_n"]


def test_small_gates(spark):
    got = values(spark, [("complex", "T3", 10), (None, "T1", 299), (None, "T1", 300), ("linear", "T2", 150), (None, None, 150), (None, "T3", 9999)], "t string, k string, n long", G.chimera_eligible(F.col("t"), F.col("k"), F.col("n")))
    assert [g[0] for g in got] == [True, False, True, True, True, False]
    families = spark.createDataFrame([(1, 5, 100), (2, 4, 100), (3, None, 100), (4, 9, 99)], "id long, members long, length long")
    kept = G.discovery_gate(families)
    assert sorted(r.id for r in kept.collect()) == [1, 3]
    assert G.within_bound(kept, 1).count() == 2 and G.within_bound(kept, 0).count() == 2
    with pytest.raises(Exception, match="bound"):
        G.within_bound(kept, 0.1).collect()
    got = values(spark, [("SVA_A", 900, 1000, 900.0), ("SVA_A", 1300, 1371, 900.0), ("SVA_A", 800, 1000, 900.0), ("LAVA", 1, 2, 499.0), ("LAVA", 1, 2, 500.0), ("Alu", 900, 1000, 1.0)], "n string, b long, e long, s double", G.before_masklevel(*(F.col(c) for c in "nbes")))
    assert [g[0] for g in got] == [False, False, True, False, True, True]
    got = values(spark, [(10.0, 20.0), (10.0, 100.0)], "d double, i double", G.adjusted_divergence(F.col("d"), F.col("i")))
    assert [g[0] for g in got] == [12.5, 10.0]
    got = values(spark, [(4, 99.0, 9.0, 9.0), (5, 20.1, 0.0, 0.0), (5, 0.0, 0.31, 0.0), (5, 0.0, 0.3, 9.0), (20, 0.0, 0.0, 9.0), (21, 0.0, 0.0, 5.1)], "n long, r double, c double, s double", G.splits(*(F.col(c) for c in "nrcs")))
    assert [g[0] for g in got] == [False, True, True, False, False, True]
    got = values(spark, [(0.1, 79, 0.2), (0.1, 80, 0.2), (0.5, 79, 0.2), (0.7, 10, 0.0), (0.1, 79, 0.3)], "s double, n long, c double", G.candidate_class(F.col("s"), F.col("n"), F.col("c"), F.lit(0.65), F.lit(0.45)))
    assert [g[0] for g in got] == ["rejected", "C", "B", "A", "C"]


def test_gene_exclusion_and_routes(spark):
    hits = spark.createDataFrame([(1, 100, 400, 35.0), (2, 70, 400, 90.0), (3, 70, 400, 90.0), (4, 100, 400, 34.9), (5, 20, 0, 99.0)], "q long, width long, qlen long, pident double")
    records = spark.createDataFrame([(1, True), (2, True), (3, False), (4, False), (5, None), (6, None)], "id long, has_signal boolean")
    assert sorted((r.id, round(r["cov"], 6), r.excluded) for r in G.gene_excluded(hits, records).collect()) == [(1, 0.75, True), (2, 0.525, False), (3, 0.525, True), (4, 0.0, False), (5, 0.0, False), (6, 0.0, False)]
    organelle = spark.createDataFrame([(1, 30, 100, 80.0), (1, 30, 100, 99.0), (2, 90, 100, 79.9)], "q long, width long, qlen long, pident double")
    rrna, tandem = spark.createDataFrame([(1,), (3,), (3,)], "q long"), spark.createDataFrame([(2, 1, 50), (3, 1, 100), (4, 1, 49)], "q long, s long, e long")
    rows = spark.createDataFrame([(i, 100) for i in range(1, 6)], "id long, length long")
    assert sorted((r.id, r.route) for r in G.foreign_routes(rows, organelle, rrna, tandem).collect()) == [(1, "organelle"), (2, "satellite"), (3, "rrna"), (4, "te"), (5, "te")]


def test_pseudo_families_need_every_condition(spark):
    # n, median identity, homologous share, fallback, coherent copies, verified
    rows = [(5, 0.44, 0.24, True, 0, True), (5, 0.44, 0.24, True, 0, None), (5, 0.44, 0.24, True, 0, False), (5, 0.44, 0.24, False, 0, True), (4, 0.44, 0.24, True, 0, True), (5, 0.45, 0.24, True, 0, True), (5, 0.44, 0.25, True, 0, True), (5, 0.44, 0.24, True, 1, True), (5, 0.44, 0.24, True, None, True)]
    got = values(spark, rows, "n long, m double, h double, f boolean, c long, v boolean", G.pseudo_family(*(F.col(c) for c in "nmhfcv")))
    assert [g[0] for g in got] == ["pseudo", "pseudo", "unverified", "clustered", "few_copies", "coherent", "coherent", "seed_coherent", "seed_coherent"]


def test_strata(spark):
    rows = [(1, k, k / 100, 1000 - k) for k in range(30)] + [(2, k, 0.5, k) for k in range(20)]
    df = spark.createDataFrame(rows, "fam long, id long, dvg double, size long")
    got = G.stratified(df, "fam", 20, "dvg", "size", ["id"]).collect()
    one = sorted((r.place, r.id, r.stratum) for r in got if r.fam == 1)
    # 30 over a cap of 20 are two strata of 15; the largest of each have the smallest numbers here
    assert one == [(2 * k + 1 + s, 15 * s + k, s + 1) for k in range(10) for s in (0, 1)]
    assert sorted(r.id for r in got if r.fam == 2) == list(range(20)) and {r.stratum for r in got if r.fam == 2} == {1}


def test_quantiles_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    for data in ([3.0], [1.0, 2.0], [5.0] * 9 + [7.0], (rng.normal(size=501) * 10.0 ** rng.integers(-3, 6, 501)).tolist(), [0.0, -1.0, 1.0, 0.0]):
        df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "v double").repartition(3)
        row = G.with_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.9}).first()
        assert [row.a, row.b, row.c] == pytest.approx(np.quantile(data, [0.25, 0.5, 0.9]).tolist(), rel=1e-12)
        assert row["__n"] == len(data) + 1


def test_places(spark):
    df = spark.createDataFrame([(k * 7919 % 101, k) for k in range(300)], "a long, id long").repartition(5)
    got = sorted((r.place, r.a, r.id) for r in G.placed(df, [F.desc("a"), F.asc("id")]).collect())
    assert got == [(k, a, i) for k, (a, i) in enumerate(sorted(((k * 7919 % 101, k) for k in range(300)), key=lambda x: (-x[0], x[1])), 1)]


def test_conserved_blocks(spark):
    # columns: 4 equal rows, one with a gap; one column of two bases (entropy 1) parts two blocks
    rows = [(1, "AACAAG"), (1, "AACAAG"), (1, "AAGAAG"), (1, "AAGAAG"), (1, "AACAA-")]
    columns = C.column_counts(C.exploded(spark.createDataFrame(rows, "fam long, seq string"), ["fam"], "seq"), "fam")
    got = sorted((r["first"], r["last"], r.conservation) for r in C.conserved_blocks(columns, "fam", least=2).collect())
    assert got == [(0, 1, 1.0), (3, 4, 1.0)]  # the gap's share is 0.2, which is not under 0.2


def test_copies_are_trimmed_where_both_sides_agree(spark):
    schema = "fam long, id long, length long, te_start long, te_end long, d5 long, d3 long"
    agree = [(1, k, 300, 50, 250, 4 if k < 4 else None, -4 if k < 4 else None) for k in range(5)]  # bins 3 and -3
    few = [(2, k, 300, 50, 250, 3 if k < 3 else None, -3 if k < 3 else None) for k in range(5)]
    short = [(3, k, 120, 50, 70, 0, 0) for k in range(4)]  # 20 bases would be left
    got = {(r.fam, r.id): (r.keep_from, r.keep_to) for r in C.trimmed_copies(spark.createDataFrame(agree + few + short, schema), "fam", ["id"]).collect()}
    assert all(got[1, k] == (53, 247) for k in range(5)) and all(got[2, k] == (0, 300) for k in range(5)) and all(got[3, k] == (0, 120) for k in range(4))


def test_coherence(spark):
    # 10 hits: starts 8 near 100, ends all near 200; the mode is the value seen most, and first on ties
    rows = [(1, k, 100 + (k % 2) * 9 if k < 8 else 300, 200 + k) for k in range(10)] + [(2, k, 1, 1) for k in range(9)]
    got = {r.q: (r.start_mode, r.end_mode, r.coherence, r.bonus) for r in C.coherence(spark.createDataFrame(rows, "q long, k long, s long, e long"), "q", [F.asc("k")], "s", "e").collect()}
    assert got == {1: (100, 200, pytest.approx(0.9), 0.06), 2: (1, 1, 1.0, 0.0)}


def test_refined_families_never_get_worse(spark):
    base = "ACGTACGGTTCA" * 6
    rows = [(1, k, base) for k in range(5)] + [(2, k, base) for k in range(4)] + [(3, k, "ACGT" * 5) for k in range(6)]
    msa = spark.createDataFrame(rows, "fam long, turn long, seq string")
    columns = C.column_counts(C.exploded(msa, ["fam"], "seq"), "fam")
    members, seeds = msa.groupBy("fam").agg(F.count(F.lit(1)).alias("n")), spark.createDataFrame([(1, "SEED1"), (2, "SEED2"), (3, "SEED3"), (4, "SEED4")], "fam long, seed string")
    members = members.union(spark.createDataFrame([(4, 9)], "fam long, n long"))
    got = {r.fam: (r.sequence, r.source) for r in C.refined(columns, "fam", members, seeds).collect()}
    assert got == {1: (base, "refined"), 2: ("SEED2", "original"), 3: ("SEED3", "original"), 4: ("SEED4", "original")}
