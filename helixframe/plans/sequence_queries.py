"""Sequence functions, gates and scores (operators A2, B1-B4, B7-B10, B12-B16, D2-D4, D8, I1, I2, I5-I7, I9, I12, I14, I18, I20, I21, I27)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions import seq as S
from helixframe.operators import gates as G
from helixframe.operators import kernels as K
from helixframe.operators import passes as P
from helixframe.operators import scores as SC
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table

H1_SQL = " + ".join(f"CASE WHEN len_{b} > 0 THEN -(len_{b} / tot) * log2(len_{b} / tot) ELSE 0 END" for b in "acgt")
COUNTS_SQL = ", ".join(f"CAST(length(seq) - length(replace(seq, '{b}', '')) AS DOUBLE) AS len_{b.lower()}" for b in "ACGT")
ENTROPY = f"counts AS (SELECT id, seq, length(seq) AS len, {COUNTS_SQL} FROM seqs), h AS (SELECT *, CASE WHEN tot > 0 THEN {H1_SQL} ELSE 0 END AS h1 FROM (SELECT *, len_a + len_c + len_g + len_t AS tot FROM counts) c)"
PAIRS = "pairs AS (SELECT id, substr(seq, i, 2) AS w FROM (SELECT id, seq, unnest(range(1, length(seq))) AS i FROM seqs) x), h2 AS (SELECT id, -sum(n / t * log2(n / t)) AS h2 FROM (SELECT id, CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER (PARTITION BY id) AS DOUBLE) AS t FROM (SELECT id, w, count(*) AS n FROM pairs GROUP BY id, w) y) z GROUP BY id)"
RUNS = "greatest(" + ", ".join(f"coalesce(list_max(list_transform(regexp_extract_all(seq, '{b}+'), lambda x: length(x))), 0)" for b in "ACGT") + ")"


@QUERIES.add("a2_substring_counts", f"""WITH {V.SEQS} SELECT id, substr(seq, 11, 40) AS part, length(seq) - length(replace(replace(seq, 'G', ''), 'C', '')) AS gc, length(seq) AS len, md5(CASE WHEN length(seq) >= 14 THEN substr(seq, 1, 9) || 'NNNNN' || substr(seq, 15) ELSE seq END) AS replaced FROM seqs""")
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = F.when(F.length("seq") >= 14, F.overlay("seq", F.lit("NNNNN"), 10)).otherwise(F.col("seq"))
    return V.seqs(spark, sf_dir).select("id", F.substring("seq", 11, 40).alias("part"), S.count_of(F.col("seq"), "GC").cast("long").alias("gc"), F.length("seq").cast("long").alias("len"), F.md5(replaced.cast("binary")).alias("replaced"))


@QUERIES.add("b1_clean_and_rename", f"""WITH {V.RAW} SELECT 'chr' || row_number() OVER (ORDER BY id) AS name, id, md5(translate(upper(seq), 'WRMKYSHBVDX', 'NNNNNNNNNNN')) AS cleaned, length(seq) AS len FROM raw""")
def b1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned sequences, and the names chr<ordinal> that they get in order (B1, B2)."""
    rows = V.raw(spark, sf_dir).withColumn("cleaned", F.md5(S.clean(F.col("seq")).cast("binary"))).select("id", "cleaned", F.length("seq").cast("long").alias("len"))
    return G.placed(rows, [F.asc("id")]).select(F.concat(F.lit("chr"), F.col("place").cast("string")).alias("name"), "id", "cleaned", "len")


@QUERIES.add("b3_hard_mask", f"""WITH {V.RAW} SELECT id, md5(regexp_replace(seq, '[acgtn]', 'N', 'g')) AS masked, length(seq) - length(regexp_replace(seq, '[acgtn]', '', 'g')) AS n_masked FROM raw""")
def b3(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    return V.raw(spark, sf_dir).select("id", F.md5(S.hard_masked(seq).cast("binary")).alias("masked"), S.count_of(seq, "acgtn").cast("long").alias("n_masked"))


@QUERIES.add("i1_reverse_complement", f"""WITH {V.RAW} SELECT id, md5(reverse(translate(regexp_replace(upper(seq), '[^ACGTRYSWKMBDHVN]', 'N', 'g'), 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN'))) AS rc FROM raw""")
def i1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.raw(spark, sf_dir).select("id", F.md5(S.reverse_complement(F.col("seq")).cast("binary")).alias("rc"))


@QUERIES.add("i2_entropy", f"""WITH {V.SEQS}, {ENTROPY}, {PAIRS} SELECT h.id, round(h1, 6) AS h1, round(coalesce(h2, 0), 6) AS h2 FROM h LEFT JOIN h2 ON h.id = h2.id""")
def i2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_entropies(V.seqs(spark, sf_dir), "id", "seq").select("id", F.round("h1", 6).alias("h1"), F.round("h2", 6).alias("h2"))


@QUERIES.add("i5_fractions", f"""WITH {V.RAW} SELECT id, round(CASE WHEN length(seq) > 0 THEN CAST(length(seq) - length(translate(upper(seq), 'GC', '')) AS DOUBLE) / length(seq) ELSE 0 END, 6) AS gc, round(CASE WHEN length(seq) > 0 THEN CAST(length(seq) - length(translate(upper(seq), 'N', '')) AS DOUBLE) / length(seq) ELSE 0 END, 6) AS n_frac,
round(CASE WHEN length(seq) - length(translate(upper(seq), 'ACGT', '')) > 0 THEN CAST(length(seq) - length(translate(upper(seq), 'GC', '')) AS DOUBLE) / (length(seq) - length(translate(upper(seq), 'ACGT', ''))) ELSE 0 END, 6) AS gc_known FROM raw""")
def i5(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.upper("seq")
    return V.raw(spark, sf_dir).select("id", F.round(S.fraction(seq, "GC"), 6).alias("gc"), F.round(S.fraction(seq, "N"), 6).alias("n_frac"), F.round(S.gc_of_known(seq), 6).alias("gc_known"))


@QUERIES.add("i6_windowed_gc", f"""WITH {V.SEQS}, w AS (SELECT id, substr(seq, CAST(i AS BIGINT), 500) AS win FROM (SELECT id, seq, unnest(range(1, length(seq) - 498, 250)) AS i FROM seqs WHERE length(seq) >= 1000) x)
SELECT seqs.id, round(coalesce(stddev_pop(CAST(500 - length(replace(replace(win, 'G', ''), 'C', '')) AS DOUBLE) / 500), 0), 6) AS gc_std, count(win) AS windows FROM seqs LEFT JOIN w ON w.id = seqs.id GROUP BY seqs.id""")
def i6(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.when(F.length("seq") >= 1000, F.sequence(F.lit(1), F.length("seq") - 499, F.lit(250))).otherwise(F.array().cast("array<int>"))
    rows = V.seqs(spark, sf_dir).withColumn("gc", F.transform(starts, lambda i: S.count_of(F.substring("seq", i, F.lit(500)), "GC") / F.lit(500.0)))
    n = F.size("gc")
    mean = F.aggregate("gc", F.lit(0.0), lambda a, x: a + x) / F.greatest(n, F.lit(1))
    var = F.aggregate("gc", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / F.greatest(n, F.lit(1))
    return rows.withColumn("mean", mean).select("id", F.round(F.when(n > 0, F.sqrt(var)).otherwise(F.lit(0.0)), 6).alias("gc_std"), n.cast("long").alias("windows"))


@QUERIES.add("i7_homopolymers", f"""WITH {V.SEQS} SELECT id, {RUNS} AS longest, len(regexp_extract_all(seq, 'A{{5,}}|C{{5,}}|G{{5,}}|T{{5,}}')) AS runs FROM seqs""")
def i7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.seqs(spark, sf_dir).select("id", S.longest_homopolymer(F.col("seq")).cast("long").alias("longest"), F.regexp_count("seq", F.lit("A{5,}|C{5,}|G{5,}|T{5,}")).cast("long").alias("runs"))


@QUERIES.add("i14_boundary_motif", f"""WITH {V.SEQS}, l AS (SELECT *, CAST(floor(length(seq) / 10) AS BIGINT) AS ltr FROM seqs) SELECT id, CAST(CASE WHEN length(seq) < 4 THEN 0 WHEN left(seq, 2) = 'TG' AND right(seq, 2) = 'CA' THEN 1.0 WHEN left(seq, 2) = 'CA' AND right(seq, 2) = 'CA' THEN 0.8 WHEN left(seq, 2) = 'TG' AND right(seq, 2) = 'TA' THEN 0.8 ELSE 0.0 END AS DOUBLE) AS motif, length(seq) >= 4 AND left(seq, 2) = 'TG' AND right(seq, 2) = 'CA' AS canonical, regexp_matches(substr(seq, ltr + 1, 20), 'TGG[CTA]') AND (regexp_matches(substr(seq, ltr + 1, 20), 'TGG[TA]|TGGC[GACT]')) AS pbs, contains(right(seq, 50), 'AAAAAA') AS poly_a FROM l""")
def i14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends like those of a long terminal repeat, and a primer site behind one of a tenth of the sequence."""
    seq = F.col("seq")
    return V.seqs(spark, sf_dir).select("id", SC.boundary_confidence(seq).alias("motif"), (SC.boundary_confidence(seq, strict=True) == 1).alias("canonical"), SC.primer_site(seq, F.floor(F.length(seq) / 10)).alias("pbs"), F.contains(F.right("seq", F.lit(50)), F.lit("AAAAAA")).alias("poly_a"))


@QUERIES.add("i12_inverted_ends", f"""WITH {V.SEQS}, r AS (SELECT id, seq, reverse(translate(right(seq, 40), 'ACGT', 'TGCA')) AS tail FROM seqs WHERE length(seq) >= 40),
p AS (SELECT id, length(seq) AS len, seq, tail, unnest(range(10, CAST(least(40, floor(length(seq) / 4)) AS BIGINT) + 1)) AS n FROM r),
m AS (SELECT id, n, list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN substr(seq, i, 1) = substr(tail, i, 1) THEN 0 ELSE 1 END)) AS mm FROM p)
SELECT seqs.id, coalesce(bool_or(mm <= 2), false) AS tir FROM seqs LEFT JOIN m ON m.id = seqs.id GROUP BY seqs.id""")
def i12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.seqs(spark, sf_dir).select("id", S.inverted_ends(F.col("seq")).alias("tir"))


@QUERIES.add("i9_positional_similarity", f"""WITH {V.SEQS}, p AS (SELECT a.id, a.seq AS x, b.seq AS y, least(length(a.seq), length(b.seq)) AS n FROM seqs a JOIN seqs b ON b.id = a.id + 1), q AS (SELECT id, n, substr(x, i, 1) = substr(y, i, 1) AS same FROM (SELECT id, n, x, y, unnest(range(1, n + 1)) AS i FROM p) u)
SELECT p.id, CAST(count_if(q.same) AS BIGINT) AS same, round(CASE WHEN p.n > 0 THEN CAST(count_if(q.same) AS DOUBLE) / p.n ELSE 0 END, 6) AS similarity FROM p LEFT JOIN q ON q.id = p.id GROUP BY p.id, p.n""")
def i9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.seqs(spark, sf_dir)
    pairs = rows.join(rows.select((F.col("id") - 1).alias("id"), F.col("seq").alias("other")), "id")
    n = F.least(F.length("seq"), F.length("other"))
    same = S.identical_positions(F.col("seq"), F.col("other"))
    return pairs.select("id", same.cast("long").alias("same"), S.rounded(F.when(n > 0, same / n).otherwise(F.lit(0.0)), 6).alias("similarity"))


GATE = "CASE WHEN len < 100 THEN 'short' WHEN len > 30000 THEN 'long' WHEN h1 < CASE WHEN len < 100 THEN 0.8 ELSE 1.9 END THEN 'low_entropy' WHEN {runs} > 12 THEN 'homopolymer' ELSE 'pass' END"


@QUERIES.add("b4_qc_reason_counts", f"""WITH {V.SEQS}, {ENTROPY} SELECT {GATE.format(runs=RUNS)} AS reason, count(*) AS n FROM h GROUP BY 1""")
def b4(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq, length = F.col("seq"), F.length("seq")
    rules = [("short", length < 100), ("long", length > 30000), ("low_entropy", S.entropy1(seq) < F.when(length < 100, 0.8).otherwise(1.9)), ("homopolymer", S.longest_homopolymer(seq) > 12)]
    return G.reason_counts(V.seqs(spark, sf_dir), G.first_reason(rules))


@QUERIES.add("b4_insertion_gate")
def b4_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason, DUST among them, that each sequence would go for; null if it stays."""
    seqs = V.seqs(spark, sf_dir)
    facts = seqs.select("id", F.length("seq").alias("length"), S.fraction(F.col("seq"), "N").alias("n_share"))
    rows = facts.join(P.with_entropies(seqs, "id", "seq"), "id").join(K.with_dust(seqs, "id", "seq"), "id")
    return rows.select("id", F.col("length").cast("long").alias("length"), G.first_reason(G.insertion_rules()).alias("reason"))


@QUERIES.add("b14_load_filter", f"""WITH {V.SEQS}, f AS (SELECT id, length(seq) AS len, CASE WHEN length(seq) > 0 THEN CAST(length(seq) - length(replace(replace(seq, 'G', ''), 'C', '')) AS DOUBLE) / length(seq) ELSE 0 END AS gc, CASE WHEN length(seq) > 0 THEN CAST(length(seq) - length(replace(seq, 'N', '')) AS DOUBLE) / length(seq) ELSE 0 END AS ns FROM seqs) SELECT id, len, round(gc, 6) AS gc, 'seq_l' || len || '_t' || id || '_set1' AS name FROM f WHERE len BETWEEN 50 AND 50000 AND ns <= 0.2 AND gc BETWEEN 0.1 AND 0.9""")
def b14(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    rows = V.seqs(spark, sf_dir).select("id", F.length("seq").cast("long").alias("len"), S.fraction(seq, "GC").alias("gc"), S.fraction(seq, "N").alias("n_share"))
    rows = rows.filter(G.loadable(F.col("len"), F.col("n_share"), F.col("gc")))
    return rows.select("id", "len", F.round("gc", 6).alias("gc"), F.format_string("seq_l%d_t%d_set1", "len", "id").alias("name"))


@QUERIES.add("b15_merge_preprocess", f"""WITH {V.SEQS} SELECT id, length(seq) AS len FROM seqs WHERE length(seq) >= 80 AND {RUNS} <= 50 AND CAST(length(seq) - length(replace(replace(seq, 'A', ''), 'T', '')) AS DOUBLE) / length(seq) <= 0.95""")
def b15(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    return V.seqs(spark, sf_dir).filter((F.length("seq") >= 80) & (S.fraction(seq, "N") <= 0.15) & (S.longest_homopolymer(seq) <= 50) & (S.fraction(seq, "AT") <= 0.95)).select("id", F.length("seq").cast("long").alias("len"))


@QUERIES.add("b16_validity_checks", f"""WITH {V.SEQS}, {ENTROPY}, k AS (SELECT id, len BETWEEN 50 AND 20000 AS ok_len, CASE WHEN len > 0 THEN (len_g + len_c) / len ELSE 0 END > 0.1 AND CASE WHEN len > 0 THEN (len_g + len_c) / len ELSE 0 END < 0.9 AS ok_gc, CASE WHEN len > 0 THEN CAST(len - length(replace(seq, 'N', '')) AS DOUBLE) / len ELSE 0 END < 0.15 AS ok_n, CASE WHEN len > 0 THEN CAST(len - length(regexp_replace(seq, '[^ACGTN]', '', 'g')) AS DOUBLE) / len ELSE 0 END < 0.2 AS ok_ambiguity, h1 > 0.8 AS ok_entropy FROM h)
SELECT id, ok_len, ok_gc, ok_n, ok_ambiguity, ok_entropy, round((CAST(ok_len AS INT) + CAST(ok_gc AS INT) + CAST(ok_n AS INT) + CAST(ok_ambiguity AS INT) + CAST(ok_entropy AS INT)) / 5.0, 6) AS score FROM k""")
def b16(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    other = F.when(F.length("seq") > 0, F.regexp_count("seq", F.lit("[^ACGTN]")) / F.length("seq")).otherwise(0.0)
    checks = G.validity_checks(F.length("seq"), S.fraction(seq, "N"), S.fraction(seq, "GC"), other, S.entropy1(seq))
    rows = V.seqs(spark, sf_dir).select("id", *(c.alias(k) for k, c in checks.items()))
    return rows.withColumn("score", F.round(sum(F.col(k).cast("int") for k in checks) / F.lit(float(len(checks))), 6))


TIERS = f"""{V.RECORDS}, m AS (SELECT *, mdl / greatest(copies, 1) AS mpc FROM records), q AS (SELECT quantile_cont(mpc, 0.25) AS p25, quantile_cont(mpc, 0.75) AS p75, count(*) AS n FROM m),
t AS (SELECT m.*, CASE WHEN mpc >= CASE WHEN n < 100 THEN 20 ELSE p75 END OR (copies >= 50 AND length >= 80) THEN CASE WHEN divergence > 0.20 THEN 'T2' ELSE 'T1' END WHEN mpc < CASE WHEN n < 100 THEN 5 ELSE p25 END THEN 'T3' ELSE 'T2' END AS t0 FROM m, q),
tiers AS (SELECT *, CASE WHEN t0 = 'T2' AND length < 200 AND (SELECT count(*) FROM t WHERE t0 = 'T2') > 10000 THEN 'T1' ELSE t0 END AS tier FROM t)"""


@QUERIES.add("d2_mdl_tiers", f"WITH {TIERS} SELECT id, length, copies, round(mpc, 4) AS mpc, tier FROM tiers")
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.mdl_tiers(V.records(spark, sf_dir)).select("id", "length", "copies", F.round("mpc", 4).alias("mpc"), "tier")


MASKING = "tier IN ('T1', 'T2') AND copies >= CASE WHEN length >= 500 THEN 2 WHEN length >= 200 THEN 3 WHEN length >= 100 THEN 5 ELSE 10 END"


@QUERIES.add("b8_library_split", f"WITH {TIERS} SELECT id, tier, {MASKING} AS masking, ({MASKING}) OR (tier = 'T3' AND copies >= 3) AS analysis FROM tiers")
def b8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.library_flags(G.mdl_tiers(V.records(spark, sf_dir))).select("id", "tier", "masking", "analysis")


@QUERIES.add("b7_native_tier_gate", f"""WITH {TIERS}, s AS (SELECT *, id % 97 = 0 AS has_signal FROM tiers) SELECT id, tier, copies FROM s WHERE NOT EXISTS (SELECT 1 FROM s WHERE has_signal) OR tier IS NULL OR tier IN ('T1') OR has_signal OR copies >= 50""")
def b7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = G.mdl_tiers(V.records(spark, sf_dir)).withColumn("has_signal", F.col("id") % 97 == 0)
    any_signal = rows.agg(F.coalesce(F.bool_or("has_signal"), F.lit(False)).alias("any_signal"))
    keep = ~F.col("any_signal") | F.col("tier").isNull() | (F.col("tier") == "T1") | F.col("has_signal") | (F.col("copies") >= 50)
    return rows.join(F.broadcast(any_signal)).filter(keep).select("id", "tier", "copies")


@QUERIES.add("b9_low_copy_filter", f"""WITH {V.RECORDS}, g AS (SELECT *, CASE WHEN id % 3 = 0 THEN copies - 25 END AS genomic, CASE WHEN id % 5 = 0 THEN NULL ELSE id % 4000 END AS mb FROM records),
c AS (SELECT id, length, coalesce(genomic, copies) AS c, CASE WHEN mb IS NULL THEN 3 WHEN mb < 100 THEN 3 WHEN mb < 500 THEN 4 WHEN mb < 1000 THEN 5 WHEN mb < 3000 THEN 6 ELSE 8 END AS least FROM g)
SELECT id, c AS copies, least AS least_copies, (c < 2) OR (c < least AND length < 200) AS dropped FROM c""")
def b9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.records(spark, sf_dir).withColumns({"genomic": F.when(F.col("id") % 3 == 0, F.col("copies") - 25), "mb": F.when(F.col("id") % 5 != 0, F.col("id") % 4000)})
    return rows.select("id", F.coalesce("genomic", "copies").alias("copies"), G.least_copies(F.col("mb")).alias("least_copies"), G.low_copy_dropped(F.col("copies"), F.col("genomic"), F.col("length"), F.col("mb"), 2).alias("dropped"))


@QUERIES.add("b10_size_bands", """WITH g AS (SELECT p_partkey AS id, CAST(p_size * p_size * (p_partkey % 7) * 5000000.0 AS DOUBLE) AS bp, p_retailprice / 40.0 AS gc FROM part) SELECT id, CASE WHEN bp <= 0 THEN 50 WHEN bp < 300000000 THEN 50 WHEN bp < 1000000000 THEN 100 WHEN bp < 3000000000 THEN 200 WHEN bp < 10000000000 THEN 300 ELSE 500 END AS seeds, CASE WHEN bp <= 0 THEN 100 WHEN bp < 100000000 THEN 50 WHEN bp < 3000000000 THEN 100 WHEN bp < 10000000000 THEN 200 WHEN bp < 30000000000 THEN 500 ELSE 1000 END AS stride,
CASE WHEN gc <= 36 THEN '35g' WHEN gc <= 38 THEN '37g' WHEN gc <= 40 THEN '39g' WHEN gc <= 42 THEN '41g' WHEN gc <= 44 THEN '43g' WHEN gc <= 46 THEN '45g' WHEN gc <= 48 THEN '47g' WHEN gc <= 50 THEN '49g' WHEN gc <= 52 THEN '51g' ELSE '53g' END AS matrix FROM g""")
def b10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds and strides by genome size, matrices by GC content; parts stand for genomes."""
    size = (F.col("p_size") * F.col("p_size") * (F.col("p_partkey") % 7)).cast("double") * 5e6
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), size.alias("bp"), (F.col("p_retailprice").cast("double") / 40).alias("gc"))
    return rows.select("id", SC.seed_count(F.col("bp")).alias("seeds"), SC.window_stride(F.col("bp")).alias("stride"), SC.gc_matrix(F.col("gc")).alias("matrix"))


@QUERIES.add("b12_coordinate_clamp", f"""WITH {V.INSTANCES}, l AS (SELECT chrom, CAST(floor(max(e) * 0.9) AS BIGINT) AS len FROM instances WHERE chrom <> 'chr5' GROUP BY chrom)
SELECT chrom, greatest(0, s - 60) AS s, least(e + 60, len) AS e, count(*) AS n FROM instances JOIN l USING (chrom) WHERE least(e + 60, len) - greatest(0, s - 60) >= 100 GROUP BY 1, 2, 3""")
def b12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.instances(spark, sf_dir)
    lengths = rows.filter("chrom <> 'chr5'").groupBy("chrom").agg(F.floor(F.max("e") * 0.9).cast("long").alias("len"))
    rows = rows.join(lengths, "chrom").select("chrom", F.greatest(F.lit(0), F.col("s") - 60).alias("s"), F.least(F.col("e") + 60, "len").alias("e"))
    return rows.filter("e - s >= 100").groupBy("chrom", "s", "e").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("b13_padded_regions", f"""WITH {V.INSTANCES}, p AS (SELECT *, CAST(floor(least(500, greatest(50, 0.2 * (e - s)))) AS BIGINT) AS pad FROM instances) SELECT o, ln, fam, chrom || ':' || greatest(1, s + 1 - pad) || '-' || least(1000000, e + pad) AS region FROM p WHERE least(1000000, e + pad) >= greatest(1, s + 1 - pad)""")
def b13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pad = F.floor(F.least(F.lit(500.0), F.greatest(F.lit(50.0), 0.2 * (F.col("e") - F.col("s"))))).cast("long")
    rows = V.instances(spark, sf_dir).withColumn("pad", pad).withColumns({"s1": F.greatest(F.lit(1), F.col("s") + 1 - F.col("pad")), "e1": F.least(F.lit(1_000_000), F.col("e") + F.col("pad"))})
    return rows.filter("e1 >= s1").select("o", "ln", "fam", F.format_string("%s:%d-%d", "chrom", "s1", "e1").alias("region"))


@QUERIES.add("d3_length_summary", f"""WITH {V.SEQS}, l AS (SELECT length(seq) AS len FROM seqs), s AS (SELECT list_sort(list(len)) AS v, count(*) AS n, round(avg(len), 6) AS mean FROM l) SELECT n, mean, v[CAST(least(n - 1, floor(0.5 * n)) AS BIGINT) + 1] AS p50, v[CAST(least(n - 1, floor(0.9 * n)) AS BIGINT) + 1] AS p90, v[1] AS least, v[n] AS most FROM s""")
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-rank quantiles from the histogram of lengths, so that no list of all rows is made."""
    bars = V.seqs(spark, sf_dir).groupBy(F.length("seq").cast("long").alias("len")).agg(F.count(F.lit(1)).alias("c"))
    bars = bars.withColumn("upto", F.sum("c").over(W.orderBy("len"))).join(F.broadcast(bars.agg(F.sum("c").alias("n"))))
    rank = lambda p: F.min(F.when(F.col("upto") > F.least(F.col("n") - 1, F.floor(F.col("n") * p)), F.col("len")))
    return bars.groupBy("n").agg(F.round(F.sum(F.col("len") * F.col("c")) / F.sum("c"), 6).alias("mean"), rank(0.5).alias("p50"), rank(0.9).alias("p90"), F.min("len").alias("least"), F.max("len").alias("most"))


@QUERIES.add("d4_recovery_report", f"""WITH {V.INSTANCES} SELECT regexp_replace('mdl_R' || (fam % 50) || CASE WHEN fam % 3 = 0 THEN '_sf2' WHEN fam % 3 = 1 THEN '_chimfrag1' ELSE '' END, '_(chimfrag|sf).*$', '') AS family, count(*) AS members, CAST(count_if(strand = '+') AS BIGINT) AS recovered, CAST(count_if(dvg >= 0.05) AS BIGINT) AS divergent, CAST(count_if(dvg >= 0.05 AND strand = '+') AS BIGINT) AS divergent_recovered FROM instances GROUP BY 1""")
def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.when(F.col("fam") % 3 == 0, "_sf2").when(F.col("fam") % 3 == 1, "_chimfrag1").otherwise("")
    name = F.concat(F.lit("mdl_R"), (F.col("fam") % 50).cast("string"), suffix)
    found, far = F.col("strand") == "+", F.col("dvg") >= 0.05
    return V.instances(spark, sf_dir).groupBy(F.regexp_replace(name, "_(chimfrag|sf).*$", "").alias("family")).agg(F.count(F.lit(1)).alias("members"), F.count_if(found).alias("recovered"), F.count_if(far).alias("divergent"), F.count_if(far & found).alias("divergent_recovered"))


@QUERIES.add("d8_masked_bases", f"""WITH {V.RAW}, m AS (SELECT regexp_replace(seq, '[acgt]', 'N', 'g') AS seq FROM raw) SELECT CAST(sum(length(seq)) AS BIGINT) AS total, CAST(sum(length(regexp_replace(seq, '[XN]{{20,}}', '', 'g'))) AS BIGINT) AS without_runs, CAST(sum(length(seq) - length(replace(seq, 'N', ''))) AS BIGINT) AS masked FROM m""")
def d8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.raw(spark, sf_dir).select(F.regexp_replace("seq", "[acgt]", "N").alias("seq"))
    return rows.agg(F.sum(F.length("seq")).alias("total"), F.sum(F.length(F.regexp_replace("seq", "[XN]{20,}", ""))).alias("without_runs"), F.sum(S.count_of(F.col("seq"), "N")).alias("masked"))


@QUERIES.add("i20_abundance", f"""WITH {V.RECORDS}, k AS (SELECT id, copies, length / 1000.0 AS kb FROM records), c AS (SELECT id, copies * (CAST(kb AS DOUBLE) / 3.0) / 0.8 AS abundance, greatest(2, CAST(ceil(CAST(5.0 * 0.8 AS DOUBLE) * (CAST(3.0 AS DOUBLE) / CAST(kb AS DOUBLE))) AS BIGINT)) AS c1, greatest(4, CAST(ceil(CAST(25.0 * 0.8 AS DOUBLE) * (CAST(3.0 AS DOUBLE) / CAST(kb AS DOUBLE))) AS BIGINT)) AS c2, copies FROM k) SELECT id, round(abundance, 6) AS abundance, c1, CASE WHEN c2 <= c1 THEN c1 + 2 ELSE c2 END AS c2, CASE WHEN copies >= CASE WHEN c2 <= c1 THEN c1 + 2 ELSE c2 END THEN 'high' WHEN copies >= c1 THEN 'medium' ELSE 'low' END AS tier FROM c""")
def i20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of 3 kb for each Gb of a genome of 0.8 Gb, and the copies that the tiers of a length need."""
    kb = F.col("length") / 1000
    c1, c2 = SC.copy_cuts(kb, 0.8)
    rows = V.records(spark, sf_dir).select("id", "copies", F.round(SC.abundance(F.col("copies"), kb, 0.8), 6).alias("abundance"), c1.alias("c1"), c2.alias("c2"))
    return rows.select("id", "abundance", "c1", "c2", F.when(F.col("copies") >= F.col("c2"), "high").when(F.col("copies") >= F.col("c1"), "medium").otherwise("low").alias("tier"))


@QUERIES.add("i21_percentile_grades", f"""WITH {V.RECORDS}, q AS (SELECT quantile_cont(copies, 0.25) AS p25, quantile_cont(copies, 0.5) AS p50, quantile_cont(copies, 0.75) AS p75 FROM records) SELECT id, CASE WHEN copies >= p75 THEN 'A' WHEN copies >= p50 THEN 'B' WHEN copies >= p25 THEN 'C' ELSE 'D' END AS grade FROM records, q""")
def i21(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = G.with_quantiles(V.records(spark, sf_dir), "copies", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    copies = F.col("copies")
    return rows.select("id", F.when(copies >= F.col("p75"), "A").when(copies >= F.col("p50"), "B").when(copies >= F.col("p25"), "C").otherwise("D").alias("grade"))


I18 = f"""{V.RECORDS}, r AS (SELECT id, length * (1 + id % 4) AS len, copies % 23 AS c, 100.0 - CAST(100 * divergence AS DOUBLE) - id % 40 AS ident FROM records),
x AS (SELECT *, greatest(3.0, least(15.0, CASE WHEN len < 300 THEN 50.0 WHEN len < 800 THEN 30.0 WHEN len < 3000 THEN 20.0 WHEN len < 7000 THEN 10.0 ELSE 5.0 END / (log10(2.0) + 1))) AS want, CASE WHEN len < 500 THEN 65.0 WHEN len < 3000 THEN 70.0 ELSE 75.0 END - CASE WHEN c > 100 THEN 5 WHEN c > 50 THEN 3 ELSE 0 END AS best FROM r),
y AS (SELECT *, CASE WHEN c >= 15 THEN 1.0 WHEN c < 3 THEN 0.01 WHEN c >= 1.5 * want THEN 1.0 WHEN c >= want THEN 0.8 + 0.2 * (c / want - 1) / 0.5 WHEN c >= 0.5 * want THEN 0.6 + 0.2 * (c / want - 0.5) / 0.5 WHEN c >= 0.25 * want THEN 0.4 + 0.2 * (c / want - 0.25) / 0.25 ELSE 0.4 * c / want / 0.25 END AS cs,
CASE WHEN ident >= best THEN 1.0 WHEN ident >= best - 10 THEN 0.8 + 0.2 * (ident - best + 10) / 10 WHEN ident >= best - 20 THEN 0.6 + 0.2 * (ident - best + 20) / 10 WHEN ident >= best - 30 THEN 0.3 + 0.3 * (ident - best + 30) / 10 ELSE greatest(0, 0.3 * ident / (best - 30)) END AS ids,
CASE WHEN len < 50 THEN CASE WHEN c > 100 THEN 0.1 ELSE 0.3 END WHEN len < 80 THEN CASE WHEN c > 10 THEN 0.5 ELSE 0.4 END WHEN len < 100 THEN 0.7 WHEN len <= 3000 THEN 1.0 WHEN len <= 7000 THEN 0.95 WHEN len <= 15000 THEN 0.85 WHEN len <= 20000 THEN CASE WHEN c >= 2 THEN 0.7 ELSE 0.5 END ELSE CASE WHEN c >= 3 THEN 0.4 ELSE 0.2 END END AS ls FROM x),
z AS (SELECT *, CASE WHEN len < 500 THEN 0.45 * cs + 0.2 * ids + 0.2 * 0.5 + 0.1 * ls + 0.05 * 0.5 WHEN len < 3000 THEN 0.35 * cs + 0.25 * ids + 0.2 * 0.5 + 0.1 * ls + 0.1 * 0.5 ELSE 0.3 * cs + 0.3 * ids + 0.15 * 0.5 + 0.1 * ls + 0.15 * 0.5 END AS score FROM y),
m AS (SELECT CASE WHEN quantile_cont(len, 0.5) < 500 THEN 0.6 WHEN quantile_cont(len, 0.5) < 2000 THEN 0.65 ELSE 0.7 END AS cut_a FROM z)"""


@QUERIES.add("i18_adaptive_scores", f"""WITH {I18} SELECT id, round(CAST(cs AS DOUBLE), 6) AS copy_score, round(CAST(ids AS DOUBLE), 6) AS identity_score, CAST(ls AS DOUBLE) AS length_score, round(CAST(score AS DOUBLE), 6) AS score, CASE WHEN round(CAST(score AS DOUBLE), 9) >= greatest(0.5, cut_a) THEN 'A' WHEN round(CAST(score AS DOUBLE), 9) >= greatest(0.3, cut_a - 0.2) THEN 'B' ELSE 'C' END AS class FROM z, m""")
def i18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by length band for a genome of 1 Gb, and classes by cuts that follow the median length."""
    return scored(spark, sf_dir).select("id", F.round("copy", 6).alias("copy_score"), F.round("identity", 6).alias("identity_score"), F.col("size").alias("length_score"), F.round("score", 6).alias("score"), "class")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with lengths, copies and identities spread out, their scores, and their class."""
    rows = V.records(spark, sf_dir).select("id", (F.col("length") * (1 + F.col("id") % 4)).alias("len"), (F.col("copies") % 23).alias("c"), (100 - 100 * F.col("divergence") - F.col("id") % 40).alias("ident"))
    n, c, ident = F.col("len"), F.col("c"), F.col("ident")
    rows = rows.withColumns({"copy": SC.copy_score(c, n), "identity": SC.identity_score(ident, n, c), "size": SC.length_score(n, c)})
    rows = rows.withColumn("score", SC.final_score(n, {"copy": F.col("copy"), "identity": F.col("identity"), "complexity": F.lit(0.5), "length": F.col("size"), "boundary": F.lit(0.5)}))
    rows = G.with_quantiles(rows, "len", {"median": 0.5})
    cut_a, cut_b = SC.class_cuts(F.col("median"))
    score = F.round("score", 9)
    return rows.withColumns({"cut_a": cut_a, "cut_b": cut_b}).withColumn("class", F.when(score >= F.col("cut_a"), "A").when(score >= F.col("cut_b"), "B").otherwise("C")).drop("median", "__n")


@QUERIES.add("i27_names", f"""WITH {V.RECORDS} SELECT id, 'mdl_R' || id || CASE WHEN copies % 4 > 1 THEN '_sf' || copies % 4 ELSE '' END AS name, '>mdl_R' || id || ' length=' || length || ' copies=' || copies || ' tier=T' || (id % 3 + 1) AS header FROM records""")
def i27(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = F.col("copies") % 4
    name = F.concat(F.format_string("mdl_R%d", "id"), F.when(sub > 1, F.concat(F.lit("_sf"), sub.cast("string"))).otherwise(""))
    return V.records(spark, sf_dir).select("id", name.alias("name"), F.format_string(">mdl_R%d length=%d copies=%d tier=T%d", F.col("id"), F.col("length").cast("long"), F.col("copies"), F.col("id") % 3 + 1).alias("header"))
