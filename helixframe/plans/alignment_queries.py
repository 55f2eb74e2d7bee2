"""Aligned columns, consensus and divergence (operators D9, E13, E15, E16, I22, I25, I26, J2-J9, J14, J15, J17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import consensus as C
from helixframe.operators import gates as G
from helixframe.operators import passes as P
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table

LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz ", "ACGTACGTACGTACGTACGTACGTAC-"
MSA = f"msa AS (SELECT conv_id AS fam, turn, translate(lower(regexp_replace(text, '[^A-Za-z ]', '', 'g')), '{LETTERS}', '{BASES}') AS seq FROM conversations WHERE text IS NOT NULL), cells AS (SELECT fam, turn, i - 1 AS col, substr(seq, i, 1) AS base FROM (SELECT fam, turn, seq, unnest(range(1, length(seq) + 1)) AS i FROM msa) x), cols AS (SELECT fam, col, count_if(base = 'A') AS a, count_if(base = 'C') AS c, count_if(base = 'G') AS g, count_if(base = 'T') AS t, count(*) AS n_rows FROM cells GROUP BY fam, col), cc AS (SELECT *, a + c + g + t AS present, greatest(a, c, g, t) AS top, CASE WHEN a + c + g + t = 0 THEN NULL WHEN t = greatest(a, c, g, t) THEN 'T' WHEN g = greatest(a, c, g, t) THEN 'G' WHEN c = greatest(a, c, g, t) THEN 'C' ELSE 'A' END AS majority FROM cols), mem AS (SELECT fam, count(*) AS n FROM msa WHERE seq <> '' GROUP BY fam)"


def msa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fam, turn, seq): the turns of a conversation as aligned rows, blanks as gaps."""
    letters = F.lower(F.regexp_replace("text", "[^A-Za-z ]", ""))
    return table(spark, sf_dir, "conversations").filter("text is not null").select(F.col("conv_id").alias("fam"), "turn", F.translate(letters, LETTERS, BASES).alias("seq"))


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.column_counts(C.exploded(msa(spark, sf_dir), ["fam"], "seq"), "fam")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msa(spark, sf_dir).filter("seq <> ''").groupBy("fam").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("d9_column_majority", f"WITH {MSA} SELECT fam, CAST(col AS BIGINT) AS col, CAST(present AS BIGINT) AS present, CAST(top AS BIGINT) AS top, majority FROM cc")
def d9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(spark, sf_dir).select("fam", F.col("col").cast("long").alias("col"), "present", "top", "majority")


@QUERIES.add("j3_occupancy_trim", f"WITH {MSA} SELECT fam, CAST(min(col) AS BIGINT) AS first, CAST(max(col) AS BIGINT) AS last FROM cc JOIN mem USING (fam) WHERE present >= greatest(3.0, 0.3 * n) AND CAST(top AS DOUBLE) / greatest(present, 1) >= 0.5 GROUP BY fam")
def j3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.occupancy_span(columns(spark, sf_dir), "fam", members(spark, sf_dir)).select("fam", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))


@QUERIES.add("j4_majority_consensus", f"WITH {MSA} SELECT fam, md5(string_agg(CASE WHEN CAST(top AS DOUBLE) / present >= 0.3 THEN majority ELSE 'N' END, '' ORDER BY col)) AS consensus, count(*) AS len FROM cc JOIN mem USING (fam) WHERE present >= greatest(2, floor(0.1 * n)) GROUP BY fam")
def j4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.majority_consensus(columns(spark, sf_dir), "fam", members(spark, sf_dir))
    return rows.select("fam", F.md5(F.col("consensus").cast("binary")).alias("consensus"), F.length("consensus").cast("long").alias("len"))


@QUERIES.add("j5_iupac_consensus", f"WITH {MSA}, k AS (SELECT fam, col, CASE WHEN CAST(top AS DOUBLE) / present >= 0.7 THEN majority ELSE CASE (CASE WHEN CAST(a AS DOUBLE) / present >= 0.2 THEN 'A' ELSE '' END || CASE WHEN CAST(c AS DOUBLE) / present >= 0.2 THEN 'C' ELSE '' END || CASE WHEN CAST(g AS DOUBLE) / present >= 0.2 THEN 'G' ELSE '' END || CASE WHEN CAST(t AS DOUBLE) / present >= 0.2 THEN 'T' ELSE '' END) {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in C.IUPAC.items())} ELSE 'N' END END AS letter FROM cc WHERE present > 0 AND present * 2 >= n_rows) SELECT fam, md5(string_agg(letter, '' ORDER BY col)) AS consensus, CAST(count_if(letter NOT IN ('A', 'C', 'G', 'T')) AS BIGINT) AS ambiguous FROM k GROUP BY fam")
def j5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.iupac_consensus(columns(spark, sf_dir), "fam")
    return rows.select("fam", F.md5(F.col("consensus").cast("binary")).alias("consensus"), F.regexp_count("consensus", F.lit("[^ACGT]")).cast("long").alias("ambiguous"))


ENTROPY = " + ".join(f"CASE WHEN {b} > 0 THEN -(CAST({b} AS DOUBLE) / present) * log2(CAST({b} AS DOUBLE) / present) ELSE 0 END" for b in "acgt")


@QUERIES.add("j6_conserved_blocks", f"WITH {MSA}, e AS (SELECT fam, col, CASE WHEN present > 0 THEN {ENTROPY} ELSE 0 END AS h, 1 - CAST(present AS DOUBLE) / n_rows AS gap FROM cc), good AS (SELECT fam, col, h, col - row_number() OVER (PARTITION BY fam ORDER BY col) AS run FROM e WHERE round(h, 9) < 1.0 AND round(gap, 9) < 0.2) SELECT fam, CAST(min(col) AS BIGINT) AS first, CAST(max(col) AS BIGINT) AS last, round(1 - avg(h), 6) AS conservation FROM good GROUP BY fam, run HAVING max(col) - min(col) + 1 >= 4")
def j6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation are hardly alike, so entropies under 1 bit and blocks of 4 columns are looked for."""
    rows = C.conserved_blocks(columns(spark, sf_dir), "fam", most_entropy=1.0, least=4)
    return rows.select("fam", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), F.round("conservation", 6).alias("conservation"))


@QUERIES.add("j7_alignment_qc", f"WITH {MSA} SELECT fam, count(*) AS columns, round(avg(CASE WHEN CAST(present AS DOUBLE) / n < 0.3 THEN 1.0 ELSE 0.0 END), 6) AS sparse, avg(CASE WHEN CAST(present AS DOUBLE) / n < 0.3 THEN 1.0 ELSE 0.0 END) <= 0.5 AS ok FROM cc JOIN mem USING (fam) GROUP BY fam")
def j7(spark: SparkSession, sf_dir: str) -> DataFrame:
    sparse = F.avg(F.when(F.col("present") / F.col("n") < 0.3, 1.0).otherwise(0.0))
    return columns(spark, sf_dir).join(members(spark, sf_dir), "fam").groupBy("fam").agg(F.count(F.lit(1)).alias("columns"), F.round(sparse, 6).alias("sparse"), (sparse <= 0.5).alias("ok"))


@QUERIES.add("j2_msa_regime", f"WITH {V.RECORDS} SELECT id, CASE WHEN copies * length > 150000 THEN 'abpoa' WHEN copies <= 30 AND divergence <= 0.1 THEN 'linsi' WHEN copies <= 200 THEN 'auto' ELSE 'abpoa' END AS regime FROM records")
def j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    regime = F.when(F.col("copies") * F.col("length") > 150_000, "abpoa").when((F.col("copies") <= 30) & (F.col("divergence") <= 0.1), "linsi").when(F.col("copies") <= 200, "auto").otherwise("abpoa")
    return V.records(spark, sf_dir).select("id", regime.alias("regime"))


K2P = "round(CASE WHEN sites > 0 AND 1 - 2.0 * {t} / sites - CAST(tv AS DOUBLE) / sites > 0 AND 1 - 2.0 * tv / sites > 0 THEN abs(-0.5 * ln((1 - 2 * (CAST({t} AS DOUBLE) / sites) - CAST(tv AS DOUBLE) / sites) * sqrt(1 - 2 * (CAST(tv AS DOUBLE) / sites)))) ELSE 1 END * 100, 6)"


@QUERIES.add("i22_kimura_divergence", f"""WITH {V.SEQS}, p AS (SELECT a.id, a.seq AS x, b.seq AS y, least(length(a.seq), length(b.seq)) AS n FROM seqs a JOIN seqs b ON b.id = a.id + 1), u AS (SELECT id, i, substr(x, i, 1) || substr(y, i, 1) AS w, i > 1 AND substr(y, i - 1, 2) = 'CG' AS second, i < n AND substr(y, i, 2) = 'CG' AS first FROM (SELECT id, x, y, n, unnest(range(1, n + 1)) AS i FROM p) z),
m AS (SELECT *, w IN ('AG', 'GA', 'CT', 'TC') AS moved, lag(w IN ('AG', 'GA', 'CT', 'TC')) OVER (PARTITION BY id ORDER BY i) AS before FROM u),
s AS (SELECT id, count(*) AS sites, count_if(moved) AS ts, count_if(NOT moved AND w NOT IN ('AA', 'CC', 'GG', 'TT')) AS tv, count_if(second) AS cpg, sum(CASE WHEN second THEN CASE WHEN moved AND before THEN 1.0 WHEN moved OR before THEN 0.1 ELSE 0 END WHEN first THEN 0 WHEN moved THEN 1.0 ELSE 0 END) AS cts FROM m GROUP BY id), r AS (SELECT p.id, coalesce(sites, 0) AS sites, coalesce(ts, 0) AS ts, coalesce(tv, 0) AS tv, coalesce(cpg, 0) AS cpg, coalesce(cts, 0) AS cts FROM p LEFT JOIN s ON s.id = p.id)
SELECT id, sites, CAST(ts AS BIGINT) AS transitions, CAST(tv AS BIGINT) AS transversions, {K2P.format(t='ts')} AS divergence, CAST(cpg AS BIGINT) AS cpg_sites, {K2P.format(t='cts')} AS cpg_divergence FROM r""")
def i22(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, and with transitions at C and G in a row counted as two in one, or a tenth where one stands alone."""
    seqs = V.seqs(spark, sf_dir)
    pairs = seqs.join(seqs.select((F.col("id") - 1).alias("id"), F.col("seq").alias("other")), "id")
    rows = P.with_divergence(pairs, "id", "seq", "other")
    divergence = lambda t: F.round(C.kimura(F.col("sites"), F.col(t), F.col("transversions")), 6)
    return rows.select("id", "sites", "transitions", "transversions", divergence("transitions").alias("divergence"), "cpg_sites", divergence("cpg_transitions").alias("cpg_divergence"))


@QUERIES.add("i25_coordinate_translation", f"WITH {MSA} SELECT fam, turn, CAST(col AS BIGINT) AS col, CAST(sum(CASE WHEN base <> '-' THEN 1 ELSE 0 END) OVER (PARTITION BY fam, turn ORDER BY col) AS BIGINT) AS position FROM cells")
def i25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ungapped position that each column of a row has come to."""
    cells = C.exploded(msa(spark, sf_dir), ["fam", "turn"], "seq")
    position = F.sum((F.col("base") != "-").cast("long")).over(W.partitionBy("fam", "turn").orderBy("col"))
    return cells.select("fam", "turn", F.col("col").cast("long").alias("col"), position.alias("position"))


@QUERIES.add("i26_weighted_divergence", f"WITH {V.HITS}, c AS (SELECT *, lead(gmin) OVER w AS n_min, lead(gmax) OVER w AS n_max, lead(pident) OVER w AS n_id FROM hits WINDOW w AS (PARTITION BY q ORDER BY gmin, gmax, o, ln, score)), d AS (SELECT q, o, ln, 100 - pident AS d1, 100 - n_id AS d2, gmax - gmin + 1 AS l1, n_max - n_min + 1 AS l2, greatest(0, least(gmax, n_max) - greatest(gmin, n_min) + 1) AS ov FROM c WHERE n_min IS NOT NULL) SELECT q, o, ln, round(CASE WHEN d1 <= d2 THEN (d1 * l1 + d2 * greatest(0, l2 - ov)) / (l1 + greatest(0, l2 - ov)) ELSE (d2 * l2 + d1 * greatest(0, l1 - ov)) / (l2 + greatest(0, l1 - ov)) END, 6) AS divergence FROM d")
def i26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours merged: the less diverged counts in full, the other without the overlap."""
    w = W.partitionBy("q").orderBy("gmin", "gmax", "o", "ln", "score")
    ahead = lambda c: F.lead(c).over(w)
    width = lambda a, b: F.col(b) - F.col(a) + 1
    rows = V.hits(spark, sf_dir).withColumns({"n_min": ahead("gmin"), "n_max": ahead("gmax"), "n_id": ahead("pident")}).filter("n_min is not null")
    rows = rows.withColumns({"d1": 100 - F.col("pident"), "d2": 100 - F.col("n_id"), "l1": width("gmin", "gmax"), "l2": width("n_min", "n_max"), "ov": F.greatest(F.lit(0), F.least("gmax", "n_max") - F.greatest("gmin", "n_min") + 1)})
    rest = lambda c: F.greatest(F.lit(0), F.col(c) - F.col("ov"))
    merged = F.when(F.col("d1") <= F.col("d2"), (F.col("d1") * F.col("l1") + F.col("d2") * rest("l2")) / (F.col("l1") + rest("l2"))).otherwise((F.col("d2") * F.col("l2") + F.col("d1") * rest("l1")) / (F.col("l2") + rest("l1")))
    return rows.select("q", "o", "ln", F.round(merged, 6).alias("divergence"))


@QUERIES.add("e13_carry_forward", "SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS UNBOUNDED PRECEDING) AS header FROM conversations")
def e13(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("conv_id").orderBy("turn", "role").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("header"))


@QUERIES.add("e15_window_tiling", f"WITH {V.SEQS} SELECT id || '__w' || k AS name, substr(seq, k * 500 + 1, 500) AS tile FROM (SELECT id, seq, unnest(range(0, CAST(ceil(length(seq) / 500.0) AS BIGINT))) AS k FROM seqs) x")
def e15(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.seqs(spark, sf_dir).filter(F.length("seq") > 0).select("id", F.posexplode(F.regexp_extract_all("seq", F.lit("(.{1,500})"), 1)).alias("k", "tile"))
    return rows.select(F.concat(F.col("id").cast("string"), F.lit("__w"), F.col("k").cast("string")).alias("name"), "tile")


MODE = "{m} AS (SELECT q, {c} AS mode FROM (SELECT q, {c}, row_number() OVER (PARTITION BY q ORDER BY count(*) DESC, min(r)) AS k FROM g GROUP BY q, {c}) x WHERE k = 1)"


@QUERIES.add("e16_position_coherence", f"WITH {V.HITS}, f AS (SELECT q, qstart, qend, row_number() OVER (PARTITION BY q ORDER BY score DESC, o, ln) AS r FROM hits), g AS (SELECT q, r, qstart, qend FROM f WHERE r <= 50), {MODE.format(m='ms', c='qstart')}, {MODE.format(m='me', c='qend')}, s AS (SELECT q, ms.mode AS start_mode, me.mode AS end_mode, avg(CASE WHEN abs(qstart - ms.mode) <= 10 THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN abs(qend - me.mode) <= 10 THEN 1.0 ELSE 0.0 END) AS b, count(*) AS n FROM g JOIN ms USING (q) JOIN me USING (q) GROUP BY q, ms.mode, me.mode) SELECT q, start_mode, CAST(end_mode AS BIGINT) AS end_mode, round((a + b) / 2, 6) AS coherence, CAST(CASE WHEN n < 10 THEN 0.0 WHEN round((a + b) / 2, 9) >= 0.7 THEN 0.06 WHEN round((a + b) / 2, 9) >= 0.5 THEN 0.03 ELSE 0.0 END AS DOUBLE) AS bonus FROM s")
def e16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a query's best 50 hits begin, and end, within 10 of where most do; the first seen wins ties."""
    rows = C.coherence(V.hits(spark, sf_dir), "q", [F.desc("score"), F.asc("o"), F.asc("ln")], "qstart", "qend")
    return rows.select("q", "start_mode", F.col("end_mode").cast("long").alias("end_mode"), F.round("coherence", 6).alias("coherence"), "bonus")


@QUERIES.add("j9_tsd_consensus_trim", f"""WITH {V.INSTANCES}, c AS (SELECT fam, o, ln, s, e - s + 100 AS len, 50 AS ts, 50 + e - s AS te, CASE WHEN (o + ln) % 5 > 0 THEN (fam + o % 2) % 9 - 4 END AS d5, CASE WHEN (o + ln) % 5 > 0 THEN (fam * 2 + ln % 2) % 9 - 4 END AS d3, row_number() OVER (PARTITION BY fam ORDER BY o, ln, s) AS k, count(*) OVER (PARTITION BY fam) AS n FROM instances),
f AS (SELECT fam, d, votes FROM (SELECT fam, CAST(round(d5 / 3.0) AS BIGINT) * 3 AS d, count(*) AS votes, row_number() OVER (PARTITION BY fam ORDER BY count(*) DESC, min(k)) AS r FROM c WHERE d5 IS NOT NULL GROUP BY 1, 2) x WHERE r = 1), t AS (SELECT fam, d, votes FROM (SELECT fam, CAST(round(d3 / 3.0) AS BIGINT) * 3 AS d, count(*) AS votes, row_number() OVER (PARTITION BY fam ORDER BY count(*) DESC, min(k)) AS r FROM c WHERE d3 IS NOT NULL GROUP BY 1, 2) x WHERE r = 1),
w AS (SELECT c.*, f.d AS s5, t.d AS s3, n >= 4 AND f.votes >= greatest(4, floor(0.3 * n)) AND t.votes >= greatest(4, floor(0.3 * n)) AS agreed FROM c LEFT JOIN f USING (fam) LEFT JOIN t USING (fam)), b AS (SELECT *, greatest(0, ts + s5) AS b5, least(len, te + s3) AS b3 FROM w)
SELECT fam, o, ln, s, CAST(CASE WHEN coalesce(agreed, false) AND b3 - b5 >= 50 AND NOT (b5 <= 0 AND b3 >= len) THEN b5 ELSE 0 END AS BIGINT) AS keep_from, CAST(CASE WHEN coalesce(agreed, false) AND b3 - b5 >= 50 AND NOT (b5 <= 0 AND b3 >= len) THEN b3 ELSE len END AS BIGINT) AS keep_to FROM b""")
def j9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies padded by 50, cut where a site duplication lies in enough of the family's; four in five copies have one."""
    seen, fam, o, ln = (F.col("o") + F.col("ln")) % 5 > 0, F.col("fam"), F.col("o"), F.col("ln")
    copies = V.instances(spark, sf_dir).select("fam", "o", "ln", "s", (F.col("e") - F.col("s") + 100).alias("length"), F.lit(50).alias("te_start"), (F.col("e") - F.col("s") + 50).alias("te_end"), F.when(seen, (fam + o % 2) % 9 - 4).alias("d5"), F.when(seen, (fam * 2 + ln % 2) % 9 - 4).alias("d3"))
    return C.trimmed_copies(copies, "fam", ["o", "ln", "s"]).select("fam", "o", "ln", "s", F.col("keep_from").cast("long").alias("keep_from"), F.col("keep_to").cast("long").alias("keep_to"))


@QUERIES.add("j14_host_flank_trim", f"WITH {V.HITS}, c AS (SELECT q, min(qstart) AS a, max(qend) AS b FROM hits WHERE score > 60000 GROUP BY q), k AS (SELECT q, a, b, CAST(b - a + 1 AS DOUBLE) / 400 AS cov FROM c) SELECT q, CAST(CASE WHEN cov >= 0.3 AND cov < 0.7 AND a <= 30 AND b < 370 AND 400 - b >= 100 THEN b + 1 ELSE 1 END AS BIGINT) AS keep_from, CAST(CASE WHEN cov >= 0.3 AND cov < 0.7 AND b >= 370 AND a > 30 AND a - 1 >= 100 THEN a - 1 ELSE 400 END AS BIGINT) AS keep_to FROM k")
def j14(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = V.hits(spark, sf_dir).filter("score > 60000").groupBy("q").agg(F.min("qstart").alias("a"), F.max("qend").alias("b"))
    first, last = G.flank_kept(F.col("a"), F.col("b"), F.lit(400))
    return spans.select("q", first.cast("long").alias("keep_from"), last.cast("long").alias("keep_to"))


@QUERIES.add("j15_pseudo_family_verdict", f"WITH {V.HITS}, g AS (SELECT q, count(*) AS n, quantile_cont((pident - 50) / 100, 0.5) AS median, avg(CASE WHEN pident >= 98 THEN 1.0 ELSE 0.0 END) AS pairs, count_if(score > 95000) AS coherent FROM hits WHERE ln <= q % 7 + 1 GROUP BY q) SELECT q, round(median, 6) AS median, round(pairs, 6) AS homologous, CASE WHEN q % 7 = 0 THEN 'unverified' WHEN q % 3 = 0 THEN 'clustered' WHEN n < 5 THEN 'few_copies' WHEN round(median, 9) >= 0.45 OR round(pairs, 9) >= 0.25 THEN 'coherent' WHEN q % 11 = 0 OR coherent >= 1 THEN 'seed_coherent' ELSE 'pseudo' END AS verdict FROM g")
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of hits, their identities 50 less; some clustered, some with a recall or a seed search that failed."""
    q = F.col("q")
    rows = V.hits(spark, sf_dir).filter("ln <= q % 7 + 1").groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.percentile((F.col("pident") - 50) / 100, F.lit(0.5)).alias("median"), F.avg(F.when(F.col("pident") >= 98, 1.0).otherwise(0.0)).alias("homologous"), F.count_if(F.col("score") > 95_000).alias("coherent"))
    verdict = G.pseudo_family(F.col("n"), F.round("median", 9), F.round("homologous", 9), q % 3 > 0, F.when(q % 11 > 0, F.col("coherent")), F.when(q % 7 == 0, False))
    return rows.select("q", F.round("median", 6).alias("median"), F.round("homologous", 6).alias("homologous"), verdict.alias("verdict"))


@QUERIES.add("j17_representative_variants", f"WITH {V.INSTANCES}, m AS (SELECT *, avg(e - s) OVER (PARTITION BY fam) AS mean FROM instances), r AS (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY abs(e - s - mean), o, ln, s) AS near, row_number() OVER (PARTITION BY fam ORDER BY abs(e - s - mean) DESC, o, ln, s) AS far FROM m) SELECT fam, o, ln, CASE WHEN near = 1 THEN 'typical' ELSE 'deviant' END AS kind FROM r WHERE near = 1 OR far <= 2")
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = F.abs(F.col("e") - F.col("s") - F.avg(F.col("e") - F.col("s")).over(W.partitionBy("fam")))
    rows = V.instances(spark, sf_dir).withColumn("apart", apart)
    w = lambda first: F.row_number().over(W.partitionBy("fam").orderBy(first, "o", "ln", "s"))
    rows = rows.withColumns({"near": w(F.col("apart")), "far": w(F.desc("apart"))}).filter("near = 1 or far <= 2")
    return rows.select("fam", "o", "ln", F.when(F.col("near") == 1, "typical").otherwise("deviant").alias("kind"))


@QUERIES.add("j8_refined_families", f"""WITH {MSA}, seed AS (SELECT fam, seq FROM (SELECT fam, seq, row_number() OVER (PARTITION BY fam ORDER BY turn, seq) AS r FROM msa WHERE seq <> '') x WHERE r = 1),
span AS (SELECT fam, min(col) AS first, max(col) AS last FROM cc JOIN mem USING (fam) WHERE present >= greatest(3.0, 0.3 * n) AND CAST(top AS DOUBLE) / greatest(present, 1) >= 0.5 GROUP BY fam),
qc AS (SELECT fam, avg(CASE WHEN CAST(present AS DOUBLE) / n < 0.3 THEN 1.0 ELSE 0.0 END) <= 0.5 AS ok FROM cc JOIN mem USING (fam) GROUP BY fam),
cons AS (SELECT fam, string_agg(CASE WHEN CAST(top AS DOUBLE) / present >= 0.3 THEN majority ELSE 'N' END, '' ORDER BY col) AS seq FROM cc JOIN mem USING (fam) JOIN span USING (fam) WHERE col BETWEEN first AND last AND present >= greatest(2, floor(0.1 * n)) GROUP BY fam)
SELECT seed.fam, CASE WHEN mem.n >= 5 AND qc.ok AND last - first + 1 >= 50 AND length(cons.seq) >= 50 THEN 'refined' ELSE 'original' END AS source, md5(CASE WHEN mem.n >= 5 AND qc.ok AND last - first + 1 >= 50 AND length(cons.seq) >= 50 THEN cons.seq ELSE replace(seed.seq, '-', '') END) AS sequence FROM seed JOIN mem USING (fam) LEFT JOIN qc USING (fam) LEFT JOIN span USING (fam) LEFT JOIN cons USING (fam)""")
def j8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus of each family's rows, or its seed, the first row, where any step falls short."""
    rows = msa(spark, sf_dir).filter("seq <> ''")
    seeds = rows.groupBy("fam").agg(F.min_by("seq", F.struct("turn", "seq")).alias("seed")).withColumn("seed", F.replace("seed", F.lit("-"), F.lit("")))
    out = C.refined(columns(spark, sf_dir), "fam", members(spark, sf_dir), seeds)
    return out.select("fam", "source", F.md5(F.col("sequence").cast("binary")).alias("sequence"))
