"""Structure of elements (operators I11, I13, I16, I19, J11, J13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import structure as X
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES

SELF_HITS = f"{V.HITS}, self AS (SELECT q, strand, qstart, qend, (o * 13 + ln * 7) % 360 + 1 AS sstart, (o * 13 + ln * 7) % 360 + qend - qstart + 1 AS send, qlen, pident, qend - qstart + 1 AS length, o, ln FROM hits)"


def self_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q, strand, qstart, qend, sstart, send, qlen, pident, length): the hits as a sequence's hits on itself."""
    start = (F.col("o") * 13 + F.col("ln") * 7) % 360 + 1
    width = F.col("qend") - F.col("qstart")
    return V.hits(spark, sf_dir).select("q", "strand", "qstart", "qend", start.alias("sstart"), (start + width).alias("send"), "qlen", "pident", (width + 1).alias("length"), "o", "ln")


@QUERIES.add("i11_flank_duplication", f"""WITH {V.SEQS}, x AS (SELECT id, left(seq, 30) AS l, right(seq, 30) AS r FROM seqs WHERE length(seq) >= 64), c AS (SELECT n, i FROM range(4, 21) a(n), range(0, 20) b(i) WHERE i < n AND i + n <= 30),
t AS (SELECT id, n, i, hamming(right(l, n), substr(r, i + 1, n)) AS mm FROM x, c), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n - mm DESC, n, i) AS k FROM t WHERE mm <= 1) SELECT id, CAST(n AS BIGINT) AS length, CAST(mm AS BIGINT) AS mismatches, CAST(i AS BIGINT) AS place FROM k WHERE k = 1""")  # fmt: skip
def i11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.seqs(spark, sf_dir).select("id", X.flank_duplication(F.col("seq")).alias("x")).filter("x is not null")
    return rows.select("id", *(F.col(f"x.{c}").cast("long").alias(c) for c in ("length", "mismatches", "place")))


@QUERIES.add("i11_duplication_bounds", f"""WITH {V.SEQS}, x AS (SELECT id, seq, length(seq) AS n, greatest(20, 25) AS lo5, least(length(seq), 55) AS hi5, greatest(0, length(seq) - 55) AS lo3, least(length(seq) - 4, length(seq) - 25) AS hi3 FROM seqs),
a AS (SELECT id, k, b5, substr(seq, b5 - k + 1, k) AS w FROM (SELECT id, seq, unnest(range(lo5, hi5 + 1)) AS b5 FROM x WHERE hi5 > lo5 AND hi3 > lo3) y, range(4, 21) z(k)), b AS (SELECT id, k, b3, n, substr(seq, b3 + 1, k) AS w FROM (SELECT id, seq, n, unnest(range(lo3, hi3 + 1)) AS b3 FROM x WHERE hi5 > lo5 AND hi3 > lo3) y, range(4, 21) z(k) WHERE b3 + k <= n),
r AS (SELECT id, b5, b3, row_number() OVER (PARTITION BY id ORDER BY k DESC, abs(b5 - 40) + abs(b3 - (n - 40)), b5, b3) AS rank FROM a JOIN b USING (id, k, w) WHERE b3 - b5 >= 50 AND replace(w, left(w, 1), '') <> '') SELECT id, CAST(b5 AS BIGINT) AS b5, CAST(b3 AS BIGINT) AS b3 FROM r WHERE rank = 1""")  # fmt: skip
def i11_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.with_duplication_bounds(V.seqs(spark, sf_dir), "id", "seq", 40, 40)


@QUERIES.add("i13_terminal_repeats", f"""WITH {SELF_HITS} SELECT q, string_agg(DISTINCT CASE WHEN strand = '-' THEN 'tir' ELSE 'ltr' END, ',' ORDER BY CASE WHEN strand = '-' THEN 'tir' ELSE 'ltr' END) AS signals FROM self
WHERE length >= CASE WHEN strand = '-' THEN 10 ELSE 50 END AND length <= 200 AND (qstart <= 80 AND send >= 320 OR qend >= 320 AND sstart <= 80) GROUP BY q""")  # fmt: skip
def i13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.terminal_repeats(self_hits(spark, sf_dir))


@QUERIES.add("i16_ltr_pairs", f"""WITH {SELF_HITS}, p AS (SELECT *, qstart < qlen / 3.0 AND sstart > qlen / 3.0 * 2 AS ahead, sstart < qlen / 3.0 AND qstart > qlen / 3.0 * 2 AS back, count(*) OVER (PARTITION BY q) AS n FROM self),
k AS (SELECT *, CASE WHEN ahead THEN qstart ELSE sstart END AS a, CASE WHEN ahead THEN qend ELSE send END AS b, CASE WHEN ahead THEN sstart ELSE qstart END AS c, CASE WHEN ahead THEN send ELSE qend END AS d FROM p WHERE n >= 2 AND (ahead OR back)),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY pident DESC, length DESC, a, b, c, d) AS rank FROM k) SELECT q, round(pident / 100, 6) AS similarity, a AS ltr5_start, b AS ltr5_end, c AS ltr3_start, d AS ltr3_end FROM r WHERE rank = 1 AND pident / 100 >= 0.7 AND b - a BETWEEN 50 AND 5000 AND d - c BETWEEN 50 AND 5000""")  # fmt: skip
def i16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.ltr_pairs(self_hits(spark, sf_dir), least=50).withColumn("similarity", F.round("similarity", 6))


@QUERIES.add("i19_edge_quality", f"""WITH {V.RAW}, u AS (SELECT id, upper(seq) AS s, length(seq) AS n, least(50, length(seq) // 10) AS k FROM raw), p AS (SELECT id, n, k, left(s, k) AS l, right(s, k) AS r, substr(s, n // 4 + 1, 3 * n // 4 - n // 4) AS m FROM u),
f AS (SELECT id, n, CAST(k AS DOUBLE) AS k, CAST(length(m) AS DOUBLE) AS w, length(translate(l, 'GC', '')) AS lg, length(translate(r, 'GC', '')) AS rg, length(translate(m, 'GC', '')) AS mg, length(translate(l, 'N', '')) AS ln, length(translate(r, 'N', '')) AS rn, length(translate(m, 'N', '')) AS mn FROM p),
v AS (SELECT id, n, CASE WHEN n >= 100 THEN abs((k - lg) / k - (w - mg) / w) + abs((k - rg) / k - (w - mg) / w) END AS gc, CASE WHEN n >= 100 THEN (k - ln) / k + (k - rn) / k - (w - mn) / w END AS un FROM f)
SELECT id, round(CASE WHEN n < 100 THEN 0.5 ELSE least(1, greatest(0, 0.6 * greatest(0, 1 - gc * 5) + 0.4 * greatest(0, 1 - un))) END, 6) AS edges, round(CASE WHEN n < 50 THEN 0 WHEN n > 20000 THEN 0.5 WHEN n < 100 THEN n / 100.0 WHEN n <= 5000 THEN 1 ELSE greatest(0.5, 1 - (n - 5000) / 15000.0) END, 6) AS completeness FROM v""")  # fmt: skip
def i19(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.raw(spark, sf_dir).select("id", F.upper("seq").alias("seq"))
    return rows.select("id", F.round(X.edge_quality(F.col("seq")), 6).alias("edges"), F.round(X.length_completeness(F.length("seq")), 6).alias("completeness"))


@QUERIES.add("j11_seed_breakpoints", f"""WITH {V.HITS}, l AS (SELECT q AS fam, qstart, qend, qlen FROM hits), g AS (SELECT fam, p, qstart AS s, qend AS e FROM l, range(80, 320, 20) x(p)),
c AS (SELECT fam, p, count(*) AS n, count_if(s <= p - 30 AND e >= p + 30) AS sp, count_if(e < p + 30 AND s < p) AS lf, count_if(s > p - 30 AND e > p) AS rt, count_if(e < p + 30 AND s < p AND s > p - 30 AND e > p) AS b, greatest(1, (count_if(s <= p - 30 AND e >= p - 30) + count_if(s <= p + 30 AND e >= p + 30)) // 2) AS d FROM g GROUP BY fam, p),
k AS (SELECT fam, p, round((1 - CAST(sp AS DOUBLE) / d) * (1 - CAST(b AS DOUBLE) / greatest(1, least(lf, rt))) * least(lf, rt) / d, 9) AS score FROM c WHERE n >= 8 AND least(lf, rt) >= 4 AND CAST(sp AS DOUBLE) / d <= 0.15 AND 1 - CAST(b AS DOUBLE) / greatest(1, least(lf, rt)) >= 0.8),
one AS (SELECT fam, max((score, p)) AS x FROM k GROUP BY fam), a AS (SELECT fam, x[2] AS p1 FROM one), two AS (SELECT fam, max((score, p)) AS x FROM k JOIN a USING (fam) WHERE abs(p - p1) >= 80 GROUP BY fam), b2 AS (SELECT fam, p1, x[2] AS p2 FROM a LEFT JOIN two USING (fam)),
three AS (SELECT fam, max((score, p)) AS x FROM k JOIN b2 USING (fam) WHERE p2 IS NOT NULL AND abs(p - p1) >= 80 AND abs(p - p2) >= 80 GROUP BY fam) SELECT fam, array_to_string(list_sort([p1, p2, x[2]]), ',') AS breakpoints FROM b2 LEFT JOIN three USING (fam)""")  # fmt: skip
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    loci = V.hits(spark, sf_dir).select(F.col("q").alias("fam"), "qstart", "qend", "qlen")
    return X.seed_breakpoints(loci).select("fam", F.concat_ws(",", F.col("breakpoints").cast("array<string>")).alias("breakpoints"))


@QUERIES.add("j13_internal_repeat_cuts", """WITH RECURSIVE h AS (SELECT l_partkey AS q, 6000 AS len, l_orderkey * 11 % 5900 AS ss, l_orderkey * 11 % 5900 + CAST(floor(l_quantity) AS BIGINT) * 8 AS se, 100 - 300 * CAST(l_discount AS DOUBLE) AS pid, CAST(floor(l_quantity) AS BIGINT) * 8 AS w FROM lineitem),
k AS (SELECT DISTINCT q, len, se FROM h WHERE pid >= 80 AND w >= 100 AND ss >= 1000 AND se <= len - 100), walk(q, len, pos) AS (SELECT DISTINCT q, len, CAST(0 AS BIGINT) FROM k UNION ALL SELECT w.q, w.len, (SELECT min(se) FROM k WHERE k.q = w.q AND se - w.pos > 500 AND w.len - se > 500) FROM walk w WHERE w.pos IS NOT NULL),
c AS (SELECT q, len, pos FROM walk WHERE pos IS NOT NULL), r AS (SELECT q, row_number() OVER (PARTITION BY q ORDER BY pos) AS segment, pos AS s, coalesce(lead(pos) OVER (PARTITION BY q ORDER BY pos), len) AS e, count(*) OVER (PARTITION BY q) AS n FROM c) SELECT q, segment, s, CAST(e AS BIGINT) AS e FROM r WHERE n > 1""")  # fmt: skip
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, width = F.col("l_orderkey") * 11 % 5900, F.floor("l_quantity").cast("long") * 8
    lines = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("q"), F.lit(6000).alias("qlen"), start.alias("sstart"), (start + width).alias("send"), (100 - 300 * F.col("l_discount").cast("double")).alias("pident"), width.alias("length")
    )
    return X.internal_repeat_cuts(lines).withColumn("segment", F.col("segment").cast("long"))
