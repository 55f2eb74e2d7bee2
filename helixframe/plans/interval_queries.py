"""Interval queries (operators C3-C5, C16, D1, D5, D7, E1-E9, E12, J12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import gates as G
from helixframe.operators import intervals as I
from helixframe.operators import kernels as K
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES

ISLANDS = """islands AS (SELECT *, sum(fresh) OVER (PARTITION BY {by} ORDER BY {s}, {e} ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN {s} {op} max({e}) OVER (PARTITION BY {by} ORDER BY {s}, {e} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS fresh FROM {t}) x)"""


def islands_sql(by: str, s: str, e: str, table: str, gap: int = 0, op: str = "<=") -> str:
    return ISLANDS.format(by=by, s=s, e=e, t=table, gap=gap, op=op)


@QUERIES.add("e1_island_merge", f"""WITH {V.INSTANCES}, {islands_sql('chrom', 's', 'e', 'instances')}
SELECT chrom, CAST(min(s) AS BIGINT) AS s, CAST(max(e) AS BIGINT) AS e, string_agg(DISTINCT strand, '+' ORDER BY strand) AS sources, count(*) AS n FROM islands GROUP BY chrom, island HAVING max(e) - min(s) BETWEEN 100 AND 30000""")
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = F.array_join(F.array_sort(F.collect_set("strand")), "+").alias("sources")
    return I.merged(V.instances(spark, sf_dir), ["chrom"], "s", "e", [sources, F.count(F.lit(1)).alias("n")], width=I.BIN).filter("e - s between 100 and 30000")


@QUERIES.add("e2_mask_merge", f"""WITH {V.HITS}, {islands_sql('subject', 'gmin', 'gmax', 'hits')}
SELECT subject, CAST(min(gmin) AS BIGINT) AS gmin, CAST(max(gmax) AS BIGINT) AS gmax, max(score) AS score, max(pident) AS identity FROM islands GROUP BY subject, island""")
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.merged(V.hits(spark, sf_dir), ["subject"], "gmin", "gmax", [F.max("score").alias("score"), F.max("pident").alias("identity")], width=I.BIN)


@QUERIES.add("e3_hsp_loci", f"""WITH {V.HITS}, {islands_sql('q, subject, strand', 'gmin', 'gmax', 'hits', 2000)},
loci AS (SELECT q, subject, strand, island, min(gmin) AS gmin, max(gmax) AS gmax, min(qstart) AS qstart, max(qend) AS qend, greatest(0, 1 - avg(pident) / 100) AS divergence FROM islands GROUP BY q, subject, strand, island),
inner_islands AS (SELECT *, sum(fresh2) OVER (PARTITION BY q, subject, strand, island ORDER BY qstart, qend ROWS UNBOUNDED PRECEDING) AS part FROM (
 SELECT *, CASE WHEN qstart <= max(qend) OVER (PARTITION BY q, subject, strand, island ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh2 FROM islands) y),
spans AS (SELECT q, subject, strand, island, sum(b - a + 1) AS covered FROM (SELECT q, subject, strand, island, part, min(qstart) AS a, max(qend) AS b FROM inner_islands GROUP BY q, subject, strand, island, part) z GROUP BY q, subject, strand, island)
SELECT q, subject, strand, CAST(l.gmin AS BIGINT) AS gmin, CAST(l.gmax AS BIGINT) AS gmax, CAST(qstart AS BIGINT) AS qstart, CAST(qend AS BIGINT) AS qend, round(divergence, 6) AS divergence, round(CAST(covered AS DOUBLE) / 400, 6) AS cov FROM loci l JOIN spans USING (q, subject, strand, island)""")
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["q", "subject", "strand"]
    rows = I.with_island(V.hits(spark, sf_dir), by, "gmin", "gmax", 2000)
    loci = rows.groupBy(*by, "island").agg(F.min("gmin").alias("gmin"), F.max("gmax").alias("gmax"), F.min("qstart").cast("long").alias("qstart"), F.max("qend").cast("long").alias("qend"), F.greatest(F.lit(0.0), 1 - F.avg("pident") / 100).alias("divergence"))
    spans = I.union_length(rows, [*by, "island"], "qstart", "qend", "covered")
    return loci.join(spans, [*by, "island"]).select(*by, "gmin", "gmax", "qstart", "qend", F.round("divergence", 6).alias("divergence"), F.round(F.col("covered") / 400, 6).alias("cov"))


@QUERIES.add("e4_spanning_loci", f"""WITH {V.INSTANCES}, {islands_sql('chrom, strand', 's', 'e', 'instances', 50)},
g AS (SELECT chrom, strand, min(s) AS s, max(e) AS e, avg(dvg) AS dvg, count(DISTINCT fam) AS families FROM islands GROUP BY chrom, strand, island)
SELECT chrom, strand, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, round(dvg, 6) AS dvg, families FROM g WHERE families >= 2 AND e - s BETWEEN 80 AND 25000 AND (SELECT count(*) FROM g WHERE families >= 2 AND e - s BETWEEN 80 AND 25000) >= 5""")
def e4(spark: SparkSession, sf_dir: str) -> DataFrame:
    loci = I.merged(V.instances(spark, sf_dir), ["chrom", "strand"], "s", "e", [F.avg("dvg").alias("dvg"), F.count_distinct("fam").alias("families")], gap=50, width=I.BIN)
    loci = loci.filter("families >= 2 and e - s between 80 and 25000")
    enough = loci.agg((F.count(F.lit(1)) >= 5).alias("enough")).filter("enough")
    return loci.join(F.broadcast(enough)).select("chrom", "strand", "s", "e", F.round("dvg", 6).alias("dvg"), "families")


@QUERIES.add("e5_gap_insertions", f"""WITH {V.HITS}, c AS (SELECT *, lead(gmin) OVER w - 1 - gmax AS t_gap, CASE WHEN strand = '+' THEN lead(qstart) OVER w - 1 - qend ELSE qstart - 1 - lead(qend) OVER w END * 10 AS q_gap FROM hits WINDOW w AS (PARTITION BY q, subject, strand ORDER BY gmin, gmax, o, ln))
SELECT q, subject, strand, CAST(gmax AS BIGINT) AS gmax, CAST(t_gap AS BIGINT) AS t_gap, CAST(q_gap AS BIGINT) AS q_gap, CASE WHEN abs(q_gap) > abs(t_gap) THEN 'query' ELSE 'target' END AS side FROM c
WHERE greatest(abs(t_gap), abs(q_gap)) BETWEEN 100 AND 30000 AND least(abs(t_gap), abs(q_gap)) <= 0.3 * greatest(abs(t_gap), abs(q_gap)) AND CASE WHEN abs(q_gap) > abs(t_gap) THEN q_gap ELSE t_gap END > 0""")
def e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("q", "subject", "strand").orderBy("gmin", "gmax", "o", "ln")
    ahead = lambda c: F.lead(c).over(w)
    q_gap = F.when(F.col("strand") == "+", ahead("qstart") - 1 - F.col("qend")).otherwise(F.col("qstart") - 1 - ahead("qend")) * 10
    rows = V.hits(spark, sf_dir).withColumns({"t_gap": ahead("gmin") - 1 - F.col("gmax"), "q_gap": q_gap})
    more, less = F.greatest(F.abs("t_gap"), F.abs("q_gap")), F.least(F.abs("t_gap"), F.abs("q_gap"))
    larger = F.abs("q_gap") > F.abs("t_gap")
    rows = rows.filter(more.between(100, 30000) & (less <= 0.3 * more) & (F.when(larger, F.col("q_gap")).otherwise(F.col("t_gap")) > 0))
    return rows.select("q", "subject", "strand", "gmax", "t_gap", F.col("q_gap").cast("long").alias("q_gap"), F.when(larger, "query").otherwise("target").alias("side"))


@QUERIES.add("e6_blunt_trim", f"""WITH {V.HITS}, c AS (SELECT *, lag(qend) OVER (PARTITION BY q ORDER BY qstart, qend, o, ln) AS p FROM hits)
SELECT q, o, ln, CAST(CASE WHEN p >= qstart AND p + 1 < qend THEN p + 1 ELSE qstart END AS BIGINT) AS qstart, CAST(qend AS BIGINT) AS qend FROM c""")
def e6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.trimmed(V.hits(spark, sf_dir), ["q"], ["qstart", "qend", "o", "ln"], "qstart", "qend", "begin")
    return rows.select("q", "o", "ln", F.col("begin").cast("long").alias("qstart"), F.col("qend").cast("long").alias("qend"))


@QUERIES.add("e8_contained_lower_score", f"""WITH {V.HITS} SELECT o, ln, subject, CAST(gmin AS BIGINT) AS gmin, CAST(gmax AS BIGINT) AS gmax, score FROM hits a WHERE NOT EXISTS (SELECT 1 FROM hits b WHERE b.subject = a.subject AND a.gmin >= b.gmin AND a.gmax < b.gmax AND b.score > a.score AND b.gmin > a.gmin - 300)""")
def e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.contained_lower(V.hits(spark, sf_dir), "subject", "gmin", "gmax", "score", 1000).select("o", "ln", "subject", "gmin", "gmax", "score")


@QUERIES.add("e9_fragment_rejoin", f"""WITH RECURSIVE {V.HITS}, h AS (SELECT q, strand, o, ln, qstart // 80 AS score, CASE WHEN pident >= 95 THEN 0 ELSE 1 END AS dvg, p_brand AS lineage, (o * 7 + ln * 3) % 40 AS ss, (o * 7 + ln * 3) % 40 + ln AS se, row_number() OVER (PARTITION BY q ORDER BY o, ln, gmin, subject) AS k FROM hits JOIN part ON p_partkey = q WHERE p_brand <> 'Brand#11'),
g AS (SELECT *, row_number() OVER (PARTITION BY q, strand, score, dvg, lineage ORDER BY k) AS r FROM h),
d AS (SELECT q, strand, score, dvg, lineage, k, ss, se, r, 1 AS chain, [{{'s': ss, 'e': se}}] AS lasts FROM g WHERE r = 1
UNION ALL SELECT q, strand, score, dvg, lineage, k, ss, se, r, coalesce(hit, len(lasts) + 1), CASE WHEN hit IS NULL THEN list_append(lasts, {{'s': ss, 'e': se}}) ELSE list_concat(lasts[:hit - 1], [{{'s': ss, 'e': se}}], lasts[hit + 1:]) END
FROM (SELECT g.*, d.lasts, nullif(list_position(list_transform(d.lasts, lambda x: abs(g.ss - x.e) < 5 OR abs(g.se - x.s) < 5), true), 0) AS hit FROM d JOIN g ON g.q = d.q AND g.strand = d.strand AND g.score = d.score AND g.dvg = d.dvg AND g.lineage = d.lineage AND g.r = d.r + 1) x)
SELECT q, strand, CAST(score AS BIGINT) AS score, min(k) AS first, count(*) AS n, CAST(min(least(ss, se)) AS BIGINT) AS low, CAST(max(greatest(ss, se)) AS BIGINT) AS high FROM d GROUP BY q, strand, score, dvg, lineage, chain""")
def e9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of one alignment: equal name, score, divergence and lineage, and consensus ends that meet; one class is left out."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("q"), F.col("p_brand").alias("lineage"))
    place = (F.col("o") * 7 + F.col("ln") * 3) % 40
    rows = V.hits(spark, sf_dir).join(parts, "q").filter("lineage <> 'Brand#11'")
    rows = rows.withColumns({"score": F.floor(F.col("qstart") / 80), "dvg": F.when(F.col("pident") >= 95, 0).otherwise(1), "ss": place, "se": place + F.col("ln")})
    rows = rows.withColumn("k", F.row_number().over(W.partitionBy("q").orderBy("o", "ln", "gmin", "subject")))
    chains = K.rejoined(rows, ["q", "strand", "score", "dvg", "lineage"], ["k"], "ss", "se")
    found = chains.groupBy("q", "strand", "score", "dvg", "lineage", "chain").agg(F.min("k").cast("long").alias("first"), F.count(F.lit(1)).alias("n"), F.min(F.least("ss", "se")).cast("long").alias("low"), F.max(F.greatest("ss", "se")).cast("long").alias("high"))
    return found.drop("dvg", "lineage", "chain")


@QUERIES.add("e12_rank_and_cap", f"""WITH {V.HITS} SELECT q, o, ln, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, o, ln) AS rank FROM hits) x WHERE rank <= 5""")
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "o", "ln"))
    return V.hits(spark, sf_dir).withColumn("rank", rank.cast("long")).filter("rank <= 5").select("q", "o", "ln", "score", "rank")


@QUERIES.add("c3_overlap_recovery", f"""WITH {V.INSTANCES}, m AS (SELECT DISTINCT o, ln, fam, chrom, s, e FROM instances WHERE strand = '+'), h AS (SELECT * FROM instances WHERE strand = '-')
SELECT m.o, m.ln, m.fam, m.chrom, round(coalesce(max(CASE WHEN h.s IS NULL THEN 0 ELSE CAST(least(m.e, h.e) - greatest(m.s, h.s) AS DOUBLE) / (m.e - m.s) END), 0), 6) AS best, coalesce(max(CASE WHEN h.s IS NULL THEN 0 ELSE CAST(least(m.e, h.e) - greatest(m.s, h.s) AS DOUBLE) / (m.e - m.s) END), 0) >= 0.5 AS recovered
FROM m LEFT JOIN h ON m.chrom = h.chrom AND m.s < h.e AND h.s < m.e GROUP BY m.o, m.ln, m.fam, m.chrom, m.s, m.e""")
def c3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.instances(spark, sf_dir)
    members = rows.filter("strand = '+'").select("o", "ln", "fam", "chrom", F.col("s").alias("ls"), F.col("e").alias("le")).distinct()
    key = ["o", "ln", "fam", "chrom", "ls", "le"]
    found = I.overlapping(members, rows.filter("strand = '-'").select("chrom", F.col("s").alias("rs"), F.col("e").alias("re")), "chrom", 10_000)
    best = found.groupBy(*key).agg(F.max(I.overlap_length() / (F.col("le") - F.col("ls"))).alias("best"))
    out = members.join(best, key, "left").withColumn("best", F.coalesce("best", F.lit(0.0)))
    return out.select("o", "ln", "fam", "chrom", F.round("best", 6).alias("best"), (F.col("best") >= 0.5).alias("recovered"))


@QUERIES.add("c4_overlap_length", f"""WITH {V.INSTANCES} SELECT chrom, count(*) AS pairs, CAST(sum(least(a_e, b_e) - greatest(a_s, b_s)) AS BIGINT) AS bases FROM (SELECT a.chrom, a.s AS a_s, a.e AS a_e, b.s AS b_s, b.e AS b_e FROM instances a JOIN instances b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e AND (a.o, a.ln) < (b.o, b.ln)) x GROUP BY chrom""")
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.instances(spark, sf_dir)
    a = rows.select("chrom", F.col("s").alias("ls"), F.col("e").alias("le"), F.struct("o", "ln").alias("a"))
    b = rows.select("chrom", F.col("s").alias("rs"), F.col("e").alias("re"), F.struct("o", "ln").alias("b"))
    return I.overlapping(a, b, "chrom", 10_000).filter("a < b").groupBy("chrom").agg(F.count(F.lit(1)).alias("pairs"), F.sum(I.overlap_length()).alias("bases"))


@QUERIES.add("c5_lookahead_pairs", f"""WITH {V.INSTANCES}, r AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY s, e, o, ln, fam, strand, dvg) AS k FROM instances),
p AS (SELECT a.chrom, a.k, a.fam AS f1, b.fam AS f2, a.strand, b.k - a.k AS d FROM r a JOIN r b ON a.chrom = b.chrom AND b.k - a.k BETWEEN 1 AND 4 WHERE b.s - a.e <= 300 AND a.strand = b.strand AND a.fam <> b.fam AND greatest(0, least(a.e, b.e) - greatest(a.s, b.s)) <= 0.5 * least(a.e - a.s, b.e - b.s)),
u AS (SELECT DISTINCT chrom, k, f1, f2, strand FROM p)
SELECT CASE WHEN strand = '+' THEN f1 ELSE f2 END AS left_fam, CASE WHEN strand = '+' THEN f2 ELSE f1 END AS right_fam, count(*) AS n FROM u GROUP BY 1, 2""")
def c5(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["s", "e", "o", "ln", "fam", "strand", "dvg"]
    rows = I.next_rows(V.instances(spark, sf_dir), ["chrom"], order, ["s", "e", "strand", "fam"], 4)
    pairs = rows.select("chrom", "k", "s", "e", "strand", "fam", F.explode("__next").alias("b"))
    overlap = F.greatest(F.lit(0), F.least("e", "b.e") - F.greatest("s", "b.s"))
    shorter = F.least(F.col("e") - F.col("s"), F.col("b.e") - F.col("b.s"))
    pairs = pairs.filter((F.col("b.s") - F.col("e") <= 300) & (F.col("strand") == F.col("b.strand")) & (F.col("fam") != F.col("b.fam")) & (overlap <= 0.5 * shorter))
    pairs = pairs.select("chrom", "k", "strand", "fam", F.col("b.fam").alias("other")).distinct()
    forward = F.col("strand") == "+"
    return pairs.groupBy(F.when(forward, F.col("fam")).otherwise(F.col("other")).alias("left_fam"), F.when(forward, F.col("other")).otherwise(F.col("fam")).alias("right_fam")).agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("c16_congruity_join", f"""WITH {V.HITS}, c AS (SELECT *, lag(gmax) OVER w AS pg, lag(qend) OVER w AS pq, lag(o) OVER w AS po, lag(ln) OVER w AS pl FROM hits WINDOW w AS (PARTITION BY q, subject, strand ORDER BY gmin, gmax, o, ln))
SELECT po, pl, o, ln, CAST(abs((gmin - pg) - (qstart - pq)) AS BIGINT) AS apart FROM c WHERE pg IS NOT NULL AND abs((gmin - pg) - (qstart - pq)) < 7000""")
def c16(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("q", "subject", "strand").orderBy("gmin", "gmax", "o", "ln")
    apart = F.abs((F.col("gmin") - F.lag("gmax").over(w)) - (F.col("qstart") - F.lag("qend").over(w)))
    return V.hits(spark, sf_dir).select(F.lag("o").over(w).alias("po"), F.lag("ln").over(w).alias("pl"), "o", "ln", apart.cast("long").alias("apart")).filter("apart < 7000")


@QUERIES.add("d1_completeness_presignals", f"""WITH {V.INSTANCES}, st AS (SELECT fam, count(*) AS n, avg(dvg) AS mean, stddev_pop(dvg) AS spread FROM instances WHERE strand = '+' GROUP BY fam)
SELECT p_partkey AS id, coalesce(n, 0) AS n, round(mean, 6) AS mean, round(spread, 6) AS spread, CASE WHEN p_size * 60 >= 1000 THEN 4 WHEN p_size * 60 >= 500 THEN 3 WHEN p_size * 60 >= 200 THEN 3 ELSE 2 END AS expected, coalesce(n, 0) < CASE WHEN p_size * 60 >= 1000 THEN 4 WHEN p_size * 60 >= 500 THEN 3 WHEN p_size * 60 >= 200 THEN 3 ELSE 2 END AS flagged, coalesce(n, 0) < 5 AND (coalesce(10 * spread >= 0.31 AND n >= 2, false) OR coalesce(n, 0) < CASE WHEN p_size * 60 >= 1000 THEN 4 WHEN p_size * 60 >= 200 THEN 3 ELSE 2 END) AS eligible FROM part LEFT JOIN st ON fam = p_partkey""")
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness signals (D1), the expectation of a length (B22) and recall eligibility (B21), for divergences ten times as wide."""
    stats = V.instances(spark, sf_dir).filter("strand = '+'").groupBy("fam").agg(F.count(F.lit(1)).alias("n"), F.avg("dvg").alias("mean"), F.stddev_pop("dvg").alias("spread"))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 60).alias("length"))
    length = F.col("length")
    rows = parts.join(stats, F.col("id") == F.col("fam"), "left").withColumns({"n": F.coalesce("n", F.lit(0)), "expected": F.when(length >= 1000, 4).when(length >= 500, 3).when(length >= 200, 3).otherwise(2)})
    short = F.col("n") < F.col("expected")
    return rows.select("id", "n", F.round("mean", 6).alias("mean"), F.round("spread", 6).alias("spread"), "expected", short.alias("flagged"), G.recall_eligible(F.col("n"), 10 * F.col("spread"), F.col("expected")).alias("eligible"))


@QUERIES.add("d5_genomic_copies", f"""WITH {V.HITS}, {islands_sql('q, subject', 'gmin', 'gmax', 'hits', 100000)},
i2 AS (SELECT *, sum(f2) OVER (PARTITION BY q, subject, island ORDER BY qstart, qend ROWS UNBOUNDED PRECEDING) AS part FROM (SELECT *, CASE WHEN qstart <= max(qend) OVER (PARTITION BY q, subject, island ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f2 FROM islands) y),
sp AS (SELECT q, subject, island, sum(b - a + 1) AS covered FROM (SELECT q, subject, island, part, min(qstart) AS a, max(qend) AS b FROM i2 GROUP BY q, subject, island, part) z GROUP BY q, subject, island)
SELECT q, count(*) AS loci, CAST(sum(CASE WHEN covered >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS copies FROM sp GROUP BY q""")
def d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.with_island(V.hits(spark, sf_dir), ["q", "subject"], "gmin", "gmax", 100_000)
    spans = I.union_length(rows, ["q", "subject", "island"], "qstart", "qend", "covered")
    return spans.groupBy("q").agg(F.count(F.lit(1)).alias("loci"), F.count_if(F.col("covered") >= 60).alias("copies"))


@QUERIES.add("d7_class_summary", f"""WITH {V.HITS}, c AS (SELECT h.*, p_brand AS cls, lag(gmax) OVER (PARTITION BY subject ORDER BY gmin, gmax, o, ln, q, score) AS prev FROM hits h JOIN part ON p_partkey = q)
SELECT coalesce(cls, 'all') AS cls, count(*) AS elements, count(DISTINCT q) AS families, CAST(sum(CASE WHEN prev IS NULL OR prev < gmin THEN gmax - gmin + 1 ELSE greatest(0, gmax - prev) END) AS BIGINT) AS bp FROM c GROUP BY ROLLUP(cls)""")
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("q"), F.col("p_brand").alias("cls"))
    rows = I.with_previous(V.hits(spark, sf_dir).join(parts, "q"), ["subject"], ["gmin", "gmax", "o", "ln", "q", "score"], "gmax", "prev")
    bp = F.when(F.col("prev").isNull() | (F.col("prev") < F.col("gmin")), F.col("gmax") - F.col("gmin") + 1).otherwise(F.greatest(F.lit(0), F.col("gmax") - F.col("prev")))
    return rows.rollup("cls").agg(F.count(F.lit(1)).alias("elements"), F.count_distinct("q").alias("families"), F.sum(bp).alias("bp")).withColumn("cls", F.coalesce("cls", F.lit("all")))


@QUERIES.add("j12_depth_profile", f"""WITH {V.INSTANCES}, ev AS (SELECT chrom, p, sum(d) AS d FROM (SELECT chrom, s AS p, 1 AS d FROM instances UNION ALL SELECT chrom, e, -1 FROM instances) x GROUP BY chrom, p),
c AS (SELECT chrom, p, lead(p) OVER w AS u, sum(d) OVER (PARTITION BY chrom ORDER BY p ROWS UNBOUNDED PRECEDING) AS depth FROM ev WINDOW w AS (PARTITION BY chrom ORDER BY p))
SELECT chrom, CAST(depth AS BIGINT) AS depth, CAST(sum(u - p) AS BIGINT) AS bases FROM c WHERE u IS NOT NULL GROUP BY chrom, depth""")
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = I.depth(V.instances(spark, sf_dir), ["chrom"], "s", "e")
    return steps.groupBy("chrom", "depth").agg(F.sum(F.col("until") - F.col("position")).alias("bases"))
