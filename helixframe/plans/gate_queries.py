"""Ordered gates, rescue and typing (operators B5, B6, B11, B17, B23, B24, F8, I7, I12, I15, I17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import seq as S
from helixframe.operators import gates as G
from helixframe.operators import graph as GR
from helixframe.operators import kernels as K
from helixframe.operators import passes as P
from helixframe.operators import scores as SC
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table
from helixframe.plans.sequence_queries import I18, scored


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences (id, seq) with length, n_fraction, entropies, DUST and the share of simple windows; every third one's vowels unknown."""
    seqs = V.seqs(spark, sf_dir).withColumn("seq", F.when(F.col("id") % 3 == 0, F.regexp_replace("seq", "A", "N")).otherwise(F.col("seq")))
    rows = seqs.select("id", F.length("seq").alias("length"), S.fraction(F.col("seq"), "N").alias("n_fraction"))
    dust = K.with_dust(seqs, "id", "seq").withColumnRenamed("dust_fraction", "simple_fraction")
    return rows.join(P.with_entropies(seqs, "id", "seq"), "id").join(dust, "id")


@QUERIES.add("b5_triage_reasons")
def b5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many families each reason of the input gate takes, in its order."""
    known = V.records(spark, sf_dir).select("id", "copies", "mdl")
    rows = measured(spark, sf_dir).join(known, "id", "left").withColumn("topology", F.when(F.col("id") % 41 == 0, "cyclic").otherwise("linear"))
    rows = rows.withColumns({"copies": F.coalesce("copies", F.lit(1)), "mdl": F.when(F.col("id") % 37 == 0, -1.0).otherwise(F.coalesce("mdl", F.lit(1.0)))})
    return G.reason_counts(rows, G.first_reason(G.triage_rules()))


@QUERIES.add("b6_final_reasons")
def b6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sequences through the output gate, which looks for unknown bases last."""
    return G.reason_counts(measured(spark, sf_dir), G.first_reason(G.final_rules()))


@QUERIES.add("b11_discovery_gate", f"""WITH {V.RECORDS}, f AS (SELECT id, CASE WHEN id % 9 > 0 THEN copies % 11 END AS members, length % 400 AS length FROM records), k AS (SELECT * FROM f WHERE coalesce(members, 5) >= 5 AND length >= 100) SELECT id, members, CAST(length AS BIGINT) AS length, (SELECT count(*) FROM k) <= 15 * 2000 AS within FROM k""")
def b11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovered families with members and length, and whether they are no more than 15 for each Mb of a genome of 2000 Mb."""
    rows = V.records(spark, sf_dir).select("id", F.when(F.col("id") % 9 > 0, F.col("copies") % 11).alias("members"), (F.col("length") % 400).cast("long").alias("length"))
    return G.with_bound(G.discovery_gate(rows), 2000)


@QUERIES.add("b17_candidate_classes", f"""WITH {I18}, q AS (SELECT id, len % 700 AS length, c AS copies, ident AS identity, round(CAST(score AS DOUBLE), 9) AS score, greatest(0.5, cut_a) AS a, greatest(0.3, cut_a - 0.2) AS b, (id % 10) / 10.0 AS complexity, id % 6 = 0 AS structural FROM z, m), k AS (SELECT *, CASE WHEN score < b AND length < 80 AND complexity < 0.3 THEN 'rejected' WHEN score >= a THEN 'A' WHEN score >= b THEN 'B' ELSE 'C' END AS class FROM q)
SELECT id, class, CASE WHEN class = 'rejected' THEN 'not_rescued' WHEN length < 50 THEN 'too_short' WHEN identity < 70 AND NOT (length >= 500 OR class = 'A' OR structural) THEN 'low_identity' WHEN copies < 1 AND class NOT IN ('A', 'B') AND length < 200 THEN 'no_copies' ELSE 'candidate' END AS reason FROM k""")
def b17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes with rescue of all but short simple sequences, and why a candidate is left out (identity below 70 here)."""
    rows = scored(spark, sf_dir).select("id", (F.col("len") % 700).alias("length"), F.col("c").alias("copies"), F.col("ident").alias("identity"), F.round("score", 9).alias("score"), "cut_a", "cut_b", (F.col("id") % 10 / 10).alias("complexity"), (F.col("id") % 6 == 0).alias("structural"))
    rows = rows.withColumn("class", G.candidate_class(F.col("score"), F.col("length"), F.col("complexity"), F.col("cut_a"), F.col("cut_b")))
    rules = [("not_rescued", F.col("class") == "rejected"), *G.candidate_rules(least_identity=70.0)]
    return rows.select("id", "class", F.coalesce(G.first_reason(rules), F.lit("candidate")).alias("reason"))


@QUERIES.add("b23_chimera_eligible", f"""WITH {V.RECORDS}, t AS (SELECT id, length % 400 AS length, CASE WHEN id % 13 = 0 THEN 'complex' WHEN id % 2 = 0 THEN 'linear' END AS topology, CASE id % 4 WHEN 0 THEN 'T1' WHEN 1 THEN 'T2' WHEN 2 THEN 'T3' END AS tier FROM records) SELECT id, coalesce(topology = 'complex', false) OR CASE coalesce(tier, 'T2') WHEN 'T1' THEN length >= 300 WHEN 'T2' THEN length >= 150 ELSE false END AS eligible FROM t""")
def b23(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    topology = F.when(i % 13 == 0, "complex").when(i % 2 == 0, "linear")
    tier = F.when(i % 4 == 0, "T1").when(i % 4 == 1, "T2").when(i % 4 == 2, "T3")
    return V.records(spark, sf_dir).select("id", G.chimera_eligible(topology, tier, F.col("length") % 400).alias("eligible"))


@QUERIES.add("b24_stage_filters", f"""WITH {V.HITS}, h AS (SELECT o, ln, CASE q % 5 WHEN 0 THEN 'SVA_' WHEN 1 THEN 'LAVA_' ELSE 'Alu' END || q AS name, (q * 31 + ln * 97) % 1500 AS b, (q * 31 + ln * 97) % 1500 + qend - qstart AS e, score / 50 AS score, 100 - pident AS dvg, CAST(ln * 17 AS DOUBLE) AS ins FROM hits) SELECT o, ln, name, round(CASE WHEN ins < 100 THEN 100 * dvg / (100 - ins) ELSE dvg END, 6) AS divergence FROM h WHERE NOT (name LIKE 'SVA%' AND (b >= 855 AND e < 1270 OR b >= 1263 AND e < 1372)) AND NOT (name LIKE 'LAVA%' AND score < 500)""")
def b24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits that may compete, with divergence over what isn't inserted."""
    kind = F.when(F.col("q") % 5 == 0, "SVA_").when(F.col("q") % 5 == 1, "LAVA_").otherwise("Alu")
    begin = (F.col("q") * 31 + F.col("ln") * 97) % 1500
    rows = V.hits(spark, sf_dir).select("o", "ln", F.concat(kind, F.col("q").cast("string")).alias("name"), begin.alias("b"), (begin + F.col("qend") - F.col("qstart")).alias("e"), (F.col("score") / 50).alias("score"), (100 - F.col("pident")).alias("dvg"), (F.col("ln") * 17).cast("double").alias("ins"))
    kept = rows.filter(G.before_masklevel(F.col("name"), F.col("b"), F.col("e"), F.col("score")))
    return kept.select("o", "ln", "name", F.round(G.adjusted_divergence(F.col("dvg"), F.col("ins")), 6).alias("divergence"))


RATIOS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40)


@QUERIES.add("i15_ltr_scores", f"""WITH {V.SEQS}, r AS (SELECT id, seq, CAST(floor(length(seq) * CAST(share AS DOUBLE)) AS BIGINT) AS n FROM seqs, (SELECT unnest([0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40]) AS share) x WHERE length(seq) >= 300), t AS (SELECT id, n, avg(CASE WHEN substr(seq, i, 1) = substr(seq, length(seq) - n + i, 1) THEN 1.0 ELSE 0.0 END) AS alike FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM r WHERE n BETWEEN 100 AND 1500) u GROUP BY id, n),
b AS (SELECT id, alike, n FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY alike DESC, n) AS k FROM t) v WHERE k = 1),
f AS (SELECT s.id, seq, length(seq) AS len, coalesce(alike, 0) AS alike, coalesce(n, 0) AS n, left(seq, 2) = 'TG' AS five, right(seq, 2) = 'CA' AS three, CASE WHEN length(seq) < 4 THEN 0 WHEN left(seq, 2) = 'TG' AND right(seq, 2) = 'CA' THEN 100 WHEN left(seq, 2) = 'CA' AND right(seq, 2) = 'CA' THEN 80 WHEN left(seq, 2) = 'TG' AND right(seq, 2) = 'TA' THEN 80 ELSE 0 END AS motif, length(seq) > 20 AND (left(seq, 4) = right(seq, 4) OR left(seq, 5) = right(seq, 5) OR left(seq, 6) = right(seq, 6) OR left(seq, 7) = right(seq, 7) OR left(seq, 8) = right(seq, 8) OR left(seq, 9) = right(seq, 9)) AS tsd FROM seqs s LEFT JOIN b ON b.id = s.id),
p AS (SELECT *, regexp_matches(substr(seq, n + 1, 20), 'TGG[TA]|TGGC[GACT]') AS pbs, len >= 300 AND alike >= 0.35 AS whole FROM f),
g AS (SELECT *, CASE WHEN whole THEN (0.4 * CASE WHEN alike >= 0.9 THEN 100 WHEN alike >= 0.8 THEN 95 WHEN alike >= 0.7 THEN 85 WHEN alike >= 0.5 THEN 70 WHEN alike >= 0.4 THEN 50 ELSE 0 END + CASE WHEN tsd THEN 24 ELSE 0 END + CASE WHEN five AND three THEN 15 WHEN five OR three THEN 7.5 ELSE 0 END + CASE WHEN pbs THEN 15 ELSE 0 END) * CASE WHEN len < 2000 AND NOT (tsd OR five AND three) THEN 0.5 ELSE 1 END * CASE WHEN tsd OR five OR three OR pbs THEN 1 ELSE 0.4 END WHEN motif < 80 THEN 0 ELSE motif * 0.7 + CASE WHEN len BETWEEN 100 AND 1500 THEN 30 ELSE 15 END END AS total FROM p)
SELECT id, CASE WHEN whole THEN 'complete' ELSE 'single' END AS kind, round(CAST(alike AS DOUBLE), 6) AS similarity, n AS repeat_length, round(CAST(total AS DOUBLE), 6) AS total, CASE WHEN whole THEN CASE WHEN total >= 70 AND alike >= 0.8 OR total >= 60 AND alike >= 0.7 THEN 'confirmed' WHEN total >= 50 AND alike >= 0.45 THEN 'probable' WHEN total >= 35 THEN 'possible' ELSE 'none' END WHEN total >= 70 THEN 'confirmed' WHEN total >= 50 THEN 'probable' WHEN total >= 30 THEN 'possible' ELSE 'none' END AS category FROM g""")
def i15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole elements and single repeats, typed by how alike their ends are, with scores."""
    seqs = V.seqs(spark, sf_dir)
    ends = P.with_terminal_repeat(seqs.filter(F.length("seq") >= 300), "id", "seq", RATIOS, 100, 1500)
    rows = seqs.join(ends, "id", "left").withColumns({"similarity": F.coalesce("similarity", F.lit(0.0)), "repeat_length": F.coalesce("repeat_length", F.lit(0))})
    return SC.ltr_scores(rows).select("id", "kind", S.rounded(F.col("similarity"), 6).alias("similarity"), F.col("repeat_length").cast("long").alias("repeat_length"), S.rounded(F.col("total"), 6).alias("total"), "category")


@QUERIES.add("i17_structure_score")
def i17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure scores of sequences whose hits are the line items of the part with their id; domains were sought in every other one."""
    seqs = V.seqs(spark, sf_dir)
    hits = V.hits(spark, sf_dir).groupBy(F.col("q").alias("id")).agg(F.count(F.lit(1)).alias("hits"), F.avg(F.when(F.col("qstart") % 3 == 0, 1.0).otherwise(0.0)).alias("rate"))
    rows = seqs.join(P.with_open_frame(seqs, "id", "seq"), "id").join(K.with_dust(seqs, "id", "seq"), "id").join(hits, "id", "left")
    found = F.array_distinct(F.array(F.when(F.col("id") % 3 == 0, "rt").otherwise("x"), F.when(F.col("id") % 5 == 0, "transposase").otherwise("x")))
    rows = rows.withColumns({"domains": F.when(F.col("id") % 2 == 0, found), "rate": F.coalesce("rate", F.lit(0.0)), "tsd_length": F.when(F.col("hits") > 0, F.col("id") % 9).otherwise(0)})
    seq = F.col("seq")
    often, of_class = SC.tsd_scores(F.col("rate"), F.col("tsd_length"))
    parts = {"terminal_pairs": SC.terminal_pairs(seq), "terminal_motifs": SC.terminal_motifs(seq), "coherence": F.when(F.col("hits") >= 10, 0.03).otherwise(0.0), "tsd_rate": often, "tsd_length": of_class, "domains": SC.domain_score(F.col("domains")), "open_frame": SC.frame_score(F.col("open_frame"), F.length(seq)), "poly_a": SC.tail_score(seq), "primer": SC.primer_score(seq)}
    taken = SC.penalties(seq, 1 - F.col("dust"), F.col("domains"))
    score, tier = SC.structure_score(parts, taken, F.coalesce(F.col("hits") > 0, F.lit(False)), F.lit(0.0), F.lit(0.0))
    return rows.select("id", "open_frame", F.round(score, 6).alias("score"), tier.alias("tier"))


@QUERIES.add("f8_ordered_library", """SELECT id, CAST(row_number() OVER (ORDER BY mdl DESC, length DESC, id) AS BIGINT) AS place FROM (SELECT p_partkey AS id, p_size * 60 AS length, CAST(floor(CAST(p_retailprice AS DOUBLE) / 50) AS BIGINT) AS mdl FROM part) x""")
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in the order that gives representatives: by MDL, then length, both falling, then the smaller id."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 60).alias("length"), F.floor(F.col("p_retailprice").cast("double") / 50).alias("mdl"))
    return G.placed(rows, [F.desc("mdl"), F.desc("length"), F.asc("id")]).select("id", "place")


@QUERIES.add("i7_repeat_shares")
def i7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of each sequence in simple runs and tandem repeats; unions of spans, so nothing counts twice."""
    rows = P.with_repeats(V.seqs(spark, sf_dir), "id", "seq")
    return rows.select("id", *(F.round(c, 6).alias(c) for c in ("simple", "tandem", "tandem_long")))


@QUERIES.add("i12_structural_features")
def i12_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long terminal repeats, inverted ends, a poly-A tail and boundary heads, and whether a sequence has any."""
    seqs, seq = V.seqs(spark, sf_dir), F.col("seq")
    ends = (seq.startswith("TG") & seq.endswith("CA")) | (seq.startswith("TA") & seq.endswith("TA"))
    head = sum((F.contains(F.right(seq, F.lit(20)), F.left(seq, F.lit(k))).cast("int") for k in range(4, 9)), F.lit(0)) > 0
    rows = seqs.join(P.with_terminal_flags(seqs, "id", "seq"), "id")
    rows = rows.select("id", "ltr", S.inverted_ends(seq).alias("tir"), F.contains(F.right(seq, F.lit(50)), F.lit("AAAAAA")).alias("poly_a"), ((F.length(seq) >= 20) & (ends | head)).alias("boundary"))
    return rows.withColumn("structural", F.col("ltr") | F.col("tir") | F.col("poly_a") | F.col("boundary"))


@QUERIES.add("h12_greedy_descent", """WITH l AS (SELECT p_size % 5 AS a, p_size AS b, p_brand AS c, CAST(p_retailprice AS DOUBLE) / 3000 AS p FROM part), s AS (SELECT a, avg(p) AS s FROM l GROUP BY a), n2 AS (SELECT a, b, round(avg(p), 9) AS p FROM l GROUP BY a, b), n3 AS (SELECT a, b, c, round(avg(p), 9) AS p FROM l GROUP BY a, b, c),
c2 AS (SELECT a, b, p, CASE WHEN b % 10 = 0 THEN 0.34 ELSE 0.31 END AS own FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY p DESC, b) AS r FROM n2) x WHERE r = 1), c3 AS (SELECT a, b, c, p FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY p DESC, c) AS r FROM n3) x WHERE r = 1)
SELECT c2.a, CASE WHEN c2.p <= 0.33 THEN '#self' WHEN c3.p <= c2.own THEN CAST(c2.b AS VARCHAR) || '.#self' ELSE CAST(c2.b AS VARCHAR) || '.' || c3.c END AS path FROM c2 JOIN c3 ON c3.a = c2.a AND c3.b = c2.b""")
def h12_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each root to its most probable child, and on, until a node itself is more probable than its children."""
    leaves = table(spark, sf_dir, "part").select((F.col("p_size") % 5).cast("string").alias("a"), F.col("p_size").alias("b"), F.col("p_brand").alias("c"), (F.col("p_retailprice").cast("double") / 3000).alias("p"))
    one = leaves.groupBy("a", "b").agg(F.round(F.avg("p"), 9).alias("p")).select(F.col("a").alias("node"), F.concat_ws("/", "a", F.col("b").cast("string")).alias("child"), "p", F.lit(0.33).alias("own"))
    two = leaves.groupBy("a", "b", "c").agg(F.round(F.avg("p"), 9).alias("p")).select(F.concat_ws("/", "a", F.col("b").cast("string")).alias("node"), F.concat_ws("/", "a", F.col("b").cast("string"), "c").alias("child"), "p", F.when(F.col("b") % 10 == 0, 0.34).otherwise(0.31).alias("own"))
    roots = leaves.select(F.col("a").alias("id"), F.col("a").alias("node")).distinct()
    found = GR.descended(roots, one.unionByName(two), depth=2)
    parts = F.split("node", "/")
    path = F.array_join(F.concat(F.slice(parts, 2, 2), F.when(F.col("stopped"), F.array(F.lit("#self"))).otherwise(F.array().cast("array<string>"))), ".")
    return found.select(F.col("id").cast("int").alias("a"), path.alias("path"))
