"""k-mers, sets, graphs and lookups (operators C1, C2, C6-C9, C11-C15, D6, D10-D14, F2-F8, G1-G6, H2, H4, H5, H10-H13, B18-B20, B25)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import gates as G
from helixframe.operators import graph as GR
from helixframe.operators import kmers as K
from helixframe.operators import pairs as PR
from helixframe.operators import passes as P
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table

RC = "reverse(translate(w, 'ACGT', 'TGCA'))"
#: Classes of equal sequences by their smallest id, and all pairs of classes whose 13-mers have a Jaccard similarity of 0.5 or more.
PAIRS = f"""{V.SEQS}, rep AS (SELECT min(id) AS id, arg_min(seq, id) AS seq FROM seqs GROUP BY least(seq, reverse(translate(seq, 'ACGT', 'TGCA')))),
k13 AS (SELECT DISTINCT id, least(w, {RC}) AS w FROM (SELECT id, substr(seq, i, 13) AS w FROM (SELECT id, seq, unnest(range(1, length(seq) - 11)) AS i FROM rep WHERE length(seq) >= 13) x) y),
n13 AS (SELECT id, count(*) AS n FROM k13 GROUP BY id), twice AS (SELECT w FROM k13 GROUP BY w HAVING count(*) > 1), s13 AS (SELECT k13.id, w, n FROM k13 JOIN twice USING (w) JOIN n13 ON n13.id = k13.id),
nb AS (SELECT x.id AS a, y.id AS b FROM s13 x JOIN s13 y ON x.w = y.w AND x.id < y.id AND 2 * least(x.n, y.n) >= greatest(x.n, y.n) GROUP BY x.id, y.id, x.n, y.n HAVING 3 * count(*) >= x.n + y.n)"""


def related(spark: SparkSession, sf_dir: str, more: str = "", of: Callable[[str, str], tuple] | None = None) -> tuple[DataFrame, DataFrame]:
    """One sequence (id, seq) of each class of equal ones, and all pairs (a, b, common, n_a, n_b, ...) of classes with half or more of their 13-mers in common."""
    classes = GR.written(K.class_sequences(V.seqs(spark, sf_dir)), "classes")
    return classes, GR.written(PR.related(classes, 13, 0.5, more, of), "pairs")


def shared(k: int) -> Callable[[str, str], tuple[int, int, int]]:
    """Of two texts, their k-mers in common and those of each, on their own strands."""

    def of(x: str, y: str) -> tuple[int, int, int]:
        a, b = (np.unique(code[good]) for code, good in (P.words(P.codes(t), k) for t in (x, y)))
        return PR.common(a, b), len(a), len(b)

    return of


SHARED = "common_k long, n_a_k long, n_b_k long"


def likeness() -> Column:
    return F.col("common_k") / (F.col("n_a_k") + F.col("n_b_k") - F.col("common_k"))


@QUERIES.add("c7_kmer_jaccard", f"""WITH {PAIRS},
n AS (SELECT id, count(*) AS n FROM k13 GROUP BY id), c AS (SELECT nb.a, nb.b, count(*) AS common FROM nb JOIN k13 x ON x.id = nb.a JOIN k13 y ON y.id = nb.b AND y.w = x.w GROUP BY nb.a, nb.b)
SELECT nb.a, nb.b, coalesce(common, 0) AS common, round(CASE WHEN coalesce(p.n, 0) + coalesce(q.n, 0) = 0 THEN 0 ELSE 1 - CAST(coalesce(common, 0) AS DOUBLE) / (coalesce(p.n, 0) + coalesce(q.n, 0) - coalesce(common, 0)) END, 6) AS distance FROM nb LEFT JOIN c USING (a, b) LEFT JOIN n p ON p.id = nb.a LEFT JOIN n q ON q.id = nb.b""")
def c7(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pairs = related(spark, sf_dir)
    return pairs.select("a", "b", "common", F.round(1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common")), 6).alias("distance"))


@QUERIES.add("c8_mash_identity", f"""WITH {PAIRS}, km AS (SELECT DISTINCT id, substr(seq, i, 8) AS w FROM (SELECT id, seq, unnest(range(1, length(seq) - 6)) AS i FROM rep WHERE length(seq) >= 8) x),
n AS (SELECT id, count(*) AS n FROM km GROUP BY id), c AS (SELECT nb.a, nb.b, count(*) AS common FROM nb JOIN km x ON x.id = nb.a JOIN km y ON y.id = nb.b AND y.w = x.w GROUP BY nb.a, nb.b),
j AS (SELECT a, b, CAST(common AS DOUBLE) / (p.n + q.n - common) AS j FROM c JOIN n p ON p.id = a JOIN n q ON q.id = b),
s AS (SELECT a, b, CASE WHEN length(x.seq) <= length(y.seq) THEN x.seq ELSE y.seq END AS short, CASE WHEN length(x.seq) <= length(y.seq) THEN y.seq ELSE x.seq END AS long FROM nb JOIN rep x ON x.id = a JOIN rep y ON y.id = b WHERE least(length(x.seq), length(y.seq)) < 200),
o AS (SELECT *, unnest(range(0, length(long) - length(short) + 1, greatest(1, (length(long) - length(short) + 1) // 100))) AS spot FROM s),
m AS (SELECT a, b, spot, avg(CASE WHEN substr(short, i, 1) = substr(long, spot + i, 1) THEN 1.0 ELSE 0.0 END) AS same FROM (SELECT *, unnest(range(1, length(short) + 1)) AS i FROM o) u GROUP BY a, b, spot), best AS (SELECT a, b, max(same) AS same FROM m GROUP BY a, b)
SELECT nb.a, nb.b, round(CASE WHEN best.same IS NOT NULL THEN CAST(best.same AS DOUBLE) WHEN j > 0 THEN least(1, greatest(0, 1 + ln(2 * j / (1 + j)) / 8)) ELSE 0 END, 6) AS identity FROM nb LEFT JOIN j USING (a, b) LEFT JOIN best USING (a, b)""")
def c8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By shared 8-mers; pairs with a sequence under 200 bases by the best offset of the shorter."""
    counts = shared(8)

    def of(x: str, y: str) -> tuple[int, int, int, float]:
        return *counts(x, y), P.offset_identity(x, y) if min(len(x), len(y)) < 200 else -1.0

    _, pairs = related(spark, sf_dir, f"{SHARED}, best double", of)
    near = F.when(F.col("common_k") == 0, 0.0).otherwise(K.mash_identity(likeness(), 8))
    return pairs.select("a", "b", F.round(F.when(F.col("best") >= 0, F.col("best")).otherwise(near), 6).alias("identity"))


@QUERIES.add("c9_kmer_cosine", f"""WITH {PAIRS}, km AS (SELECT id, w, CAST(count(*) AS DOUBLE) AS n FROM (SELECT id, substr(seq, i, 5) AS w FROM (SELECT id, seq, unnest(range(1, length(seq) - 3)) AS i FROM rep WHERE length(seq) >= 5) x) y GROUP BY id, w),
nm AS (SELECT id, sqrt(sum(n * n)) AS norm FROM km GROUP BY id), d AS (SELECT nb.a, nb.b, sum(x.n * y.n) AS dot FROM nb JOIN km x ON x.id = nb.a JOIN km y ON y.id = nb.b AND y.w = x.w GROUP BY nb.a, nb.b)
SELECT nb.a, nb.b, round(1 - coalesce(dot, 0) / (p.norm * q.norm), 6) AS distance FROM nb JOIN nm p ON p.id = nb.a JOIN nm q ON q.id = nb.b LEFT JOIN d USING (a, b)""")
def c9(spark: SparkSession, sf_dir: str) -> DataFrame:

    def of(x: str, y: str) -> tuple[float]:
        a, b = (np.bincount(code[good], minlength=4**5).astype(float) for code, good in (P.words(P.codes(t), 5) for t in (x, y)))
        return (float(1 - a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))),)

    _, pairs = related(spark, sf_dir, "distance double", of)
    return pairs.select("a", "b", F.round("distance", 6).alias("distance"))


@QUERIES.add("d11_kmer_features", f"""WITH {V.SEQS}, km AS (SELECT substr(seq, i, k) AS w FROM (SELECT seq, k, unnest(range(1, length(seq) - k + 2)) AS i FROM seqs, (SELECT unnest([2, 3, 4]) AS k) ks WHERE length(seq) >= k) x) SELECT w AS kmer, count(*) AS n FROM km GROUP BY w""")
def d11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.kmer_totals(V.seqs(spark, sf_dir), "seq", (2, 3, 4))


@QUERIES.add("g1_exact_identity_dedup", f"""WITH {V.SEQS}, k AS (SELECT id, md5(least(seq, reverse(translate(seq, 'ACGT', 'TGCA')))) AS key FROM seqs) SELECT id, min(id) OVER (PARTITION BY key) AS representative, count(*) OVER (PARTITION BY key) AS members FROM k""")
def g1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.exact_representatives(V.seqs(spark, sf_dir))


@QUERIES.add("g3_library_union", f"""WITH {V.RECORDS}, u AS (SELECT id, 0 AS priority, copies FROM records WHERE id % 2 = 0 UNION ALL SELECT id, 1, copies + 1 FROM records WHERE id % 3 = 0 UNION ALL SELECT id, 2, copies + 2 FROM records WHERE id % 5 = 0) SELECT id, priority AS source, copies FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY priority) AS r FROM u) x WHERE r = 1""")
def g3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.records(spark, sf_dir)
    part = lambda m, p: rows.filter(F.col("id") % m == 0).select("id", F.lit(p).alias("source"), (F.col("copies") + p).alias("copies"))
    return part(2, 0).unionByName(part(3, 1)).unionByName(part(5, 2)).groupBy("id").agg(F.min("source").alias("source"), F.min_by("copies", "source").alias("copies"))


@QUERIES.add("g4_survivor_intersect", f"""WITH {V.RECORDS}, kept AS (SELECT id FROM records WHERE copies >= 30 UNION SELECT id FROM records WHERE length >= 2500) SELECT id FROM kept INTERSECT SELECT id FROM records WHERE mdl >= 700""")
def g4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.records(spark, sf_dir)
    kept = rows.filter("copies >= 30").select("id").union(rows.filter("length >= 2500").select("id"))
    return kept.intersect(rows.filter("mdl >= 700").select("id"))


@QUERIES.add("g5_unconsumed_members", f"""WITH {V.INSTANCES}, st AS (SELECT DISTINCT fam FROM instances WHERE dvg >= 0.1 AND strand = '+') SELECT 'st_' || fam AS id FROM st UNION ALL SELECT 'fam_' || p_partkey FROM part WHERE p_partkey NOT IN (SELECT fam FROM st)""")
def g5(spark: SparkSession, sf_dir: str) -> DataFrame:
    consumed = V.instances(spark, sf_dir).filter("dvg >= 0.1 and strand = '+'").select("fam").distinct()
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("fam"))
    return consumed.select(F.format_string("st_%d", "fam").alias("id")).unionByName(parts.join(consumed, "fam", "left_anti").select(F.format_string("fam_%d", "fam").alias("id")))


@QUERIES.add("g6_conservation_audit", f"""WITH {V.RECORDS} SELECT count(*) AS n_in, CAST(count_if(copies >= 30) AS BIGINT) AS n_out, CAST(count_if(copies < 30) AS BIGINT) AS n_pruned, count_if(copies >= 30) + count_if(copies < 30) = count(*) AS conserved FROM records""")
def g6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, pruned = F.count_if(F.col("copies") >= 30), F.count_if(F.col("copies") < 30)
    return V.records(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_in"), out.alias("n_out"), pruned.alias("n_pruned"), (out + pruned == F.count(F.lit(1))).alias("conserved"))


@QUERIES.add("c1_instance_routing", f"""WITH {V.INSTANCES}, own AS (SELECT m AS fam, max(id) AS owner FROM (SELECT p_partkey AS id, unnest([p_partkey, p_partkey * 2 % 2500]) AS m FROM part WHERE p_partkey % 3 > 0) x GROUP BY m) SELECT coalesce(owner, -1) AS owner, count(*) AS n, CAST(sum(e - s) AS BIGINT) AS bases FROM instances LEFT JOIN own USING (fam) GROUP BY 1""")
def c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "part").filter("p_partkey % 3 > 0").select(F.col("p_partkey").alias("id"), F.explode(F.array("p_partkey", F.col("p_partkey") * 2 % 2500)).alias("fam"))
    owners = members.groupBy("fam").agg(F.max("id").alias("owner"))
    rows = V.instances(spark, sf_dir).join(owners, "fam", "left").withColumn("owner", F.coalesce("owner", F.lit(-1)))
    return rows.groupBy("owner").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") - F.col("s")).alias("bases"))


@QUERIES.add("c6_best_pair_distance", f"""WITH {V.HITS} SELECT q, subject, round(1 - max(CASE WHEN CAST(qend - qstart + 1 AS DOUBLE) / 100 >= 0.4 THEN pident ELSE 0 END) / 100, 6) AS distance FROM hits GROUP BY q, subject""")
def c6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best identity of each query and subject that have hits; short hits leave a pair at distance 1, as no hit would."""
    near = F.when((F.col("qend") - F.col("qstart") + 1) / 100 >= 0.4, F.col("pident")).otherwise(0.0)
    return V.hits(spark, sf_dir).groupBy("q", "subject").agg(F.round(1 - F.max(near) / 100, 6).alias("distance"))


@QUERIES.add("c11_similarity_graph", """WITH w AS (SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, (1 - CAST(l_discount AS DOUBLE)) * CAST(l_quantity AS DOUBLE) / 50 AS weight FROM lineitem WHERE l_partkey <> l_suppkey) SELECT a, b, round(max(weight), 6) AS weight FROM w GROUP BY a, b""")
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = (1 - F.col("l_discount").cast("double")) * F.col("l_quantity").cast("double") / 50
    rows = table(spark, sf_dir, "lineitem").filter("l_partkey <> l_suppkey").select(F.least("l_partkey", "l_suppkey").alias("a"), F.greatest("l_partkey", "l_suppkey").alias("b"), weight.alias("weight"))
    return rows.groupBy("a", "b").agg(F.round(F.max("weight"), 6).alias("weight"))


@QUERIES.add("c12_classification_merge", """WITH a AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'Unknown' ELSE 'LTR/' || p_brand END AS l FROM part), b AS (SELECT p_partkey AS id, 'I/' || p_type AS l FROM part WHERE p_size % 2 = 0)
SELECT a.id, regexp_replace(regexp_replace('TE#' || coalesce(CASE WHEN a.l <> 'Unknown' THEN a.l END, b.l, 'Unknown'), '#I/', '#LINE/'), '#LTR/Brand#1', '#LTR/Gypsy') AS name FROM a LEFT JOIN b ON a.id = b.id""")
def c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    first = parts.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 3 == 0, "Unknown").otherwise(F.concat(F.lit("LTR/"), "p_brand")).alias("one"))
    second = parts.filter("p_size % 2 = 0").select(F.col("p_partkey").alias("id"), F.concat(F.lit("I/"), "p_type").alias("two"))
    label = F.coalesce(F.when(F.col("one") != "Unknown", F.col("one")), F.col("two"), F.lit("Unknown"))
    name = F.regexp_replace(F.regexp_replace(F.concat(F.lit("TE#"), label), "#I/", "#LINE/"), "#LTR/Brand#1", "#LTR/Gypsy")
    return first.join(second, "id", "left").select("id", name.alias("name"))


@QUERIES.add("c13_recall_dedup", f"""WITH {V.INSTANCES}, bed AS (SELECT DISTINCT o, ln FROM instances WHERE strand = '+'), rec AS (SELECT DISTINCT o, ln FROM instances WHERE dvg >= 0.05) SELECT o, ln, 'bed' AS source FROM bed UNION ALL SELECT o, ln, 'recall' FROM rec WHERE NOT EXISTS (SELECT 1 FROM bed WHERE bed.o = rec.o AND bed.ln = rec.ln)""")
def c13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.instances(spark, sf_dir)
    bed, recalled = rows.filter("strand = '+'").select("o", "ln").distinct(), rows.filter("dvg >= 0.05").select("o", "ln").distinct()
    return bed.withColumn("source", F.lit("bed")).unionByName(recalled.join(bed, ["o", "ln"], "left_anti").withColumn("source", F.lit("recall")))


TREE = "tree AS (SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier)"
UP = "up(id, ancestor, depth) AS (SELECT id, id, 0 FROM tree UNION ALL SELECT up.id, t.parent, up.depth + 1 FROM up JOIN tree t ON t.id = up.ancestor WHERE t.parent IS NOT NULL)"


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, parent): regions over nations over suppliers."""
    node = lambda name, letter, key, above, parent: table(spark, sf_dir, name).select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("id"), (F.concat(F.lit(above), F.col(parent).cast("string")) if above else F.lit(None).cast("string")).alias("parent"))
    return node("region", "r", "r_regionkey", "", "").unionByName(node("nation", "n", "n_nationkey", "r", "n_regionkey")).unionByName(node("supplier", "s", "s_suppkey", "n", "s_nationkey"))


@QUERIES.add("c14_lineage_closure", f"WITH RECURSIVE {TREE}, {UP} SELECT id, ancestor, CAST(depth AS BIGINT) AS depth FROM up")
def c14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GR.closure(spark, taxonomy(spark, sf_dir)).withColumn("depth", F.col("depth").cast("long"))


@QUERIES.add("d14_lineage_totals", f"""WITH RECURSIVE {TREE}, {UP}, f AS (SELECT DISTINCT l_partkey AS fam, 's' || l_suppkey AS node FROM lineitem) SELECT ancestor AS id, count(DISTINCT fam) AS families FROM up JOIN f ON f.node = up.id GROUP BY ancestor""")
def d14(spark: SparkSession, sf_dir: str) -> DataFrame:
    families = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("fam"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("id")).distinct()
    up = GR.closure(spark, taxonomy(spark, sf_dir))
    return up.join(families, "id").groupBy(F.col("ancestor").alias("id")).agg(F.count_distinct("fam").alias("families"))


@QUERIES.add("c15_species_resolution", """WITH n AS (SELECT n_nationkey AS id, lower(n_name) AS name FROM nation), t AS (SELECT DISTINCT lower(substr(n_name, 1, 4)) AS term FROM nation UNION SELECT lower(n_name) FROM nation), m AS (SELECT term, count_if(name = term) AS exact, min(CASE WHEN name = term THEN id END) AS e, count_if(contains(name, term)) AS part, min(CASE WHEN contains(name, term) THEN id END) AS p FROM t, n GROUP BY term)
SELECT term, CASE WHEN exact = 1 THEN e WHEN exact = 0 AND part = 1 THEN p END AS id FROM m""")
def c15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact names before substrings; a term that stays ambiguous has no id. Terms have three letters or more."""
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("name"))
    terms = names.select(F.substring("name", 1, 4).alias("term")).union(names.select("name")).distinct()
    # a name holds a term only if it holds the term's first three letters: an equal-key join, then the whole term
    pieces = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))
    rows = terms.withColumn("piece", F.substring("term", 1, 3)).join(names.withColumn("piece", F.explode(pieces(F.col("name")))), "piece").filter(F.contains("name", "term"))
    same = F.col("name") == F.col("term")
    found = rows.groupBy("term").agg(F.count_if(same).alias("exact"), F.min(F.when(same, F.col("id"))).alias("e"), F.count(F.lit(1)).alias("part"), F.min("id").alias("p"))
    return found.select("term", F.when(F.col("exact") == 1, F.col("e")).when((F.col("exact") == 0) & (F.col("part") == 1), F.col("p")).alias("id"))


@QUERIES.add("b25_family_filters", f"""WITH RECURSIVE {TREE}, {UP}, f AS (SELECT p_partkey AS fam, lower(p_name) AS name, p_type FROM part WHERE p_type LIKE 'L%' OR p_type LIKE 'S%' OR p_type LIKE 'P%'), s AS (SELECT DISTINCT l_partkey AS fam, 's' || l_suppkey AS node FROM lineitem WHERE l_returnflag = 'A') SELECT DISTINCT f.fam FROM f JOIN s ON s.fam = f.fam JOIN up ON up.id = s.node WHERE up.ancestor = 'r1' AND f.fam % 7 > 0""")
def b25(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.col("p_type")
    families = table(spark, sf_dir, "part").filter(kinds.startswith("L") | kinds.startswith("S") | kinds.startswith("P")).select(F.col("p_partkey").alias("fam")).filter("fam % 7 > 0")
    staged = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_partkey").alias("fam"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("id"))
    below = GR.closure(spark, taxonomy(spark, sf_dir)).filter("ancestor = 'r1'").select("id")
    return families.join(staged.join(below, "id", "left_semi"), "fam", "left_semi")


@QUERIES.add("b18_gene_exclusion", f"""WITH {V.HITS}, c AS (SELECT q, max(CAST(qend - qstart + 1 AS DOUBLE) * 3 / (250 + q % 300)) AS cov FROM hits WHERE pident - 57 >= 35 GROUP BY q) SELECT p_partkey AS id, round(coalesce(cov, 0), 6) AS cov, coalesce(cov, 0) >= 0.7 OR (coalesce(cov, 0) >= 0.5 AND p_size % 4 = 0) AS excluded FROM part LEFT JOIN c ON q = p_partkey""")
def b18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits against proteins: their identities are 57 less than those of the line items."""
    hits = V.hits(spark, sf_dir).select("q", (F.col("qend") - F.col("qstart") + 1).alias("width"), (250 + F.col("q") % 300).alias("qlen"), (F.col("pident") - 57).alias("pident"))
    records = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 4 > 0).alias("has_signal"))
    return G.gene_excluded(hits, records).select("id", F.round("cov", 6).alias("cov"), "excluded")


@QUERIES.add("b19_non_te_routing", f"""WITH {V.HITS}, o AS (SELECT q, CAST(sum(qend - qstart + 1) AS DOUBLE) / 800 AS cov FROM hits WHERE subject = 'chr1' AND pident - 13 >= 80 GROUP BY q), r AS (SELECT DISTINCT q FROM hits WHERE score > 100000), t AS (SELECT q, CAST(sum(qend - qstart + 1) AS DOUBLE) / 900 AS cov FROM hits WHERE subject = 'chr2' GROUP BY q) SELECT p_partkey AS id, CASE WHEN o.cov >= 0.5 THEN 'organelle' WHEN r.q IS NOT NULL THEN 'rrna' WHEN t.cov >= 0.5 THEN 'satellite' ELSE 'te' END AS route FROM part LEFT JOIN o ON o.q = p_partkey LEFT JOIN r ON r.q = p_partkey LEFT JOIN t ON t.q = p_partkey""")
def b19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits on one chromosome stand for those on organelles, on another for tandem spans, strong ones anywhere for rRNA."""
    hits = V.hits(spark, sf_dir)
    width = F.col("qend") - F.col("qstart") + 1
    organelle = hits.filter("subject = 'chr1'").select("q", width.alias("width"), F.lit(800).alias("qlen"), (F.col("pident") - 13).alias("pident"))
    tandem = hits.filter("subject = 'chr2'").select("q", F.col("qstart").alias("s"), F.col("qend").alias("e"))
    records = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit(900).alias("length"))
    return G.foreign_routes(records, organelle, hits.filter("score > 100000"), tandem).select("id", "route")


@QUERIES.add("b20_evidence_rescue", f"""WITH {V.RECORDS}, d AS (SELECT * FROM records WHERE copies < 32), e AS (SELECT id, concat_ws(',', CASE WHEN id % 5 = 0 THEN 'hmm' END, CASE WHEN id % 7 = 0 THEN 'tir' END, CASE WHEN id % 11 = 0 THEN 'ltr' END, CASE WHEN id % 13 = 0 THEN 'known' END) AS by_what FROM d) SELECT id, CAST(NULL AS VARCHAR) AS rescued_by FROM records WHERE copies >= 32 UNION ALL SELECT id, by_what FROM e WHERE by_what <> ''""")
def b20(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.records(spark, sf_dir)
    evidence = F.concat_ws(",", *(F.when(F.col("id") % m == 0, name) for m, name in ((5, "hmm"), (7, "tir"), (11, "ltr"), (13, "known"))))
    rescued = rows.filter("copies < 32").select("id", evidence.alias("rescued_by")).filter("rescued_by <> ''")
    return rows.filter("copies >= 32").select("id", F.lit(None).cast("string").alias("rescued_by")).unionByName(rescued)


@QUERIES.add("d6_rm_rollup", f"""WITH {V.HITS}, g AS (SELECT q, count(*) AS n, avg(pident) AS identity, stddev_pop(pident) AS std, max(pident) - min(pident) AS spread, stddev_pop(gmax - gmin + 61) / avg(gmax - gmin + 61) AS cv FROM hits GROUP BY q) SELECT q, n, round(identity, 6) AS identity, round(std, 6) AS std, round(spread, 6) AS spread, round(cv, 6) AS cv, n >= 5 AND (spread > 20 OR cv > 0.3 OR (n > 20 AND std > 5)) AS split FROM g""")
def d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = F.col("gmax") - F.col("gmin") + 61
    rows = V.hits(spark, sf_dir).groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.avg("pident").alias("identity"), F.stddev_pop("pident").alias("std"), (F.max("pident") - F.min("pident")).alias("spread"), (F.stddev_pop(width) / F.avg(width)).alias("cv"))
    split = G.splits(F.col("n"), F.col("spread"), F.col("cv"), F.col("std"))
    return rows.select("q", "n", *(F.round(c, 6).alias(c) for c in ("identity", "std", "spread", "cv")), split.alias("split"))


@QUERIES.add("d10_hierarchical_scores", """WITH x AS (SELECT p_size AS s, len(list_intersect(list_distinct(string_split(p_name, ' ')), list_distinct(string_split(p_type || ' ' || lower(p_type), ' ')))) AS both_n, len(list_distinct(string_split(p_type || ' ' || lower(p_type), ' '))) AS p, len(list_distinct(string_split(p_name, ' '))) AS t FROM part) SELECT s AS level, CAST(sum(both_n) AS BIGINT) AS hits, round(CAST(sum(both_n) AS DOUBLE) / sum(p), 6) AS precision_h, round(CAST(sum(both_n) AS DOUBLE) / sum(t), 6) AS recall_h FROM x GROUP BY s""")
def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of common labels, over all rows of a level: of the predicted path, and of the true one."""
    true, predicted = F.array_distinct(F.split("p_name", " ")), F.array_distinct(F.split(F.concat_ws(" ", "p_type", F.lower("p_type")), " "))
    rows = table(spark, sf_dir, "part").select(F.col("p_size").alias("level"), F.size(F.array_intersect(true, predicted)).alias("b"), F.size(predicted).alias("p"), F.size(true).alias("t"))
    return rows.groupBy("level").agg(F.sum("b").alias("hits"), F.round(F.sum("b") / F.sum("p"), 6).alias("precision_h"), F.round(F.sum("b") / F.sum("t"), 6).alias("recall_h"))


@QUERIES.add("d13_cluster_sizes", "WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) SELECT count(*) AS clusters, CAST(sum(n) AS BIGINT) AS total, max(n) AS most, min(n) AS least, round(avg(n), 6) AS mean, CAST(count_if(n = 1) AS BIGINT) AS singletons FROM c")
def d13(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("total"), F.max("n").alias("most"), F.min("n").alias("least"), F.round(F.avg("n"), 6).alias("mean"), F.count_if(F.col("n") == 1).alias("singletons"))


@QUERIES.add("d12_set_diversity", f"""WITH {PAIRS}, km AS (SELECT DISTINCT id, substr(seq, i, 7) AS w FROM (SELECT id, seq, unnest(range(1, length(seq) - 5)) AS i FROM rep WHERE length(seq) >= 7) x), n AS (SELECT id, count(*) AS n FROM km GROUP BY id),
c AS (SELECT nb.a, nb.b, count(*) AS common FROM nb JOIN km x ON x.id = nb.a JOIN km y ON y.id = nb.b AND y.w = x.w GROUP BY nb.a, nb.b), j AS (SELECT coalesce(CAST(common AS DOUBLE) / (p.n + q.n - common), 0) AS j FROM nb LEFT JOIN c USING (a, b) LEFT JOIN n p ON p.id = nb.a LEFT JOIN n q ON q.id = nb.b), l AS (SELECT stddev_pop(length(seq)) / avg(length(seq)) AS cv FROM rep)
SELECT round(avg(j), 6) AS mean, round(stddev_pop(j), 6) AS std, round(1 - avg(j) + stddev_pop(j), 6) AS diversity, (SELECT round(cv, 6) FROM l) AS length_cv FROM j""")
def d12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likeness over all related pairs, and how much lengths vary over all classes."""
    classes, pairs = related(spark, sf_dir, SHARED, shared(7))
    j = pairs.select(F.when(F.col("common_k") > 0, likeness()).otherwise(F.lit(0.0)).alias("j"))
    cv = classes.agg(F.round(F.stddev_pop(F.length("seq")) / F.avg(F.length("seq")), 6).alias("length_cv"))
    return j.agg(F.round(F.avg("j"), 6).alias("mean"), F.round(F.stddev_pop("j"), 6).alias("std"), F.round(1 - F.avg("j") + F.stddev_pop("j"), 6).alias("diversity")).join(F.broadcast(cv))


@QUERIES.add("f2_stratified_subsample", f"""WITH {V.INSTANCES}, n AS (SELECT *, count(*) OVER (PARTITION BY fam) AS n, row_number() OVER (PARTITION BY fam ORDER BY dvg, o, ln, s, chrom) - 1 AS k FROM instances), t AS (SELECT *, CASE WHEN n <= 20 THEN 1 ELSE least(10, greatest(1, n // 20 + 1)) END AS g FROM n), u AS (SELECT *, CASE WHEN k < (n % g) * (n // g + 1) THEN k // (n // g + 1) ELSE n % g + (k - (n % g) * (n // g + 1)) // (n // g) END + 1 AS stratum FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY fam, stratum ORDER BY e - s DESC, o, ln, s, chrom) AS rn FROM u), p AS (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY rn, stratum) AS place FROM r) SELECT fam, o, ln, CAST(stratum AS BIGINT) AS stratum, place FROM p WHERE place <= 20""")
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.instances(spark, sf_dir).withColumn("size", F.col("e") - F.col("s"))
    return G.stratified(rows, "fam", 20, "dvg", "size", ["o", "ln", "s", "chrom"]).select("fam", "o", "ln", "stratum", "place")


@QUERIES.add("f3_even_stride_cap", f"""WITH {V.INSTANCES}, u AS (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY e - s, dvg, o, ln, s, chrom) - 1 AS place, count(*) OVER (PARTITION BY fam) AS n0 FROM instances), v AS (SELECT *, max(CASE WHEN place = least(n0 - 1, CAST(floor(n0 * 0.9) AS BIGINT)) THEN e - s END) OVER (PARTITION BY fam) AS usual FROM u), x AS (SELECT *, n0 <= 2 OR e - s <= 1.05 * usual AS fits FROM v), y AS (SELECT *, count_if(fits) OVER (PARTITION BY fam) AS room FROM x), z AS (SELECT * FROM y WHERE fits OR room < 2),
r AS (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY dvg, o, ln, s, chrom) - 1 AS k, count(*) OVER (PARTITION BY fam) AS n FROM z) SELECT fam, o, ln, k FROM r WHERE n <= 15 OR (CAST(ceil(k * 15.0 / n) AS BIGINT) * n) // 15 = k AND CAST(ceil(k * 15.0 / n) AS BIGINT) < 15""")
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items differ little in length and a part has few: so 15 of each, and none much longer than nine tenths of them."""
    rows = V.instances(spark, sf_dir).withColumn("size", F.col("e") - F.col("s"))
    return G.even_stride(rows, "fam", ["dvg", "o", "ln", "s", "chrom"], "size", cap=15, most_times=1.05).select("fam", "o", "ln", "k")


@QUERIES.add("f5_shard_striping", f"""WITH {V.RECORDS} SELECT id, (row_number() OVER (ORDER BY length * copies DESC, id) - 1) % 16 AS shard FROM records""")
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work in descending order, dealt in turn to 16 shards."""
    rows = V.records(spark, sf_dir).select("id", (F.col("length") * F.col("copies")).alias("work"))
    return G.placed(rows, [F.desc("work"), F.asc("id")]).select("id", ((F.col("place") - 1) % 16).alias("shard"))


@QUERIES.add("f6_longest_pick", f"""WITH {V.SEQS}, d AS (SELECT id, seq, lang FROM seqs JOIN documents ON doc_id = id) SELECT lang, id, len FROM (SELECT lang, id, length(seq) AS len, row_number() OVER (PARTITION BY lang ORDER BY length(seq) DESC, id) AS r FROM d) x WHERE r = 1""")
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    rows = V.seqs(spark, sf_dir).select("id", F.length("seq").cast("long").alias("len")).join(langs, "id")
    best = rows.groupBy("lang").agg(F.max(F.struct("len", (-F.col("id")).alias("neg"))).alias("m"))
    return best.select("lang", (-F.col("m.neg")).alias("id"), F.col("m.len").alias("len"))


EDGES = "dir AS (SELECT CASE WHEN l_linestatus = 'O' THEN l_partkey ELSE l_suppkey + 1000000000 END AS u, CASE WHEN l_linestatus = 'O' THEN l_suppkey + 1000000000 ELSE l_partkey END AS v, count(*) AS n FROM lineitem GROUP BY 1, 2), sz AS (SELECT id, sum(n) AS size FROM (SELECT u AS id, n FROM dir UNION ALL SELECT v, n FROM dir) x GROUP BY id), ed AS (SELECT least(u, v) AS a, greatest(u, v) AS b, sum(CASE WHEN u < v THEN n ELSE 0 END) AS fwd, sum(CASE WHEN u > v THEN n ELSE 0 END) AS rev FROM dir GROUP BY 1, 2), gt AS (SELECT a, b, CAST(fwd AS BIGINT) AS fwd, CAST(rev AS BIGINT) AS rev, CAST(fwd + rev AS DOUBLE) / least(p.size, q.size) AS ratio, fwd >= rev AS forward FROM ed JOIN sz p ON p.id = a JOIN sz q ON q.id = b WHERE fwd + rev >= 2 AND CAST(fwd + rev AS DOUBLE) / least(p.size, q.size) >= 0.01 AND CAST(greatest(fwd, rev) AS DOUBLE) / (fwd + rev) >= 0.6 AND CAST(least(p.size, q.size) AS DOUBLE) / greatest(p.size, q.size) >= 0.02)"


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers as families, a line item as a neighbourhood, its status as the strand."""
    part, supplier, open_ = F.col("l_partkey"), F.col("l_suppkey") + 1_000_000_000, F.col("l_linestatus") == "O"
    directed = table(spark, sf_dir, "lineitem").groupBy(F.when(open_, part).otherwise(supplier).alias("u"), F.when(open_, supplier).otherwise(part).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    sizes = directed.select(F.col("u").alias("id"), "n").union(directed.select("v", "n")).groupBy("id").agg(F.sum("n").alias("size"))
    return GR.gated_edges(directed, sizes, 2, 0.01, 0.6, 0.02)


@QUERIES.add("h2_edge_gates", f"WITH {EDGES} SELECT a, b, fwd, rev, round(ratio, 6) AS ratio, forward FROM gt")
def h2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir).select("a", "b", "fwd", "rev", F.round("ratio", 6).alias("ratio"), "forward")


@QUERIES.add("h5_components", f"""WITH RECURSIVE e AS (SELECT l_orderkey AS a, 1000000000 + (l_partkey * 50 + CAST(floor(l_quantity) AS BIGINT)) * 11 + CAST(round(l_discount * 100) AS BIGINT) AS b FROM lineitem), bi AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(id, r) AS (SELECT DISTINCT a, a FROM bi UNION SELECT bi.b, reach.r FROM reach JOIN bi ON bi.a = reach.id) SELECT id, min(r) AS component FROM reach GROUP BY id""")
def h5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, and the kinds of line items (part, quantity, discount) that they have."""
    kind = 1_000_000_000 + (F.col("l_partkey") * 50 + F.floor("l_quantity").cast("long")) * 11 + F.round(F.col("l_discount") * 100).cast("long")
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"), kind.alias("b"))
    nodes = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    return GR.components(pairs, nodes)


@QUERIES.add("h4_scaffold_assembly", f"""WITH {V.SEQS}, d AS (SELECT id, seq, id // 40 AS scaffold, n_chars FROM seqs JOIN documents ON doc_id = id) SELECT scaffold, md5(string_agg(seq, 'NNNNNNNNNN' ORDER BY id)) AS joined, CAST(sum(length(seq)) + 10 * (count(*) - 1) AS BIGINT) AS len, min(n_chars) AS least FROM d GROUP BY scaffold""")
def h4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a scaffold, up to 40, joined in order by ten unknown bases."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / 40).alias("scaffold"), "n_chars")
    rows = V.seqs(spark, sf_dir).join(docs, "id")
    parts = F.array_sort(F.collect_list(F.struct("id", "seq")))
    joined = rows.groupBy("scaffold").agg(F.array_join(F.transform(parts, lambda x: x["seq"]), "NNNNNNNNNN").alias("joined"), F.min("n_chars").alias("least"))
    return joined.select("scaffold", F.md5(F.col("joined").cast("binary")).alias("joined"), F.length("joined").cast("long").alias("len"), "least")


@QUERIES.add("h10_path_runs", """WITH RECURSIVE s AS (SELECT o_custkey AS path, o_orderstatus = 'F' AS ref, CAST(floor(o_totalprice / 1000) AS BIGINT) AS seg, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, count(*) OVER (PARTITION BY o_custkey) AS steps FROM orders),
st AS (SELECT DISTINCT path, steps, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS run, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS len, CAST(0 AS BIGINT) AS done_n, CAST(0 AS BIGINT) AS done_len FROM s
UNION ALL SELECT st.path, st.steps, s.rn, CASE WHEN ref OR len + seg > 600 THEN run + 1 ELSE run END, CASE WHEN ref OR len + seg > 600 THEN 0 ELSE n + 1 END, CASE WHEN ref OR len + seg > 600 THEN 0 ELSE len + seg END, CASE WHEN ref THEN n ELSE 0 END, CASE WHEN ref THEN len ELSE 0 END FROM st JOIN s ON s.path = st.path AND s.rn = st.rn + 1)
SELECT path, run - 1 AS run, done_n AS n, done_len AS len FROM st WHERE done_n > 0 AND done_len >= 100 UNION ALL SELECT path, run, n, len FROM st WHERE rn = steps AND n > 0 AND len >= 100""")
def h10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as a path; a run that would pass 600 starts anew, as one of 30000 would in a genome."""
    steps = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("place"), (F.col("o_orderstatus") == "F").alias("breaks"), F.floor(F.col("o_totalprice") / 1000).cast("long").alias("length"))
    return GR.bounded_runs(steps, 100, 600).withColumnRenamed("length", "len")


@QUERIES.add("h11_reference_reconstruction", f"""WITH {V.SEQS}, d AS (SELECT 'GRCh#0#' || lang || (id // 50) AS sn, id, seq FROM seqs JOIN documents ON doc_id = id) SELECT string_split(sn, '#')[-1] AS chrom, md5(string_agg(seq, '' ORDER BY id)) AS seq, CAST(sum(length(seq)) AS BIGINT) AS len FROM d GROUP BY sn""")
def h11(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("GRCh#0#"), "lang", F.floor(F.col("doc_id") / 50).cast("string")).alias("sn"))
    """Segments of one sequence name in the order of their offsets; a name has up to 50."""
    rows = V.seqs(spark, sf_dir).join(langs, "id")
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "seq"))), lambda x: x["seq"]), "").alias("whole")
    return rows.groupBy("sn").agg(ordered).select(F.element_at(F.split("sn", "#"), -1).alias("chrom"), F.md5(F.col("whole").cast("binary")).alias("seq"), F.length("whole").cast("long").alias("len"))


@QUERIES.add("h12_path_descent", """WITH l AS (SELECT p_size % 5 AS a, p_size AS b, p_brand AS c, CAST(p_retailprice AS DOUBLE) / 3000 AS p, p_partkey AS id FROM part), n1 AS (SELECT a, avg(p) AS s1 FROM l GROUP BY a), n2 AS (SELECT a, b, avg(p) AS s2 FROM l GROUP BY a, b), n3 AS (SELECT a, b, c, avg(p) AS s3 FROM l GROUP BY a, b, c),
s AS (SELECT n3.a, n3.b, n3.c, (s1 + s2 + s3) / 3 AS score FROM n3 JOIN n2 ON n2.a = n3.a AND n2.b = n3.b JOIN n1 ON n1.a = n3.a) SELECT a, b || '.' || c AS path, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(score, 9) DESC, b, c) AS r FROM s) x WHERE r = 1""")
def h12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The branch with the highest mean probability of its nodes, under each root."""
    leaves = table(spark, sf_dir, "part").select((F.col("p_size") % 5).alias("a"), F.col("p_size").alias("b"), F.col("p_brand").alias("c"), (F.col("p_retailprice").cast("double") / 3000).alias("p"))
    level = lambda n: leaves.groupBy(*"abc"[:n]).agg(F.avg("p").alias(f"s{n}"))
    paths = level(3).join(level(2), ["a", "b"]).join(level(1), "a").withColumn("score", (F.col("s1") + F.col("s2") + F.col("s3")) / 3)
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc(F.round("score", 9)), "b", "c"))
    return paths.withColumn("rank", rank).filter("rank = 1").select("a", F.concat_ws(".", "b", "c").alias("path"), F.round("score", 6).alias("score"))


@QUERIES.add("h13_hierarchy_relabel", """WITH c AS (SELECT DISTINCT p_size || '.' || (p_partkey % 3) || '.' || (p_partkey % 2) AS code FROM part) SELECT code, CASE WHEN code LIKE '1%' THEN string_split(code, '.')[1] || '.' || string_split(code, '.')[2] ELSE '#' || string_split(code, '.')[1] END AS label, CAST(len(string_split(code, '.')) AS BIGINT) AS depth FROM c""")
def h13(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat_ws(".", F.col("p_size"), F.col("p_partkey") % 3, F.col("p_partkey") % 2)
    parts = F.split("code", "\\.")
    label = F.when(F.col("code").startswith("1"), F.array_join(F.slice(parts, 1, 2), ".")).otherwise(F.concat(F.lit("#"), parts[0]))
    return table(spark, sf_dir, "part").select(code.alias("code")).distinct().select("code", label.alias("label"), F.size(parts).cast("long").alias("depth"))
