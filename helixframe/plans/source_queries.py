"""Scans and sinks (operators A1-A30): tables written in each format by Spark, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import seq as S
from helixframe.operators.graph import scratch
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table
from helixframe.sources import text as T


def stored(df: DataFrame, column, name: str, codec: str = "none") -> str:
    path = scratch(df.sparkSession, name)
    T.write_lines(df, column, path, codec)
    return path


def tabbed(*columns) -> Column:
    return F.concat_ws("\t", *(F.lit(c) if isinstance(c, (str, int)) else c.cast("string") for c in columns))


@QUERIES.add("a1_fasta_scan", f"WITH {V.SEQS} SELECT 'doc' || id AS id, length(seq) AS len, md5(seq) AS seq FROM seqs")
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FASTA out, compressed, and back (A1, A3, A28)."""
    record = T.fasta_record(F.concat(F.lit("doc"), F.col("id").cast("string"), F.lit(" from documents")), F.col("seq"))
    path = stored(V.seqs(spark, sf_dir), record, "fasta", "gzip")
    return T.read_fasta(spark, path).select("id", F.length("seq").cast("long").alias("len"), F.md5(F.col("seq").cast("binary")).alias("seq"))


@QUERIES.add("a4_fai_genome_size", f"WITH {V.SEQS} SELECT count(*) AS contigs, CAST(sum(length(seq)) AS BIGINT) AS bases, max(length(seq)) AS longest FROM seqs")
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(V.seqs(spark, sf_dir), tabbed(F.col("id"), F.length("seq"), 0, 80, 81), "fai")
    return T.read_fai(spark, path).agg(F.count(F.lit(1)).alias("contigs"), F.sum("length").alias("bases"), F.max("length").alias("longest"))


PAF = "paf AS (SELECT 'asm' || (l_partkey % 40) AS qname, 'asm' || (l_suppkey % 40) AS tname, l_orderkey * 10 AS qstart, l_orderkey * 10 + CAST(floor(l_quantity) AS BIGINT) * 400 AS qend, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_linenumber * 9 AS mapq, CASE WHEN l_returnflag <> 'N' THEN 'P' END AS tp, CAST(floor(l_quantity) AS BIGINT) || 'M' || (l_linenumber * 30) || 'I' || CAST(floor(l_quantity) AS BIGINT) || 'M' || (l_linenumber * 20) || 'D9M' AS cigar, l_orderkey * 7 AS tstart FROM lineitem)"
PAF_KEPT = "kept AS (SELECT * FROM paf WHERE qname <> tname AND qend - qstart >= 5000 AND (tp IS NULL OR mapq >= 20))"


def paf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as PAF, and read back."""
    n, o, ln = F.floor("l_quantity").cast("long"), F.col("l_orderkey"), F.col("l_linenumber")
    cigar = F.concat(F.lit("cg:Z:"), n.cast("string"), F.lit("M"), (ln * 30).cast("string"), F.lit("I"), n.cast("string"), F.lit("M"), (ln * 20).cast("string"), F.lit("D9M"))
    line = F.concat_ws(
        "\t", F.concat(F.lit("asm"), (F.col("l_partkey") % 40).cast("string")), F.lit("900000000"), (o * 10).cast("string"), (o * 10 + n * 400).cast("string"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-"),
        F.concat(F.lit("asm"), (F.col("l_suppkey") % 40).cast("string")), F.lit("900000000"), (o * 7).cast("string"), (o * 7 + n * 400).cast("string"), (n * 390).cast("string"), (n * 400).cast("string"), (ln * 9).cast("string"),
        F.when(F.col("l_returnflag") != "N", "tp:A:P"), cigar,
    )
    return T.read_paf(spark, stored(table(spark, sf_dir, "lineitem"), line, "paf"))


@QUERIES.add("a5_paf_scan", f"WITH {V.INSTANCES}, {PAF}, {PAF_KEPT} SELECT qname, tname, strand, count(*) AS n, CAST(sum(qend - qstart) AS BIGINT) AS bases, CAST(count(tp) AS BIGINT) AS tagged, CAST(sum(length(cigar)) AS BIGINT) AS cigars FROM kept GROUP BY qname, tname, strand")
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.filtered_paf(paf(spark, sf_dir))
    return rows.groupBy("qname", "tname", "strand").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("qend") - F.col("qstart")).alias("bases"), F.count("tp").alias("tagged"), F.sum(F.length("cigar")).alias("cigars"))


@QUERIES.add("a6_chromosome_map", f"WITH {PAF}, {PAF_KEPT}, m AS (SELECT DISTINCT 'asm' || (p_partkey % 40) AS name, (p_partkey % 40) % 7 AS assembly, (p_partkey % 40) % 3 AS chr FROM part WHERE p_partkey % 40 < 30) SELECT qname, tname, count(*) AS n FROM kept LEFT JOIN m a ON a.name = qname LEFT JOIN m b ON b.name = tname WHERE NOT coalesce(a.assembly = b.assembly OR a.chr <> b.chr, false) GROUP BY qname, tname")
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 40
    mapping = table(spark, sf_dir, "part").filter(k < 30).select(F.concat(F.lit("asm"), k.cast("string")).alias("name"), (k % 7).alias("assembly"), (k % 3).alias("chr")).distinct()
    return T.mapped_pairs(T.filtered_paf(paf(spark, sf_dir)), mapping).groupBy("qname", "tname").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("i10_cigar_walk", f"WITH {PAF}, {PAF_KEPT}, x AS (SELECT qname, tname, CAST(regexp_extract(cigar, '^(\\d+)M', 1) AS BIGINT) AS m, CAST(regexp_extract(cigar, 'M(\\d+)I', 1) AS BIGINT) AS i, CAST(regexp_extract(cigar, '(\\d+)D', 1) AS BIGINT) AS d, qstart, tstart FROM kept), u AS (SELECT qname AS seq_name, 'query' AS side, qstart + m AS s, qstart + m + i AS e FROM x WHERE i BETWEEN 100 AND 30000 UNION ALL SELECT tname, 'target', tstart + 2 * m, tstart + 2 * m + d FROM x WHERE d BETWEEN 100 AND 30000) SELECT seq_name, side, s, e, count(*) AS n FROM u GROUP BY seq_name, side, s, e")
def i10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insertions of 100 to 30000 bases along the operations of each alignment's CIGAR."""
    lengths, kinds = F.regexp_extract_all("cigar", F.lit("(\\d+)[MIDNSHP=X]"), 1), F.regexp_extract_all("cigar", F.lit("\\d+([MIDNSHP=X])"), 1)
    ops = F.transform(F.arrays_zip(lengths.alias("n"), kinds.alias("op")), lambda x: F.struct(x["n"].cast("long").alias("n"), x["op"].alias("op")))
    start = F.struct(F.col("qstart").alias("q"), F.col("tstart").alias("t"), F.array().cast("array<struct<side:string,s:bigint,e:bigint>>").alias("found"))

    def step(at, x):
        n, op = x["n"], x["op"]
        large = n.between(100, 30000)
        side = lambda name, where: F.array(F.struct(F.lit(name).alias("side"), where.alias("s"), (where + n).alias("e")))
        found = F.when((op == "I") & large, F.concat(at["found"], side("query", at["q"]))).when((op == "D") & large, F.concat(at["found"], side("target", at["t"]))).otherwise(at["found"])
        q = at["q"] + F.when(op.isin("M", "=", "X", "I"), n).otherwise(F.lit(0))
        t = at["t"] + F.when(op.isin("M", "=", "X", "D", "N"), n).otherwise(F.lit(0))
        return F.struct(q.alias("q"), t.alias("t"), found.alias("found"))

    rows = T.filtered_paf(paf(spark, sf_dir)).filter(~F.col("cigar").rlike("[SH]"))
    rows = rows.select("qname", "tname", F.explode(F.aggregate(ops, start, step)["found"]).alias("x")).select(F.when(F.col("x.side") == "query", F.col("qname")).otherwise(F.col("tname")).alias("seq_name"), "x.*")
    return rows.groupBy("seq_name", "side", "s", "e").agg(F.count(F.lit(1)).alias("n"))


def graph(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a graph: a segment for each, links from each to the next of a customer, customers as paths."""
    orders = table(spark, sf_dir, "orders")
    rank = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    segment = F.concat_ws("\t", F.lit("S"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")), F.lit("*"), F.concat(F.lit("LN:i:"), F.floor(F.col("o_totalprice") / 1000).cast("string")), F.concat(F.lit("SN:Z:smp"), (F.col("o_custkey") % 9).cast("string"), F.lit("#chr1")), F.concat(F.lit("SO:i:"), F.col("o_orderkey").cast("string")), F.concat(F.lit("SR:i:"), rank.cast("string")))
    steps = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(F.lit("s"), k.cast("string"), F.when(k % 2 == 0, "+").otherwise("-"))), ",")
    paths = orders.groupBy("o_custkey").agg(steps.alias("steps"))
    path = F.concat_ws("\t", F.lit("P"), F.concat(F.lit("cust"), F.col("o_custkey").cast("string")), "steps", F.lit("*"))
    link = F.concat_ws("\t", F.lit("L"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")), F.lit("+"), F.concat(F.lit("s"), (F.col("o_custkey")).cast("string")), F.lit("-"), F.lit("0M"))
    out = scratch(spark, "gfa")
    orders.select(segment.alias("value")).union(orders.select(link)).union(paths.select(path)).write.text(out)
    return out


@QUERIES.add("a8_rgfa_scan", "SELECT 'smp' || (o_custkey % 9) AS sample, o_orderstatus = 'F' AS reference, count(*) AS segments, CAST(sum(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS BIGINT) AS bases, CAST(sum(o_orderkey) AS BIGINT) AS offsets FROM orders GROUP BY 1, 2")
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.read_segments(spark, graph(spark, sf_dir))
    return rows.groupBy(F.split("name", "#")[0].alias("sample"), (F.col("rank") == 0).alias("reference")).agg(F.count(F.lit(1)).alias("segments"), F.sum("length").alias("bases"), F.sum("offset").alias("offsets"))


@QUERIES.add("a8_link_degrees", "SELECT 's' || o_custkey AS segment, count(*) AS degree FROM orders GROUP BY 1")
def a8_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read_links(spark, graph(spark, sf_dir)).groupBy(F.col("b").alias("segment")).agg(F.count(F.lit(1)).alias("degree"))


@QUERIES.add("a9_path_scan", "SELECT 'cust' || o_custkey AS path, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place, 's' || o_orderkey AS segment, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders")
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read_paths(spark, graph(spark, sf_dir)).withColumn("place", F.col("place").cast("long"))


@QUERIES.add("a10_reference_path", "SELECT c_name AS path, CAST(CASE WHEN contains(c_name, '#000000077') THEN 1 ELSE 3 END AS INT) AS priority FROM customer ORDER BY priority, c_custkey LIMIT 1")
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.reference_path(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line"), F.col("c_name").alias("path")), "#000000077")


@QUERIES.add("a11_vcf_alleles", f"WITH {V.SEQS}, v AS (SELECT id, list_filter(string_split(substr(seq, 1, 61) || ',' || substr(seq, 62, 40) || ',' || substr(seq, 102), ','), lambda a: length(a) > 50) AS al FROM seqs WHERE length(seq) >= 120) SELECT 'chr' || (id % 5) AS chrom, len(al) AS n, count(*) AS alleles, CAST(sum(length(a)) AS BIGINT) AS bases FROM (SELECT id, al, unnest(al) AS a FROM v) x GROUP BY 1, 2")
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    alleles = F.concat_ws(",", F.substring("seq", 1, 61), F.substring("seq", 62, 40), F.expr("substring(seq, 102)"))
    rows = V.seqs(spark, sf_dir).filter(F.length("seq") >= 120)
    path = stored(rows, tabbed(F.concat(F.lit("chr"), (F.col("id") % 5).cast("string")), F.col("id"), ".", "A", alleles, "60"), "vcf")
    return T.read_vcf_alleles(spark, path).groupBy("chrom", F.col("n").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("alleles"), F.sum(F.length("allele")).alias("bases"))


@QUERIES.add("a13_mdl_header_scan", f"WITH {V.RECORDS} SELECT CASE WHEN id % 10 = 0 THEN 'odd' || id ELSE 'mdl_R' || id END AS id, CASE WHEN id % 10 = 0 THEN 0 ELSE id END AS r, CAST(CASE WHEN id % 10 = 0 THEN 0 ELSE length END AS BIGINT) AS length, CASE WHEN id % 10 = 0 THEN 1 ELSE copies END AS copies, CASE WHEN id % 10 = 0 THEN 1.0 ELSE round(mdl, 1) END AS mdl, CASE WHEN id % 10 > 0 AND id % 3 = 0 THEN 'cyclic' END AS topology FROM records")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    full = F.concat_ws(" ", F.concat(F.lit("R="), text("id")), F.concat(F.lit("length="), text("length")), F.concat(F.lit("copies="), text("copies")), F.concat(F.lit("mdl="), F.round("mdl", 1).cast("string")), F.when(F.col("id") % 3 == 0, "topo=cyclic"))
    header = F.when(F.col("id") % 10 == 0, F.concat(F.lit("odd"), text("id"))).otherwise(full)
    path = stored(V.records(spark, sf_dir), T.fasta_record(header, F.lit("ACGT")), "mdl")
    return T.read_fasta(spark, path).select(*T.mdl_header(F.col("header"))).select("id", "r", "length", "copies", "mdl", "topology")


@QUERIES.add("a14_bed_scan", f"WITH {V.INSTANCES} SELECT chrom, strand, count(*) AS n, CAST(sum(e - s) AS BIGINT) AS bases, round(avg(1 - (1000 - round(dvg * 1000)) / 1000), 6) AS divergence FROM instances GROUP BY chrom, strand")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (1000 - F.round(F.col("dvg") * 1000)).cast("int")
    path = stored(V.instances(spark, sf_dir), tabbed(F.col("chrom"), F.col("s"), F.col("e"), F.concat(F.lit("R="), F.col("fam").cast("string")), score, F.col("strand")), "bed")
    return T.read_bed(spark, path).groupBy("chrom", "strand").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") - F.col("s")).alias("bases"), F.round(F.avg("divergence"), 6).alias("divergence"))


@QUERIES.add("a15_coordinate_check", f"WITH {V.INSTANCES}, g AS (SELECT DISTINCT 'chr' || (s_suppkey % 4 + 1) AS chrom FROM supplier) SELECT count(*) AS n, CAST(count_if(chrom IN (SELECT chrom FROM g)) AS BIGINT) AS known, count_if(chrom IN (SELECT chrom FROM g)) > 0 AS valid FROM instances")
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many intervals lie on a sequence of the genome; none at all is an error."""
    names = table(spark, sf_dir, "supplier").select(F.concat(F.lit("chr"), (F.col("s_suppkey") % 4 + 1).cast("string")).alias("chrom"), F.lit(1).alias("known")).distinct()
    rows = V.instances(spark, sf_dir).join(names, "chrom", "left")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("known"), (F.count("known") > 0).alias("valid"))


@QUERIES.add("a17_blast_scan", f"WITH {V.HITS} SELECT subject, strand, count(*) AS n, CAST(sum(gmin - 1) AS BIGINT) AS starts, CAST(sum(gmax) AS BIGINT) AS ends, round(avg(1 - round(pident, 2) / 100), 6) AS divergence FROM hits GROUP BY subject, strand")
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    plus = F.col("strand") == "+"
    a, b = F.when(plus, F.col("gmin")).otherwise(F.col("gmax")), F.when(plus, F.col("gmax")).otherwise(F.col("gmin"))
    line = tabbed(F.concat(F.lit("q"), F.col("q").cast("string")), F.concat(F.lit("ref|"), "subject", F.lit("|")), F.round("pident", 2), 100, 0, 0, F.col("qstart"), F.col("qend"), a, b, "1e-9", F.col("score"))
    rows = T.read_blast(spark, stored(V.hits(spark, sf_dir), line, "blast"))
    return rows.groupBy("subject", "strand").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("starts"), F.sum("e").alias("ends"), F.round(F.avg("divergence"), 6).alias("divergence"))


@QUERIES.add("a18_repeatmasker_scan", f"WITH {V.HITS} SELECT 'fam' || q AS name, count(*) AS copy_number, CAST(sum(gmax - gmin + 1) AS BIGINT) AS total_length, round(avg(round(pident, 2)), 6) AS identity FROM hits GROUP BY q")
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = spark.createDataFrame([("   SW   perc perc perc  query",), ("score   div. del. ins.  sequence",), ("",)], "value string")
    line = F.concat(F.lit("  "), F.concat_ws("   ", F.floor("score").cast("string"), F.round(100 - F.col("pident"), 2).cast("string"), F.lit("0.0"), F.lit("0.0"), "subject", F.col("gmin").cast("string"), F.col("gmax").cast("string"), F.lit("(0)"), "strand", F.concat(F.lit("fam"), F.col("q").cast("string")), F.lit("LTR/Gypsy"), F.col("qstart").cast("string"), F.col("qend").cast("string"), F.lit("(9)"), F.lit("1")))
    path = scratch(spark, "rm")
    head.union(V.hits(spark, sf_dir).select(line)).write.text(path)
    return T.read_repeatmasker(spark, path).groupBy("name").agg(F.count(F.lit(1)).alias("copy_number"), F.sum(F.col("e") - F.col("s") + 1).alias("total_length"), F.round(F.avg("identity"), 6).alias("identity"))


@QUERIES.add("a21_cluster_scan", "SELECT o_custkey AS cluster, 'seq' || o_orderkey AS member FROM orders")
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(F.lit("0\t99nt, >seq"), k.cast("string"), F.lit("... at +/98%"))), "\n")
    blocks = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(members.alias("members"))
    path = stored(blocks, F.concat(F.lit(">Cluster "), F.col("o_custkey").cast("string"), F.lit("\n"), "members"), "clstr")
    return T.read_clusters(spark, path)


@QUERIES.add("a26_hierarchy_nodes", "WITH c AS (SELECT DISTINCT (p_size % 5) || '.' || (p_partkey % 4) || '.' || (p_partkey % 3) AS code FROM part), n AS (SELECT DISTINCT array_to_string(string_split(code, '.')[1:k], '.') AS code, k FROM c, (SELECT unnest([1, 2, 3]) AS k) x) SELECT code, CASE WHEN k > 1 THEN array_to_string(string_split(code, '.')[1:k - 1], '.') END AS parent, CAST(k AS BIGINT) AS depth FROM n")
def a26(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "part").select(F.concat_ws(".", F.col("p_size") % 5, F.col("p_partkey") % 4, F.col("p_partkey") % 3).alias("code")).distinct()
    rows = T.lines(spark, stored(codes, F.col("code"), "nodes")).select(F.split("value", "\\.").alias("f"))
    rows = rows.select("f", F.explode(F.sequence(F.lit(1), F.size("f"))).alias("depth"))
    code = lambda n: F.array_join(F.slice("f", F.lit(1), n), ".")
    return rows.select(code(F.col("depth")).alias("code"), F.when(F.col("depth") > 1, code(F.col("depth") - 1)).alias("parent"), F.col("depth").cast("long").alias("depth")).distinct()


@QUERIES.add("a27_feature_csv", f"WITH {V.SEQS} SELECT id, {', '.join(f'length(seq) - length(replace(seq, {b!r}, {chr(39)*2})) AS n_{b.lower()}' for b in 'ACGT')} FROM seqs")
def a27(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "features")
    V.seqs(spark, sf_dir).select("id", *(S.count_of(F.col("seq"), b).alias(f"n_{b.lower()}") for b in "ACGT")).write.option("header", True).csv(path)
    return spark.read.schema("id long, n_a long, n_c long, n_g long, n_t long").option("header", True).csv(path)


@QUERIES.add("a29_library_bundles", f"WITH {V.RECORDS} SELECT CASE WHEN copies >= 30 THEN 'masking' ELSE 'analysis' END AS library, count(*) AS n, CAST(sum(length) AS BIGINT) AS bases FROM records GROUP BY 1")
def a29(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "libraries")
    rows = V.records(spark, sf_dir).withColumn("library", F.when(F.col("copies") >= 30, "masking").otherwise("analysis"))
    rows.select("library", F.format_string(">mdl_R%d length=%d", F.col("id"), F.col("length").cast("long")).alias("value")).write.partitionBy("library").text(path)
    back = spark.read.text(path).withColumn("bases", F.regexp_extract("value", "length=(\\d+)", 1).cast("long"))
    return back.groupBy("library").agg(F.count(F.lit(1)).alias("n"), F.sum("bases").alias("bases"))


@QUERIES.add("a30_json_round_trip", f"WITH {V.RECORDS} SELECT id, length, copies, round(mdl, 3) AS mdl, CASE WHEN id % 4 > 0 THEN round(divergence, 6) END AS divergence FROM records")
def a30(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    rows = V.records(spark, sf_dir).select("id", "length", "copies", F.round("mdl", 3).alias("mdl"), F.when(F.col("id") % 4 > 0, F.round("divergence", 6)).alias("divergence"))
    rows.write.json(path)
    return spark.read.schema(rows.schema).json(path)
