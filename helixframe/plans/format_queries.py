"""Formats of many-line records and scores under matrices (operators A20, A22-A25, A31, A32, D15, I22, I23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators import consensus as C
from helixframe.operators import matrices as M
from helixframe.operators import passes as P
from helixframe.operators.graph import scratch
from helixframe.plans import views as V
from helixframe.plans.catalog import QUERIES
from helixframe.plans.registry import table
from helixframe.plans.set_queries import taxonomy
from helixframe.plans.source_queries import stored
from helixframe.sources import records as R
from helixframe.sources import reports as RP
from helixframe.sources import store as ST

BASES = "ACGT"


@QUERIES.add("a22_stockholm_round_trip", f"WITH {V.SEQS} SELECT 'fam' || (id // 3) AS id, 'doc' || id AS name, length(seq) AS len, md5(seq) AS seq FROM seqs WHERE length(seq) >= 30")
def a22(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of three sequences of at least 30 bases, out and back."""
    rows = V.seqs(spark, sf_dir).filter(F.length("seq") >= 30).select(F.floor(F.col("id") / 3).alias("fam"), "id", F.concat(F.lit("doc"), F.col("id").cast("string")).alias("name"), "seq")
    blocks = rows.groupBy("fam").agg(F.array_sort(F.collect_list(F.struct("id", "name", "seq"))).alias("rows"))
    path = scratch(spark, "stockholm")
    R.write_stockholm(blocks, F.concat(F.lit("fam"), F.col("fam").cast("string")), F.col("rows"), path)
    return R.read_stockholm(spark, path).select("id", "name", F.length("seq").cast("long").alias("len"), F.md5(F.col("seq").cast("binary")).alias("seq"))


FAMILIES = f"{V.SEQS}, fams AS (SELECT 'DF' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS accession, 'fam' || p_partkey AS name, p_name AS title, split_part(p_type, ' ', 1) AS type, split_part(p_type, ' ', 2) AS subtype, p_brand AS species, length(seq) AS length, seq FROM part JOIN seqs ON p_partkey = id)"


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as families, each with the sequence of the document of its number."""
    seqs = V.seqs(spark, sf_dir).withColumnRenamed("id", "p_partkey")
    words = F.split("p_type", " ")
    return table(spark, sf_dir, "part").join(seqs, "p_partkey").select(
        F.concat(F.lit("DF"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("accession"), F.concat(F.lit("fam"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_name").alias("title"),
        words[0].alias("type"), F.coalesce(F.get(words, F.lit(1)), F.lit("")).alias("subtype"), F.col("p_brand").alias("species"), F.length("seq").cast("long").alias("length"), "seq",
    )


@QUERIES.add("a23_embl_round_trip", f"WITH {FAMILIES} SELECT accession, name, title, type, nullif(subtype, '') AS subtype, species, length, md5(seq) AS seq FROM fams")
def a23(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "embl")
    R.write_embl(families(spark, sf_dir), R.embl_record(*(F.col(c) for c in ("accession", "name", "title", "type", "subtype", "species", "seq"))), path)
    return R.read_embl(spark, path).withColumn("seq", F.md5(F.col("seq").cast("binary")))


@QUERIES.add("a24_family_store", f"WITH {FAMILIES}, one AS (SELECT * FROM fams WHERE CAST(substr(accession, 3) AS BIGINT) % 3 <> 0), two AS (SELECT accession, name, length FROM fams WHERE CAST(substr(accession, 3) AS BIGINT) % 3 = 0 OR CAST(substr(accession, 3) AS BIGINT) % 2 = 0) SELECT accession, name, length, 1 AS batch FROM one UNION ALL SELECT accession, name, length, 2 FROM two WHERE accession NOT IN (SELECT accession FROM one)")
def a24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store filled by two batches that share families; the second adds only those that are new."""
    store, number = scratch(spark, "store"), F.substring("accession", 3, 9).cast("long")
    rows = families(spark, sf_dir).select("accession", "name", "length")
    R.append_families(rows.filter(number % 3 != 0).withColumn("batch", F.lit(1)), store)
    R.append_families(rows.filter((number % 3 == 0) | (number % 2 == 0)).withColumn("batch", F.lit(2)), store)
    return spark.read.parquet(store)


STAGED = f"""{FAMILIES}, numbered AS (SELECT *, CAST(substr(accession, 3) AS BIGINT) AS k, (CAST(substr(accession, 3) AS BIGINT) % 9 * 5 + 35)::VARCHAR AS searched, (CAST(substr(accession, 3) AS BIGINT) % 4 * 10 + 40)::VARCHAR AS buffered FROM fams),
one AS (SELECT accession || CASE WHEN k % 7 = 0 THEN 'v' ELSE '' END AS accession, name, type, subtype, k, searched, buffered FROM numbered WHERE k % 3 <> 0),
two AS (SELECT CASE WHEN k % 10 = 2 THEN name WHEN k % 11 = 0 THEN 'DR' || lpad(k::VARCHAR, 7, '0') ELSE accession END AS accession, 'second' || k AS name, type, subtype, k, searched, buffered FROM numbered WHERE k % 3 = 0 OR k % 2 = 0),
store AS (SELECT * FROM one UNION ALL SELECT * FROM two WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.k = two.k AND (one.accession IN (two.accession, two.accession || 'v') OR one.name = two.accession))),
taxa AS (SELECT DISTINCT l_partkey AS k, 's' || l_suppkey AS taxon FROM lineitem), below AS (SELECT 's' || s_suppkey AS taxon FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 1)"""


@QUERIES.add("a24_store_lookups", f"""WITH {STAGED} SELECT 'stage' AS search, accession, name FROM store WHERE searched = '50' OR buffered = '50' UNION ALL SELECT 'models', accession, name FROM store WHERE searched IN ('35', '50', '55', '60', '65', '70', '75') AND type LIKE 'S%'
UNION ALL SELECT 'below', accession, name FROM store WHERE k IN (SELECT k FROM taxa JOIN below USING (taxon)) AND (searched = '40' OR buffered = '40') UNION ALL SELECT 'uncurated', accession, name FROM store WHERE accession LIKE 'DR%' AND name LIKE 'second%'""")
def a24_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of two batches that share names in several ways, and its families by stage, by models, below a taxon, uncurated."""
    store, k = scratch(spark, "store"), F.substring("accession", 3, 9).cast("long")
    clades = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.collect_set(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("clades"))
    rows = families(spark, sf_dir).withColumn("k", k).join(clades, "k", "left").select("k", "accession", "name", "type", "subtype", (F.col("k") % 9 * 5 + 35).cast("string").alias("search_stages"), (F.col("k") % 4 * 10 + 40).cast("string").alias("buffer_stages"), "clades")
    one = rows.filter("k % 3 <> 0").withColumn("accession", F.concat("accession", F.when(F.col("k") % 7 == 0, "v").otherwise("")))
    other = F.when(F.col("k") % 10 == 2, F.col("name")).when(F.col("k") % 11 == 0, F.concat(F.lit("DR"), F.lpad(F.col("k").cast("string"), 7, "0"))).otherwise(F.col("accession"))
    two = rows.filter("k % 3 = 0 or k % 2 = 0").withColumns({"accession": other, "name": F.concat(F.lit("second"), F.col("k").cast("string"))})
    for batch in (one, two):
        ST.append(batch.drop("k"), store)
    searches = {
        "stage": {"stage": 50}, "models": {"stage": 95, "is_hmm": True, "kind": "s"}, "below": {"taxonomy": taxonomy(spark, sf_dir), "taxon": "r1", "descendants": True, "stage": 40},
        "uncurated": {"curated": False, "name": "SECOND"},
    }
    found = [ST.selected(spark, store, **search).select(F.lit(label).alias("search"), "accession", "name") for label, search in searches.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@QUERIES.add("a20_crossmatch_scan", f"WITH {V.HITS} SELECT CAST(floor(score) AS BIGINT) AS score, 100 - pident AS div, 'q' || q AS q, gmin AS qstart, gmax AS qend, strand, 'fam' || subject AS name, CASE WHEN ln % 2 = 0 THEN 'LTR/Copia' END AS class, qstart AS sstart, qend AS send, 400 - qend AS sleft, 'm_b' || o AS id FROM hits")
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits as summary lines with an alignment line under each, and back."""
    h = V.hits(spark, sf_dir)
    name = F.concat(F.lit("fam"), F.col("subject"), F.when(F.col("ln") % 2 == 0, "#LTR/Copia").otherwise(""))
    a, b, rest = F.col("qstart").cast("string"), F.col("qend").cast("string"), F.concat(F.lit("("), (400 - F.col("qend")).cast("string"), F.lit(")"))
    place = F.when(F.col("strand") == "-", F.concat_ws(" ", F.lit("C"), name, rest, b, a)).otherwise(F.concat_ws(" ", name, a, b, rest))
    head = F.concat_ws(" ", F.floor("score").cast("string"), F.format_string("%.2f", 100 - F.col("pident")), F.lit("0.50"), F.lit("0.25"), F.concat(F.lit("q"), F.col("q").cast("string")), F.col("gmin").cast("string"), F.col("gmax").cast("string"), F.lit("(100)"), place, F.concat(F.lit("m_b"), F.col("o").cast("string")))
    found = R.read_crossmatch(spark, stored(h, F.concat(F.lit("  "), head, F.lit("\n\n  q 1 ACGT 4\n  s 1 AC-T 3\n")), "cat"))
    return found.select("score", "div", "q", "qstart", "qend", "strand", "name", "class", "sstart", "send", "sleft", "id")


@QUERIES.add("a20_tandem_repeat_scan", "SELECT 'chr' || (l_suppkey % 50) AS q, l_orderkey * 50 AS s, l_orderkey * 50 + CAST(floor(l_quantity) AS BIGINT) AS e, CAST(l_linenumber AS BIGINT) AS period, CAST(floor(l_quantity) AS DOUBLE) AS copies, repeat('A', l_linenumber) AS consensus FROM lineitem")
def a20_trf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under the line of their sequence, and back."""
    n, start, ln = F.floor("l_quantity").cast("long"), F.col("l_orderkey") * 50, F.col("l_linenumber")
    row = F.concat_ws(" ", *(c.cast("string") for c in (start, start + n, ln, n)), ln.cast("string"), F.lit("90 2 70 80 5 5 10 0.90"), F.repeat(F.lit("A"), ln), F.lit("AAAC"))
    lines = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("chr"), (F.col("l_suppkey") % 50).cast("string")).alias("q"), F.floor(F.col("l_orderkey") / 1000).alias("part"), row.alias("row"))
    blocks = lines.groupBy("q", "part").agg(F.array_join(F.collect_list("row"), "\n").alias("rows"))
    path = stored(blocks, F.concat(F.lit("Sequence: "), F.col("q"), F.lit(" assembled\n\nParameters: 2 7 7 80 10 50 500\n\n"), F.col("rows"), F.lit("\n")), "trf")
    return R.read_tandem_repeats(spark, path).select("q", "s", "e", "period", "copies", "consensus")


def reports(hits: DataFrame, query: Column, head: Column, body: Column, name: str) -> str:
    """The path of reports of hits (o, ...): blocks of a query's head and its hits' bodies."""
    rows = hits.select(query.alias("query"), F.floor(F.col("o") / 1000).alias("part"), head.alias("head"), body.alias("body"))
    blocks = rows.groupBy("query", "part").agg(F.max("head").alias("head"), F.array_join(F.collect_list("body"), "").alias("bodies"))
    return stored(blocks, F.concat("head", "bodies", F.lit("//")), name)


@QUERIES.add("a20_profile_scan", f"WITH {V.HITS} SELECT CAST(floor(score) AS BIGINT) AS score, subject AS q, gmin AS qstart, gmax AS qend, 500000000 - gmax AS qleft, strand, 'fam' || q AS name, qstart AS sstart, qend AS send, 400 - qend AS sleft, round(100 / (gmax - gmin + 1), 2) AS div, 0.0 AS ins, CASE strand WHEN '-' THEN 'A-GT' ELSE 'AC-T' END AS query, CASE strand WHEN '-' THEN 'TCGT' ELSE 'ACGA' END AS subject, CASE strand WHEN '-' THEN '*.98' ELSE '89.*' END AS pp FROM hits")
def a20_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits as blocks of profile search reports, and back."""
    back, text = F.col("strand") == "-", lambda c: F.col(c).cast("string")
    model = F.concat(F.lit("fam"), text("q"))
    first, last = F.when(back, text("gmax")).otherwise(text("gmin")), F.when(back, text("gmin")).otherwise(text("gmax"))
    figures = F.concat_ws("  ", F.lit(" !"), text("score"), F.lit("0.0  1e-05"), text("qstart"), text("qend"), F.lit(".."), first, last, F.lit(".."), first, last, F.lit("..  500000000  0.95"))
    rows = F.concat(F.concat_ws(" ", F.lit(" "), model, text("qstart"), F.lit("acga"), text("qend")), F.lit("\n"), F.concat_ws(" ", F.lit(" "), "subject", first, F.lit("AC.T"), last), F.lit("\n     89.* PP\n\n"))
    body = F.concat(F.lit("\n>> "), "subject", F.lit("\n"), figures, F.lit("\n\n  Alignment:\n"), rows)
    path = reports(V.hits(spark, sf_dir), F.col("q"), F.concat(F.lit("Query:       "), model, F.lit("  [M=400]\n")), body, "profiles")
    return RP.read_profile_hits(spark, path).select("score", "q", "qstart", "qend", "qleft", "strand", "name", "sstart", "send", "sleft", "div", "ins", "query", "subject", "pp")


@QUERIES.add("a20_pairwise_scan", f"WITH {V.HITS} SELECT CAST(floor(score) AS BIGINT) AS score, subject AS q, gmin AS qstart, gmax AS qend, 500000000 - gmax AS qleft, strand, 'fam' || q AS name, CASE strand WHEN '-' THEN 401 - qend ELSE qstart END AS sstart, CASE strand WHEN '-' THEN 401 - qstart ELSE qend END AS send, CASE strand WHEN '-' THEN qstart - 1 ELSE 400 - qend END AS sleft, round(100 / (gmax - gmin + 1), 2) AS del, 'AC-TACGT' AS query, 'ACGTACGT' AS subject FROM hits")
def a20_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits as blocks of pairwise search reports, subjects of the reverse strand as turned copies, and back."""
    text = lambda c: F.col(c).cast("string")
    line = F.concat(F.lit("\n>fam"), text("q"), F.when(F.col("strand") == "-", " (anti)").otherwise(""), F.lit("\n        Length = 400\n"))
    score = F.concat(F.lit("\n Score = "), F.floor("score").cast("string"), F.lit(" (71.2 bits), Expect = 1e-30, P = 1e-30\n"))
    part = lambda a, x, b, c, y, d: F.concat(F.lit("\nQuery:  "), a, F.lit(f" {x} "), b, F.lit("\n        ||||\nSbjct:  "), c, F.lit(f" {y} "), d, F.lit("\n"))
    one, two = part(text("gmin"), "AC-T", (F.col("gmin") + 2).cast("string"), text("qstart"), "ACGT", text("qstart")), part((F.col("gmin") + 3).cast("string"), "ACGT", text("gmax"), text("qstart"), "ACGT", text("qend"))
    path = reports(V.hits(spark, sf_dir), F.col("subject"), F.concat(F.lit("Query=  "), "subject", F.lit("\n        (500,000,000 letters)\n")), F.concat(line, score, one, two), "pairwise")
    return RP.read_pairwise_hits(spark, path).select("score", "q", "qstart", "qend", "qleft", "strand", "name", "sstart", "send", "sleft", "del", "query", "subject")


@QUERIES.add("a31_gff_round_trip", f"WITH {V.HITS} SELECT subject AS q, gmin AS s, gmax AS e, score, strand, 'fam' || q AS motif, qstart AS ms, qend AS me FROM hits")
def a31(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = V.hits(spark, sf_dir)
    line = R.gff_line(F.col("subject"), "helixframe", F.col("gmin"), F.col("gmax"), F.col("score"), F.col("strand"), F.concat(F.lit("fam"), F.col("q").cast("string")), F.col("qstart"), F.col("qend"))
    return R.read_gff(spark, stored(h, line, "gff")).select("q", "s", "e", "score", "strand", "motif", "ms", "me")


@QUERIES.add("a31_ace_round_trip", f"WITH {V.HITS} SELECT 'fam' || q AS name, 100 - pident AS divergence, gmin AS s, gmax AS e, strand, qstart AS ms, qend AS me FROM hits")
def a31_ace(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = V.hits(spark, sf_dir)
    line = R.ace_line(F.concat(F.lit("fam"), F.col("q").cast("string")), 100 - F.col("pident"), F.col("gmin"), F.col("gmax"), F.col("strand"), F.col("qstart"), F.col("qend"))
    return R.read_ace(spark, stored(h, line, "ace"))


@QUERIES.add("a31_html_round_trip", "SELECT page_id, url, length(html) AS chars FROM pages WHERE page_id IS NOT NULL")
def a31_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows with addresses that need escaping, and back."""
    rows = table(spark, sf_dir, "pages").filter("page_id is not null").select(R.html_row([F.col("page_id"), F.col("url"), F.length("html")]).alias("row"))
    cells = R.read_html_rows(spark, stored(rows, F.col("row"), "html")).select("cells")
    return cells.select(F.col("cells")[0].cast("long").alias("page_id"), F.col("cells")[1].alias("url"), F.col("cells")[2].cast("long").alias("chars"))


PAIRS = f"{V.SEQS}, pairs AS (SELECT id, replace(seq, 'AC', '--') AS q, replace(replace(seq, 'GT', '--'), 'TA', 'TC') AS s FROM seqs), cells AS (SELECT id, i, substr(q, i, 1) AS x, substr(s, i, 1) AS y FROM (SELECT *, unnest(range(1, length(q) + 1)) AS i FROM pairs) z)"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, q, s): the sequences and their changed copies, aligned; no column has two gaps."""
    replaced = lambda c, a, b: F.replace(c, F.lit(a), F.lit(b))
    return V.seqs(spark, sf_dir).select("id", replaced(F.col("seq"), "AC", "--").alias("q"), replaced(replaced(F.col("seq"), "GT", "--"), "TA", "TC").alias("s"))


@QUERIES.add("a32_alignment_strings", f"""WITH {PAIRS}, c AS (SELECT id, string_agg(CASE WHEN x = '-' THEN '+' || y || '+' WHEN y = '-' THEN '-' || x || '-' WHEN x = y THEN x ELSE x || '/' || y END, '' ORDER BY i) AS a, string_agg(CASE WHEN x = '-' THEN 'I' WHEN y = '-' THEN 'D' ELSE 'M' END, '' ORDER BY i) AS k FROM cells GROUP BY id)
SELECT id, md5(replace(replace(a, '++', ''), '--', '')) AS compressed, array_to_string(list_transform(regexp_extract_all(k, '(M+|I+|D+)'), lambda r: length(r) || left(r, 1)), '') AS cigar, md5(q) AS query, md5(s) AS subject FROM c JOIN pairs USING (id)""")  # fmt: skip
def a32(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both forms of each alignment, and its rows again from the compressed one."""
    q, s = F.col("q"), F.col("s")
    rows = pairs(spark, sf_dir).filter("q <> ''").select("id", R.compressed_alignment(q, s).alias("c"), R.run_lengths(q, s).alias("cigar"))
    rows = rows.withColumn("back", R.expanded_alignment(F.col("c")))
    digest = lambda c, n: F.md5(F.col(c).cast("binary")).alias(n)
    return rows.select("id", digest("c", "compressed"), "cigar", digest("back.query", "query"), digest("back.subject", "subject"))


SCORES = {a + b: 10.0 if a == b else -6.0 if a + b in ("AG", "GA", "CT", "TC") else -15.0 for a in BASES for b in BASES}
FREQS, LAMBDA, MU = [0.295, 0.205, 0.205, 0.295], 0.12, 0.3


@QUERIES.add("i23_rescored_alignment", f"""WITH {PAIRS}, g AS (SELECT id, sum(CASE WHEN x = '-' OR y = '-' THEN 0 WHEN x = y THEN 10 WHEN x || y IN ('AG', 'GA', 'CT', 'TC') THEN -6 ELSE -15 END) AS m, CAST(count_if(x = 'A' AND y <> '-') AS DOUBLE) AS a, CAST(count_if(x = 'C' AND y <> '-') AS DOUBLE) AS c, CAST(count_if(x = 'G' AND y <> '-') AS DOUBLE) AS g, CAST(count_if(x = 'T' AND y <> '-') AS DOUBLE) AS t, count_if(x = '-' OR y = '-') AS gaps FROM cells GROUP BY id),
r AS (SELECT g.*, a + c + g + t AS n, m - (len(regexp_extract_all(q, '-+')) + len(regexp_extract_all(s, '-+'))) * 12.0 - (gaps - len(regexp_extract_all(q, '-+')) - len(regexp_extract_all(s, '-+'))) * 4.0 AS raw FROM g JOIN pairs USING (id)),
e AS (SELECT *, CASE WHEN a > 0 THEN a * ln(0.295) - a * ln(a) ELSE 0 END + CASE WHEN c > 0 THEN c * ln(0.205) - c * ln(c) ELSE 0 END + CASE WHEN g > 0 THEN g * ln(0.205) - g * ln(g) ELSE 0 END + CASE WHEN t > 0 THEN t * ln(0.295) - t * ln(t) ELSE 0 END + CASE WHEN n > 0 THEN n * ln(n) ELSE 0 END AS x FROM r)
SELECT id, CAST(raw AS DOUBLE) AS raw, CAST(greatest(0, floor(raw + round(x, 9) / 0.12 + 0.999)) AS BIGINT) AS adjusted, round((raw * 0.12 - ln(0.3)) / ln(2), 6) AS bits FROM e""")  # fmt: skip
def i23(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs(spark, sf_dir).filter("q <> ''").withColumn("cols", R.columns_of(F.col("q"), F.col("s")))
    bases = F.filter("cols", lambda c: c["s"] != "-")
    count = lambda b: F.size(F.filter(bases, lambda c: c["q"] == b)).cast("double")
    counts = [count(b) for b in BASES]
    rows = rows.select("id", M.rescored(F.col("cols"), F.col("q"), F.col("s"), SCORES, 12.0, 4.0).alias("raw"), F.array(*counts).alias("n"))
    adjusted = M.complexity_adjusted(F.col("raw"), [F.col("n")[k] for k in range(4)], FREQS, LAMBDA)
    return rows.select("id", "raw", adjusted.cast("long").alias("adjusted"), F.round(M.bits(F.col("raw"), LAMBDA, MU), 6).alias("bits"))


@QUERIES.add("i22_gap_divergence", f"""WITH {PAIRS}, c AS (SELECT id, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(x <> '-' AND y <> '-') AS DOUBLE) AS sites, CAST(count_if(x || y IN ('AG', 'GA', 'CT', 'TC')) AS DOUBLE) AS ts, CAST(count_if(x <> '-' AND y <> '-' AND x <> y AND x || y NOT IN ('AG', 'GA', 'CT', 'TC')) AS DOUBLE) AS tv, CAST(count_if((x = '-') <> (y = '-')) AS DOUBLE) AS gaps FROM cells GROUP BY id),
k AS (SELECT *, ts / n AS p, tv / n AS q, (sites - ts - tv) / n AS s, (2 * n - gaps) / (2 * n) AS w FROM c) SELECT id, CAST(gaps AS BIGINT) AS gaps, round(CASE WHEN sites < 1 THEN 10000 ELSE (0.75 * w * CASE WHEN w > 0 THEN ln(w) ELSE 1 END - w / 2 * CASE WHEN s - p > 0 AND s + p - q > 0 THEN ln((s - p) * sqrt(s + p - q)) ELSE 1 END) * 100 END, 6) AS divergence FROM k""")  # fmt: skip
def i22_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the aligned copies with their gaps."""
    rows = P.with_gap_counts(pairs(spark, sf_dir).filter("q <> ''"), "id", "q", "s")
    return rows.select("id", "gaps", F.round(C.kimura_with_gaps(*(F.col(c) for c in ("columns", "sites", "transitions", "transversions", "gaps"))), 6).alias("divergence"))


@QUERIES.add("i23_x_drop_fragments")
def i23_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a search that gives up 60 below its best score would have broken the alignments."""
    rows = P.with_x_drop(pairs(spark, sf_dir).filter("q <> ''"), "id", "q", "s", SCORES, 12.0, 4.0, 60.0)
    return rows.select("id", "raw", F.posexplode("fragments").alias("place", "x")).select("id", "raw", F.col("place").cast("long").alias("place"), "x.first", "x.last")


COUNTS = f"""{V.SEQS}, cnt AS (SELECT id % 5 AS fam, substr(seq, i, 1) AS "row", substr(seq, i + 1, 1) AS col, count(*) AS n FROM (SELECT id, seq, unnest(range(1, length(seq))) AS i FROM seqs) x GROUP BY ALL), bg AS (SELECT "row", col, sum(n) AS n FROM cnt GROUP BY ALL)"""


def neighbour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fam, row, col, n): neighbouring bases in five groups of sequences; sixteen sums a group are shuffled."""
    pairs_of = [a + b for a in BASES for b in BASES]
    sums = V.seqs(spark, sf_dir).groupBy((F.col("id") % 5).alias("fam")).agg(*(F.sum(F.regexp_count("seq", F.lit(f"{p[0]}(?={p[1]})"))).alias(p) for p in pairs_of))
    cells = F.explode(F.array(*(F.struct(F.lit(p[0]).alias("row"), F.lit(p[1]).alias("col"), F.col(p).alias("n")) for p in pairs_of)))
    return sums.select("fam", cells.alias("c")).select("fam", "c.*").filter("n > 0")


def log_ratio_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = neighbour_counts(spark, sf_dir)
    return M.log_ratios(counts, counts.groupBy("row", "col").agg(F.sum("n").alias("n")), ["fam"], 1000)


@QUERIES.add("d15_matrix_statistics", f"""WITH {COUNTS}, p AS (SELECT fam, "row", col, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY fam, "row") AS p FROM cnt), q AS (SELECT "row", col, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY "row") AS q FROM bg) SELECT fam, "row", col, CAST(round((ln(p) - ln(q)) * 1000) AS BIGINT) AS score FROM p JOIN q USING ("row", col)""")
def d15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_ratio_matrix(spark, sf_dir)


@QUERIES.add("d15_lambda")
def d15_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lambda of each group's pairs of neighbours, scored against what their frequencies alone give."""
    counts = neighbour_counts(spark, sf_dir)
    share = lambda *by: F.sum("n").over(W.partitionBy("fam", *by)) / F.sum("n").over(W.partitionBy("fam"))
    matrix = counts.select("fam", "row", "col", share("row").alias("freq_row"), share("col").alias("freq_col"), share("row", "col").alias("p"))
    score = F.round(F.log(F.col("p") / (F.col("freq_row") * F.col("freq_col"))) * 100).cast("long")
    return M.with_lambda(matrix.withColumn("score", score), "fam").select("fam", F.round("lambda", 6).alias("lambda"))


@QUERIES.add("a25_matrix_scan", f"""WITH {COUNTS}, p AS (SELECT fam, "row", col, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY fam, "row") AS p FROM cnt), q AS (SELECT "row", col, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY "row") AS q FROM bg)
SELECT "row", col, count(*) AS matrices, CAST(sum(CAST(round((ln(p) - ln(q)) * 1000) AS BIGINT)) AS BIGINT) AS total FROM p JOIN q USING ("row", col) GROUP BY "row", col""")  # fmt: skip
def a25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group's matrix as text, and back."""
    lines = R.matrix_lines(log_ratio_matrix(spark, sf_dir).withColumn("freq", F.lit(0.25)), "fam")
    path = scratch(spark, "matrix")
    lines.select("value").write.option("lineSep", "\n//\n").text(path)
    return R.read_matrices(spark, path, "\n//\n").groupBy("row", "col").agg(F.count(F.lit(1)).alias("matrices"), F.sum("score").alias("total"))
