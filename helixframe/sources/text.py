"""Scans and sinks of the text formats: each scan is a table of typed columns over Spark's text reader.

Coordinates come out 0-based and half open. A field that a record doesn't have is null, never zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of all lines; .gz and .bz2 files are decompressed by their suffix."""
    return spark.read.text(path)


def write_lines(df: DataFrame, column: Column, path: str, codec: str = "none") -> None:
    df.select(column.alias("value")).write.option("compression", codec).text(path)


# FASTA


def fasta_record(name: Column, seq: Column, width: int = 80) -> Column:
    """A header and the sequence in lines of `width`."""
    return F.concat(F.lit(">"), name, F.lit("\n"), F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, header, seq); records are split at line starts with '>', so large files are read in parts."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter("value <> ''")
    split = F.split("value", "\n", 2)
    rows = rows.select(split[0].alias("header"), F.regexp_replace(F.coalesce(F.get(split, F.lit(1)), F.lit("")), "\\s", "").alias("seq"))
    return rows.select(F.split("header", "\\s+")[0].alias("id"), "header", "seq")


def count_fasta(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).filter(F.col("value").startswith(">")).agg(F.count(F.lit(1)).alias("n"))


def mdl_header(header: Column) -> list[Column]:
    """Columns of `R=N length=L copies=C mdl=M [div=] [topo=] [tier=]`; a malformed header has defaults, absent fields are null."""
    field = lambda name: F.nullif(F.regexp_extract(header, f"(?:^| ){name}=([^ ]+)", 1), F.lit(""))
    number = field("R").try_cast("long")
    well = number.isNotNull()
    return [
        F.when(well, F.concat(F.lit("mdl_R"), number.cast("string"))).otherwise(F.split(header, " ")[0]).alias("id"),
        F.coalesce(number, F.lit(0)).alias("r"), F.coalesce(field("length").try_cast("long"), F.lit(0)).alias("length"),
        F.coalesce(field("copies").try_cast("long"), F.lit(1)).alias("copies"), F.coalesce(field("mdl").try_cast("double"), F.lit(1.0)).alias("mdl"),
        field("div").try_cast("double").alias("divergence"), field("topo").alias("topology"), field("tier").alias("tier"),
    ]


# Tables of tab-separated fields


def fields(spark: SparkSession, path: str, least: int, pattern: str = "\t", comment: str = "#") -> DataFrame:
    """(f) the fields of all lines that have at least so many and aren't comments."""
    rows = lines(spark, path).filter(~F.col("value").startswith(comment)).select(F.split(F.trim("value") if pattern != "\t" else F.col("value"), pattern).alias("f"))
    return rows.filter(F.size("f") >= least)


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    return fields(spark, path, 2).select(F.col("f")[0].alias("name"), F.col("f")[1].cast("long").alias("length"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, s, e, r, divergence, strand) of instances; divergence is 1 - score / 1000, not below 0."""
    f = F.col("f")
    return fields(spark, path, 6).select(f[0].alias("chrom"), f[1].cast("long").alias("s"), f[2].cast("long").alias("e"), F.regexp_extract(f[3], "R=(\\d+)", 1).cast("long").alias("r"), F.greatest(F.lit(0.0), 1 - f[4].cast("double") / 1000).alias("divergence"), f[5].alias("strand"))


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    """(q, subject, s, e, strand, divergence, score) of tabular hits; prefixes such as ref|x| go."""
    f = F.col("f")
    a, b = f[8].cast("long"), f[9].cast("long")
    subject = F.regexp_replace(f[1], "^[^|]+\\|([^|]+)\\|?$", "$1")
    return fields(spark, path, 12).select(f[0].alias("q"), subject.alias("subject"), (F.least(a, b) - 1).alias("s"), F.greatest(a, b).alias("e"), F.when(a <= b, "+").otherwise("-").alias("strand"), (1 - f[2].cast("double") / 100).alias("divergence"), f[11].cast("double").alias("score"))


def read_repeatmasker(spark: SparkSession, path: str) -> DataFrame:
    """(q, chrom, s, e, identity, name) of .out rows: at least 15 fields, the first a number."""
    f = F.col("f")
    rows = fields(spark, path, 15, "\\s+").filter(f[0].rlike("^\\d+$"))
    return rows.select(f[4].alias("chrom"), f[5].cast("long").alias("s"), f[6].cast("long").alias("e"), (100 - f[1].cast("double")).alias("identity"), f[9].alias("name"))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    """The 12 columns of PAF, its tags tp and cg, and the line's number of fields."""
    names = ["qname", "qlen", "qstart", "qend", "strand", "tname", "tlen", "tstart", "tend", "matches", "block", "mapq"]
    f = F.col("f")
    tag = lambda prefix: F.get(F.transform(F.filter(F.slice(f, 13, 1000), lambda x: x.startswith(prefix)), lambda x: F.substring(x, F.lit(6), F.length(x))), F.lit(0))
    typed = [f[k].cast("string" if n in ("qname", "strand", "tname") else "long").alias(n) for k, n in enumerate(names)]
    return fields(spark, path, 12).select(*typed, tag("tp:").alias("tp"), tag("cg:Z:").alias("cigar"))


def filtered_paf(paf: DataFrame, least: int = 5000, mapq: int = 20) -> DataFrame:
    """Without self alignments, short ones, and those of low quality where quality is told (a tp tag)."""
    return paf.filter((F.col("qname") != F.col("tname")) & (F.col("qend") - F.col("qstart") >= least) & (F.col("tp").isNull() | (F.col("mapq") >= mapq)))


def mapped_pairs(paf: DataFrame, mapping: DataFrame) -> DataFrame:
    """Alignments whose sides, where both are mapped (name, assembly, chr), differ in assembly and agree in chr."""
    q, t = (mapping.select(F.col("name").alias(f"{x}name"), F.col("assembly").alias(f"{x}a"), F.col("chr").alias(f"{x}c")) for x in "qt")
    rows = paf.join(q, "qname", "left").join(t, "tname", "left")
    bad = F.coalesce((F.col("qa") == F.col("ta")) | (F.col("qc") != F.col("tc")), F.lit(False))
    return rows.filter(~bad).drop("qa", "qc", "ta", "tc")


# Graphs


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(id, length, rank, name, offset) of S lines; the length tag, or else the sequence's length."""
    f = F.col("f")
    tag = lambda prefix: F.get(F.transform(F.filter(F.slice(f, 4, 1000), lambda x: x.startswith(prefix)), lambda x: F.substring(x, F.lit(6), F.length(x))), F.lit(0))
    rows = fields(spark, path, 3).filter(f[0] == "S")
    return rows.select(f[1].alias("id"), f[2].alias("seq"), F.coalesce(tag("LN:i:").cast("long"), F.length(f[2]).cast("long")).alias("length"), tag("SR:i:").cast("int").alias("rank"), tag("SN:Z:").alias("name"), tag("SO:i:").cast("long").alias("offset"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    return fields(spark, path, 5).filter(f[0] == "L").select(f[1].alias("a"), f[2].alias("a_strand"), f[3].alias("b"), f[4].alias("b_strand"))


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """(path, place, segment, strand), a row for each step of P lines."""
    f = F.col("f")
    steps = fields(spark, path, 3).filter(f[0] == "P").select(f[1].alias("path"), F.posexplode(F.split(f[2], ",")).alias("place", "step"))
    return steps.select("path", "place", F.expr("substring(step, 1, length(step) - 1)").alias("segment"), F.right("step", F.lit(1)).alias("strand"))


def reference_path(paths: DataFrame, wanted: str | None) -> DataFrame:
    """The one path (path, line) to use: the wanted name, then a name with it inside, then T2T, then the first."""
    name, wanted = F.col("path"), wanted or "\0"
    priority = F.when(name == wanted, 0).when(F.contains(name, F.lit(wanted)), 1).when(F.contains(F.lower(name), F.lit("t2t")), 2).otherwise(3)
    return paths.groupBy().agg(F.min(F.struct(priority.alias("priority"), "line", "path")).alias("m")).select("m.path", "m.priority")


def read_vcf_alleles(spark: SparkSession, path: str, least: int = 50) -> DataFrame:
    """(chrom, pos, n, allele, place): ALT alleles longer than `least`, of rows whose ALT field is."""
    f = F.col("f")
    rows = fields(spark, path, 5).filter(F.length(f[4]) > least).select(f[0].alias("chrom"), f[1].cast("long").alias("pos"), F.filter(F.split(f[4], ","), lambda a: F.length(a) > least).alias("alleles"))
    return rows.select("chrom", "pos", F.size("alleles").alias("n"), F.posexplode("alleles").alias("place", "allele"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, member) of .clstr blocks: each block is one record, split at line starts with '>Cluster '."""
    rows = spark.read.option("lineSep", "\n>Cluster ").text(path).select(F.regexp_replace("value", "^>Cluster ", "").alias("value"))
    names = F.regexp_extract_all("value", F.lit(">([^.\\s]+)\\.\\.\\."), 1)
    return rows.select(F.regexp_extract("value", "^(\\d+)", 1).cast("long").alias("cluster"), F.explode(names).alias("member"))


# Kinds of graphs, discovered families, masking summaries


def graph_dialect(spark: SparkSession, path: str, heads: int = 50) -> DataFrame:
    """(dialect) of the graph at path, by its first S lines: rGFA if one has a rank tag before any P line, else PGGB; null without S and P lines.

    Lines are in the order of files, of blocks in a file, and of lines in a block.
    """
    rows = spark.read.text(path).select("value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias("at"))
    first = rows.filter(F.col("value").startswith("S\t")).orderBy("at").limit(heads)
    seen = first.agg(F.min(F.when(F.contains("value", F.lit("SR:i:")), F.col("at"))).alias("ranked"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))
    paths = rows.filter(F.col("value").startswith("P\t")).agg(F.min("at").alias("path"))
    # a path line ends the search where it stands before what would decide it
    before = F.col("path").isNotNull() & (F.col("last").isNull() | (F.col("path") < F.coalesce("ranked", "last")) | (F.col("ranked").isNull() & (F.col("n") < heads)))
    return seen.join(F.broadcast(paths)).select(F.when(before, "PGGB").when(F.col("ranked").isNotNull(), "rGFA").when(F.col("n") > 0, "PGGB").alias("dialect"))


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, s, e, family, strand) of discovered families' members; lines of under six fields go."""
    f = F.col("f")
    return fields(spark, path, 6).select(f[0].alias("chrom"), f[1].try_cast("long").alias("s"), f[2].try_cast("long").alias("e"), f[3].alias("family"), f[5].alias("strand"))


def read_families(spark: SparkSession, path: str) -> DataFrame:
    """(family, members, length, seq) of discovered families; `_ref` goes from names, members and length are null where a header lacks them."""
    number = lambda name: F.regexp_extract("header", rf"\b{name}=(\d+)", 1).try_cast("long").alias({"members": "members", "len": "length"}[name])
    return read_fasta(spark, path).select(F.regexp_replace("id", "_ref$", "").alias("family"), number("members"), number("len"), "seq")


def masking_summary(name: Column, sequences: Column, total: Column, masked: Column, interspersed: Column, unclassified: Column) -> Column:
    """The summary of a masked genome, one value for a file."""
    text = lambda c: c.cast("string")
    percent = F.format_string("%.2f", 100.0 * masked / total)
    line = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts), F.lit("\n"))
    return F.concat(
        line("=" * 50), line("file name: ", name), line("sequences: ", F.lpad(text(sequences), 15, " ")), line("total length: ", text(total), " bp  (", text(total), " bp excl N/X-runs)"), line("GC level: 50.00 %"), line("bases masked: ", text(masked), " bp ( ", percent, " %)"), line("=" * 50),
        line("Unclassified:  ", F.lpad(text(unclassified), 10, " "), " elements"), line("Total interspersed repeats: ", text(interspersed), " bp"), line("=" * 50),
    )


def read_masking_summaries(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, sequences, total_length, bases_masked, masked_percent, elements), a row for each file that has the three figures in the middle.

    Interspersed repeats, where they are given and not 0, count as the bases masked.
    """
    whole = spark.read.text(path, wholetext=True)
    found = lambda pattern: F.nullif(F.regexp_extract("value", rf"(?m)^{pattern}", 1), F.lit(""))
    number = lambda pattern: found(pattern).try_cast("long")
    inner = number(r"Total interspersed repeats:\s*(\d+)")
    rows = whole.select(
        F.trim(found(r"file name:\s*(.*)$")).alias("file_name"), number(r"sequences:\s*(\d+)").alias("sequences"), number(r"total length:\s*(\d+)").alias("total_length"),
        F.when(inner > 0, inner).otherwise(number(r"bases masked:\s*(\d+)")).alias("bases_masked"), found(r"bases masked:.*\(\s*([0-9.]+)\s*%").try_cast("double").alias("masked_percent"), F.coalesce(number(r"Unclassified:\s*(\d+)"), F.lit(0)).alias("elements"),
    )
    return rows.filter("total_length is not null and bases_masked is not null and masked_percent is not null")


#: What a file is by the end of its name, compression aside.
ENDINGS = {"fa": "fasta", "fasta": "fasta", "fna": "fasta", "fai": "fai", "bed": "bed", "paf": "paf", "gfa": "gfa", "vcf": "vcf", "out": "repeatmasker", "tbl": "summary", "clstr": "clusters", "tsv": "table", "csv": "table"}


def sniffed(name: Column) -> tuple[Column, Column]:
    """(kind, codec) of a file by its name: codec is gzip, bzip2 or none, kind is null for an unknown ending."""
    lower = F.lower(name)
    codec = F.when(lower.rlike(r"\.(gz|gzip|bgz)$"), "gzip").when(lower.rlike(r"\.bz2$"), "bzip2").otherwise("none")
    ending = F.regexp_extract(F.regexp_replace(lower, r"\.(gz|gzip|bgz|bz2)$", ""), r"\.([a-z0-9]+)$", 1)
    kinds = F.create_map(*(F.lit(x) for kv in ENDINGS.items() for x in kv))
    return F.try_element_at(kinds, ending), codec


def fasta_totals(spark: SparkSession, path: str) -> DataFrame:
    """(codec, records, bases) of all lines below path, by the compression of their files; Spark decompresses by the ending."""
    rows = spark.read.text(path).select("value", sniffed(F.col("_metadata.file_name"))[1].alias("codec"))
    head = F.col("value").startswith(">")
    return rows.groupBy("codec").agg(F.count_if(head).alias("records"), F.sum(F.when(head, 0).otherwise(F.length("value"))).cast("long").alias("bases"))
