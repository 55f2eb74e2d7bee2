"""The given tables as operator inputs, and the same views as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.registry import table

LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"

SEQS = f"seqs AS (SELECT doc_id AS id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}') AS seq FROM documents WHERE text IS NOT NULL)"
RAW = "raw AS (SELECT doc_id AS id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents WHERE text IS NOT NULL)"
INSTANCES = "instances AS (SELECT 'chr' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS chrom, l_orderkey * 50 + l_linenumber * 37 AS s, l_orderkey * 50 + l_linenumber * 37 + CAST(floor(l_quantity) AS BIGINT) * 4 AS e, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_partkey AS fam, CAST(l_discount AS DOUBLE) AS dvg, l_orderkey AS o, l_linenumber AS ln FROM lineitem)"
HITS = "hits AS (SELECT l_partkey AS q, 'chr' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS subject, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_orderkey * 50 + l_linenumber * 37 + 1 AS gmin, l_orderkey * 50 + l_linenumber * 37 + CAST(floor(l_quantity) AS BIGINT) * 4 AS gmax, l_linenumber * 40 - 39 AS qstart, l_linenumber * 40 + CAST(floor(l_quantity) AS BIGINT) AS qend, 400 AS qlen, 100 - 100 * CAST(l_discount AS DOUBLE) AS pident, CAST(l_extendedprice AS DOUBLE) AS score, l_orderkey AS o, l_linenumber AS ln FROM lineitem)"
RECORDS = "records AS (SELECT p_partkey AS id, p_size * 60 AS length, count(*) AS copies, CAST(sum(CAST(l_extendedprice AS DOUBLE)) / 1000 AS DOUBLE) AS mdl, avg(CAST(l_discount AS DOUBLE)) * 4 AS divergence FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_size)"


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, seq): the letters of each document as bases; near copies stay near copies."""
    letters = F.lower(F.regexp_replace("text", "[^A-Za-z]", ""))
    return table(spark, sf_dir, "documents").filter("text is not null").select(F.col("doc_id").alias("id"), F.translate(letters, LETTERS, BASES).alias("seq"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, seq): the letters of each document as they are, of either case."""
    return table(spark, sf_dir, "documents").filter("text is not null").select(F.col("doc_id").alias("id"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chrom, s, e, strand, fam, dvg, o, ln): line items as intervals, 0-based and half open."""
    start = F.col("l_orderkey") * 50 + F.col("l_linenumber") * 37
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5 + 1).cast("string")).alias("chrom"), start.alias("s"), (start + F.floor("l_quantity").cast("long") * 4).alias("e"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"), F.col("l_partkey").alias("fam"), F.col("l_discount").cast("double").alias("dvg"), F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("ln"),
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q, subject, strand, gmin, gmax, qstart, qend, qlen, pident, score, o, ln): line items as alignments, 1-based and closed."""
    start = F.col("l_orderkey") * 50 + F.col("l_linenumber") * 37
    width = F.floor("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("q"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 5 + 1).cast("string")).alias("subject"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        (start + 1).alias("gmin"), (start + width * 4).alias("gmax"), (F.col("l_linenumber") * 40 - 39).alias("qstart"), (F.col("l_linenumber") * 40 + width).alias("qend"), F.lit(400).alias("qlen"),
        (100 - 100 * F.col("l_discount").cast("double")).alias("pident"), F.col("l_extendedprice").cast("double").alias("score"), F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("ln"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, length, copies, mdl, divergence): parts as families, their line items as copies."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("copies"), (F.sum(F.col("l_extendedprice").cast("double")) / 1000).alias("mdl"), (F.avg(F.col("l_discount").cast("double")) * 4).alias("divergence"))
    return table(spark, sf_dir, "part").join(lines, F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_partkey").alias("id"), (F.col("p_size") * 60).alias("length"), "copies", "mdl", "divergence")
