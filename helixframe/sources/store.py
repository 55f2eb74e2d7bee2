"""A store of families as Parquet tables: `families` by accession, `by_stage` and `by_taxon` beside it (operator A24).

A family (accession, name, search_stages, buffer_stages, clades, ...) is linked with each stage that its two lists name,
separated by commas, and with each of its clades. Links are written before the families: what a lost driver leaves are
links without a family, which no lookup returns, and the append can be run again.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.graph import lookup, written

#: Folders of families and of taxa.
BINS = 64
#: The stage that stands for all, and what stage 95 stands for.
EVERY_STAGE, STAGE_LISTS = 80, {95: ["35", "50", "55", "60", "65", "70", "75"]}


def bin_of(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(BINS)).cast("int")


def tokens(families: DataFrame, asked: bool) -> DataFrame:
    """(token, accession): the names that a family takes; asked: those that must be free for it."""
    names = [F.col("accession"), F.col("name"), *([F.concat("accession", F.lit("v"))] if asked else [])]
    return families.select("accession", F.explode(F.array_distinct(F.array(*names))).alias("token")).filter("token is not null")


def unclaimed(families: DataFrame) -> DataFrame:
    """The families, of unique accessions, that a pass in their order takes: those whose names none before has taken.

    One that asks for no name of an earlier one is taken by any such pass. All that ask for its names go, and what is left
    is looked at again; each round ends in a written table.
    """
    left, taken = written(families, "families"), None
    while not left.isEmpty():
        asked = tokens(left, True)
        first = tokens(left, False).groupBy("token").agg(F.min("accession").alias("first"), F.count(F.lit(1)).alias("n"))
        waits = lookup(asked, first, "token", "n").filter(F.col("first") < F.col("accession")).select("accession").distinct()
        new = written(left.join(waits, "accession", "left_anti").select(families.columns), "families")
        taken = new if taken is None else taken.unionByName(new)
        gone = asked.join(tokens(new, False).select("token"), "token", "left_semi").select("accession").distinct()
        left = written(left.join(gone, "accession", "left_anti").select(families.columns), "families")
    return families.limit(0) if taken is None else taken


def stage_links(families: DataFrame) -> DataFrame:
    """(stage, accession, search): search says whether it is a search stage, not a buffer stage alone."""
    listed = lambda c, search: F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.struct(F.trim(F.split(x, "\\[")[0]).alias("stage"), F.lit(search).alias("search")))
    rows = families.select("accession", F.explode(F.concat(listed(F.col("search_stages"), True), listed(F.col("buffer_stages"), False))).alias("x"))
    return rows.select("accession", "x.*").filter("stage <> ''").groupBy("stage", "accession").agg(F.bool_or("search").alias("search"))


def held(spark: SparkSession, store: str, part: str) -> DataFrame | None:
    """A table of the store, or None if the store isn't there yet."""
    try:
        return spark.read.parquet(f"{store}/{part}")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def append(families: DataFrame, store: str) -> DataFrame:
    """Those of families that were new, appended to the store and its links.

    A family is refused if its accession, the accession with a `v`, or its name is an accession or a name that the store or
    an earlier family of the batch has, in the order of accessions; of equal accessions the first by name stands for all.
    A null name takes none; a row without accession is left out.
    """
    spark, columns = families.sparkSession, families.columns
    others = [c for c in columns if c not in ("accession", "name")]
    rows = families.filter("accession is not null").groupBy("accession").agg(F.min_by(F.struct(*others), F.struct(F.coalesce("name", F.lit("")), F.to_json(F.struct(*others)))).alias("r"), F.min(F.coalesce("name", F.lit(""))).alias("name"))
    rows = rows.select("accession", F.nullif("name", F.lit("")).alias("name"), "r.*").select(columns)
    old = held(spark, store, "families")
    if old is not None:
        known = old.select(F.col("accession").alias("token")).union(old.select("name")).distinct()
        rows = rows.join(tokens(rows, True).join(known, "token", "left_semi").select("accession").distinct(), "accession", "left_anti").select(columns)
    fresh = written(unclaimed(rows), "families")
    # a salt deals out a stage or taxon that most families have
    salt = F.pmod(F.xxhash64("accession"), F.lit(16))
    stage_links(fresh).repartition("stage", salt).write.mode("append").partitionBy("stage").parquet(f"{store}/by_stage")
    taxa = fresh.select("accession", F.explode(F.array_distinct("clades")).alias("taxon")).filter("taxon is not null").withColumn("bin", bin_of(F.col("taxon")))
    taxa.repartition("bin", salt).sortWithinPartitions("bin", "taxon").write.mode("append").partitionBy("bin").parquet(f"{store}/by_taxon")
    fresh.withColumn("bin", bin_of(F.col("accession"))).repartition("bin").sortWithinPartitions("bin", "accession").write.mode("append").partitionBy("bin").parquet(f"{store}/families")
    return fresh


def by_accession(spark: SparkSession, store: str, accession: str) -> DataFrame:
    """The family of an accession; only its folder is read."""
    place = zlib.crc32(accession.encode()) % BINS
    return spark.read.parquet(f"{store}/families").filter((F.col("bin") == place) & (F.col("accession") == accession)).drop("bin")


def by_name(spark: SparkSession, store: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{store}/families").filter(F.col("name") == name).drop("bin")


def lineage(taxonomy: DataFrame, taxon: str, ancestors: bool, descendants: bool) -> DataFrame:
    """(taxon) itself, and those above or below it in a forest (id, parent); the walk starts at the taxon."""
    spark = taxonomy.sparkSession
    steps = [("t.parent", "t.id = w.id AND t.parent IS NOT NULL")] * ancestors + [("t.id", "t.parent = w.id")] * descendants
    nodes = taxonomy.filter(F.col("id") == taxon).select(F.col("id").alias("taxon"))
    for reached, on in steps:
        walk = f"WITH RECURSIVE w(id) AS (SELECT id FROM {{t}} WHERE id = :taxon UNION ALL SELECT {reached} FROM w JOIN {{t}} t ON {on}) SELECT id AS taxon FROM w"
        nodes = nodes.union(spark.sql(walk, args={"taxon": taxon}, t=taxonomy))
    return nodes.distinct()


def selected(
    spark: SparkSession, store: str, taxonomy: DataFrame | None = None, taxon: str | None = None, ancestors: bool = False, descendants: bool = False,
    curated: bool | None = None, stage: int | None = None, is_hmm: bool = False, kind: str | None = None, name: str | None = None,
) -> DataFrame:
    """The families of a store that pass all filters given, each once.

    taxon: those linked with it and, as asked, with taxa above and below it in taxonomy (id, parent). curated: whether the
    accession isn't DR with seven digits. stage: 80 is any, 95 stands for a list; with is_hmm it must be a search stage.
    kind: how `type/subtype` begins; name: how the name begins, both in any case.
    """
    rows = spark.read.parquet(f"{store}/families").drop("bin")
    if curated is not None:
        rows = rows.filter(F.col("accession").rlike("^DR[0-9]{7}$") != F.lit(curated))
    if kind:
        full = F.when(F.coalesce("subtype", F.lit("")) != "", F.concat("type", F.lit("/"), "subtype")).otherwise(F.col("type"))
        rows = rows.filter(F.lower(full).startswith(kind.lower()))
    if name:
        rows = rows.filter(F.lower("name").startswith(name.lower()))
    if stage and stage != EVERY_STAGE:
        links = spark.read.schema("accession string, search boolean, stage string").parquet(f"{store}/by_stage").filter(F.col("stage").isin(STAGE_LISTS.get(stage, [str(stage)])))
        rows = rows.join(links.filter("search") if is_hmm else links, "accession", "left_semi")
    if taxon is not None:
        nodes = lineage(taxonomy, taxon, ancestors, descendants).withColumn("bin", bin_of(F.col("taxon")))
        links = spark.read.parquet(f"{store}/by_taxon").join(nodes, ["bin", "taxon"], "left_semi")
        rows = rows.join(links, "accession", "left_semi")
    return rows
