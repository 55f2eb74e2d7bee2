"""Sequences of padded regions, from a genome cut into tiles, so that neither a chromosome nor an index has to fit in a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import seq as S

TILE = 1 << 16


def tiles(genome: DataFrame, width: int = TILE) -> DataFrame:
    """(chrom, tile, piece) of a genome (chrom, seq)."""
    return genome.select("chrom", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s)(.{{1,{width}}})"), 1)).alias("tile", "piece"))


def usual_pad(length: Column, share: float = 0.2, least: int = 50, most: int = 500) -> Column:
    """Flanks in proportion to an element, within bounds."""
    return F.floor(F.least(F.lit(float(most)), F.greatest(F.lit(float(least)), share * length))).cast("long")


def padded(instances: DataFrame, lengths: DataFrame, pad: Column) -> DataFrame:
    """instances (chrom, s, e, ...) with s1 and e1, the padded region, 1-based and closed, inside its chromosome (chrom, length).

    Instances on unknown chromosomes, and those whose region is empty, go.
    """
    rows = instances.join(lengths.select("chrom", F.col("length").alias("__length")), "chrom").withColumn("__pad", pad)
    rows = rows.withColumns({"s1": F.greatest(F.lit(1), F.col("s") + 1 - F.col("__pad")), "e1": F.least("__length", F.col("e") + F.col("__pad"))})
    return rows.filter("e1 >= s1").drop("__length", "__pad")


def region_sequences(regions: DataFrame, genome_tiles: DataFrame, width: int = TILE) -> DataFrame:
    """(chrom, s1, e1, seq) of distinct regions: each meets the tiles that it touches by an equal-key join."""
    first, last = F.floor((F.col("s1") - 1) / width), F.floor((F.col("e1") - 1) / width)
    wanted = regions.select("chrom", "s1", "e1").distinct().withColumn("tile", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    begin = F.greatest(F.col("s1") - 1 - F.col("tile") * width, F.lit(0))
    end = F.least(F.col("e1") - F.col("tile") * width, F.lit(width))
    pieces = wanted.join(genome_tiles, ["chrom", "tile"]).select("chrom", "s1", "e1", "tile", F.substring("piece", (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece"))
    parts = F.array_sort(F.collect_list(F.struct("tile", "piece")))
    return pieces.groupBy("chrom", "s1", "e1").agg(F.array_join(F.transform(parts, lambda x: x["piece"]), "").alias("seq"))


def padded_copies(instances: DataFrame, genome: DataFrame, pad: Column | None = None, width: int = TILE) -> DataFrame:
    """instances (chrom, s, e, strand, ...) with their padded sequence on their own strand, and where in it the element lies.

    te_start and te_end are 0-based and half open. `pad` is computed for each instance, by its own length by default.
    """
    lengths = genome.select("chrom", F.length("seq").cast("long").alias("length"))
    rows = padded(instances, lengths, usual_pad(F.col("e") - F.col("s")) if pad is None else pad)
    rows = rows.join(region_sequences(rows, tiles(genome, width), width), ["chrom", "s1", "e1"])
    n, turned = F.length("seq"), F.col("strand") == "-"
    a, b = F.col("s") - F.col("s1") + 1, F.col("e") - F.col("s1") + 1
    rows = rows.withColumns({"te_start": F.greatest(F.lit(0), F.when(turned, n - b).otherwise(a)), "te_end": F.least(n, F.when(turned, n - a).otherwise(b))})
    return rows.withColumn("seq", F.when(turned, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
