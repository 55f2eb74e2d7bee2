"""Row gates: the first reason that applies rejects a row, and tiers by quantiles.

Thresholds are parameters; their defaults are the usual ones. Gates read columns by the names that they state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.operators.graph import written


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, null if none does. A rule that is null doesn't hold."""
    return reduce(lambda acc, rule: acc.when(F.coalesce(rule[1], F.lit(False)), rule[0]), rules[1:], F.when(F.coalesce(rules[0][1], F.lit(False)), rules[0][0]))


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    return df.groupBy(F.coalesce(reason, F.lit("pass")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def steps(value: Column, bands: list[tuple[float, object]], otherwise: object) -> Column:
    """The result of the first band whose limit is above value."""
    return reduce(lambda acc, b: acc.when(value < b[0], b[1]), bands[1:], F.when(value < bands[0][0], bands[0][1])).otherwise(otherwise)


def with_quantiles(df: DataFrame, column: str, quantiles: dict[str, float]) -> DataFrame:
    """df with exact, linearly interpolated quantiles of a column over all rows.

    The values are counted first, so the ranks are found among distinct values: these are dealt into ranges, each is
    summed up by itself, and one row for each range meets in a task.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__total"))
    # the bits of a double, less those that order similar values, deal them into ranges that need no sampling
    ranged = counts.withColumn("range", F.floor(F.signum("v") * F.log2(1 + F.abs("v")) * 64).cast("long"))
    sizes = ranged.groupBy("range").agg(F.sum("n").alias("size"))
    sizes = sizes.select(F.col("range").alias("r"), F.coalesce(F.sum("size").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    upto = F.sum("n").over(W.partitionBy("range").orderBy("v"))
    ranked = ranged.withColumn("upto", upto).join(sizes, F.col("range") == F.col("r")).withColumn("last", F.col("before") + F.col("upto") - 1)
    ranked = ranked.join(F.broadcast(total))
    at = lambda k: F.min(F.when(F.col("last") >= k, F.col("v")))
    found = []
    for name, q in quantiles.items():
        place = F.lit(q) * (F.col("__total") - 1)
        found += [at(F.floor(place)).alias(f"{name}__a"), at(F.ceil(place)).alias(f"{name}__b"), F.first(place - F.floor(place)).alias(f"{name}__f")]
    row = ranked.agg(F.first("__total").alias("__known"), *found)
    named = row.select(*((F.col(f"{x}__a") + (F.col(f"{x}__b") - F.col(f"{x}__a")) * F.col(f"{x}__f")).alias(x) for x in quantiles))
    return df.join(F.broadcast(df.agg(F.count(F.lit(1)).alias("__n")))).join(F.broadcast(named))


def mdl_tiers(records: DataFrame) -> DataFrame:
    """records with mpc (mdl for each copy) and tier T1, T2 or T3."""
    rows = with_quantiles(records.withColumn("mpc", F.col("mdl") / F.greatest("copies", F.lit(1))), "mpc", {"__p25": 0.25, "__p75": 0.75})
    high = F.when(F.col("__n") < 100, F.lit(20.0)).otherwise(F.col("__p75"))
    low = F.when(F.col("__n") < 100, F.lit(5.0)).otherwise(F.col("__p25"))
    first = (F.col("mpc") >= high) | ((F.col("copies") >= 50) & (F.col("length") >= 80))
    tier = F.when(first & (F.coalesce("divergence", F.lit(0.0)) > 0.20), "T2").when(first, "T1").when(F.col("mpc") < low, "T3").otherwise("T2")
    rows = rows.withColumn("tier", tier)
    counted = rows.agg((F.count_if(F.col("tier") == "T2") > 10_000).alias("__many"))
    rows = rows.join(F.broadcast(counted))
    tier = F.when(F.col("__many") & (F.col("tier") == "T2") & (F.col("length") < 200), "T1").otherwise(F.col("tier"))
    return rows.withColumn("tier", tier).drop("__p25", "__p75", "__n", "__many")


def library_flags(records: DataFrame) -> DataFrame:
    """records with masking and analysis: which library each belongs to; masking is part of analysis."""
    length, copies = F.col("length"), F.col("copies")
    least = F.when(length >= 500, 2).when(length >= 200, 3).when(length >= 100, 5).otherwise(10)
    masking = F.col("tier").isin("T1", "T2") & (copies >= least)
    return records.withColumn("masking", masking).withColumn("analysis", masking | ((F.col("tier") == "T3") & (copies >= 3)))


def least_copies(genome_mb: Column) -> Column:
    """The recurrence floor of a genome's size; 3 where it is unknown."""
    return F.when(genome_mb.isNull(), 3).otherwise(steps(genome_mb, [(100, 3), (500, 4), (1000, 5), (3000, 6)], 8))


def low_copy_dropped(copies: Column, genomic: Column, length: Column, genome_mb: Column, hard: int = 0) -> Column:
    c = F.coalesce(genomic, copies)
    return ((F.lit(hard) > 0) & (c < hard)) | ((c < least_copies(genome_mb)) & (length < 200))


def triage_rules(entropy: tuple[float, float] = (1.0, 0.8), entropy2: tuple[float, float] = (2.0, 1.6), least_length: int = 50, least_mdl: float = 0.0, most_n: float = 0.2, most_dust: float = 0.7, most_simple: float = 0.6) -> list[tuple[str, Column]]:
    """Why a family is no input, first reason first: (topology, length, copies, mdl, n_fraction, h1, dust, h2, simple_fraction).

    Entropies have a limit for sequences of 100 bases or more, and one for shorter ones.
    """
    quality = _quality_rules(entropy, entropy2, most_dust, most_simple)
    first = [("cyclic_topology", F.col("topology") == "cyclic"), ("too_short", F.col("length") < least_length), ("single_copy", F.col("copies") <= 1), ("low_mdl", F.col("mdl") <= least_mdl)]
    return [*first, ("high_n", F.col("n_fraction") > most_n), *quality]


def final_rules(entropy: tuple[float, float] = (1.0, 0.8), entropy2: tuple[float, float] = (2.0, 1.6), least_length: int = 50, most_n: float = 0.2, most_dust: float = 0.7, most_simple: float = 0.6) -> list[tuple[str, Column]]:
    """Why a consensus is no output: the same limits, with unknown bases last."""
    return [("too_short", F.col("length") < least_length), *_quality_rules(entropy, entropy2, most_dust, most_simple), ("high_n", F.col("n_fraction") > most_n)]


def _quality_rules(entropy: tuple[float, float], entropy2: tuple[float, float], most_dust: float, most_simple: float) -> list[tuple[str, Column]]:
    by_length = lambda limits: F.when(F.col("length") >= 100, limits[0]).otherwise(limits[1])
    return [("low_entropy", F.col("h1") < by_length(entropy)), ("dust", F.col("dust") > most_dust), ("low_entropy2", F.col("h2") < by_length(entropy2)), ("simple_fraction", F.col("simple_fraction") > most_simple)]


def insertion_rules(least_length: int = 100, most_length: int = 30_000, most_n: float = 0.2, entropy: tuple[float, float] = (1.0, 0.8), most_dust: float = 0.7) -> list[tuple[str, Column]]:
    """Why an inserted sequence (length, n_share, h1, dust) goes, in order; entropy has one limit from 100 bases on and one below."""
    length = F.col("length")
    least_entropy = F.when(length >= 100, entropy[0]).otherwise(entropy[1])
    return [("short", length < least_length), ("long", length > most_length), ("high_n", F.col("n_share") > most_n), ("low_entropy", F.col("h1") < least_entropy), ("high_dust", F.col("dust") > most_dust)]


def loadable(length: Column, n_share: Column, gc: Column, lengths: tuple[int, int] = (50, 50_000), most_n: float = 0.2, gcs: tuple[float, float] = (0.1, 0.9)) -> Column:
    """Whether a sequence enters the repeat finder."""
    return length.between(*lengths) & (n_share <= most_n) & gc.between(*gcs)


def validity_checks(length: Column, n_share: Column, gc: Column, ambiguous: Column, entropy: Column, lengths: tuple[int, int] = (50, 20_000), gcs: tuple[float, float] = (0.1, 0.9), most_n: float = 0.15, most_ambiguous: float = 0.2, least_entropy: float = 0.8) -> dict[str, Column]:
    """The checks of a consensus by name; limits of shares and entropy themselves don't pass."""
    return {"ok_len": length.between(*lengths), "ok_gc": (gc > gcs[0]) & (gc < gcs[1]), "ok_n": n_share < most_n, "ok_ambiguity": ambiguous < most_ambiguous, "ok_entropy": entropy > least_entropy}


def recall_eligible(n: Column, spread: Column, expected: Column, few: int = 5, least_spread: float = 0.31, least_for_spread: int = 2) -> Column:
    """Whether copies are worth looking for: few are known, and they are spread wide or fewer than the length lets expect."""
    wide = F.coalesce((spread >= least_spread) & (n >= least_for_spread), F.lit(False))
    return (n < few) & (wide | (n < expected))


def flank_kept(start: Column, end: Column, length: Column, least: float = 0.3, most: float = 0.7, margin: int = 30, retain: int = 100) -> tuple[Column, Column]:
    """First and last base to keep of a sequence whose bases from start to end, 1-based, are like a host gene.

    Cut if they are a share of the length from `least` to under `most`, reach within `margin` of one end alone, and leave
    `retain` bases.
    """
    cover = (end - start + 1) / length
    partial, head, tail = (cover >= least) & (cover < most), start <= margin, end >= length - margin
    return F.when(partial & head & ~tail & (length - end >= retain), end + 1).otherwise(F.lit(1)), F.when(partial & tail & ~head & (start - 1 >= retain), start - 1).otherwise(length)


def even_stride(copies: DataFrame, by: str, order: list[str], length: str, cap: int = 150, most_times: float = 5.0) -> DataFrame:
    """At most `cap` copies of each family, at even steps in their order, with their place k before the cap.

    First, copies of over `most_times` the length that nine tenths have at most go, unless that leaves fewer than two.
    """
    size = W.partitionBy(by)
    ranked = copies.withColumns({"__r": F.row_number().over(size.orderBy(length, *order)) - 1, "__n": F.count(F.lit(1)).over(size)})
    usual = F.max(F.when(F.col("__r") == F.least(F.col("__n") - 1, F.floor(F.col("__n") * 0.9)), F.col(length))).over(size)
    fits = ranked.withColumn("__fits", (F.col("__n") <= 2) | (F.col(length) <= most_times * usual))
    fits = fits.withColumn("__left", F.count_if("__fits").over(size)).filter(F.col("__fits") | (F.col("__left") < 2))
    fits = fits.withColumns({"k": (F.row_number().over(size.orderBy(*order)) - 1).cast("long"), "__n": F.count(F.lit(1)).over(size)})
    slot = F.ceil(F.col("k") * float(cap) / F.col("__n"))
    kept = (F.col("__n") <= cap) | ((F.floor(slot * F.col("__n") / cap) == F.col("k")) & (slot < cap))
    return fits.filter(kept).drop("__r", "__n", "__fits", "__left")


def chimera_eligible(topology: Column, tier: Column, length: Column, least: dict[str, int] | None = None) -> Column:
    """Whether a family may be cut: complex ones always, others by tier and length; a tier without a limit never, no tier is T2."""
    least = least or {"T1": 300, "T2": 150}
    tier = F.coalesce(tier, F.lit("T2"))
    by_tier = reduce(lambda acc, x: acc | ((tier == x[0]) & (length >= x[1])), least.items(), F.lit(False))
    return F.coalesce(topology == "complex", F.lit(False)) | by_tier


def discovery_gate(families: DataFrame, least_members: int = 5, least_length: int = 100) -> DataFrame:
    """families (members, length, ...) with enough members, a header without them counting as enough, and long enough."""
    return families.filter((F.coalesce("members", F.lit(least_members)) >= least_members) & (F.col("length") >= least_length))


def with_bound(families: DataFrame, genome_mb: float, per_mb: float = 15.0) -> DataFrame:
    """families with `within`: whether there are at most `per_mb` of them for each Mb of the genome; true where its size is unknown."""
    if genome_mb <= 0:
        return families.withColumn("within", F.lit(True))
    bound = families.agg((F.count(F.lit(1)) <= per_mb * genome_mb).alias("within"))
    return families.join(F.broadcast(bound))


def within_bound(families: DataFrame, genome_mb: float, per_mb: float = 15.0) -> DataFrame:
    """families as they are; reading them fails if there are more than `per_mb` for each Mb of a known genome."""
    if genome_mb <= 0:
        return families
    bound = families.agg(F.count(F.lit(1)).alias("__count"))
    told = F.concat(F.lit("families for this genome: "), F.col("__count").cast("string"), F.lit(f", bound {per_mb * genome_mb}"))
    return families.join(F.broadcast(bound)).filter(F.assert_true(F.col("__count") <= per_mb * genome_mb, told).isNull()).drop("__count")


def candidate_class(score: Column, length: Column, complexity: Column, cut_a: Column, cut_b: Column, least_length: int = 80, least_complexity: float = 0.3) -> Column:
    """A, B or C by score, or `rejected`: only what is below both cuts, short and simple at once is not rescued."""
    rejected = (score < cut_b) & (length < least_length) & (complexity < least_complexity)
    return F.when(rejected, "rejected").when(score >= cut_a, "A").when(score >= cut_b, "B").otherwise("C")


def candidate_rules(least_length: int = 50, least_identity: float = 40.0, long_length: int = 500, trusted: tuple[str, ...] = ("A",)) -> list[tuple[str, Column]]:
    """Why a candidate (length, identity, copies, class, structural) is left out."""
    good = (F.col("length") >= long_length) | F.col("class").isin(*trusted) | F.col("structural")
    none = (F.col("copies") < 1) & ~F.col("class").isin("A", "B") & (F.col("length") < 200)
    return [("too_short", F.col("length") < least_length), ("low_identity", (F.col("identity") < least_identity) & ~good), ("no_copies", none)]


def before_masklevel(name: Column, begin: Column, end: Column, score: Column, least_score: float = 500.0) -> Column:
    """Whether a hit is kept before domination is looked at: parts of SVA that are LTR5, and weak LAVA, go."""
    ltr5 = ((begin >= 855) & (end < 1270)) | ((begin >= 1263) & (end < 1372))
    return ~((name.startswith("SVA") & ltr5) | (name.startswith("LAVA") & (score < least_score)))


def adjusted_divergence(divergence: Column, insertions: Column) -> Column:
    """Per cent of divergence over what isn't inserted; as it is where all is."""
    return F.when(insertions < 100, 100 * divergence / (100 - insertions)).otherwise(divergence)


def gene_excluded(hits: DataFrame, records: DataFrame, least_identity: float = 35.0, certain: float = 0.7, likely: float = 0.5) -> DataFrame:
    """records (id, has_signal, ...) with `cov`, the best protein coverage of hits (q, width, qlen, pident), and `excluded`.

    A base triplet is one residue. Coverage of `certain` excludes any record, of `likely` one without signal of its own.
    """
    cov = hits.filter((F.col("pident") >= least_identity) & (F.col("qlen") > 0)).groupBy("q").agg(F.max(F.col("width") * 3.0 / F.col("qlen")).alias("cov"))
    rows = records.join(cov, F.col("id") == F.col("q"), "left").drop("q").withColumn("cov", F.coalesce("cov", F.lit(0.0)))
    return rows.withColumn("excluded", (F.col("cov") >= certain) | ((F.col("cov") >= likely) & ~F.coalesce("has_signal", F.lit(False))))


def foreign_routes(records: DataFrame, organelle: DataFrame, rrna: DataFrame, tandem: DataFrame, least_identity: float = 80.0, least_cover: float = 0.5, least_tandem: float = 0.5) -> DataFrame:
    """records (id, length, ...) with `route`: organelle, rrna, satellite, or te, the first that holds.

    organelle: hits (q, width, qlen, pident) whose widths, overlaps counted twice, reach a share of the query; rrna: any
    row (q); tandem: spans (q, s, e), 1-based and closed, whose sum reaches a share of the record.
    """
    far = organelle.filter((F.col("pident") >= least_identity) & (F.col("qlen") > 0)).groupBy(F.col("q").alias("id")).agg((F.sum("width") / F.max("qlen")).alias("__o"))
    some = rrna.select(F.col("q").alias("id")).distinct().withColumn("__r", F.lit(True))
    turns = tandem.groupBy(F.col("q").alias("id")).agg(F.sum(F.col("e") - F.col("s") + 1).alias("__t"))
    rows = records.join(far, "id", "left").join(some, "id", "left").join(turns, "id", "left")
    satellite = (F.col("length") > 0) & (F.col("__t") / F.col("length") >= least_tandem)
    return rows.withColumn("route", F.when(F.col("__o") >= least_cover, "organelle").when(F.col("__r"), "rrna").when(satellite, "satellite").otherwise("te")).drop("__o", "__r", "__t")


def splits(n: Column, spread: Column, cv: Column, std: Column, least: int = 5, most_spread: float = 20.0, most_cv: float = 0.3, many: int = 20, most_std: float = 5.0) -> Column:
    """Whether a family's hits are varied enough to be subfamilies: range of identities, variation of lengths, or deviation of many."""
    return (n >= least) & ((spread > most_spread) | (cv > most_cv) | ((n > many) & (std > most_std)))


def pseudo_family(n: Column, median: Column, homologous: Column, fallback: Column, coherent: Column, verified: Column, least: int = 5, most_identity: float = 0.45, most_homologous: float = 0.25, least_coherent: int = 1) -> Column:
    """Why a family is kept, or `pseudo`: no cluster formed, enough copies, alike neither at the median nor in pairs, none like the seed.

    A recall that failed (verified is false), and coherence that couldn't be measured (null), keep it.
    """
    return (
        F.when(F.coalesce(~verified, F.lit(False)), "unverified")
        .when(~fallback, "clustered")
        .when(n < least, "few_copies")
        .when((median >= most_identity) | (homologous >= most_homologous), "coherent")
        .when(coherent.isNull() | (coherent >= least_coherent), "seed_coherent")
        .otherwise("pseudo")
    )


def stratified(rows: DataFrame, by: str, cap: int, value: str, size: str, ties: list[str], most_strata: int = 10) -> DataFrame:
    """rows with `stratum` and `place`, at most `cap` for each `by`: one of each stratum of value in turn, the largest first.

    Families over the cap have min(most_strata, n // cap + 1) strata of equal counts, the first ones larger by one;
    others are kept whole, in one stratum.
    """
    w = W.partitionBy(by)
    n = F.count(F.lit(1)).over(w)
    strata = F.when(n <= cap, 1).otherwise(F.least(F.lit(most_strata), F.greatest(F.lit(1), F.floor(n / cap) + 1)))
    rows = rows.withColumns({"__k": F.row_number().over(w.orderBy(value, *ties)) - 1, "__n": n, "__strata": strata})
    base, more = F.floor(F.col("__n") / F.col("__strata")), F.col("__n") % F.col("__strata")
    large = more * (base + 1)
    stratum = F.when(F.col("__k") < large, F.floor(F.col("__k") / (base + 1))).otherwise(more + F.floor((F.col("__k") - large) / base))
    rows = rows.withColumn("stratum", (stratum + 1).cast("long"))
    rows = rows.withColumn("__r", F.row_number().over(W.partitionBy(by, "stratum").orderBy(F.desc(size), *ties)))
    rows = rows.withColumn("place", F.row_number().over(w.orderBy("__r", "stratum")).cast("long")).filter(F.col("place") <= cap)
    return rows.drop("__k", "__n", "__strata", "__r")


def placed(rows: DataFrame, order: list[Column], out: str = "place") -> DataFrame:
    """rows with their place, from 1, in a total order: they are dealt into ranges of it, and each range counts those before it.

    The dealt rows are written, so that both uses see the same ranges.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    here = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    # one row for each shuffle partition
    return dealt.withColumn("__here", here).join(F.broadcast(before), F.col("__range") == F.col("__r")).withColumn(out, (F.col("__before") + F.col("__here")).cast("long")).drop("__range", "__r", "__here", "__before")
