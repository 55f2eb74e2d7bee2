"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are lower-cased in A-Z and split into pieces, those into words; no phrase leaves its piece. The graph of a
language has an edge for each distinct phrase of `longest` words, from its first to its last longest - 1 words, which
are the nodes, and the edge's weight is how often the phrase occurs. Each place of a piece gives one row: the edge that
starts there or, too near to the piece's end, what is left of the piece, as a correction. Shorter counts are derived:
a phrase occurs as often as edges and ends that start with it.

Tasks count their texts in steps, and one shuffle by language and bucket, a hash of the node, brings all that leaves a node
together; edges, node flows and shorter counts are added up from it. A task sends one row for each bucket, with its edges
and ends as sorted lines of text: rows of their own would take twice the bytes. Only phrases of `least` or more go on, and
so words, pairs of words and edges that occur less often are cut before the shuffle: what stands before the cut becomes an
end. The filters are bitmaps of fixed sizes over counted hashes, which may keep a rare phrase but never drop a frequent
one: counts are exact.

Where an edge carries all that its two nodes carry, these are one unary path. Such paths are compacted to one row each
by doubling steps (a path is no longer than a piece), and candidates are read from the paths and from the edges between
them: inside a path all phrases weigh the same, and a node of a longer path is always part of a longer phrase that
occurs as often.

A candidate's score is floor(1e6 a^2 / (l r)) at its worst cut into l and r, in decimals of 38 digits. A candidate
that lies inside a longer one with at least `inside` per cent of its count is dropped; as a longer candidate's parts
are as frequent, those of one word more decide.

Defined results: null text is empty; a null language is `und`, as one of that name; ids are not read; repeated rows
count as often as they occur; languages without candidates give no rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.common import Words, lookup, slices, utf8, written
from helixframe.llm.near_dup import mixed
from helixframe.operators.graph import linear_chains

LONGEST, LEAST, INSIDE, TOP = 3, 10, 50, 2000
#: Buckets of the filters of words, and of pairs and longer phrases: a byte each while a task counts (64 MB at most), a bit
#: each in the filter; they are added up in blocks.
WORD_BITS, PAIR_BITS, BLOCK = 1 << 24, 1 << 26, 1 << 16
#: Bytes of text that a task counts at a time.
STEP_BYTES = 1 << 22
#: Rows of edges and ends that a task holds to add them up before they are shuffled.
MOST_HELD = 2_000_000
#: Buckets of a language's nodes; a task sends at most a row for each, whatever the number of partitions.
BUCKETS = 1 << 13
#: The first rows of a language are chosen in so many parts, then from these.
PARTS = 256
#: For each byte: itself in lower case, a tab as a space, and the end of a piece as a line break.
BYTES = np.array([10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
U = np.uint64


class Pieces:
    """The words of some texts as numbers, a hash of each with its language, and whether a piece ends after it."""

    def __init__(self, part: pa.RecordBatch) -> None:
        data, starts = utf8(part.column("text"))
        data = BYTES[data]
        words = Words(data, starts)
        breaks = np.flatnonzero(data == 10)
        ends = np.searchsorted(breaks, words.start)
        self.last = np.ones(len(ends), bool)
        self.last[:-1] = (ends[1:] != ends[:-1]) | (words.text[1:] != words.text[:-1])
        coded = part.column("lang").dictionary_encode()
        self.langs, self.lang = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.text]
        self.word, self.words = words.numbers()
        by_lang = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs.to_pylist()], U)
        by_word = np.array([xxhash.xxh3_64_intdigest(x) for x in self.words.to_pylist()], U)
        self.hash = mixed(by_lang[self.lang] * U(0x9E3779B97F4A7C15) + by_word[self.word]) if len(self.word) else np.zeros(0, U)

    def phrases(self, longest: int) -> np.ndarray:
        """A hash of each word and those that follow, for all places with so many left."""
        n = max(len(self.hash) - longest + 1, 0)
        out = np.zeros(n, U)
        for k in range(longest):
            out = mixed(out * U(0xC2B2AE3D27D4EB4F) + self.hash[k : k + n])
        return out

    def pairs(self) -> np.ndarray:
        return self.phrases(2)

    def goes_on(self, kept: tuple[bytes, ...]) -> np.ndarray:
        """Whether a frequent phrase may pass from each word to the next: by the filter of words and, if there, that of pairs."""
        usual, on = marked(kept[0], self.hash), np.zeros(len(self.hash), bool)
        on[:-1] = usual[:-1] & usual[1:] & ~self.last[:-1]
        if len(kept) > 1 and len(on):
            on[:-1] &= marked(kept[1], self.pairs())
        return on

    def whole(self, longest: int, on: np.ndarray) -> np.ndarray:
        """Of the places with `longest` words left, those from which a phrase may go that far."""
        n = max(len(on) - longest + 1, 0)
        out = np.ones(n, bool)
        for k in range(longest - 1):
            out &= on[k : k + n]
        return out


def rows_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def marked(filter_bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bits set."""
    bits = np.frombuffer(filter_bits, np.uint8)
    at = (hashes & U(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bitmap(rows: DataFrame, hashes, least: int, size: int) -> bytes:
    """A filter of the hashes, of each step's `hashes(part)`, that occur `least` times in all.

    A task counts in one byte for each of `size` buckets; a bucket that fills its byte counts as frequent. Blocks of
    counters, as distances between those above 0 and their values, are added up by block, and their bits come to the
    driver: size / 8 bytes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, ruler = np.zeros(size, np.uint8), np.arange(0, BLOCK, 255)
        for part in slices(batches, "text", STEP_BYTES):
            at, n = np.unique((hashes(part) & U(size - 1)).astype(np.int64), return_counts=True)
            counters[at] = np.minimum(counters[at] + n, 255)
        for k in range(0, size, BLOCK):
            block = counters[k : k + BLOCK]
            if block.any():
                # no distance is over 255, as the ruler's places are listed too
                places = np.union1d(np.flatnonzero(block), ruler)
                steps = np.diff(places, prepend=0).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([steps.tobytes()]), pa.array([block[places].tobytes()])], names=["block", "steps", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(BLOCK, np.int64)

        def bits() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()])], names=["block", "bits"])

        for batch in batches:
            for k, steps, n in zip(*(batch.column(c).to_pylist() for c in ("block", "steps", "n")), strict=True):
                if k != block:
                    if block is not None:
                        yield bits()
                    block, total = k, np.zeros(BLOCK, np.int64)
                values = np.frombuffer(n, np.uint8).astype(np.int64)
                values[values == 255] = least
                total[np.cumsum(np.frombuffer(steps, np.uint8), dtype=np.int64)] += values
        if block is not None:
            yield bits()

    counted = rows.mapInArrow(count, "block int, steps binary, n binary").repartition("block").sortWithinPartitions("block")
    found, out = counted.mapInArrow(add, "block int, bits binary").toArrow(), np.zeros((size // BLOCK, BLOCK // 8), np.uint8)
    for k, bits in zip(found.column("block").to_pylist(), found.column("bits").to_pylist(), strict=True):
        out[k] = np.frombuffer(bits, np.uint8)
    return out.tobytes()


def frequent(rows: DataFrame, longest: int, least: int) -> tuple[bytes, bytes, bytes]:
    """Filters of the words, of the pairs of words and of the longest phrases that occur so often in all; a phrase's parts must too."""
    spark = rows.sparkSession
    words = bitmap(rows, lambda part: Pieces(part).hash, least, WORD_BITS)
    kept = spark.sparkContext.broadcast((words,))
    pairs = bitmap(rows, lambda part: (p := Pieces(part)).pairs()[p.goes_on(kept.value)[:-1]], least, PAIR_BITS)
    both = spark.sparkContext.broadcast((words, pairs))
    return words, pairs, bitmap(rows, lambda part: (p := Pieces(part)).phrases(longest)[p.whole(longest, p.goes_on(both.value))], least, PAIR_BITS)


def packed(counted: pa.Table) -> pa.Table:
    """(lang, bucket, lines) of (lang, bucket, node, last, n): a line for each node and last word, none if null; no word has a tab or line break."""
    counted = counted.sort_by([(c, "ascending") for c in ("lang", "bucket", "node", "last")])
    lang, bucket = counted.column("lang").combine_chunks(), counted.column("bucket").to_numpy()
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | pc.not_equal(lang[1:], lang[:-1]).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(new)
    lines = pc.binary_join_element_wise(counted.column("n").cast(pa.string()), counted.column("node"), counted.column("last"), "\t", null_handling="skip")
    lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(bucket)), pa.int32()), lines.combine_chunks())
    return pa.table([lang.take(pa.array(at)), pa.array(bucket[at]), pc.binary_join(lists, "\n")], names=["lang", "bucket", "lines"])


def grams(rows: DataFrame, longest: int, kept: tuple[bytes, bytes, bytes]) -> DataFrame:
    """(lang, bucket, node, last, n): the edges that start at each place, or what the piece's end or a rare word or pair leaves of them, without a last word.

    A place whose own word is rare counts for the empty node. Rows of a node are in one bucket, and dealt out by language and bucket.
    """
    shared = rows.sparkSession.sparkContext.broadcast(kept)

    def summed(tables: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(tables).group_by(["lang", "bucket", "node", "last"], use_threads=False).aggregate([("n", "sum")])
        return out.select(["lang", "bucket", "node", "last", "n_sum"]).rename_columns(["lang", "bucket", "node", "last", "n"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for part in slices(batches, "text", STEP_BYTES):
            found = Pieces(part)
            count = len(found.word)
            if not count:
                continue
            usual = marked(shared.value[0], found.hash)
            on = found.goes_on(shared.value[:2])
            edge = np.zeros(count, bool)
            edge[: max(count - longest + 1, 0)] = found.whole(longest, on) & marked(shared.value[2], found.phrases(longest))
            own = np.where(usual, found.word + 1, 0)
            columns, goes = [own], on
            for k in range(1, longest):
                following = np.zeros(count, np.int64)
                following[:-k] = np.where(goes[:-k] & (edge[:-k] if k == longest - 1 else True), own[k:], 0)
                columns.append(following)
                goes = goes.copy()
                goes[:-k] &= on[k:]
                goes[count - k :] = False
            key = found.lang
            for c in columns:
                _, key = np.unique(key * (len(found.words) + 1) + c, return_inverse=True)
            _, at, n = np.unique(key, return_index=True, return_counts=True)
            texts = pa.concat_arrays([pa.nulls(1, pa.string()), found.words.cast(pa.string())])
            parts = [texts.take(pa.array(c[at])) for c in columns]
            parts[0] = pc.fill_null(parts[0], "")
            node = pc.binary_join_element_wise(*parts[:-1], " ", null_handling="skip")
            by_node = np.zeros(len(at), U)
            for k, c in enumerate(columns[:-1]):
                by_node = mixed(by_node * U(0xC2B2AE3D27D4EB4F) + np.where(c[at] > 0, found.hash[np.minimum(at + k, count - 1)], U(0)))
            bucket = pa.array((by_node % U(BUCKETS)).astype(np.int32))
            held.append(pa.table([found.langs.take(pa.array(found.lang[at])).cast(pa.string()), bucket, node, parts[-1], pa.array(n.astype(np.int64))], names=["lang", "bucket", "node", "last", "n"]))
            if sum(x.num_rows for x in held) > MOST_HELD:
                held = [summed(held)]
                if held[0].num_rows > MOST_HELD // 2:
                    yield from packed(held.pop()).to_batches(max_chunksize=1 << 10)
        if held:
            held = [summed(held)]
            yield from packed(held.pop()).to_batches(max_chunksize=1 << 10)

    dealt = rows.mapInArrow(step, "lang string, bucket int, lines string").repartition("lang", "bucket")
    line = F.split("line", "\t")
    lines = dealt.select("lang", "bucket", F.explode(F.split("lines", "\n")).alias("line"))
    return lines.select("lang", "bucket", line[1].alias("node"), F.get(line, F.lit(2)).alias("last"), line[0].cast("long").alias("n"))


def first_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def last_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", -k)


def counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, phrase, f) of all phrases of up to `longest` words that occur `least` times or more; phrase null and words 0 for all words of a language.

    One shuffle deals the edges out by language and bucket of the node, so edges and node flows are added up where they lie;
    shorter prefixes of nodes are added up before they are shuffled.
    """
    rows = rows_of(docs, text_col, lang_col)
    edges = grams(rows, longest, frequent(rows, longest, least)).groupBy("lang", "bucket", "node", "last").agg(F.sum("n").alias("f"))
    # partitioned alike, so neither the sum nor the flow of a node shuffles again; one row of a node speaks for it
    node = W.partitionBy("lang", "bucket", "node")
    edges = edges.withColumns({"flow": F.sum("f").over(node), "first": F.row_number().over(node.orderBy(F.col("last").asc_nulls_first())) == 1})
    size = F.regexp_count("node", F.lit(" ")) + 1
    found = [(F.col("last").isNotNull() & (F.col("f") >= least), longest, F.concat_ws(" ", "node", "last"), F.col("f")), (F.col("first"), 0, F.lit(None).cast("string"), F.col("flow"))]
    for k in range(1, longest):
        enough = F.col("flow") >= least if k == longest - 1 else F.lit(True)
        found.append((F.col("first") & (F.col("node") != "") & (size >= k) & enough, k, first_words(F.col("node"), k), F.col("flow")))
    each = F.filter(F.array(*(F.when(test, F.struct(F.lit(k).alias("words"), phrase.alias("phrase"), f.alias("f"))) for test, k, phrase, f in found)), lambda x: x.isNotNull())
    out = edges.select("lang", F.explode(each).alias("x")).groupBy("lang", "x.words", "x.phrase").agg(F.sum("x.f").alias("f"))
    return written(out.filter((F.col("f") >= least) | (F.col("words") == 0)), "phrase-counts")


def keyed(lang: Column, phrase: Column) -> Column:
    """One string for both: no phrase has a line break."""
    return F.concat(lang, F.lit("\n"), phrase)


def table_of(found: DataFrame, words: int, name: str) -> DataFrame:
    """(key, name, weight) of the phrases of so many words, to look up; a phrase starts and ends no more candidates than its count."""
    return found.filter(F.col("words") == words).select(keyed(F.col("lang"), F.col("phrase")).alias("key"), F.col("f").alias(name), F.col("f").alias("weight"))


def with_count(rows: DataFrame, found: DataFrame, part: Column, words: int, name: str) -> DataFrame:
    return lookup(rows.withColumn("key", keyed(F.col("lang"), part)), table_of(found, words, name), "key", "weight").drop("key")


def compacted(found: DataFrame, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """The graph's unary paths (lang, phrase, words, f), single nodes among them, and the edges between paths (lang, phrase, f, from_f, to_f)."""
    edges = found.filter(F.col("words") == longest).select("lang", "phrase", "f")
    edges = with_count(edges, found, first_words(F.col("phrase"), longest - 1), longest - 1, "from_f")
    edges = written(with_count(edges, found, last_words(F.col("phrase"), longest - 1), longest - 1, "to_f"), "phrase-edges")
    whole = (F.col("f") == F.col("from_f")) & (F.col("f") == F.col("to_f"))
    end = lambda words: keyed(F.col("lang"), words(F.col("phrase"), longest - 1))
    links = edges.filter(whole).select(end(first_words).alias("u"), end(last_words).alias("v"), F.col("f").alias("weight"))
    links = written(links, "phrase-links")
    nodes = links.select(F.col("u").alias("id")).union(links.select(F.col("v").alias("id"))).distinct()
    chains = written(linear_chains(nodes, links.select("u", "v")), "phrase-chains")
    weights = links.groupBy(F.col("u").alias("chain")).agg(F.max("weight").alias("f"))
    # a path is no longer than a piece of a text, and so are its rows
    steps = chains.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("place", last_words(F.substring_index("id", "\n", -1), 1).alias("word")))).alias("steps"))
    rest = F.array_join(F.transform(F.expr("slice(steps, 2, size(steps) - 1)"), lambda s: s["word"]), " ")
    head, lang = F.substring_index("chain", "\n", -1), F.expr("left(chain, length(chain) - length(substring_index(chain, '\n', -1)) - 1)")
    paths = steps.join(weights, "chain").select(lang.alias("lang"), F.concat_ws(" ", head, rest).alias("phrase"), (F.size("steps") + longest - 2).alias("words"), "f")
    alone = found.filter(F.col("words") == longest - 1).withColumn("key", keyed(F.col("lang"), F.col("phrase"))).join(nodes.withColumnRenamed("id", "key"), "key", "left_anti")
    return paths.unionByName(alone.select("lang", "phrase", "words", "f")), edges.filter(~whole)


def candidates(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, a, from_f, to_f) of all phrases of two words or more that may be candidates, from the compacted graph.

    from_f and to_f, the counts of all words but the last and but the first, are known for the longest. Nodes of paths
    of several are left out: the edge beside them occurs as often.
    """
    paths, edges = compacted(found, longest)
    paths = written(paths, "phrase-paths")
    words = F.split("phrase", " ")
    cut = paths.filter(F.col("words") >= longest).select("lang", "f", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("words") - longest + 1), lambda i: F.array_join(F.slice(words, i, longest), " "))).alias("place", "phrase"))
    out = cut.select("lang", "phrase", F.lit(longest).alias("words"), F.col("f").alias("a"), F.col("f").alias("from_f"), F.col("f").alias("to_f"))
    out = out.unionByName(edges.select("lang", "phrase", F.lit(longest).alias("words"), F.col("f").alias("a"), "from_f", "to_f"))
    none = F.lit(None).cast("long")
    if longest > 2:
        out = out.unionByName(paths.filter(F.col("words") == longest - 1).select("lang", "phrase", "words", F.col("f").alias("a"), none.alias("from_f"), none.alias("to_f")))
    shorter = found.filter(F.col("words").between(2, longest - 2)).select("lang", "phrase", "words", F.col("f").alias("a"), none.alias("from_f"), none.alias("to_f"))
    return written(out.unionByName(shorter), "phrase-candidates")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language by score, count and phrase: lang, rank, phrase, a, l, r, n, score."""
    found = counts(docs, longest, least, text_col=text_col, lang_col=lang_col)
    rows = candidates(found, longest)
    phrase, words = F.col("phrase"), F.col("words")

    # the most frequent phrase of one word more around each
    around = found.filter(F.col("words").between(3, longest)).select("lang", "f", F.explode(F.expr("array(left(phrase, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1), substring(phrase, length(substring_index(phrase, ' ', 1)) + 2))")).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    rows = rows.join(around, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a"))).drop("most")
    rows = written(rows, "phrase-kept")

    for k in range(1, max(longest - 1, 2)):
        rows = with_count(rows, found, F.when(words > k, first_words(phrase, k)), k, f"first_{k}")
        rows = with_count(rows, found, F.when(words > k, last_words(phrase, k)), k, f"last_{k}")

    def part(side: str, known: str, k: int, size: int) -> Column:
        return F.col(known) if size == longest and k == longest - 1 > 1 else F.col(f"{side}_{k}")

    exact = lambda c: c.cast("decimal(20,0)")
    cuts = []
    for size in range(2, longest + 1):
        for k in range(1, size):
            before, after = part("first", "from_f", k, size), part("last", "to_f", size - k, size)
            score = F.lit(1_000_000).cast("decimal(7,0)") * (exact(F.col("a")) * exact(F.col("a"))).cast("decimal(31,0)")
            cuts.append((size, F.struct(_quotient(score, (exact(before) * exact(after)).cast("decimal(38,0)")).alias("score"), F.lit(k).alias("k"), before.alias("l"), after.alias("r"))))
    worst = None
    for size in range(2, longest + 1):
        least_cut = F.array_min(F.array(*(c for s, c in cuts if s == size)))
        worst = F.when(words == size, least_cut) if worst is None else worst.when(words == size, least_cut)
    rows = rows.withColumn("cut", worst).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    best = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = found.filter("words = 0").select(F.col("lang").alias("key"), F.col("f").alias("n"), F.lit(top).alias("weight"))
    out = lookup(best.withColumn("key", F.col("lang")), totals, "key", "weight")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _quotient(a: Column, b: Column) -> Column:
    """a / b without its fraction, of whole decimals."""
    return F.call_function("div", a, b)


ORACLE_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM t),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 4) r(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
long AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, f FROM c WHERE k = 3),
around AS (SELECT lang, phrase, max(f) AS most FROM long GROUP BY lang, phrase),
kept AS (SELECT c.* FROM c LEFT JOIN around USING (lang, phrase) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * f),
cuts AS (SELECT lang, k, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y FROM kept, range(1, 3) r(j) WHERE j < k),
s AS (SELECT cuts.*, p.f AS l, q.f AS r, ((1000000::HUGEINT * a * a) // (p.f::HUGEINT * q.f))::BIGINT AS score FROM cuts JOIN f p ON p.lang = cuts.lang AND p.phrase = x AND p.k = j JOIN f q ON q.lang = cuts.lang AND q.phrase = y AND q.k = cuts.k - j),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
