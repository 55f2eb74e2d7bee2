"""Personal data: fixed patterns, and the terms that give a protected entity away.

Each distinct value that a pattern finds (an address, a number) is a protected entity. Terms are runs of ASCII letters
and digits or other characters beyond ASCII, lower-cased in A-Z; those within `reach` terms of an entity stand with it.
Over the whole corpus, with documents as the events, the information content of an entity c is IC = -log2 p(c), and
the pointwise mutual information PMI = log2(p(c, t) / (p(c) p(t))) says how much of it a term t reveals. A term that
stands with c in at least `support` different contexts discloses c if PMI >= IC / alpha: at alpha 1, only a term that
occurs with nothing else; above, rarer entities are protected more. An entity of one context proves nothing about its
neighbours, and copies of a context are one.

Wherever a disclosing term stands with its entity it is generalised to its shape (`Aa` for a name, `9` for a number),
unless the shape itself discloses the entity by the same rule, or removed. Texts that hold no entity are left alone.

Texts are read once for entities and their terms with places, once for the documents of each term; all that is
counted and joined afterwards are entities (128-bit hashes), terms and places.

Spans are code points, end exclusive. Defined results: null text is empty; a null id stays; equal texts get equal
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Words, at_most, lookup, slices, utf8, written

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is tried from its start alone: from within, it ends where it ended before.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")
NOT_DIGIT = re.compile(r"[^0-9]+")
KINDS = ("email", "ip", "card", "phone", "general", "remove")
REACH, SUPPORT, ALPHA = 8, 3, 1.1
#: Runs of fewer characters aren't terms: most of a language's words that are so short say nothing.
LEAST = 3
#: For each byte: itself in lower case, and its class in a shape; a space for what no term has.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)
CLASS = np.array([ord("A") if 65 <= b <= 90 else ord("9") if 48 <= b <= 57 else ord("a") if LOWER[b] != 32 else 32 for b in range(256)], np.uint8)


def luhn(digits: str) -> bool:
    """Whether the digits pass the check sum: every second from the right counts double, its digits added."""
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that don't overlap. Each @ is looked at once, so a long run without one costs nothing."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and (text[start - 1] in "._%+-" or text[start - 1].isascii() and text[start - 1].isalnum()):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns by kind, then start."""
    out = [(0, s, e, text[s:e].lower()) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end(), m[0]))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end(), digits))
    for m in PHONE.finditer(text):
        if 8 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end(), digits))
    return out


def plain(term: str) -> str:
    """In lower case, A to Z alone."""
    return term.encode().lower().decode()


def shape(term: str) -> str:
    """A for capitals, 9 for digits and a for other characters, each run of one kind as one."""
    return "".join(k for k, _ in groupby("A" if "A" <= c <= "Z" else "9" if "0" <= c <= "9" else "a" for c in term))


def neighbours(text: str, base: list[tuple[int, int, int, str]], reach: int) -> list[dict]:
    """entity, term, shape, context and places, starts and ends in turn, of each entity and term that stand together.

    A row with an empty term stands for the entity itself. What overlaps a span of a pattern is no term.
    """
    spans, terms, k, end = sorted((s, e) for _, s, e, _ in base), [], 0, 0
    for m in TERM.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            end, k = max(end, spans[k][1]), k + 1
        if m.start() >= end and m.end() - m.start() >= LEAST:
            terms.append((m.start(), m.end(), m[0]))
    starts, found = [t[0] for t in terms], {}
    for kind, s, e, value in base:
        entity = xxhash.xxh3_128_digest(f"{kind} {value}")
        near = terms[max(0, bisect_left(starts, s) - reach) : bisect_right(starts, e) + reach]
        context = xxhash.xxh3_64_intdigest(" ".join(plain(t) for _, _, t in near)) - (1 << 63)
        found.setdefault((entity, "", ""), (context, set()))
        for a, b, term in near:
            found.setdefault((entity, plain(term), shape(term)), (context, set()))[1].add((a, b))
    return [{"entity": entity, "term": term, "shape": form, "context": context, "places": [x for place in sorted(places) for x in place]} for (entity, term, form), (context, places) in found.items()]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


SCAN = "row long, hash binary, id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<kind: int, start: int, end: int>>, near array<struct<entity: binary, term: string, shape: string, context: long, places: array<int>>>"
SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
NEAR = pa.list_(pa.struct([("entity", pa.binary()), ("term", pa.string()), ("shape", pa.string()), ("context", pa.int64()), ("places", pa.list_(pa.int32()))]))


def scanned(docs: DataFrame, id_col: str, text_col: str, reach: int) -> DataFrame:
    """What the patterns find in each text, and the terms that stand with it; `row` numbers the rows."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = pc.fill_null(part.column("text"), "").to_pylist()
            base = [base_spans(t) for t in texts]
            near = [neighbours(t, found, reach) if found else [] for t, found in zip(texts, base, strict=True)]
            counts = [pa.array([sum(b[0] == kind for b in found) for found in base], pa.int64()) for kind in range(4)]
            digests = pa.array([hashlib.sha256(joined([b[:3] for b in found]).encode()).hexdigest() for found in base])
            spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e, _ in found] for found in base], SPANS)
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("hash"), part.column("id"), *counts, digests, spans, pa.array(near, NEAR)], names=["row", "hash", "id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "near"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), text_hash(text_col).alias("hash"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    return rows.mapInArrow(step, SCAN)


def text_hash(text_col: str):
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def documents_of_terms(docs: DataFrame, text_col: str) -> DataFrame:
    """(name, n), several rows for a name: in how many documents each term occurs, and each shape, after a tab; all documents as the empty name."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, starts = utf8(part.column("text"))
            words = Words(LOWER[data], starts)
            size = pc.utf8_length(words.value.cast(pa.large_string())).to_numpy(zero_copy_only=False) if len(words.start) else np.zeros(0, np.int64)
            long = np.flatnonzero(size >= LEAST)
            names, counts = [pa.array([""])], [np.array([len(starts) - 1])]
            for values, mark in ((words.value, ""), (shapes(data, words), "\t")):
                coded = values.take(pa.array(long)).dictionary_encode()
                n = max(len(coded.dictionary), 1)
                once = np.unique(words.text[long] * n + coded.indices.to_numpy(zero_copy_only=False)) % n
                text = coded.dictionary.cast(pa.string())
                names.append(pc.binary_join_element_wise(mark, text, "") if mark else text)
                counts.append(np.bincount(once, minlength=n)[: len(text)])
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(names), pa.array(np.concatenate(counts).astype(np.int64))], names=["name", "n"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(step, "name string, n long")


def shapes(data: np.ndarray, words: Words) -> pa.Array:
    """The shape of each word of some bytes."""
    kind = CLASS[data]
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[words.start] = True
    first &= words.inside
    before = np.concatenate([[0], np.cumsum(first)])
    offsets = np.concatenate([before[words.start], before[-1:]]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kind[first]))])


def disclosing(near: DataFrame, docs: DataFrame, text_col: str, support: int, alpha: float) -> DataFrame:
    """(entity, name, both) of the pairs in which the term or shape discloses the entity. near: (row, entity, term, shape, context).

    A pair's documents are added up by context first, so a frequent entity is no hot key.
    """
    names = F.explode(F.when(F.col("term") == "", F.array(F.lit(""))).otherwise(F.array("term", F.concat(F.lit("\t"), "shape"))))
    seen = near.select("row", "entity", "context", names.alias("name")).distinct()
    pairs = seen.groupBy("entity", "name", "context").agg(F.count(F.lit(1)).alias("n")).groupBy("entity", "name").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("contexts"))
    pairs = written(pairs.filter((F.col("contexts") >= support) | (F.col("name") == "")), "private-pairs")
    needed = pairs.groupBy("name").agg(F.count(F.lit(1)).alias("weight"))
    needed = written(needed, "private-names")
    wanted = F.broadcast(needed) if at_most(needed) else needed
    counted = documents_of_terms(docs, text_col).join(wanted, "name").groupBy("name").agg(F.sum("n").alias("in_docs"), F.max("weight").alias("weight"))
    counted = written(counted, "private-terms")
    entities = pairs.groupBy("entity").agg(F.max(F.when(F.col("name") == "", F.col("both"))).alias("of_entity"), F.count(F.lit(1)).alias("weight"))
    total = (counted.filter("name = ''").first() or {"in_docs": 0})["in_docs"]
    rows = lookup(pairs.filter("name <> ''"), counted, "name", "weight")
    rows = lookup(rows, written(entities, "private-entities"), "entity", "weight").withColumn("all_docs", F.lit(total).cast("double"))
    content = F.log2(F.col("all_docs") / F.col("of_entity"))
    revealed = F.log2(F.col("both") * F.col("all_docs") / (F.col("of_entity") * F.col("in_docs").cast("double")))
    return rows.filter((content > 0) & (revealed >= content / alpha - 1e-9)).select("entity", "name", "both")


def located(docs: DataFrame, id_col: str, text_col: str, reach: int, support: int, alpha: float) -> DataFrame:
    """The rows of `scanned` without near, with all spans (kind, start, end) by kind, then start."""
    scan = written(scanned(docs, id_col, text_col, reach), "private-scan")
    near = scan.select("row", F.explode("near").alias("x")).select("row", "x.*")
    found = written(disclosing(near.drop("places"), docs, text_col, support, alpha).withColumn("pair", F.struct("entity", "name")), "private-disclosing")
    terms = found.filter("name not like '\t%'").select("pair", F.lit(True).alias("discloses"), "both")
    forms = found.filter("name like '\t%'").select("pair", F.lit(True).alias("remove"), "both")
    rows = lookup(near.filter("term <> ''").withColumn("pair", F.struct("entity", F.col("term").alias("name"))), terms, "pair", "both").filter("discloses")
    rows = lookup(rows.withColumn("pair", F.struct("entity", F.concat(F.lit("\t"), "shape").alias("name"))), forms, "pair", "both")
    place = F.explode(F.expr("transform(sequence(0, size(places) div 2 - 1), i -> struct(places[2 * i] as start, places[2 * i + 1] as end))"))
    kind = F.when(F.col("remove"), KINDS.index("remove")).otherwise(KINDS.index("general"))
    # a place that stands with several entities is removed if it is for one of them
    marks = rows.select("row", kind.alias("kind"), place.alias("p")).groupBy("row", "p").agg(F.max("kind").alias("kind"))
    extra = marks.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "p.start", "p.end"))).alias("extra"), F.lit(1).alias("weight"))
    out = lookup(scan.drop("near"), written(extra, "private-extra"), "row", "weight")
    return out.withColumn("all", F.concat("base", F.coalesce("extra", F.array().cast("array<struct<kind: int, start: int, end: int>>")))).drop("extra", "base")


def find_private(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """One row for each text: id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    kinds = F.array(*map(F.lit, KINDS))
    span = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    spans = F.array_join(F.transform("all", span), ",")
    return located(docs, id_col, text_col, reach, support, alpha).select(F.col("id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """docs with each entity in text_col replaced by its kind, and each disclosing term by its shape or by nothing; overlapping spans become one, named by the first."""

    names = docs.columns

    def clean(text: str | None, spans: list[dict] | None) -> str | None:
        if not text or not spans:
            return text
        out, at = [], 0
        for s in sorted(spans, key=lambda s: (s["start"], s["kind"])):
            if s["start"] >= at:
                kind = KINDS[s["kind"]]
                out += [text[at : s["start"]], "" if kind == "remove" else f"[{shape(text[s['start'] : s['end']]) if kind == 'general' else kind}]"]
            at = max(at, s["end"])
        return "".join([*out, text[at:]])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            k = part.schema.get_field_index(text_col)
            new = pa.array([clean(t, s) for t, s in zip(part.column(k).to_pylist(), part.column("__all").to_pylist(), strict=True)], part.schema.field(k).type)
            yield part.set_column(k, part.schema.field(k), new).select(names)

    found = located(docs, id_col, text_col, reach, support, alpha).filter("size(all) > 0")
    by_text = found.groupBy(F.col("hash").alias("__hash")).agg(F.any_value("all").alias("__all"), F.count(F.lit(1)).alias("__weight"))
    rows = lookup(docs.withColumn("__hash", text_hash(text_col)), written(by_text, "private-spans"), "__hash", "__weight")
    return rows.select(*names, "__all").mapInArrow(step, docs.schema)
