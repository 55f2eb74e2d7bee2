"""Token identifiers as Parquet list columns, with page indexes.

Texts are encoded with a public tokenizer, an end identifier closes each document, and the identifiers are written in
ascending order of doc_id: the rows are dealt into ranges of doc_id, each range is sorted, and each file holds one
list column of identifiers beside its columns of metadata. Row groups and pages have set sizes, metadata is
dictionary- or delta-encoded (writer version 2), and files carry column indexes, so a read of a few documents, or of
the metadata alone, opens only the pages that it needs.

Texts are split at ASCII white space, words of Latin letters, marks and digits also into pre-tokens, and each distinct
part is encoded once and kept for later slices; probes make sure that the tokenizer drops white space and cuts as
this does, so the identifiers are those of the whole text. `tokenizer` is the
path of a file that every executor has; it is never copied. A tokenizer that keeps white space encodes whole texts.

Defined results: null text is empty and has the end identifier alone; null ids come first; rows with equal ids are in
the order of their texts' hashes, so that one id's rows need not share a range; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.common import Words, scratch, slices, utf8

TOKENIZER, END = public_tokenizers.path("word_bpe_49k.json"), 2
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2000
#: Words that a Python worker remembers, from task to task, and bytes of text that it encodes at a time.
MEMORY_WORDS, STEP_BYTES = 1_000_000, 2 << 20
#: Ranges of at most about so many bytes of text; beyond so many ranges, they grow instead (tasks stream through them).
RANGE_BYTES, MOST_RANGES = 32 << 20, 100_000

#: Pre-tokens that can be told apart by their bytes: runs of Latin letters, runs of marks, single digits.
SIMPLE = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[!-&(-/:-@\[-`{-~]+|[0-9]")
LETTER, MARK, DIGIT, OTHER, SPACE = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[33:127] = MARK
CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
CLASS[48:58], CLASS[39] = DIGIT, OTHER
CLASS[[*range(9, 14), 32]] = SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Units:
    """Words, those of Latin letters, marks and digits lower-cased and cut into pre-tokens: their bytes, and where each text's begin."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        kind = CLASS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
        lead = lead[(data[lead + 1] & 0xC0 == 0x80) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        inside = kind != SPACE
        first = kind == DIGIT
        first[:1] = True
        first[1:] |= kind[1:] != kind[:-1]
        first[starts[:-1][starts[:-1] < len(data)]] = True
        begin = np.flatnonzero(first & inside)
        opens = ~inside[begin - 1]
        at = np.searchsorted(begin, starts)
        opens[at[:-1][at[:-1] < len(begin)]] = True
        word = np.cumsum(opens) - 1
        # words with other bytes, or with what may be a special token, stay whole
        odd = kind[begin] == OTHER
        special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        odd[np.searchsorted(begin, special, side="right") - 1] |= True
        whole = np.zeros(int(word[-1]) + 1 if len(word) else 0, bool)
        whole[word[odd]] = True
        whole = whole[word]
        keep = opens | ~whole
        begin, whole = begin[keep], whole[keep]
        ordinal = np.cumsum(inside, dtype=np.int64)
        bounds = np.append(ordinal[begin] - 1, ordinal[-1:]) if len(begin) else np.zeros(1, np.int64)
        low = LOWER[data]
        low[lead[data[lead + 1] < 0x9F] + 1] += 32
        packed = low[inside]
        if whole.any():
            packed = np.where(np.repeat(whole, np.diff(bounds)), data[inside], packed)
        self.value = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
        self.at = np.searchsorted(begin, starts)

    def numbers(self) -> tuple[np.ndarray, pa.Array]:
        coded = self.value.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def as_bytes(values: pa.Array) -> list[bytes]:
    _, offsets, data = values.buffers()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in pairwise(np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8).tolist())]


class Encoder:
    """Identifiers of texts; what it has learned stays with it."""

    def __init__(self, path: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        probe = ("ab cd", "ab\tcd", " ab \n cd ")
        self.by_word = all(self.ids(p) == self.ids("ab") + self.ids("cd") for p in probe)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closes[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        #: Whether words are cut into pre-tokens as Units does, and each one's last identifier closes it.
        parts = ("ab", "#?", "é", "1", "2", ".", "x")
        self.joins = self.ids("Ab#?É12. X") == [i for p in parts for i in self.ids(p)] and all(self.closes[self.ids(p)].tolist() == [False] * (len(self.ids(p)) - 1) + [True] for p in (*parts, "abracadabra"))
        #: For pre-tokens, the same model without what would cut and fold them once more, if that gives the same.
        spec = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "post_processor": None, "added_tokens": []}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.model, probe = self.tokenizer, " ".join((*parts, "abracadabra", "ñandú", "straße", "&&", "thx"))
        if self.joins:
            bare = Tokenizer.from_str(json.dumps(spec))
            if bare.encode(probe, add_special_tokens=False).ids == self.ids(probe):
                self.model = bare
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, words: list[bytes]) -> None:
        """Encodes words and remembers them: simple ones joined by spaces, others one by one."""
        joined, other = [], []
        for w in words:
            text = w.decode()
            (joined if self.joins and SIMPLE.fullmatch(text) else other).append((w, text))
        flat, sizes = [self.flat], []
        groups = [" ".join(t for _, t in joined[k : k + 1000]) for k in range(0, len(joined), 1000)]
        for found in self.model.encode_batch_fast(groups, add_special_tokens=False):
            ids = np.array(found.ids, np.int32)
            sizes.append(np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0))
            flat.append(ids)
        for found in self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False):
            flat.append(np.array(found.ids, np.int32))
            sizes.append(np.array([len(flat[-1])]))
        for k, (w, _) in enumerate(joined + other, len(self.place)):
            self.place[w] = k
        self.flat = np.concatenate(flat)
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(sizes))]) if sizes else self.bounds

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts, each with its end, and where each text's start; the end last."""
        if not self.by_word:
            each = [np.array([*self.ids(t or ""), self.end], np.int32) for t in texts.to_pylist()]
            return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        words = (Units if self.joins else Words)(*utf8(texts))
        number, distinct = words.numbers()
        distinct = as_bytes(distinct)
        place = list(map(self.place.get, distinct))
        if new := [w for w, k in zip(distinct, place, strict=True) if k is None]:
            if len(self.place) + len(new) > MEMORY_WORDS:
                self.forget()
                new = distinct
            self.learn(new)
            place = list(map(self.place.get, distinct))
        known = np.array(place, np.int64)[number]
        n = self.bounds[known + 1] - self.bounds[known]
        # the end identifiers stand after each text's words
        total = np.concatenate([[0], np.cumsum(n)])
        bounds = total[words.at] + np.arange(len(words.at))
        source = np.repeat(self.bounds[known] - total[:-1], n) + np.arange(total[-1])
        out = np.insert(self.flat[source], total[words.at[1:]], self.end)
        return out, bounds


@lru_cache(maxsize=1)
def encoder(path: str, end: int) -> Encoder:
    """One for each Python worker, so that a task finds the words of those before it."""
    return Encoder(path, end)


def write_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end: int = END, ranges: int | None = None, range_bytes: int = RANGE_BYTES) -> None:
    """Writes (part, place, doc_id, n_tokens, tokens) below path, in ascending order of doc_id.

    `part` numbers the ranges in order; `place` counts the identifiers before a document in its range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if ranges is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(rows.sparkSession.sparkContext.defaultParallelism, min(MOST_RANGES, -(-size // range_bytes)))
    rows = rows.repartitionByRange(int(ranges), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for piece in slices(batches, "text", STEP_BYTES):
            ids, bounds = encoder(tokenizer, end).encode(piece.column("text"))
            n = len(bounds) - 1
            tokens = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(place + bounds[:-1]), piece.column("doc_id"), pa.array(np.diff(bounds)), tokens], names=["part", "place", "doc_id", "n_tokens", "tokens"])
            place += int(bounds[-1])

    out = rows.mapInArrow(step, "part int, place long, doc_id long, n_tokens long, tokens array<int>")
    settings = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.page.row.count.limit": PAGE_ROWS, "parquet.columnindex.truncate.length": 64}
    # a list's identifiers hardly repeat in a page's order: delta encoding with bit packing
    settings["parquet.enable.dictionary#tokens.list.element"] = "false"
    out.write.options(**settings).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (identifiers of all documents before it), n_tokens and tokens."""
    rows = spark.read.schema("part int, place long, doc_id long, n_tokens long, tokens array<int>").parquet(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    # one row for each range, MOST_RANGES of write_tokens or so many as its caller asked for
    before = sums.select(F.col("part").alias("p"), F.coalesce(F.sum("all").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    few = sums.limit(MOST_RANGES + 1).count() <= MOST_RANGES
    return rows.join(F.broadcast(before) if few else before, F.col("part") == F.col("p")).select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "tokens")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, and the CRC of the identifiers as little-endian unsigned 32-bit integers."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            bounds = lists.offsets.to_numpy()
            raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "tokens").mapInArrow(step, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, **options) -> DataFrame:
    """read_tokens of docs, written to the shared folder."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path)
