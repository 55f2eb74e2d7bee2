"""What the training-data operators share: scratch tables, Arrow slices and word arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of code points outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one step inside a task works on at a time, whatever the Arrow batch holds.
SLICE_BYTES = 1 << 20
#: Tables of ids or hashes of at most so many rows are broadcast (16 MB at 16 bytes); longer ones are joined by key.
BROADCAST_IDS = 1_000_000
#: A key of at most so many rows is never heavy.
HEAVY = 1000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir; in local mode, as in tests, one is set where none is."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df as a table written to the shared folder, which ends its lineage: lost executors cost no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int | None = None) -> bool:
    """Whether df has no more rows than that, which are counted; BROADCAST_IDS by default."""
    rows = BROADCAST_IDS if rows is None else rows
    return df.limit(rows + 1).count() <= rows


def lookup(df: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """df with the columns of `table`, a row for each key, joined left; `weight` says how many rows of df have the key.

    A small table is broadcast. Beyond BROADCAST_IDS rows, only the keys are broadcast that have more than their
    share of all rows, of which there are BROADCAST_IDS at most; the other rows are joined by key, so no task gets a
    heavy key's rows.
    """
    rows, total = table.agg(F.count(F.lit(1)), F.sum(weight)).first()
    if rows <= BROADCAST_IDS:
        return df.join(F.broadcast(table.drop(weight)), key, "left")
    heavy = F.col(weight) > max(HEAVY, total // BROADCAST_IDS)
    values = [c for c in table.columns if c not in (key, weight)]
    out = df.join(F.broadcast(table.filter(heavy).drop(weight).withColumn("__heavy", F.lit(True))), key, "left")
    rest = out.filter(F.col("__heavy").isNull()).drop("__heavy", *values).join(table.filter(~heavy).drop(weight), key, "left")
    return out.filter("__heavy").drop("__heavy").unionByName(rest)


def size_in_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of each batch, cut where a column's values reach so many bytes; a longer value comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each value starts in them, with the end last; null is empty."""
    array = pc.fill_null(array.cast(pa.large_binary()), b"")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pa.concat_arrays([array])
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, np.int64, len(array) + 1, array.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


class Words:
    """The words of a slice of texts as arrays: byte spans, the text of each, equal words as equal numbers.

    cuts: bytes at which a word is cut in two.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, cuts: np.ndarray | None = None) -> None:
        self.data, self.starts = data, starts
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cut = starts[:-1][starts[:-1] < starts[1:]]
        first[cut] = inside[cut]
        if cuts is not None:
            first[cuts] = inside[cuts]
        self.inside = inside
        self.start = np.flatnonzero(first)
        ordinal = np.cumsum(inside)
        before = np.concatenate([ordinal[self.start] - 1, ordinal[-1:]]) if len(data) else np.zeros(1, np.int64)
        self.length = np.diff(before)
        self.end = self.start + self.length
        packed = np.ascontiguousarray(data[inside])
        offsets = before.astype(np.int64)
        self.value = pa.Array.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        self.text = np.searchsorted(starts, self.start, side="right") - 1
        self.count = np.bincount(self.text, minlength=len(starts) - 1)
        self.at = np.concatenate([[0], np.cumsum(self.count)])

    def numbers(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the distinct words by number."""
        coded = self.value.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def code_points(data: np.ndarray) -> np.ndarray:
    """How many code points start before each byte; one more entry for the end."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
