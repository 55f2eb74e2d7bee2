"""Token lists: identifiers of the whole text, order, offsets, and what the files hold."""

import glob
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import xxhash
from tokenizers import Tokenizer

from helixframe.llm import tokens as K

DOCS = "/root/testdata/sf0.001/documents.parquet"


def text_hash(text):
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def expected(rows):
    t, start, out = Tokenizer.from_file(K.TOKENIZER), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1]))):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_documents(spark):
    docs = spark.read.parquet(DOCS)
    path = K.scratch(spark, "t")
    K.write_tokens(docs, path, ranges=3)
    read = K.read_tokens(spark, path)
    assert result(K.digests(read)) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
    plan = read.filter("doc_id = 17").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,17)" in plan and "array<int>" not in plan.split("ReadSchema")[1].split("\n")[0]
    files = glob.glob(path.removeprefix("file:") + "/*.parquet")
    for f in files:
        group = pq.ParquetFile(f).metadata.row_group(0)
        assert all(group.column(k).has_offset_index and group.column(k).has_column_index for k in range(4))
        assert "DELTA_BINARY_PACKED" in group.column(4).encodings


def test_odd_texts(spark):
    rng = random.Random(11)
    parts = [" ", "\t", "\n", " ", "　", "a", "A", "é", "e", "́", "Σ", "ß", "İ", "'s", "don't", "12", "<|endoftext|>", "<|start", "oftext|>", "!?", "漢字", "\U0001f600", "‍", "\x1c", "ﬁ"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for k in range(400)]
    rows += [(None, "x"), (None, None), (3, None), (3, ""), (5, "same"), (5, "same"), (900, "word " * 60_000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, start string")
    assert [r[:4] for r in result(K.digests(K.tokenized(docs)))] == expected(rows)
    assert K.digests(K.tokenized(docs.limit(0))).count() == 0
