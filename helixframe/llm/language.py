"""Language identification by compression.

Each language has a zstandard raw-content dictionary, made of texts known to be in it. A text is cut into blocks,
each block is compressed with each dictionary, and the language with the fewest bytes in all is the prediction.
Letters are lower-cased and everything else is a space, so that digits, marks and case weigh nothing. Compressing
block by block keeps a long text from becoming its own dictionary, so the margin doesn't shrink with the length. A
block is compressed as COPIES copies of itself in a row: a short one alone would be stored as it is, whatever the
dictionary; of several, the first is coded by the dictionary and the others cost the same few bytes under each.

The dictionaries are fitted on a bounded sample: for each language, the documents with the smallest hash of doc_id in
each of SAMPLES salts, at most SAMPLE_CHARS characters from each and DICTIONARY_BYTES in all. Of more than LANGUAGES
languages each has as many times fewer samples and bytes, but one sample at least, so that all dictionaries together
stay as large. Documents that are held out (crc32 of doc_id as text, mod 4, is 2), have no lang or no doc_id are never
in it.

`score` is the share of the best language when sizes are read as likelihoods, tempered by the text's length;
`accepted` is whether the best beats the second by at least `margin_bytes` and `margin_share` of its size, at any
length; a lone language has no second and is accepted.

Defined results: a text that is null or has no letter is `und`, score 0, not accepted; without labelled documents
every text is; ties go to the language with more labelled documents, then the first by code point, and are never
accepted; a null id stays and isn't held out; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import slices

UNDETERMINED = "und"
SAMPLES, SAMPLE_CHARS, DICTIONARY_BYTES = 96, 4000, 112 << 10
#: Beyond so many languages the samples and dictionaries of each are smaller: the dictionaries go to every task.
LANGUAGES = 300
BLOCK, COPIES, LEVEL = 1500, 4, 6
MARGIN_BYTES, MARGIN_SHARE = 1, 0.002
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Classifier:
    """Dictionaries by language, those that win ties first."""

    def __init__(self, dictionaries: dict[str, bytes], block: int = BLOCK, level: int = LEVEL) -> None:
        self.dictionaries, self.block, self.level = dictionaries, block, level

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "block": self.block, "level": self.level}

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        if not hasattr(self, "_compressors"):
            self._compressors = []
            for data in self.dictionaries.values():
                raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(level=self.level)
                self._compressors.append(zstandard.ZstdCompressor(level=self.level, dict_data=raw, write_content_size=False, write_dict_id=False))
        return self._compressors

    def sizes(self, text: str) -> list[int]:
        """Bytes of the text under each dictionary, block by block."""
        data = text.encode()
        blocks = [b" ".join([data[k : k + self.block]] * COPIES) for k in range(0, len(data), self.block)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors()]

    def predict(self, text: str | None, margin_bytes: int = MARGIN_BYTES, margin_share: float = MARGIN_SHARE) -> tuple[str, float, bool]:
        text = letters(text or "")
        if not self.dictionaries or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False
        sizes = self.sizes(text)
        best = min(sizes)
        # a byte is 8 bits, tempered so that long texts don't all come to 1
        temper = 8 * math.log(2) / max(4.0, math.sqrt(len(text)))
        score = 1 / sum(math.exp(-(s - best) * temper) for s in sizes)
        margin = min((s for k, s in enumerate(sizes) if k != sizes.index(best)), default=best + len(text)) - best
        return list(self.dictionaries)[sizes.index(best)], score, margin >= max(margin_bytes, margin_share * best)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", samples: int = SAMPLES, sample_chars: int = SAMPLE_CHARS, dictionary_bytes: int = DICTIONARY_BYTES) -> Classifier:
    """The classifier of the documents that are labelled and not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))).withColumn("hash", F.xxhash64("id"))
    more = max(1.0, rows.select("lang").distinct().count() / LANGUAGES)
    samples, dictionary_bytes = max(1, int(samples / more)), int(dictionary_bytes / more)
    salted = rows.groupBy("lang", F.pmod("hash", F.lit(samples)).alias("salt"))
    # LANGUAGES times SAMPLES rows, or one for each language if these are more
    least = salted.agg(F.min("hash").alias("hash"), F.count(F.lit(1)).alias("n")).collect()
    picked = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(r.lang, r.hash) for r in least], "lang string, hash long")), ["lang", "hash"], "left_semi")
    # a repeated id is still one sample
    picked = picked.groupBy("lang", "hash").agg(F.min(F.substring("text", 1, sample_chars)).alias("text"))
    found: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r.lang, r.hash)):
        found.setdefault(r.lang, []).append(letters(r.text or ""))
    labelled = Counter()
    for r in least:
        labelled[r.lang] += r.n
    order = sorted(found, key=lambda lang: (-labelled[lang], lang))
    return Classifier({lang: " ".join(x for x in found[lang] if x).encode()[:dictionary_bytes] for lang in order})


def identify(docs: DataFrame, model: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id_col, held_out, lang_pred, score, accepted."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [model.predict(t) for t in part.column("text").to_pylist()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), *columns], names=["id", "held_out", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, "id long, held_out boolean, lang_pred string, score double, accepted boolean").withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Classifier, *, text_col: str = "text") -> DataFrame:
    """The rows of docs whose language is accepted, all columns as they are."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            yield part.filter(pa.array([model.predict(t)[2] for t in part.column(text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(step, docs.schema)
