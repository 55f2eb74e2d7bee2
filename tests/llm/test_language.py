"""Compression classifier: held-out accuracy, and defined results of odd rows."""

import re
import zlib

import zstandard

from helixframe.llm import language as L

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DATA)
    rows = L.identify(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.accepted for r in rows) >= 0.98 * len(rows)


def test_held_out_and_unlabelled_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "abc def " * 9, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else None) for i in range(40)], "doc_id long, text string, lang string")
    assert not L.fit(docs).dictionaries
    assert {r.lang_pred for r in L.identify(docs, L.fit(docs)).collect()} == {"und"}


def test_odd_rows(spark):
    model = L.Classifier({"en": b"the cat and the dog of this that", "de": b"der die das und nicht ist ein"})
    docs = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "12 ²³ !?", None), (None, "und nicht " * 50_000, "q"), (4, "the", "q"), (4, "the", "q")], "doc_id long, text string, score string")
    rows = sorted((r.doc_id or 0, r.lang_pred, r.accepted, r.score == 0) for r in L.identify(docs, model).collect())
    assert rows == [(0, "de", True, False), (1, "und", False, True), (2, "und", False, True), (3, "und", False, True), (4, "en", True, False), (4, "en", True, False)]
    assert L.identify(docs.limit(0), model).count() == 0
    assert sorted(r.score for r in L.accepted(docs, model).collect()) == ["q", "q", "q"]


def test_blocks_are_decodable():
    import zstandard

    model = L.Classifier({"en": b"the cat and the dog " * 40})
    text = L.letters("The Cat, and 99 dogs! " * 300)
    raw = zstandard.ZstdCompressionDict(model.dictionaries["en"], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    reader = zstandard.ZstdDecompressor(dict_data=raw)
    blocks = [text.encode()[k : k + L.BLOCK] for k in range(0, len(text), L.BLOCK)]
    assert "".join(reader.decompress(model.compressors()[0].compress(b), max_output_size=L.BLOCK).decode() for b in blocks) == text


def plain(dictionaries, text):
    """The prediction from its definition, with a new compressor for each size."""
    text = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
    if not any(c.isalpha() for c in text):
        return "und", False
    data, sizes = text.encode(), {}
    for lang, content in dictionaries.items():
        sizes[lang] = 0
        for k in range(0, len(data), 1500):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=6)
            piece = data[k : k + 1500]
            sizes[lang] += len(zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_content_size=False, write_dict_id=False).compress(piece + b" " + piece + b" " + piece + b" " + piece))
    best = min(sizes, key=sizes.get)  # the first of equals
    rest = [v for lang, v in sizes.items() if lang != best]
    return best, not rest or min(rest) - sizes[best] >= max(1, 0.002 * sizes[best])


def test_predictions_match_plain_compression_at_every_length(spark):
    docs = spark.read.parquet(DATA)
    model = L.fit(docs)
    texts = [r.text or "" for r in docs.orderBy("doc_id").limit(40).collect()]
    letters = L.letters(" ".join(t for t in texts if t)[:4000])
    texts += [letters[:n] for n in (1, 2, 3, 5, 8, 20, 62, 63, 64, 65, 66, 200, 1499, 1500, 1501, 3001)] + ["xyz", "zz zz zz zz", "the", "", "123"]
    for t in texts:
        lang, score, accepted = model.predict(t)
        assert (lang, accepted) == plain(model.dictionaries, t), t


def test_ties_and_narrow_margins_are_rejected_at_every_length():
    same = L.Classifier({"en": b"the cat and the dog ", "de": b"the cat and the dog "})
    for text in ("the", "xyz", "the cat and the dog", "the dog " * 8, "the cat and the dog " * 500):
        assert same.predict(text)[0] == "en" and not same.predict(text)[2]
    for text in ("xyz", "qqq www"):
        assert not L.Classifier({"en": b"the cat and the dog of this that", "de": b"der die das und nicht ist ein"}).predict(text)[2]
    wide = L.Classifier({"en": b"the cat and the dog ", "de": b"der die das und nicht "})
    assert wide.predict("the cat and the dog")[2] and not wide.predict("the cat and the dog", margin_bytes=10**6)[2]


def test_many_languages_share_the_room(spark, monkeypatch):
    monkeypatch.setattr(L, "LANGUAGES", 4)
    docs = spark.createDataFrame([(k, f"word{chr(97 + k % 20) * 5} " * 30, f"l{k % 20}") for k in range(400)], "doc_id long, text string, lang string")
    model = L.fit(docs, samples=10, dictionary_bytes=1000)
    assert len(model.dictionaries) == 20 and all(0 < len(v) <= 200 for v in model.dictionaries.values())
    rows = L.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in rows)
