"""The pipeline: each stage against what it should do with its own input."""

import re

import corpus_pipeline as P
from helixframe.llm import language, mixing, secrets
from test_near_dup import expected

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names, tables = docs.columns, [docs]
    for _, stage in P.STAGES:
        tables.append(P.written(stage(spark, tables[-1], DIR), "stage").cache())
    assert all(t.columns == names and t.dtypes == docs.dtypes for t in tables[:5])
    rows = [[r.asDict() for r in t.collect()] for t in tables]
    ids = [[r["doc_id"] for r in t] for t in rows]

    assert set(ids[1]) <= set(ids[0]) and len(ids[1]) >= 0.97 * len(ids[0])
    assert {r["doc_id"]: r for r in rows[1]} == {r["doc_id"]: r for r in rows[0] if r["doc_id"] in set(ids[1])}
    assert sorted(ids[2]) == sorted(i for i, _, _, kept in expected([(r["doc_id"], r["text"]) for r in rows[1]]) if kept)
    assert sorted(ids[3]) == sorted(ids[2])
    for r in rows[3]:
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    clean = {r["doc_id"]: r for r in rows[2]}
    assert all(r == clean[r["doc_id"]] for r in rows[3] if not secrets.scan(clean[r["doc_id"]]["text"])[4])
    assert set(ids[4]) <= set(ids[3]) and all(ids[4].count(i) <= 2 for i in set(ids[4]))
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert sum(size(r["text"]) for r in rows[4]) == sum(r["length"] for r in rows[5])
    assert abs(sum(size(r["text"]) for r in rows[4]) - 1.5 * sum(size(r["text"]) for r in rows[3])) < 0.1 * sum(size(r["text"]) for r in rows[3])


def test_odd_rows(spark, tmp_path):
    long = "the cat and the dog of this that " * 3000
    rows = [(1, None, None, None, None), (None, "x y", None, "a", 3), (2, "", "en", None, 0), (3, long, "en", "a", 5), (4, long, "en", "a", 5), (4, long, "en", "a", 5), (5, "und das ist nicht " * 40, "de", "b", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, table in (("some", rows), ("none", [])):
        path = f"{tmp_path}/{name}/documents.parquet"
        spark.createDataFrame(table, schema).write.parquet(path)
        out = P.run(spark, f"{tmp_path}/{name}")
        assert out.count() >= 0 and "batch" in out.columns
    docs = spark.createDataFrame([(*r, "q") for r in rows], schema + ", __row string")
    for _, stage in P.STAGES[:4]:
        assert stage(spark, docs, "").columns == docs.columns


def test_odd_rows_have_defined_results(spark):
    """Each stage on nulls, empty and long texts, repeated and equal rows without ids: exactly the rows that should stay."""
    long = "the cat and the dog of this that " * 3000
    german = "und das ist nicht der rede wert " * 40
    twins = [(None, "the dog and this cat of that other kind are here again and again", "en", "c", k) for k in range(60)]
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (3, long, "en", "a", 5), (4, long, "en", "a", 5), (4, long, "en", "a", 5), (5, german, "de", "b", None), (6, "123 456", "en", "a", 7), (7, german.replace("wert", "token = abcdefgh12"), "de", "b", 8)]
    docs = spark.createDataFrame(rows + twins, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.fit(docs)
    kept = lambda df: sorted((r.doc_id or 0, r.text or "") for r in df.collect())
    one = P.identify_language(spark, docs, "")
    assert kept(one) == sorted((r[0] or 0, r[1] or "") for r in rows + twins if model.predict(r[1])[2])
    assert {r[0] for r in kept(one)} == {0, 3, 4, 5, 7}
    two = P.drop_near_duplicates(spark, P.written(one, "stage"), "")
    assert [r[0] for r in kept(two)] == [0] * 60 + [3, 5, 7]
    three = P.redact_secrets(spark, P.written(two, "stage"), "")
    assert [t for i, t in kept(three) if i == 7] == [german.replace("wert", "[assign]")] and [t for i, t in kept(three) if i == 3] == [long]
    four = P.written(P.mix_sources(spark, P.written(three, "stage"), ""), "stage")
    size = lambda df: sum(len(t.split()) for _, t in kept(df))
    assert abs(size(four) - 1.5 * size(three)) <= 0.02 * size(three) + len(long.split())
    twins_taken = sum(len(t.split()) for i, t in kept(four) if i == 0)
    want = {r.source: r.target for r in mixing.pareto_mix(P.written(three, "stage")).collect()}["c"]
    assert abs(twins_taken - want) <= 13
    packed = P.pack_batches(spark, four, "").collect()
    assert sum(r.length for r in packed) == size(four) and sum(r.doc_id is None for r in packed) == sum(i == 0 for i, _ in kept(four))
    nothing = docs.limit(0)
    for _, stage in P.STAGES:
        nothing = stage(spark, nothing, "")
        assert nothing.count() == 0
