"""The family store: what an append refuses, and what lookups return, against a plain pass and plain filters."""

import random

from helixframe.sources import store as S

SCHEMA = "accession string, name string, type string, subtype string, search_stages string, buffer_stages string, clades array<string>"


def plain_append(rows, seen):
    """The accessions that a pass in order adds to a set of names."""
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or (r[1] or "") < (best[r[0]][1] or "")):
            best[r[0]] = r
    out = []
    for acc in sorted(best):
        name = best[acc][1]
        if {acc, acc + "v", name} - {None} & seen:
            continue
        seen |= {acc, name} - {None}
        out.append(acc)
    return out


def test_append_is_the_pass_in_order(spark, tmp_path):
    rng = random.Random(4)
    store, seen = str(tmp_path / "store"), set()
    word = lambda: rng.choice("abcdefgh") + rng.choice("12345") + rng.choice(["", "v", "vv"])
    for _ in range(3):
        rows = [(rng.choice([None, word(), word(), word()]), rng.choice([None, word(), word()]), "LINE", None, "50", None, ["r"]) for _ in range(40)]
        want = plain_append(rows, seen)
        assert sorted(r.accession for r in S.append(spark.createDataFrame(rows, SCHEMA), store).collect()) == sorted(want)
    assert S.append(spark.createDataFrame([], SCHEMA), store).count() == 0
    assert spark.read.parquet(f"{store}/families").count() == spark.read.parquet(f"{store}/by_stage").count() > 20


def test_lookups(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [
        ("DF1", "L1a", "LINE", "L1", "35,50", "40[1-200], 65", ["a", "b"]),
        ("DR0000001", "l1b", "LINE", None, "40", None, ["c"]),
        ("DF3", None, "DNA", "hAT", None, "50", []),
        ("DF4", "Alu", "SINE", "", "", "", None),
    ]
    S.append(spark.createDataFrame(rows, SCHEMA), store)
    tree = spark.createDataFrame([("r", None), ("a", "r"), ("b", "a"), ("c", "b"), ("d", "r")], "id string, parent string")
    got = lambda **k: sorted(r.accession for r in S.selected(spark, store, tree, **k).collect())
    assert got() == got(stage=80) == ["DF1", "DF3", "DF4", "DR0000001"]
    assert got(stage=50) == ["DF1", "DF3"] and got(stage=50, is_hmm=True) == ["DF1"] and got(stage=40) == ["DF1", "DR0000001"] and got(stage=40, is_hmm=True) == ["DR0000001"]
    assert got(stage=95) == ["DF1", "DF3"] and got(stage=1) == []
    assert got(curated=True) == ["DF1", "DF3", "DF4"] and got(curated=False) == ["DR0000001"]
    assert got(kind="line") == ["DF1", "DR0000001"] and got(kind="LINE/L") == ["DF1"] and got(kind="sine/") == [] and got(name="L1") == ["DF1", "DR0000001"]
    assert got(taxon="a") == ["DF1"] and got(taxon="r") == [] and got(taxon="r", descendants=True) == ["DF1", "DR0000001"] and got(taxon="c", ancestors=True) == ["DF1", "DR0000001"]
    assert got(taxon="d", ancestors=True, descendants=True) == [] and got(taxon="no") == []
    assert [r.name for r in S.by_accession(spark, store, "DF4").collect()] == ["Alu"] and [r.accession for r in S.by_name(spark, store, "l1b").collect()] == ["DR0000001"]


def test_lookups_read_their_folders_alone(spark, tmp_path):
    store = str(tmp_path / "store")
    S.append(spark.createDataFrame([(f"D{k}", None, "LINE", None, str(k % 5), None, ["a"]) for k in range(200)], SCHEMA), store)
    one = S.by_accession(spark, store, "D7")
    assert one.count() == 1 and len(one.inputFiles()) <= len(S.selected(spark, store).inputFiles())
    plan = S.selected(spark, store, stage=3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [stage" in plan or "PartitionFilters: [isnotnull(stage" in plan
