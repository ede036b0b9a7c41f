from __future__ import annotations

import random

import pytest

from syncloom.operators import apply, changes, keys
from syncloom.plans.spec import SyncSpec

SCHEMA = "k int, u string, v string, n double"


def random_table(spark, seed, n=60, schema=SCHEMA):
    rng = random.Random(seed)
    ks = rng.sample(range(100), n)
    return spark.createDataFrame([(k, rng.choice([None, f"u{k}"]), rng.choice([None, "a", "b"]), rng.choice([None, 1.0, 2.0])) for k in ks], schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("compare", [None, "sha256", "md5"])
@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_laws(spark, seed, compare):
    s, t = random_table(spark, seed), random_table(spark, seed + 10)
    spec = SyncSpec(["k"], compare=compare)
    first, counts = apply.full_sync(s, t, spec)
    c = counts.first()
    assert c.insert + c.update + c.unchanged == s.count()
    again = apply.full_sync(s, first, spec)[1].first()
    assert again.insert == again.update == 0
    assert set(rows(s)) <= set(rows(first))


def test_unbounded_scope_makes_target_equal_source(spark):
    s, t = random_table(spark, 3), random_table(spark, 4).filter("k between 10 and 80")
    bounds = s.agg({"k": "min"}).first()[0], s.agg({"k": "max"}).first()[0]
    t = t.filter(f"k between {bounds[0]} and {bounds[1]}")
    assert rows(apply.full_sync(s, t, SyncSpec(["k"], scope="k"))[0]) == rows(s)


def test_empty_source_deletes_nothing(spark):
    t = random_table(spark, 5)
    snapshot, counts = apply.full_sync(t.limit(0), t, SyncSpec(["k"], scope="k"))
    assert rows(snapshot) == rows(t)
    assert counts.first().delete == 0


def test_null_keys(spark):
    s = spark.createDataFrame([(None, "x")], "k int, v string")
    t = spark.createDataFrame([(None, "y")], "k int, v string")
    assert rows(apply.full_sync(s, t, SyncSpec(["k"]))[0]) == [(None, "x")]
    assert len(rows(apply.full_sync(s, t, SyncSpec(["k"], null_safe=False))[0])) == 2


def test_conflicts_make_room_for_the_source_row(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b")], "k int, u string")
    t = spark.createDataFrame([(9, "a"), (2, "c"), (8, None)], "k int, u string")
    snapshot, counts = apply.full_sync(s, t, SyncSpec(["k"], unique_keys=[["u"], ["absent"]]))
    assert rows(snapshot) == [(1, "a"), (2, "b"), (8, None)]
    assert counts.first().conflict_delete == 1


def test_null_unique_keys(spark):
    s = spark.createDataFrame([(1, None)], "k int, u string")
    t = spark.createDataFrame([(9, None), (8, "a")], "k int, u string")
    assert keys.unique_conflicts(t, s, ["k"], [["u"]]).count() == 1
    assert keys.unique_conflicts(t, s, ["k"], [["u"]], nulls_conflict=False).count() == 0


def test_duplicate_source_keys(spark):
    s = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, o int")
    t = s.limit(0)
    with pytest.raises(ValueError, match="duplicate"):
        apply.full_sync(s, t, SyncSpec(["k"]))
    assert rows(apply.full_sync(s, t, SyncSpec(["k"], on_duplicate="latest", order=["o"]))[0]) == [(1, "new", 2)]


def test_hash_boundaries(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), (None, "C"), ("NULL", "C")], "a string, b string")
    h = [r[0] for r in df.select(changes.row_hash([F.col("a"), F.col("b")])).collect()]
    assert h[0] != h[1]
    assert h[2] == h[3]  # by definition; compare by columns to tell them apart
    wide = spark.createDataFrame([tuple(range(300))], ", ".join(f"col_{i} int" for i in range(300)))
    assert len(wide.select(changes.row_hash([F.col(c) for c in wide.columns])).first()[0]) == 64


def test_spec_checks():
    for bad in ({"keys": []}, {"keys": ["k"], "insert_only": True, "scope": "k"}, {"keys": ["id]; DROP TABLE dbo.Users; --"]}, {"keys": ["k"], "compare": "crc"}, {"keys": ["k"], "on_duplicate": "latest"}):
        with pytest.raises(ValueError):
            SyncSpec(**bad)


def test_no_cartesian_and_one_full_join(spark):
    s, t = random_table(spark, 6), random_table(spark, 7)
    plan = apply.full_sync(s, t, SyncSpec(["k"]))[0]._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("FullOuter") == 1


def test_update_and_delete(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (None, "y"), (5, "z")], "k int, v string")
    assert rows(apply.update_rows(t, s, ["k"])) == rows(spark.createDataFrame([(1, "x"), (2, "b"), (None, "c")], "k int, v string"))
    assert rows(apply.delete_rows(t, s.select("k"))) == rows(spark.createDataFrame([(2, "b"), (None, "c")], "k int, v string"))


def test_repeated_source_keys(spark):
    """They are an error in every operator that applies rows by key, or the latest counts."""
    t = spark.createDataFrame([(1, "a", 0)], "k int, v string, o int")
    s = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1), (2, "e", 2)], "k int, v string, o int")
    for f in (apply.update_rows, apply.insert_only):
        with pytest.raises(ValueError, match="duplicate"):
            f(t, s, ["k"])
    assert rows(apply.update_rows(t, s, ["k"], "latest", ["o"])) == [(1, "c", 2)]
    assert rows(apply.insert_only(t, s, ["k"], on_duplicate="latest", order=["o"])) == [(1, "a", 0), (2, "e", 2)]
    documents = s.withColumnRenamed("k", "_id")
    with pytest.raises(ValueError, match="duplicate"):
        apply.document_changes(documents, documents.limit(0))
    assert apply.document_changes(documents, documents.limit(0), on_duplicate="latest", order=["o"]).count() == 2


def test_store_fanout_honours_the_spec(spark):
    s = spark.createDataFrame([(1, 1, "a", "n"), (1, 2, "b", "n"), (2, 1, "a", "n")], "store int, k int, u string, v string")
    t = spark.createDataFrame([(1, 1, "a", "old"), (1, 9, "b", "x"), (2, 9, "b", "x"), (3, 1, "z", "x")], "store int, k int, u string, v string")
    snap = apply.store_snapshots(s, t, SyncSpec(["store", "k"], unique_keys=[["u"]]))
    assert rows(snap) == sorted([(1, 1, "a", "n"), (1, 2, "b", "n"), (2, 1, "a", "n"), (2, 9, "b", "x"), (3, 1, "z", "x")], key=str)
    kept = apply.store_snapshots(s, t, SyncSpec(["store", "k"], insert_only=True))
    assert (1, 1, "a", "old") in rows(kept) and len(rows(kept)) == 6


def test_columns_named_like_the_bounds(spark):
    """A target with columns low, high and _0, and the scope itself named low."""
    t = spark.createDataFrame([(1, 5, 7, "a"), (2, 6, 8, "b"), (9, 90, 9, "c"), (None, 5, 1, "d")], "k int, low int, high int, _0 string")
    s = spark.createDataFrame([(1, 5, 7, "a"), (3, 9, 1, "z")], "k int, low int, high int, _0 string")
    assert rows(apply.missing_in_source(t, s, ["k"], "low")) == sorted([(2, 6, 8, "b"), (None, 5, 1, "d")], key=str)
    assert apply.full_sync(s, t, SyncSpec(["k"], scope="low"))[1].first().asDict()["delete"] == 2
    assert apply.missing_in_source(t, s.limit(0), ["k"], "low").count() == 0
