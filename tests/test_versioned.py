"""Versioned bucketed tables against plain dictionaries: upserts, deletes, old versions, two writers, and plans that leave the old side in place."""

import random

import pytest
from pyspark.sql import functions as F

from medgraph.operators import graph as G
from medgraph.sources import commits, versioned

SCHEMA = "id string, a int, b string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("small", [versioned.SMALL, 0])
def test_changes_and_versions(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(versioned, "SMALL", small)
    at, rng = f"{tmp_path}/t", random.Random(7)
    held = {f"k{i}": (rng.choice([None, i]), rng.choice([None, "x"])) for i in range(60)}
    frame = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], SCHEMA)
    assert versioned.create(frame(held), at, "id", 8) == 1
    first = dict(held)
    for number, keep in ((2, True), (3, False)):
        new = {f"k{i}": (rng.choice([None, -i]), rng.choice([None, "y"])) for i in rng.sample(range(90), 12)}
        assert versioned.change(spark, at, frame(new), keep_old=keep) == number
        for k, v in new.items():
            old = held.get(k, (None, None))
            held[k] = tuple((o if o is not None else n) if keep else (n if n is not None else o) for o, n in zip(old, v))
        assert rows(versioned.read(spark, at)) == sorted((k, *v) for k, v in held.items())
    assert versioned.delete(spark, at, F.col("b") == "y") == 4
    assert rows(versioned.read(spark, at)) == sorted((k, *v) for k, v in held.items() if v[1] != "y")
    assert rows(versioned.read(spark, at, 1)) == sorted((k, *v) for k, v in first.items())
    assert versioned.versions(spark, at) == [1, 2, 3, 4]


def test_only_touched_buckets_are_written(spark, tmp_path):
    at = f"{tmp_path}/t"
    versioned.create(spark.range(400).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("a"), F.lit("x").alias("b")), at, "id", 16)
    before = versioned._pointer(spark, at)["folders"]
    versioned.change(spark, at, spark.createDataFrame([("k7", 2, "y"), ("new", 3, None)], SCHEMA), keep_old=False)
    after = versioned._pointer(spark, at)["folders"]
    assert 1 <= sum(before.get(b) != f for b, f in after.items()) <= 2
    assert versioned.read(spark, at).count() == 401


def test_old_side_is_not_shuffled(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("a"), F.lit("x").alias("b")).write.parquet(f"{tmp_path}/old")
    old = spark.read.parquet(f"{tmp_path}/old")
    new = spark.createDataFrame([("5", 9, None), ("z", 1, "q")], SCHEMA)
    got = versioned.upserted(old, new, "id", False, True)
    assert rows(got) == rows(G.upsert(old, new, "id", False, True))
    scans = got.where("status <> 'created'")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in scans and "SortMergeJoin" not in scans.split("left_anti")[0].split("LeftAnti")[0]


def test_two_writers(spark, tmp_path, monkeypatch):
    at = f"{tmp_path}/t"
    versioned.create(spark.createDataFrame([("a", 1, None)], SCHEMA), at, "id", 4)
    seen = versioned._pointer(spark, at)
    versioned.change(spark, at, spark.createDataFrame([("b", 2, None)], SCHEMA))
    monkeypatch.setattr(versioned, "_pointer", lambda *a: seen)
    with pytest.raises(versioned.Conflict):
        versioned.change(spark, at, spark.createDataFrame([("c", 3, None)], SCHEMA))
    monkeypatch.undo()
    assert rows(versioned.read(spark, at)) == [("a", 1, None), ("b", 2, None)]
    assert len(commits.batches(spark, at)) == 2


def test_similarity_bound(spark):
    from difflib import SequenceMatcher

    from medgraph.functions import text as T

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aabcdé가😀-") for _ in range(rng.randint(0, 9)))
    pairs = [(word(), word()) for _ in range(300)] + [("", ""), ("abc", "abc"), ("", "a")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", T.similarity_bound(F.col("a"), F.col("b")).alias("s")).collect()
    assert all(r.s >= SequenceMatcher(None, r.a, r.b).ratio() - 1e-12 and r.s <= 1 for r in got)
    assert sum(r.s < 0.5 for r in got) > 50
