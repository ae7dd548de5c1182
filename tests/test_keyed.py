"""Tables in folders by key, with filters."""

from pyspark.sql import functions as F

from tidewatch.session import new_table_path
from tidewatch.sources import keyed


def batch(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, n int")


def held(spark, path):
    return sorted(((r["k"], r["n"]) for r in keyed.read(spark, path).collect()), key=str)


def test_first_per_key_and_reruns(spark):
    path = new_table_path(spark, "keyed")
    first = batch(spark, ["a", "b", "a", None, "c", None])
    assert keyed.append_new(first, path, "k", "n", buckets=8) == []
    want = sorted([("a", 0), ("b", 1), (None, 3), ("c", 4)], key=str)
    assert held(spark, path) == want
    # the same batch again, then one with a new key and an old one that comes with other values
    assert keyed.append_new(first, path, "k", "n", buckets=8)
    assert held(spark, path) == want
    keyed.append_new(spark.createDataFrame([("d", 7), ("a", 9)], "k string, n int"), path, "k", "n", buckets=8)
    assert held(spark, path) == sorted([*want, ("d", 7)], key=str)
    keyed.append_new(batch(spark, []), path, "k", "n", buckets=8)
    assert len(held(spark, path)) == 5


def test_only_folders_that_may_hold_a_key_are_read(spark):
    path = new_table_path(spark, "keyed")
    keyed.append_new(batch(spark, [f"old{i}" for i in range(5000)]), path, "k", "n", buckets=64)
    assert len(keyed.append_new(batch(spark, [f"new{i}" for i in range(200)]), path, "k", "n", buckets=64)) <= 2
    read = keyed.append_new(batch(spark, ["old17", "other"]), path, "k", "n", buckets=64)
    assert 1 <= len(read) <= 2 and len(held(spark, path)) == 5201
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("_bucket").isin(read)).count()
    assert rows < 5201 / 16


def test_filters_that_are_full_and_a_run_that_broke_off(spark):
    """One word a folder says maybe to everything; filters without rows lose nothing."""
    path = new_table_path(spark, "keyed")
    keyed.append_new(batch(spark, [f"k{i}" for i in range(500)]), path, "k", "n", buckets=2, words=1)
    assert keyed.append_new(batch(spark, [f"k{i}" for i in range(400, 900)]), path, "k", "n", buckets=2, words=1) == [0, 1]
    assert len({k for k, _ in held(spark, path)}) == len(held(spark, path)) == 900
    broken = new_table_path(spark, "keyed")
    marks = keyed._marks(batch(spark, ["x", "y"]), "k", 4, keyed.WORDS).groupBy("_bucket", "word").agg(F.bit_or("bits").alias("bits"))
    marks.write.parquet(f"{broken}/filters")
    keyed.append_new(batch(spark, ["x", "y", "z"]), broken, "k", "n", buckets=4)
    assert len(held(spark, broken)) == 3
