"""The chunked forms give what the plain windows give, also for a key that holds most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import corpus as C
from tidewatch.operators import evaluate as E
from tidewatch.operators import incidents as I
from tidewatch.operators import metrics as M
from tidewatch.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one key, a null key, repeated values."""
    draw = random.Random(1)
    rows = []
    for i in range(600):
        key = "hot" if i % 2 else draw.choice(["a", "b", "c", None])
        rows.append((i, key, draw.randint(0, 400), float(draw.randint(0, 20)), draw.randint(0, 1)))
    return spark.createDataFrame(rows, "id long, key string, at long, value double, y int").cache()


def same(a, b):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    left, right = sorted(map(tuple, a.select(*b.columns).collect()), key=key), sorted(map(tuple, b.collect()), key=key)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for p, q in zip(x, y):
            assert p == q or (isinstance(p, float) and p == pytest.approx(q, abs=1e-9)), (x, y)


def test_row_index(skewed):
    plain = skewed.withColumn("i", F.row_number().over(Window.orderBy(F.col("value").desc(), "id")) - 1)
    same(O.with_row_index(skewed, [F.col("value").desc(), "id"], "i"), plain)


@pytest.mark.parametrize("limit", [5, 20, 137])
def test_rolling(skewed, limit):
    roll = lambda n: M.rolling_features(
        skewed, ["key"], ["at", "id"], [M.Rolled("value", "v", "v")], {"value": ("prev", "change")}, limit=n
    )
    same(roll(limit), roll(10_000))


@pytest.mark.parametrize("limit", [7, 50])
def test_running_sums(skewed, limit):
    total = lambda n: O.running_sums(skewed, ["key"], ["at", "id"], {"s": F.col("value"), "n": F.lit(1)}, n)
    same(total(limit), total(10_000))


@pytest.mark.parametrize("limit", [7, 50])
def test_running_sums_without_keys(skewed, limit):
    total = lambda n: O.running_sums(skewed, [], [F.col("value").desc(), "id"], {"n": F.col("y")}, n)
    same(total(limit), total(10_000))


def test_incidents(skewed):
    rows = skewed.filter("key IS NOT NULL").withColumn("ts", F.timestamp_seconds("at"))
    mark = lambda n: I.mark_incidents(rows, "key", "ts", ["id"], gap_seconds=3, limit=n)
    same(mark(11), mark(10_000))


@pytest.mark.parametrize("limit", [9, 10_000])
def test_quantiles(skewed, limit):
    got = {r["key"]: (r["q0"], r["q1"]) for r in O.exact_quantiles(skewed, ["key"], "value", [0.95, 0.5], limit).collect()}
    rows = skewed.collect()
    for key in {r["key"] for r in rows}:
        values = [r["value"] for r in rows if r["key"] == key]
        assert got[key] == pytest.approx((np.percentile(values, 95), np.percentile(values, 50)))
    whole = O.exact_quantiles(skewed, [], "value", [0.9], limit).first()["q0"]
    assert whole == pytest.approx(np.percentile([r["value"] for r in rows], 90))


def test_both_forms_of_quantiles_agree_in_every_digit(spark):
    rows = spark.range(5000).selectExpr("id % 3 AS key", "sin(id) * 1e3 AS value")
    shares = [p / 200 for p in range(160, 199)] + [0.0, 1.0]
    read = lambda limit: sorted(map(tuple, O.exact_quantiles(rows, ["key"], "value", shares, limit).collect()))
    assert read(100) == read(10_000)


@pytest.mark.parametrize("rows", [8, 9, 10, 11, 3])
def test_ntile(spark, rows):
    df = spark.range(rows).withColumn("arr", F.lit(1.0))
    order = [F.col("arr").desc(), F.col("id")]
    same(M.ntile(df, order, 4, "b", limit=2), M.ntile(df, order, 4, "b"))


def test_hash_rank_and_split(skewed):
    same(C.hash_rank(skewed, ["key"], "id", limit=13), C.hash_rank(skewed, ["key"], "id"))
    same(C.hash_rank(skewed, [], "id", limit=13), C.hash_rank(skewed, [], "id"))
    split = C.stratified_split(skewed, "key", "id", limit=13)
    sizes = {(r["key"], r["split"]): r["count"] for r in split.groupBy("key", "split").count().collect()}
    for key in {k for k, _ in sizes}:
        n = sum(v for (k, _), v in sizes.items() if k == key)
        held = -(-n * 3 // 10)
        assert sizes[key, "train"] == n - held
        assert sizes[key, "test"] == -(-held // 2)


def test_curves_in_chunks(skewed):
    for by in ([], ["key"]):
        small, plain = (E.areas(skewed, "y", "value", by, limit=n) for n in (4, 10_000))
        same(small, plain)
    swept = lambda n: E.percentile_sweep(skewed, "y", "value", limit=n)
    same(swept(4), swept(10_000))


def test_batch_local(skewed):
    roll = lambda n: M.batch_local_features(skewed, ["key"], ["at", "id"], [M.Rolled("value", "v", "v")], 50, n)
    same(roll(60), roll(10_000))


def test_rollup_percentile_from_counts(spark):
    from tidewatch.operators import rollup as R

    rows = [(f"p{i}", "a" if i % 3 else "b", "low", "allow", "success", i % 7 == 0, float(i % 50) * 1000, i) for i in range(300)]
    facts = spark.createDataFrame(
        rows, "prompt_id string, attack_category string, classifier_risk_tier string, final_disposition string, "
        "pipeline_status string, agents_disagreed boolean, latency double, i long"
    ).withColumns(
        {
            "total_latency_ms": F.when(F.col("i") % 11 != 0, F.col("latency")).cast("decimal(12,2)"),
            "sla_breached": F.col("latency") > 40000,
            "event_timestamp": F.timestamp_seconds(F.col("i") * 600),
        }
    )
    same(R.daily_rollup(facts, limit=5), R.daily_rollup(facts))
