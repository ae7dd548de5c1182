import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import decisions as D
from tidewatch.operators import incidents as I
from tidewatch.operators import metrics as M

START = dt.datetime(2026, 7, 10)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_gap_is_open_only_beyond(spark):
    rows = [("a", 0), ("a", 599), ("a", 1199), ("a", 1800), ("b", 10), ("b", 611), ("c", 5)]
    df = spark.createDataFrame([(i, k, at(s)) for i, (k, s) in enumerate(rows)], "id long, service string, ts timestamp")
    marked = I.mark_incidents(df, "service", "ts", ["id"])
    assert {r["id"]: r["opens"] for r in marked.collect()} == {0: 1, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 1}
    counts = I.incident_counts(marked).first()
    assert (counts["anomalous_rows"], counts["incidents_opened"], counts["rows_continued"]) == (7, 5, 2)
    assert {(r["service"], r["n_rows"]) for r in I.incidents(marked, "service", "ts").collect()} == {("a", 3), ("a", 1), ("b", 1), ("c", 1)}


@pytest.mark.parametrize("broadcast_rows", [100, 0])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_first_window_within_tolerance(spark, broadcast_rows, kind):
    windows = spark.createDataFrame(
        [("a", 0, at(1000), at(2000)), ("a", 1, at(1500), at(9000)), ("b", 2, at(0), at(10))], f"service string, window_no int, start_ts {kind}, end_ts {kind}"
    )
    times = {0: 699, 1: 700, 2: 1600, 3: 2300, 4: 9300, 5: 9301, 6: 2301}
    rows = spark.createDataFrame([(i, "a", at(s)) for i, s in times.items()], f"id int, service string, ts {kind}")
    hits = I.match_windows(rows, windows, "service", "ts", "id", broadcast_rows=broadcast_rows, cell_seconds=500)
    assert {r["id"]: r["window_no"] for r in hits.collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 6: 1}
    recall = I.window_recall(rows, windows, "service", "ts", "id", broadcast_rows=broadcast_rows).first()
    assert tuple(recall) == (7, 3, 5, 2, 66.67)
    labels = I.label_by_windows(rows, windows, "service", "ts", broadcast_rows=broadcast_rows, cell_micros=700_000_000)
    assert labels.count() == 7
    assert {r["id"] for r in labels.filter("is_anomaly = 1").collect()} == {2, 3, 6}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_overlapping_windows_meet_a_row_once(spark, broadcast_rows):
    rng = np.random.default_rng(5)
    key = lambda: "hot" if rng.random() < 0.5 else f"k{rng.integers(4)}"
    spans = [(key(), int(n), int(lo), int(lo + rng.integers(0, 4000))) for n, lo in zip(rng.permutation(120), rng.integers(0, 20_000, 120))]
    spans += [("hot", 500, 0, 30_000), ("hot", 501, -10_000_000, 10_000_000)]
    times = [(i, key(), int(s)) for i, s in enumerate(rng.integers(0, 25_000, 600))]
    windows = spark.createDataFrame([(k, n, at(lo), at(hi)) for k, n, lo, hi in spans], "service string, window_no int, start_ts timestamp, end_ts timestamp")
    rows = spark.createDataFrame([(i, k, at(s)) for i, k, s in times], "id int, service string, ts timestamp")
    want = {}
    for i, k, s in times:
        if fits := [n for key, n, lo, hi in spans if key == k and lo - 300 <= s <= hi + 300]:
            want[i] = min(fits)
    hits = I.match_windows(rows, windows, "service", "ts", "id", broadcast_rows=broadcast_rows, cell_seconds=100).collect()
    assert len(hits) == len(want) and {r["id"]: r["window_no"] for r in hits} == want
    labels = I.label_by_windows(rows, windows, "service", "ts", broadcast_rows=broadcast_rows, cell_micros=100_000_000)
    inside = {i for i, k, s in times if any(key == k and lo <= s <= hi for key, _, lo, hi in spans)}
    assert {r["id"] for r in labels.filter("is_anomaly = 1").collect()} == inside
    # a window of years does not become a row per hour
    spans = windows.select("service", I.epoch_micros(windows, "start_ts").alias("_low"), I.epoch_micros(windows, "end_ts").alias("_high"))
    cell = I.cell_length(spans, 100_000_000)
    assert I._clipped(spans, cell).count() <= 3 * windows.count()


def test_recall_without_windows(spark):
    none = spark.createDataFrame([], "service string, window_no int, start_ts timestamp, end_ts timestamp")
    rows = spark.createDataFrame([(0, "a", at(0))], "id int, service string, ts timestamp")
    assert I.window_recall(rows, none, "service", "ts", "id").first()["recall_pct"] == 0.0


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_injection(spark, broadcast_rows):
    n = 60
    base = np.random.default_rng(3).normal(10, 2, (n, 3))
    rows = spark.createDataFrame([("s", i, *map(float, base[i])) for i in range(n)], "service string, i long, lat double, mem double, thr double")
    spans = [("s", "spike", 5, 15, 0), ("s", "slow_drift", 10, 40, 1), ("s", "flatline", 30, 50, 2), ("s", "spike", 58, 59, 3)]
    windows = spark.createDataFrame(spans, "service string, kind string, start_idx long, end_idx long, window_no int")
    got = I.inject(rows, windows, "service", "i", ["lat"], ["mem"], ["thr"], broadcast_rows=broadcast_rows, cell_rows=7)
    got = np.array([tuple(r)[2:] for r in got.select("service", "i", "lat", "mem", "thr", "is_anomaly").orderBy("i").collect()])
    want = base.copy()
    sd = base.std(axis=0)
    want[5:15, 0] += 5 * sd[0] * np.hanning(10)
    want[58:59, 0] += 5 * sd[0] * np.hanning(1)
    want[10:40, 1] += np.linspace(0, 4 * sd[1], 30)
    want[30:50, 2] = base[30, 2]
    assert got[:, :3] == pytest.approx(want)
    assert set(np.flatnonzero(got[:, 3])) == {*range(5, 50), 58}


def test_telemetry_features(spark):
    """A constant metric, a row alone in its key, a zero denominator."""
    rows = []
    for i in range(14):
        rows.append(("a", at(300 * i), 30.0 + i, 40.0, 80.0, 100.0 + i * i, 200.0, 0.5, 5.0, 0.0 if i == 3 else 50.0, 0))
    rows.append(("b", at(0), 30.0, 40.0, 80.0, 100.0, 200.0, 0.5, 5.0, 50.0, 0))
    schema = "service_name string, timestamp timestamp, " + ", ".join(
        f"{c} double" for c in ("cpu_pct", "memory_pct", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms", "error_rate_pct", "queue_depth", "thread_count")
    ) + ", is_anomaly_ground_truth int"
    done = M.telemetry_features(spark.createDataFrame(rows, schema))
    assert set(M.MODEL_INPUTS) <= set(done.columns)
    got = {(r["service_name"], r["timestamp"]): r for r in done.collect()}
    last = got["a", at(300 * 13)]
    cpu = np.array([30.0 + i for i in range(1, 14)])  # thirteen rows, not twelve
    assert last["cpu_roll_mean"] == pytest.approx(cpu.mean())
    assert last["cpu_zscore"] == pytest.approx((43 - cpu.mean()) / cpu.std(ddof=1))
    assert last["mem_zscore"] == 0.0 and last["latency_rate_of_change"] == 13 * 13 - 12 * 12
    assert got["a", at(900)]["queue_per_thread_ratio"] == 0.0
    assert got["b", at(0)]["cpu_roll_std"] == 0.0 and got["b", at(0)]["cpu_rate_of_change"] == 0.0


def test_fill_gaps(spark):
    df = spark.createDataFrame([(None, 1, "x"), (float("inf"), None, None), (float("nan"), 2, "y"), (float("-inf"), 3, "z")], "a double, b int, c string")
    assert [tuple(r) for r in M.fill_gaps(df).collect()] == [(0.0, 1, "x"), (0.0, 0, None), (0.0, 2, "y"), (0.0, 3, "z")]


def test_wait_hints(spark):
    rows = ["Please try again in 3m44.64s", "try again in 12.5s.", "no hint", "try again in 1.2.3s", None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(rows)], "i int, m string")
    got = [r[0] for r in df.orderBy("i").select(I.wait_hint_seconds(F.col("m"), 15)).collect()]
    assert got == pytest.approx([224.64, 12.5, 15.0, 15.0, 15.0])


def test_min_max_of_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["n"] for r in M.min_max(df, {"v": "n"}).collect()] == [0.0, 0.0]
    scaled = M.standard_scaled(df, df, {"v": "s"})
    assert [r["s"] for r in scaled.collect()] == [0.0, 0.0]


def test_arrays_scale_like_columns(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i * i), 3.0) for i in range(40)], "i int, a double, b double, c double")
    fit = df.filter("i < 25")
    columns = M.standard_scaled(df, fit, {c: f"{c}_s" for c in "abc"}).withColumn("want", F.array("a_s", "b_s", "c_s"))
    both = M.standard_scaled_array(columns.withColumn("x", F.array("a", "b", "c")), fit.withColumn("x", F.array("a", "b", "c")), "x", "got")
    for r in both.collect():
        assert r["got"] == pytest.approx(r["want"], abs=1e-12)


def test_targets(spark):
    df = spark.createDataFrame([(1, 2.0, 0, "x")], "account_id long, arr double, Churned int, name string")
    assert M.resolve_target(df).columns == ["account_id", "arr", "churn_label", "name"]
    assert M.numeric_view(df, ["account_id"]).columns == ["arr"]
    with pytest.raises(KeyError):
        M.resolve_target(df.drop("Churned"))
