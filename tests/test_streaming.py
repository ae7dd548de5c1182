"""Streams over several files, also with rows out of order between files, against their batch twins."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.test_rollup import trace
from tidewatch.operators import decisions as D
from tidewatch.operators import incidents as I
from tidewatch.operators import metrics as M
from tidewatch.operators import rollup as R
from tidewatch.session import new_table_path
from tidewatch.streaming import jobs as J

START = dt.datetime(2026, 7, 10)


def write_files(spark, df, cuts, folder):
    """One file per cut, oldest first by modification time."""
    os.makedirs(folder, exist_ok=True)
    for n, cut in enumerate(cuts):
        part = f"{folder}-{n}"
        df.filter(cut).coalesce(1).write.parquet(part)
        source = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{folder}/part-{n}.parquet"
        with open(f"{part}/{source}", "rb") as a, open(target, "wb") as b:
            b.write(a.read())
        os.utime(target, (1_700_000_000 + 10 * n,) * 2)
    return folder


@pytest.fixture(scope="module")
def metrics(spark, tmp_path_factory):
    """Three services; rows reach the stream up to five minutes out of order across files."""
    draw = random.Random(4)
    rows, n = [], 0
    for service in ("a", "b", "c"):
        seconds = 0
        for _ in range(80):
            seconds += draw.choice([30, 60, 600, 601, 900])
            rows.append((n, service, START + dt.timedelta(seconds=seconds), draw.choice([1.0, 2.0, 5.0, 9.5])))
            n += 1
        rows.append((n, service, START + dt.timedelta(days=9, seconds=n), 1.0))  # moves the watermark past the rest
        n += 1
    df = spark.createDataFrame(rows, "id long, service string, ts timestamp, v double").cache()
    shifted = F.unix_seconds("ts") + F.pmod(F.hash("id"), F.lit(300))
    edges = [F.unix_seconds(F.lit(START + dt.timedelta(hours=h))) for h in (0, 2, 5, 9, 10_000)]
    cuts = [(shifted >= lo) & (shifted < hi) for lo, hi in zip(edges, edges[1:])]
    folder = write_files(spark, df, cuts, str(tmp_path_factory.mktemp("metrics") / "files"))
    stream = lambda: J.replay(spark, folder, df.schema, files_per_trigger=1)
    return df.filter(F.col("ts") < F.lit(START + dt.timedelta(days=8))), stream


def rows_of(df, *columns):
    return sorted(tuple(None if v is None or v != v else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())


def table_of(spark, name):
    """Paths of a new output table and of its job's folder."""
    return new_table_path(spark, name), new_table_path(spark, f"{name}-job")


@pytest.mark.parametrize("limit", [4_000_000, 20])
def test_rolling_equals_batch(spark, metrics, limit):
    df, stream = metrics
    out, folder = table_of(spark, "rolled")
    J.rolling_job(stream(), "service", "ts", "id", ["v"], out, folder, limit=limit)
    done = spark.read.parquet(out).filter(F.col("ts") < F.lit(START + dt.timedelta(days=8)))
    batch = M.rolling_features(df, ["service"], ["ts", "id"], [M.Rolled("v", "v", "v")], {"v": ("v_prev", "v_change")})
    columns = ("id", "service", "v_roll_mean", "v_roll_std", "v_zscore", "v_change")
    key = lambda rows: sorted(rows, key=lambda r: r[0])
    got, want = key([tuple(r) for r in done.select(*columns).collect()]), key([tuple(r) for r in batch.select(*columns).collect()])
    assert len(got) == len(want) == 240
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        for a, b in zip(g[2:], w[2:]):
            assert (a is None or a != a) if b is None else a == pytest.approx(b, abs=1e-9)


def test_incidents_equal_batch(spark, metrics):
    df, stream = metrics
    high = lambda d: d.filter(F.col("v") >= 5)
    # the closing row of each key is kept so that the watermark moves on
    late = lambda d: d.filter((F.col("v") >= 5) | (F.col("ts") > F.lit(START + dt.timedelta(days=8))))
    out, folder = table_of(spark, "incidents")
    J.incident_job(late(stream()), "service", "ts", "id", out, folder)
    done = spark.read.parquet(out).filter(F.col("ts") < F.lit(START + dt.timedelta(days=8)))
    batch = I.mark_incidents(high(df), "service", "ts", ["id"])
    assert rows_of(done, "id", "opens", "incident_no") == rows_of(batch, "id", "opens", "incident_no")
    closed = spark.read.parquet(J.run_to_table(J.closed_incidents(late(stream()), "service", "ts"), "closed"))
    assert rows_of(closed.filter("end_ts < '2026-07-18'"), "service", "n_rows") == rows_of(I.incidents(batch, "service", "ts"), "service", "n_rows")
    actions = new_table_path(spark, "actions")
    for _ in range(2):
        J.incident_job(late(stream()), "service", "ts", "id", *table_of(spark, "incidents"), actions=actions)
    opened = spark.read.parquet(actions).filter(F.col("ts") < F.lit(START + dt.timedelta(days=8)))
    assert opened.count() == batch.agg(F.sum("opens")).first()[0]


def test_half_the_rows_in_one_key(spark, tmp_path):
    """A hot key is cut into chunks of 50 rows; null keys and equal times are keys and times like any other."""
    draw = random.Random(8)
    rows = [(n, draw.choice(["hot"] * 5 + ["a", "b", "c", None]), START + dt.timedelta(seconds=draw.randrange(40_000)), draw.choice([1.0, None, 4.0])) for n in range(900)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp, v double")
    folder = write_files(spark, df, [F.unix_seconds("ts") % 2 == 0, F.unix_seconds("ts") % 2 == 1], str(tmp_path / "files"))
    out, job = table_of(spark, "rolled")
    J.rolling_job(J.replay(spark, folder, df.schema, files_per_trigger=1), "k", "ts", "id", ["v"], out, job, delay_seconds=50_000, limit=50)
    assert spark.read.schema("id long").parquet(out).count() == 0
    # a row far ahead passes all others on; the job goes on where it ended
    spark.createDataFrame([(900, "z", START + dt.timedelta(days=3), 1.0)], df.schema).coalesce(1).write.mode("append").parquet(folder)
    J.rolling_job(J.replay(spark, folder, df.schema), "k", "ts", "id", ["v"], out, job, delay_seconds=50_000, limit=50)
    batch = M.rolling_features(df, ["k"], ["ts", "id"], [M.Rolled("v", "v", "v")], {"v": ("v_prev", "v_change")})
    columns = ["id", "k", "v_roll_mean", "v_roll_std", "v_zscore", "v_change"]
    assert sorted(map(str, rows_of(spark.read.parquet(out), *columns))) == sorted(map(str, rows_of(batch, *columns)))


def test_late_rows_of_jobs_are_kept(spark, tmp_path):
    """Behind a watermark that has passed: aside, in every job, and none is lost."""
    at = lambda s: START + dt.timedelta(seconds=s)
    first = [(0, "a", at(0)), (1, "a", at(5000)), (2, "b", at(4900))]
    second = [(3, "a", at(4000)), (4, "b", at(4400)), (5, "b", at(4401)), (6, "a", at(9000)), (7, "a", None)]
    df = spark.createDataFrame(first + second, "id long, k string, ts timestamp")
    folder = write_files(spark, df, [F.col("id") < 3, F.col("id") >= 3], str(tmp_path / "files"))
    stream = lambda: J.replay(spark, folder, df.schema, files_per_trigger=1)
    out, job = table_of(spark, "incidents")
    J.incident_job(stream(), "k", "ts", "id", out, job, gap_seconds=600)
    ids = lambda path: {r["id"] for r in spark.read.parquet(path).collect()}
    assert ids(f"{job}/late") == {3, 4, 7} and ids(out) == {0, 1, 2, 5}
    assert {r["id"] for r in spark.read.parquet(f"{job}/rows/batch=1").filter("_place = 'waiting'").collect()} == {6}
    events = df.withColumn("approved", F.when(F.col("id") % 2 == 1, True))
    folder = write_files(spark, events, [F.col("id") < 3, F.col("id") >= 3], str(tmp_path / "events"))
    out, job = table_of(spark, "approvals")
    J.approval_job(J.replay(spark, folder, events.schema, files_per_trigger=1), "k", "ts", ["id"], out, job)
    assert ids(f"{job}/late") == {3, 4, 7} and ids(out) == {0, 1, 2, 5}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    from tidewatch.streaming import state as S

    df = spark.createDataFrame([(n, START + dt.timedelta(seconds=100 * n)) for n in range(30)], "id long, ts timestamp")
    folder = write_files(spark, df, [F.col("id") < 15, F.col("id") >= 15], str(tmp_path / "files"))
    job, tries = new_table_path(spark, "again"), []

    def each(due, batch_id):
        tries.append(batch_id)
        S.put(due, f"{job}/out", batch_id)
        if len(tries) == 2:
            raise RuntimeError("lost")

    run = lambda: S.in_event_order(J.replay(spark, folder, df.schema, files_per_trigger=1), "ts", job, each)
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert tries == [0, 1, 1]
    assert sorted(r["id"] for r in spark.read.parquet(f"{job}/out").collect()) == list(range(24))


def approved(spark, df, folder, **options):
    out, job = table_of(spark, "approvals")
    J.approval_job(J.replay(spark, folder, df.schema, files_per_trigger=1), "thread", "ts", ["id"], out, job, **options)
    return [(r["id"], r["status"]) for r in spark.read.parquet(out).collect()]


def test_approvals_equal_batch(spark, tmp_path):
    """Decisions may arrive in a file before their request."""
    at = lambda s: START + dt.timedelta(seconds=s)
    rows = [
        ("t1", at(0), None, 0), ("t1", at(60), True, 1), ("t2", at(10), None, 2), ("t2", at(70), False, 3), ("t2", at(80), True, 4),
        ("t3", at(20), None, 5), ("t4", at(30), True, 6), ("t4", at(90), None, 7), ("t5", at(15), True, 8), ("t6", at(50), None, 9), ("t6", at(50), True, 10),
        ("end", at(100_000), None, 11),
    ]
    df = spark.createDataFrame(rows, "thread string, ts timestamp, approved boolean, id long")
    folder = write_files(spark, df, [F.col("id").isin(1, 3, 4, 6), F.col("id").isin(0, 2, 5, 7, 8, 9, 10), F.col("id") == 11], str(tmp_path / "files"))
    got = dict(approved(spark, df, folder))
    requests, decisions = df.filter("approved IS NULL AND thread <> 'end'"), df.filter("approved IS NOT NULL")
    times = {"requested_at": "opened", "decided_at": "ts"}
    opened = requests.select("thread", F.col("ts").alias("opened"))
    batch = {r["thread"]: r["outcome"] for r in D.outcomes(opened, decisions, "thread", ["ts", "id"], **times).collect()}
    final = {t: "pending_human_approval" for t in batch}
    for r in rows:
        if r[2] is not None and got[r[3]] in ("approved", "rejected"):
            final[r[0]] = got[r[3]]
    assert final == batch
    refused = {r["id"]: r["reason"] for r in D.refused_decisions(opened, decisions, "thread", ["ts", "id"], **times).collect()}
    assert {i: s for i, s in got.items() if s.endswith("_thread")} == refused == {4: "inactive_thread", 6: "unknown_thread", 8: "unknown_thread"}


def walked(rows, expire=None):
    """Statuses in event order, thread by thread, as a loop."""
    state, told = {}, []
    for thread, ts, approved, n in sorted(rows, key=lambda r: (r[1], r[2] is not None, r[3], bool(r[2]))):
        status, since = state.get(thread, (None, None))
        if approved is None:
            state[thread] = (status or "pending_human_approval", since or ts)
            told.append((n, state[thread][0]))
        elif status is None:
            told.append((n, "unknown_thread"))
        elif status != "pending_human_approval" or (expire and (ts - since).total_seconds() > expire):
            told.append((n, "inactive_thread"))
        else:
            state[thread] = ("approved" if approved else "rejected", since)
            told.append((n, state[thread][0]))
    return sorted(told)


@pytest.mark.parametrize("expire", [None, 200])
def test_approvals_over_batches_equal_a_loop(spark, tmp_path, expire):
    """Threads go on over three batches: repeated requests, equal events, decisions before, after and long after."""
    draw = random.Random(12)
    rows = [(draw.choice("abcdefgh"), START + dt.timedelta(seconds=30 * draw.randrange(100)), draw.choice([None, True, False]), draw.randrange(3)) for _ in range(300)]
    rows += rows[:20]
    cut = lambda lo, hi: (F.col("ts") >= F.lit(START + dt.timedelta(seconds=lo))) & (F.col("ts") < F.lit(START + dt.timedelta(seconds=hi)))
    df = spark.createDataFrame([*rows, ("end", START + dt.timedelta(days=2), None, 9)], "thread string, ts timestamp, approved boolean, id long")
    folder = write_files(spark, df, [cut(0, 1000), cut(1000, 2200), cut(2200, 10**6)], str(tmp_path / "files"))
    assert sorted(approved(spark, df, folder, expire_seconds=expire, delay_seconds=1)) == walked(rows, expire)


def test_ingest_equals_batch(spark, tmp_path):
    docs = [[trace("a"), trace("b", tier="high")], [trace("a", latency=1.0), trace("c", latency=70000.0)], [trace("d", ts="2026-07-12T00:00:00+00:00"), trace("e", category=None)]]
    for n, part in enumerate(docs):
        (tmp_path / f"{n}.json").write_text("\n".join(map(json.dumps, part)))
        os.utime(tmp_path / f"{n}.json", (1_700_000_000 + n * 10,) * 2)
    facts, rolled = new_table_path(spark, "facts"), new_table_path(spark, "rollup")
    J.ingest_traces(J.trace_stream(spark, str(tmp_path), 1), facts, rolled)
    stored = spark.read.parquet(facts)
    assert {r["prompt_id"] for r in stored.collect()} == {"a", "b", "c", "d"} and stored.count() == 4
    batch = R.daily_rollup(stored)
    assert sorted(map(str, spark.read.parquet(rolled).select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_late_rows_go_aside(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    df = spark.createDataFrame([(0, "a", at(0)), (1, "a", at(5000)), (2, "a", at(4500)), (3, "a", at(1000)), (4, "b", at(10)), (5, "a", at(6000))], "id long, k string, ts timestamp")
    folder = write_files(spark, df, [F.col("id") < 2, F.col("id") >= 2], str(tmp_path / "files"))
    late, on_time = new_table_path(spark, "late"), new_table_path(spark, "on-time")
    J.split_late(J.replay(spark, folder, df.schema, files_per_trigger=1), ["k"], "ts", late, on_time, new_table_path(spark, "late-job"))
    assert {r["id"] for r in spark.read.parquet(late).collect()} == {3}
    assert {r["id"] for r in spark.read.parquet(on_time).collect()} == {0, 1, 2, 4, 5}


def test_approvals_move_events_once_for_state_and_once_for_status(spark, tmp_path, monkeypatch):
    """The state is written before the events are judged by it, and is not worked out again for them."""
    df = spark.createDataFrame([("a", START, None, 0), ("a", START, True, 1), ("end", START + dt.timedelta(days=1), None, 2)], "thread string, ts timestamp, approved boolean, id long")
    folder = write_files(spark, df, [F.col("id") >= 0], str(tmp_path / "files"))
    moves = []

    def put(out, path, batch_id, real=J.put):
        plan = out._jdf.queryExecution().executedPlan().toString()
        if "status" in out.columns:
            moves.append(plan.count("Exchange hashpartitioning"))
        real(out, path, batch_id)

    monkeypatch.setattr(J, "put", put)
    assert sorted(approved(spark, df, folder)) == [(0, "pending_human_approval"), (1, "approved")] and max(moves) <= 3
