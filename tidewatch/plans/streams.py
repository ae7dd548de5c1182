"""Stream jobs run over the stored tables, checked against the SQL of their batch twins.

A stream gives out what its watermark has passed: rows up to ten minutes before the newest one. The others wait in its state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import rollup as R
from tidewatch.plans.accounts import DECISION_ORDER, approvals
from tidewatch.plans.registry import query, table
from tidewatch.plans.telemetry import GAP
from tidewatch.plans.traces import FACT_SQL, ROLLUP_SQL, documents, rollup_output
from tidewatch.session import new_table_path
from tidewatch.sources import writers
from tidewatch.streaming import jobs as J

PASSED = "ts <= (SELECT max(ts) - INTERVAL '10 minutes' FROM {})"
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return J.replay(spark, sf, schema, glob="events.parquet")


@query(
    "stream_replay",
    "SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY event_type",
)
def stream_replay(spark, sf):
    path = J.run_to_table(event_stream(spark, sf), "replayed")
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "stream_rolling",
    f"""SELECT * FROM (
  SELECT event_id, event_type, round(avg(value) OVER w, 6) AS value_roll_mean, round(stddev_samp(value) OVER w, 6) AS value_roll_std,
         round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 6) AS value_zscore,
         round(value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS value_change
  FROM events WHERE {PASSED.format('events')}
  WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND CURRENT ROW))""",
)
def stream_rolling(spark, sf):
    path = new_table_path(spark, "rolled")
    J.rolling_job(event_stream(spark, sf), "event_type", "ts", "event_id", ["value"], path, new_table_path(spark, "rolling"))
    done = spark.read.parquet(path)
    return done.select("event_id", "event_type", *[F.round(c, 6).alias(c) for c in done.columns if c.startswith("value_")])


HIGH_SQL = f"""
high AS (SELECT * FROM events WHERE value >= 100),
seen AS (SELECT * FROM high WHERE {PASSED.format('high')}),
gaps AS (
  SELECT *, CASE WHEN lag(ts) OVER k IS NULL OR ts - lag(ts) OVER k > INTERVAL '{GAP} seconds' THEN 1 ELSE 0 END AS opens
  FROM {{}} WINDOW k AS (PARTITION BY event_type ORDER BY ts, event_id)),
marked AS (SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS incident_no FROM gaps)"""


def high_stream(spark, sf):
    return event_stream(spark, sf).filter(F.col("value") >= 100)


@query("stream_incidents", f"WITH {HIGH_SQL.format('seen')} SELECT event_id, event_type, opens, incident_no FROM marked")
def stream_incidents(spark, sf):
    path = new_table_path(spark, "incidents")
    J.incident_job(high_stream(spark, sf), "event_type", "ts", "event_id", path, new_table_path(spark, "incident-job"), GAP)
    return spark.read.parquet(path).select("event_id", "event_type", "opens", "incident_no")


@query(
    "stream_closed_incidents",
    f"""WITH {HIGH_SQL.format('high')},
s AS (SELECT event_type, incident_no, min(ts) AS a, max(ts) AS b, count(*) AS n_rows FROM marked GROUP BY ALL)
SELECT event_type, strftime(a, '%Y-%m-%d %H:%M:%S.%f') AS start_ts, strftime(b, '%Y-%m-%d %H:%M:%S.%f') AS end_ts, n_rows FROM s
WHERE b + INTERVAL '{GAP} seconds' <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '10 minutes' FROM high)""",
)
def stream_closed_incidents(spark, sf):
    closed = J.closed_incidents(high_stream(spark, sf), "event_type", "ts", GAP)
    done = spark.read.parquet(J.run_to_table(closed, "closed"))
    return done.select("event_type", *[F.date_format(c, TIME).alias(c) for c in ("start_ts", "end_ts")], "n_rows")


@query(
    "stream_actions",
    f"""WITH {HIGH_SQL.format('seen')}
SELECT event_id, 'INC-' || upper(substr(md5(event_type || ':' || CAST(incident_no AS BIGINT)), 1, 10)) AS incident_id FROM marked WHERE opens = 1""",
)
def stream_actions(spark, sf):
    """Run twice into one table: the second run must add nothing."""
    path = new_table_path(spark, "actions")
    for _ in range(2):
        out, folder = new_table_path(spark, "incidents"), new_table_path(spark, "incident-job")
        J.incident_job(high_stream(spark, sf), "event_type", "ts", "event_id", out, folder, GAP, actions=path)
    return spark.read.parquet(path).select("event_id", "incident_id")


@query(
    "stream_approvals",
    """WITH ev AS (
  SELECT o_orderkey AS thread_id, o_orderdate AS ts, NULL AS approved, -1 AS l_linenumber, -1 AS l_partkey, -1 AS l_suppkey, -1.0 AS l_extendedprice
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT l_orderkey, l_shipdate, l_returnflag = 'A', l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem),
passed AS (SELECT * FROM ev WHERE ts <= (SELECT max(ts) - INTERVAL '10 minutes' FROM ev)),
req AS (SELECT thread_id, ts FROM passed WHERE approved IS NULL),
dec AS (
  SELECT p.*, r.thread_id IS NOT NULL AND p.ts >= r.ts AS known FROM passed p LEFT JOIN req r ON p.thread_id = r.thread_id WHERE approved IS NOT NULL),
dr AS (SELECT *, row_number() OVER (PARTITION BY thread_id, known ORDER BY ts, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM dec)
SELECT thread_id, l_linenumber, l_partkey, CASE WHEN NOT known THEN 'unknown_thread' WHEN rn > 1 THEN 'inactive_thread' WHEN approved THEN 'approved' ELSE 'rejected' END AS status FROM dr
UNION ALL SELECT thread_id, -1, -1, 'pending_human_approval' FROM req""",
)
def stream_approvals(spark, sf):
    """Requests and decisions as one stream; matches the batch outcome per thread."""
    requests, decisions = approvals(spark, sf)
    numbers = DECISION_ORDER[1:]
    types = dict(decisions.dtypes)
    opened = requests.select(
        "thread_id", F.col("o_orderdate").alias("ts"), F.lit(None).cast("boolean").alias("approved"),
        *[F.lit(-1).cast(types[c]).alias(c) for c in numbers],
    )
    every = opened.unionByName(decisions.withColumnRenamed("l_shipdate", "ts"))
    path = new_table_path(spark, "approval-events")
    writers.write_table(every, path)
    out = new_table_path(spark, "approvals")
    J.approval_job(J.replay(spark, path, every.schema), "thread_id", "ts", numbers, out, new_table_path(spark, "approval-job"))
    done = spark.read.parquet(out)
    return done.select("thread_id", "l_linenumber", "l_partkey", "status")


@query(
    "stream_ingest",
    f"WITH {FACT_SQL.replace('fact AS (', 'every AS (')}, fact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY event_timestamp) AS rn FROM every) WHERE rn = 1) {ROLLUP_SQL}",
)
def stream_ingest(spark, sf):
    """Trace documents streamed into facts and rollup; equals the batch rollup."""
    docs, facts, rolled = (new_table_path(spark, n) for n in ("docs", "facts", "rollup"))
    writers.write_json(documents(spark, sf), docs)
    J.ingest_traces(J.trace_stream(spark, docs), facts, rolled)
    return rollup_output(spark.read.parquet(rolled))


@query(
    "stream_late",
    """WITH cut AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half FROM events),
early AS (SELECT *, event_id % 5 <> 0 OR ts > half AS early FROM events, cut),
newest AS (SELECT event_type, max(ts) AS newest FROM early WHERE early GROUP BY event_type)
SELECT event_id, (NOT early AND coalesce(ts < newest - INTERVAL '10 minutes', false))::INT AS is_late FROM early LEFT JOIN newest USING (event_type)""",
)
def stream_late(spark, sf):
    """A fifth of the first half's events arrives a run after all others: those far behind their type's newest event go aside."""
    events = table(spark, sf, "events")
    bounds = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("half"))
    early = events.crossJoin(bounds).withColumn("early", (F.col("event_id") % 5 != 0) | (F.col("ts") > F.col("half"))).drop("half")
    arriving, late, on_time, folder = (new_table_path(spark, n) for n in ("arriving", "late", "on-time", "late-job"))
    for first in (True, False):
        early.filter(F.col("early") == first).drop("early").write.mode("append").parquet(arriving)
        J.split_late(J.replay(spark, arriving, events.schema), ["event_type"], "ts", late, on_time, folder)
    read = lambda path, flag: spark.read.parquet(path).select("event_id", F.lit(flag).alias("is_late"))
    return read(late, 1).unionByName(read(on_time, 0))
