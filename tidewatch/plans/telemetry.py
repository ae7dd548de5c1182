"""Rolling features, incidents, truth windows and injections over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import incidents as I
from tidewatch.operators import metrics as M
from tidewatch.plans.registry import bound, query, table

ORDER = ["ts", "event_id"]
# the test events are sparse, so the gap is wider than the operator's default
GAP = 7200


def metric_events(spark, sf):
    """Events as a metric table: value and the number in props."""
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "value", k.alias("k"))


def scored(spark, sf, key="event_type"):
    """Events with their rolling z-score, and a bound on the rows of a key."""
    events = table(spark, sf, "events").select("event_id", "ts", key, "value")
    rows = bound(spark, sf, "events", key)
    done = M.rolling_features(events, [key], ORDER, [M.Rolled("value", "value", "value")], group_rows=rows)
    return done, rows


def anomalies(spark, sf):
    done, rows = scored(spark, sf)
    return done.filter(F.col("value_zscore") >= 2.5), rows


Z_SQL = """
z AS (
  SELECT event_id, ts, event_type, value,
         (value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0) AS z
  FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)
), anomaly AS (SELECT * FROM z WHERE z >= 2.5)"""
MARK_SQL = Z_SQL + """,
gaps AS (
  SELECT *, CASE WHEN lag(ts) OVER k IS NULL OR ts - lag(ts) OVER k > INTERVAL '7200 seconds' THEN 1 ELSE 0 END AS opens
  FROM anomaly WINDOW k AS (PARTITION BY event_type ORDER BY ts, event_id)
), marked AS (
  SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS incident_no FROM gaps
)"""


def marked_events(spark, sf):
    found, rows = anomalies(spark, sf)
    return I.mark_incidents(found, "event_type", "ts", ["event_id"], GAP, group_rows=rows)


@query(
    "incident_summary",
    f"""WITH {MARK_SQL}
SELECT event_type, count(*) AS anomalous_rows, sum(opens) AS incidents_opened,
       sum(1 - opens) AS rows_continued
FROM marked GROUP BY event_type""",
)
def incident_summary(spark, sf):
    return I.incident_counts(marked_events(spark, sf), "event_type")


@query(
    "incident_rows",
    f"""WITH {MARK_SQL}
SELECT event_type, incident_no, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_rows
FROM marked GROUP BY event_type, incident_no""",
)
def incident_rows(spark, sf):
    return I.incidents(marked_events(spark, sf), "event_type", "ts")


ROLL_SQL = """
SELECT event_id, event_type,
       round(coalesce(avg(value) OVER w, 0), 6) AS value_roll_mean,
       round(coalesce(stddev_samp(value) OVER w, 0), 6) AS value_roll_std,
       round(coalesce(avg(k) OVER w, 0), 6) AS k_roll_mean,
       round(coalesce(stddev_samp(k) OVER w, 0), 6) AS k_roll_std,
       round(coalesce((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 0), 6) AS value_zscore,
       round(coalesce((k - avg(k) OVER w) / nullif(stddev_samp(k) OVER w, 0), 0), 6) AS k_zscore,
       round(coalesce(value - lag(value) OVER o, 0), 6) AS value_change,
       coalesce(value / nullif(k, 0), 0) AS value_per_k
FROM base
WINDOW o AS (PARTITION BY {keys} ORDER BY ts, event_id),
       w AS (PARTITION BY {keys} ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)"""
BASE_SQL = "SELECT event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"
ROLLED = [M.Rolled("value", "value", "value"), M.Rolled("k", "k", "k")]
FEATURES = [
    "value_roll_mean", "value_roll_std", "k_roll_mean", "k_roll_std", "value_zscore", "k_zscore",
    "value_change",
]
EXTRA = {
    "deltas": {"value": ("value_prev", "value_change")},
    "ratios": {"value_per_k": ("value", "k")},
}


def rounded(df, ids, columns, places=6):
    return df.select(*ids, *[F.round(c, places).alias(c) for c in columns])


@query("rolling_features", f"WITH base AS ({BASE_SQL})" + ROLL_SQL.format(keys="event_type"))
def rolling_features(spark, sf):
    done = M.rolling_features(
        metric_events(spark, sf), ["event_type"], ORDER, ROLLED, group_rows=bound(spark, sf, "events", "event_type"), **EXTRA
    )
    return rounded(M.fill_gaps(done), ["event_id", "event_type", "value_per_k"], FEATURES)


# a full set of service metrics made of the two that the events hold; times are told apart by the event's number
METRICS = {
    "cpu_pct": "value", "memory_pct": "value * 0.5 + k", "latency_p50_ms": "value * 2", "latency_p95_ms": "value * 3 + k",
    "latency_p99_ms": "value * 4 + k", "error_rate_pct": "k * 0.125", "queue_depth": "k * 2", "thread_count": "k",
}


def telemetry_sql():
    """The nineteen model inputs, spelled out from the metrics' names."""
    z = "coalesce(({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0), 0)"
    change = "coalesce({c} - lag({c}) OVER o, 0)"
    terms = {c: c for c in METRICS}
    for c, name in zip(
        ("cpu_pct", "memory_pct", "latency_p95_ms", "error_rate_pct", "queue_depth", "thread_count"),
        ("cpu", "mem", "latency", "error", "queue", "thread"),
    ):
        terms[f"{name}_zscore"] = z.format(c=c)
    for c, name in (("cpu_pct", "cpu"), ("latency_p95_ms", "latency"), ("memory_pct", "memory")):
        terms[f"{name}_rate_of_change"] = change.format(c=c)
    terms["latency_per_cpu_ratio"] = "coalesce(latency_p95_ms / nullif(cpu_pct, 0), 0)"
    terms["queue_per_thread_ratio"] = "coalesce(queue_depth / nullif(thread_count, 0), 0)"
    return ", ".join(f"round({e}, 6) AS {c}" for c, e in terms.items())


@query(
    "telemetry_features",
    f"""WITH base AS ({BASE_SQL}), telemetry AS (
  SELECT event_id, event_type AS service_name, ts + to_microseconds(event_id) AS seen_at, {', '.join(f'{e} AS {c}' for c, e in METRICS.items())} FROM base)
SELECT event_id, service_name, {telemetry_sql()} FROM telemetry
WINDOW o AS (PARTITION BY service_name ORDER BY seen_at), w AS (PARTITION BY service_name ORDER BY seen_at ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)""",
)
def telemetry_features(spark, sf):
    """The feature table of a service's telemetry, all nineteen model inputs."""
    at = F.expr("timestampadd(MICROSECOND, event_id, ts)")
    metrics = metric_events(spark, sf).select(
        "event_id", F.col("event_type").alias("service_name"), at.alias("timestamp"), *[F.expr(e).alias(c) for c, e in METRICS.items()]
    )
    done = M.telemetry_features(metrics, group_rows=bound(spark, sf, "events", "event_type"))
    return rounded(done, ["event_id", "service_name"], M.MODEL_INPUTS)


@query(
    "batch_local_features",
    f"""WITH numbered AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM ({BASE_SQL})),
base AS (SELECT *, CAST(floor(i / 50) AS BIGINT) AS batch_id FROM numbered)"""
    + ROLL_SQL.format(keys="batch_id, event_type").replace("event_type,\n", "event_type, batch_id,\n", 1),
)
def batch_local_features(spark, sf):
    done = M.batch_local_features(
        metric_events(spark, sf), ["event_type"], ORDER, ROLLED, table_rows=bound(spark, sf, "events"), **EXTRA
    )
    return rounded(M.fill_gaps(done), ["event_id", "event_type", "batch_id", "value_per_k"], FEATURES)


@query(
    "rolling_eda",
    """SELECT event_id, user_id, round(avg(value) OVER w, 6) AS value_roll_mean,
       round(stddev_samp(value) OVER w, 6) AS value_roll_std
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)""",
)
def rolling_eda(spark, sf):
    done, _ = scored(spark, sf, "user_id")
    return rounded(done, ["event_id", "user_id"], ["value_roll_mean", "value_roll_std"])


@query(
    "replay_prefix",
    "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 500",
)
def replay_prefix(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return M.first_rows(events, ORDER, 500)


# --- truth windows: two hours from each event of 200 or more ------------------------------------

WINDOWS_SQL = """
win AS (
  SELECT event_type, event_id AS window_no, ts AS start_ts, ts + INTERVAL '7200 seconds' AS end_ts
  FROM events WHERE value >= 200
)"""


def truth_windows(spark, sf):
    return (
        table(spark, sf, "events")
        .filter(F.col("value") >= 200)
        .select("event_type", F.col("event_id").alias("window_no"), F.col("ts").alias("start_ts"),
                (F.col("ts") + I.seconds(7200)).alias("end_ts"))
    )


@query(
    "window_match",
    f"""WITH {Z_SQL}, {WINDOWS_SQL}
SELECT a.event_id, min(w.window_no) AS window_no
FROM anomaly a JOIN win w ON a.event_type = w.event_type
 AND a.ts >= w.start_ts - INTERVAL '300 seconds' AND a.ts <= w.end_ts + INTERVAL '300 seconds'
GROUP BY a.event_id""",
)
def window_match(spark, sf):
    found, _ = anomalies(spark, sf)
    return I.match_windows(found, truth_windows(spark, sf), "event_type", "ts", "event_id")


@query(
    "window_recall",
    f"""WITH {Z_SQL}, {WINDOWS_SQL}, hit AS (
  SELECT a.event_id, min(w.window_no) AS window_no
  FROM anomaly a JOIN win w ON a.event_type = w.event_type
   AND a.ts >= w.start_ts - INTERVAL '300 seconds' AND a.ts <= w.end_ts + INTERVAL '300 seconds'
  GROUP BY a.event_id)
SELECT (SELECT count(*) FROM anomaly) AS total_detections, (SELECT count(*) FROM win) AS total_windows,
       (SELECT count(*) FROM hit) AS detections_matched,
       (SELECT count(DISTINCT window_no) FROM hit) AS windows_recalled,
       round(100.0 * (SELECT count(DISTINCT window_no) FROM hit) / (SELECT count(*) FROM win), 2) AS recall_pct""",
)
def window_recall(spark, sf):
    found, _ = anomalies(spark, sf)
    return I.window_recall(found, truth_windows(spark, sf), "event_type", "ts", "event_id")


@query(
    "label_by_window",
    f"""WITH {WINDOWS_SQL}
SELECT event_id, CASE WHEN EXISTS (
  SELECT 1 FROM win w WHERE w.event_type = e.event_type AND e.ts >= w.start_ts AND e.ts <= w.end_ts
) THEN 1 ELSE 0 END AS is_anomaly FROM events e""",
)
def label_by_window(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    done = I.label_by_windows(events, truth_windows(spark, sf), "event_type", "ts")
    return done.select("event_id", "is_anomaly")


# --- injection: a window of 12 rows (36 for a drift) from each event of 250 or more ---------------

KINDS = {"click": "spike", "view": "spike", "error": "slow_drift", "signup": "flatline", "purchase": "flatline"}


@query(
    "inject_spike_drift_flat",
    """WITH idx AS (
  SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         value AS v2, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events
), win AS (
  SELECT event_type, event_id AS no, i AS s,
         CASE WHEN event_type IN ('click', 'view') THEN 'spike' WHEN event_type = 'error' THEN 'slow_drift' ELSE 'flatline' END AS kind,
         i + CASE WHEN event_type = 'error' THEN 36 ELSE 12 END AS e
  FROM idx WHERE value >= 250
), sd AS (SELECT event_type, stddev_pop(value) AS sv, stddev_pop(k) AS sk FROM idx GROUP BY event_type
), pair AS (
  SELECT x.event_id, w.kind, w.no, w.s, x.i - w.s AS step, w.e - w.s - 1 AS whole
  FROM idx x JOIN win w ON x.event_type = w.event_type AND x.i >= w.s AND x.i < w.e
), eff AS (
  SELECT event_id,
         sum(CASE WHEN kind = 'spike' THEN 0.5 - 0.5 * cos(2 * pi() * step / whole) END) AS bump,
         sum(CASE WHEN kind = 'slow_drift' THEN step / whole END) AS ramp,
         max_by(CASE WHEN kind = 'flatline' THEN s END, CASE WHEN kind = 'flatline' THEN no END) AS fs
  FROM pair GROUP BY event_id
)
SELECT x.event_id,
       round(x.value + coalesce(5.0 * sd.sv * eff.bump, 0), 6) AS value,
       round(x.k + coalesce(4.0 * sd.sk * eff.ramp, 0), 6) AS k,
       round(CASE WHEN eff.fs IS NOT NULL THEN f.v2 ELSE x.v2 END, 6) AS v2,
       CASE WHEN eff.event_id IS NOT NULL THEN 1 ELSE 0 END AS is_anomaly
FROM idx x JOIN sd USING (event_type) LEFT JOIN eff ON x.event_id = eff.event_id
LEFT JOIN idx f ON f.event_type = x.event_type AND f.i = eff.fs""",
)
def inject_spike_drift_flat(spark, sf):
    from tidewatch.operators.ordered import running_sums

    numbered = running_sums(
        metric_events(spark, sf), ["event_type"], ORDER, {"i": F.lit(1)}, group_rows=bound(spark, sf, "events", "event_type")
    )
    rows = numbered.select("event_id", "event_type", "value", "k", F.col("value").alias("v2"), (F.col("i") - 1).alias("i"))
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.col("event_type")]
    windows = rows.filter(F.col("value") >= 250).select(
        "event_type", kind.alias("kind"), F.col("i").alias("start_idx"),
        (F.col("i") + F.when(kind == "slow_drift", 36).otherwise(12)).alias("end_idx"),
        F.col("event_id").alias("window_no"),
    )
    done = I.inject(rows, windows, "event_type", "i", ["value"], ["k"], ["v2"])
    return done.select("event_id", *[F.round(c, 6).alias(c) for c in ("value", "k", "v2")], "is_anomaly")


# --- message text --------------------------------------------------------------------------------


@query(
    "wait_hints",
    """SELECT event_id, round(CASE event_type WHEN 'error' THEN k * 60 + value WHEN 'click' THEN value ELSE 15.0 END, 6) AS wait_s
FROM (SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""",
)
def wait_hints(spark, sf):
    events = metric_events(spark, sf)
    message = (
        F.when(F.col("event_type") == "error", F.format_string("limit hit, try again in %.0fm%.2fs", "k", "value"))
        .when(F.col("event_type") == "click", F.format_string("please try again in %.2fs.", "value"))
        .otherwise("connection reset")
    )
    return events.select("event_id", F.round(I.wait_hint_seconds(message, 15.0), 6).alias("wait_s"))
