"""Traces, contracts, decisions and rollups over records that Spark derives from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import contracts as K
from tidewatch.operators import decisions as D
from tidewatch.operators import incidents as I
from tidewatch.operators import metrics as M
from tidewatch.operators import rollup as R
from tidewatch.plans.registry import bound, query, spread, table
from tidewatch.session import new_table_path
from tidewatch.sources import keyed, readers, writers

# Both engines read these expressions; k is the number in props.
CATEGORY = """CASE event_type WHEN 'click' THEN 'benign' WHEN 'view' THEN 'roleplay' WHEN 'error' THEN 'obfuscation'
 WHEN 'signup' THEN 'direct_injection' ELSE 'instruction_override' END"""
TIER = "CASE WHEN value >= 150 THEN 'high' WHEN value >= 60 THEN 'medium' ELSE 'low' END"
TRIAGED = "CASE WHEN k < 25 THEN 'allow' WHEN k < 50 THEN 'sanitize' WHEN k < 75 THEN 'block' ELSE 'escalate' END"
JUDGED = "CASE WHEN user_id < 40 THEN 'allow' WHEN user_id < 80 THEN 'sanitize' WHEN user_id < 120 THEN 'block' ELSE 'escalate' END"
STATUS = "CASE WHEN k = {} THEN 'validation_failed' ELSE 'success' END"
LATENCY = "CASE WHEN k = 5 THEN NULL ELSE value * 1000 END"

BASE_SQL = f"""
base AS (
  SELECT event_id, ts, event_type, user_id, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
rec AS (
  SELECT *, {CATEGORY} AS category, {TIER} AS tier, {TRIAGED} AS triaged,
         CASE WHEN value >= 60 THEN {JUDGED} END AS judged,
         {STATUS.format(7)} AS t_status,
         CASE WHEN value >= 60 AND value < 150 THEN {STATUS.format(13)} END AS s_status,
         CASE WHEN value >= 60 THEN {STATUS.format(17)} END AS j_status,
         {LATENCY} AS latency,
         'PROMPT-' || user_id || '-' || k AS prompt_id
  FROM base),
ranked AS (
  SELECT *, CASE triaged WHEN 'allow' THEN 0 WHEN 'sanitize' THEN 1 WHEN 'block' THEN 2 ELSE 3 END AS t_rank,
         CASE judged WHEN 'allow' THEN 0 WHEN 'sanitize' THEN 1 WHEN 'block' THEN 2 WHEN 'escalate' THEN 3 ELSE -1 END AS j_rank,
         coalesce(judged <> triaged, false) AS disagreed,
         (t_status <> 'success' OR coalesce(s_status <> 'success', false) OR coalesce(j_status <> 'success', false)) AS failed
  FROM rec),
decided AS (
  SELECT *, CASE greatest(t_rank, j_rank) WHEN 0 THEN 'allow' WHEN 1 THEN 'sanitize' WHEN 2 THEN 'block' ELSE 'escalate' END AS final,
         (tier = 'high' OR disagreed OR failed) AS notify FROM ranked)"""


def base_events(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").withColumn("k", k).drop("props")


def records(spark, sf):
    """Events with assembled triage, sanitizer and judge records, one trace per event."""
    base = base_events(spark, sf).withColumn("key", F.col("event_id"))
    e = F.expr
    prompts = base.select("key", "event_id", "ts", "value", e(f"{CATEGORY} AS category"), e(f"{TIER} AS tier"),
                          e(f"CAST({LATENCY} AS DOUBLE) AS latency"),
                          F.concat_ws("-", F.lit("PROMPT"), "user_id", "k").alias("prompt_id"))
    triage = base.select("key", e(f"{TRIAGED} AS disposition"), e(f"{STATUS.format(7)} AS agent_status"),
                         e("value >= 60 AND value < 150 AS requires_sanitization"), e("value >= 60 AS requires_judge_review"))
    sanitizer = base.select("key", e(f"{STATUS.format(13)} AS agent_status"))
    judge = base.select("key", e(f"{JUDGED} AS judge_disposition"), e(f"{TRIAGED} AS triage_disposition_reviewed"),
                        e(f"({JUDGED}) = ({TRIAGED}) AS agrees_with_triage"), e(f"{STATUS.format(17)} AS agent_status"))
    return D.assemble_traces(prompts, triage, sanitizer, judge, "key")


def decided(spark, sf):
    rows = records(spark, sf)
    c = F.col
    report = D.escalation(
        c("key"), c("tier"), c("triage.disposition"), c("judge.judge_disposition"), c("judge.agrees_with_triage"),
        c("triage.agent_status"), c("sanitizer.agent_status"), c("judge.agent_status"),
    )
    final = D.more_conservative(c("triage.disposition"), c("judge.judge_disposition"))
    return rows.withColumn("escalation", F.struct(*[v.alias(n) for n, v in report.items()])).withColumns(
        {"final_disposition": final, "pipeline_status": D.pipeline_status(F.col("escalation.agent_status"))}
    )


@query(
    "trace_decision",
    f"""WITH {BASE_SQL}
SELECT event_id, final AS final_disposition, CASE WHEN failed THEN 'escalate' ELSE final END AS recommended_action,
       CASE WHEN failed THEN 'validation_failed' ELSE 'success' END AS pipeline_status,
       disagreed::INT AS agents_disagreed, notify::INT AS notify_slack,
       'INC-' || upper(substr(md5(event_id::VARCHAR), 1, 10)) AS incident_id,
       CASE WHEN NOT notify THEN 'routine pipeline pass -- no escalation criteria met' ELSE
         array_to_string(list_filter([
           CASE WHEN tier = 'high' THEN 'classifier risk_tier is HIGH' END,
           CASE WHEN disagreed THEN 'Triage/Judge disagreement (triage=''' || triaged || ''', judge=''' || judged || ''')' END,
           CASE WHEN failed THEN 'fail-closed fallback triggered in: ' || array_to_string(list_filter([
             CASE WHEN t_status <> 'success' THEN 'triage' END, CASE WHEN s_status <> 'success' THEN 'sanitizer' END,
             CASE WHEN j_status <> 'success' THEN 'judge' END], lambda x: x IS NOT NULL), ', ') END
         ], lambda x: x IS NOT NULL), '; ') END AS escalation_reason,
       CASE CASE WHEN failed THEN 'escalate' ELSE final END
         WHEN 'allow' THEN 'No action needed.'
         WHEN 'sanitize' THEN 'Sanitized version forwarded downstream. Spot-check recommended.'
         WHEN 'block' THEN 'Request blocked automatically. Log for weekly pattern review.'
         ELSE 'Route to human security reviewer within 1 hour SLA.' END AS action_text
FROM decided""",
)
def trace_decision(spark, sf):
    return decided(spark, sf).select(
        "event_id", "final_disposition", "escalation.recommended_action", "pipeline_status",
        F.col("escalation.agents_disagreed").cast("int").alias("agents_disagreed"),
        F.col("escalation.notify_slack").cast("int").alias("notify_slack"),
        "escalation.incident_id", "escalation.escalation_reason",
        D.action_text(F.col("escalation.recommended_action")).alias("action_text"),
    )


def documents(spark, sf, bad_times=False):
    """Trace documents of the events: some without a category, some with an unreadable time."""
    rows = decided(spark, sf)
    k = F.element_at(F.split("prompt_id", "-"), 3)
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return rows.select(
        "prompt_id",
        F.struct(
            F.when(k != "3", F.col("category")).alias("attack_category"),
            F.col("tier").alias("classifier_risk_tier"), "triage.disposition", "triage.agent_status",
        ).alias("triage"),
        "judge", F.struct("escalation.agents_disagreed", "escalation.severity", "escalation.notify_slack").alias("escalation"),
        "final_disposition", "pipeline_status", F.col("latency").alias("total_latency_ms"),
        (F.when(k == "9", F.lit("yesterday")).otherwise(time) if bad_times else time).alias("timestamp"),
    )


def scanned(spark, sf, bad_times=False):
    """The documents written as JSON lines and read back with the fixed schema."""
    path = new_table_path(spark, "traces")
    writers.write_json(documents(spark, sf, bad_times), path)
    return R.flatten_traces(readers.read_traces(spark, path))


FACT_SQL = BASE_SQL + """,
fact AS (
  SELECT prompt_id, category AS attack_category, tier AS classifier_risk_tier, final AS final_disposition,
         CASE WHEN failed THEN 'validation_failed' ELSE 'success' END AS pipeline_status, triaged AS triage_disposition,
         judged AS judge_disposition, disagreed AS agents_disagreed, tier AS escalation_severity, notify AS notify_slack,
         CAST(latency AS DECIMAL(12, 2)) AS total_latency_ms, coalesce(latency > 60000, false) AS sla_breached,
         ts AS event_timestamp, event_id, k
  FROM decided WHERE k <> 3)"""
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def fact_output(df):
    ints = ("agents_disagreed", "notify_slack", "sla_breached")
    return df.withColumns({c: F.col(c).cast("int") for c in ints}).withColumn(
        "total_latency_ms", F.col("total_latency_ms").cast("double")
    )


@query(
    "trace_facts",
    f"""WITH {FACT_SQL}
SELECT prompt_id, attack_category, classifier_risk_tier, final_disposition, pipeline_status, triage_disposition,
       judge_disposition, agents_disagreed::INT AS agents_disagreed, escalation_severity, notify_slack::INT AS notify_slack,
       total_latency_ms::DOUBLE AS total_latency_ms, sla_breached::INT AS sla_breached,
       CASE WHEN k <> 9 THEN strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS event_time
FROM fact""",
)
def trace_facts(spark, sf):
    good, _ = R.split_facts(scanned(spark, sf, bad_times=True))
    time = F.when(~F.col("timestamp_fallback"), F.date_format("event_timestamp", TIME))
    return fact_output(good).withColumn("event_time", time).drop("event_timestamp", "timestamp_fallback")


@query("skipped_traces", f"WITH {BASE_SQL} SELECT count(*) FILTER (WHERE k <> 3) AS kept, count(*) FILTER (WHERE k = 3) AS skipped FROM decided")
def skipped_traces(spark, sf):
    return scanned(spark, sf).agg(F.count_if(R.well_formed()).alias("kept"), F.count_if(~R.well_formed()).alias("skipped"))


def facts(spark, sf):
    good, _ = R.split_facts(scanned(spark, sf))
    return good.drop("timestamp_fallback")


@query(
    "append_new",
    f"""WITH {FACT_SQL}, stored AS (SELECT prompt_id FROM fact WHERE event_timestamp < TIMESTAMP '2024-01-16')
SELECT prompt_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY event_timestamp) AS rn FROM fact)
WHERE rn = 1 AND prompt_id NOT IN (SELECT prompt_id FROM stored)""",
)
def append_new(spark, sf):
    every = facts(spark, sf)
    earlier = every.filter(F.col("event_timestamp") < F.lit("2024-01-16").cast("timestamp"))
    new = R.new_rows(every, earlier, "prompt_id", "event_timestamp")
    return new.select("prompt_id", F.date_format("event_timestamp", TIME).alias("event_time"))


@query("append_keyed", f"WITH {FACT_SQL} SELECT prompt_id, strftime(min(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS event_time FROM fact GROUP BY prompt_id")
def append_keyed(spark, sf):
    """Two batches into a table in folders by key with filters; the second holds all of the first again."""
    every = facts(spark, sf).select("prompt_id", "event_timestamp")
    path = new_table_path(spark, "keyed")
    keyed.append_new(every.filter(F.col("event_timestamp") < F.lit("2024-01-16").cast("timestamp")), path, "prompt_id", "event_timestamp", buckets=16)
    keyed.append_new(every, path, "prompt_id", "event_timestamp", buckets=16)
    return keyed.read(spark, path).select("prompt_id", F.date_format("event_timestamp", TIME).alias("event_time"))


def cents(n, d):
    """Half-up quotient of whole numbers to two places, exact."""
    return f"((2 * ({n}) + {d}) // (2 * {d})) / 100.0"


COUNT_SQL = """count(*) AS total_requests, count(*) FILTER (WHERE final_disposition = 'escalate') AS escalated_count,
       count(*) FILTER (WHERE agents_disagreed) AS disagreement_count,
       count(*) FILTER (WHERE pipeline_status <> 'success') AS fail_closed_count,
       ((2 * sum(CAST(total_latency_ms * 100 AS BIGINT)) + count(total_latency_ms)) // (2 * count(total_latency_ms))) / 100.0 AS avg_latency_ms,
       count(*) FILTER (WHERE sla_breached) AS sla_breach_count"""
ROLLUP_SQL = f"""SELECT strftime(event_timestamp, '%Y-%m-%d') AS rollup_date, attack_category, classifier_risk_tier AS risk_tier, {COUNT_SQL},
       CAST(round(CAST(quantile_cont(CAST(total_latency_ms AS DOUBLE), 0.95) AS DECIMAL(20, 6)), 2) AS DOUBLE) AS p95_latency_ms,
       ((2 * 10000 * count(*) FILTER (WHERE sla_breached) + count(*)) // (2 * count(*))) / 10000.0 AS sla_breach_rate
FROM fact GROUP BY 1, 2, 3"""


def rollup_output(df):
    money = [c for c in ("avg_latency_ms", "p95_latency_ms", "sla_breach_rate") if c in df.columns]
    done = df.withColumns({c: F.col(c).cast("double") for c in money})
    if "rollup_date" in done.columns:
        done = done.withColumn("rollup_date", F.date_format("rollup_date", "yyyy-MM-dd"))
    return done


@query("daily_rollup", f"WITH {FACT_SQL} {ROLLUP_SQL}")
def daily_rollup(spark, sf):
    return rollup_output(R.daily_rollup(facts(spark, sf), group_rows=bound(spark, sf, "events")))


@query(
    "rollup_touched",
    f"""WITH {FACT_SQL.replace("WHERE k <> 3)", "WHERE k <> 3 AND CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE value >= 300))")} {ROLLUP_SQL}""",
)
def rollup_touched(spark, sf):
    every = facts(spark, sf)
    late = table(spark, sf, "events").filter(F.col("value") >= 300).select(F.to_date("ts").alias("rollup_date")).distinct()
    return rollup_output(R.rollup_of_dates(every, late, group_rows=bound(spark, sf, "events")))


@query(
    "day_snapshot",
    f"""WITH {FACT_SQL}
SELECT attack_category, classifier_risk_tier AS risk_tier, {COUNT_SQL}
FROM fact WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-15' GROUP BY 1, 2""",
)
def day_snapshot(spark, sf):
    return rollup_output(R.day_snapshot(facts(spark, sf), F.lit("2024-01-15").cast("date")))


@query(
    "rollup_overwrite",
    f"WITH {FACT_SQL.replace('fact AS (', 'every AS (')}, fact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY event_timestamp) AS rn FROM every) WHERE rn = 1) {ROLLUP_SQL}",
)
def rollup_overwrite(spark, sf):
    """The sync job run twice into the same tables; the second run must change nothing."""
    flat = scanned(spark, sf)
    facts_path, rollup_path = new_table_path(spark, "facts"), new_table_path(spark, "rollup")
    for _ in range(2):
        writers.sync_traces(flat, facts_path, rollup_path)
    return rollup_output(spark.read.parquet(rollup_path))


@query(
    "audit_append",
    """SELECT account_id, max_by(transition_node, step) AS last_node, count(*) AS n_transitions FROM (
  SELECT 'u' || user_id AS account_id, 'AnalyzeRiskContext' AS transition_node, 1 AS step FROM events
  UNION ALL SELECT 'u' || user_id, 'PolicyGuardrailCheck', 2 FROM events) GROUP BY account_id""",
)
def audit_append(spark, sf):
    rows = table(spark, sf, "events").withColumn("account_id", F.concat(F.lit("u"), "user_id"))
    path = new_table_path(spark, "audit")
    for node, details in (("AnalyzeRiskContext", ["value"]), ("PolicyGuardrailCheck", ["event_type"])):
        writers.append_audit(rows, path, "account_id", node, details)
    audit = spark.read.parquet(path).withColumn("step", F.when(F.col("transition_node") == "AnalyzeRiskContext", 1).otherwise(2))
    return D.latest_states(audit, "account_id", ["step"], "transition_node").withColumnRenamed("last_state", "last_node")


# --- risk tiers and votes ------------------------------------------------------------------------


@query(
    "risk_tiers",
    """WITH s AS (SELECT event_id, event_type, (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS p FROM events),
t AS (SELECT *, CASE WHEN p >= 0.8 THEN 'high' WHEN p >= 0.5 THEN 'medium' ELSE 'low' END AS tier FROM s)
SELECT event_id, tier, CASE WHEN event_type = 'error' AND tier = 'low' THEN 'medium' ELSE tier END AS upgraded,
       (event_type = 'error' AND tier = 'low')::INT AS risk_tier_upgraded,
       (tier <> 'low' OR event_type = 'error')::INT AS quarantine_triggered FROM t""",
)
def risk_tiers(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    scored = M.min_max(events, {"value": "p"}).withColumn("tier", D.risk_tier(F.col("p")))
    upgraded, lifted = D.upgraded_tier(F.col("tier"), F.col("event_type") == "error")
    return scored.select(
        "event_id", "tier", upgraded.alias("upgraded"), lifted.cast("int").alias("risk_tier_upgraded"),
        (upgraded != "low").cast("int").alias("quarantine_triggered"),
    )


THRESHOLDS = {"isolation_forest": 120.0, "one_class_svm": 60.0, "autoencoder": 40.0}


def votes(spark, sf):
    rows = base_events(spark, sf)
    scores = {
        "isolation_forest": F.col("value"),
        "one_class_svm": F.col("k").cast("double"),
        "autoencoder": F.col("user_id").cast("double"),
    }
    cast, alarm = D.vote_columns(scores, THRESHOLDS, ["isolation_forest", "autoencoder"])
    return rows.select("event_id", "event_type", "ts", cast.alias("votes"), alarm.alias("is_anomaly"))


VOTE_BASE = "SELECT event_id, event_type, ts, value, user_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"


@query(
    "vote_rule",
    f"""SELECT event_id, (value >= 120 AND user_id >= 40)::INT AS is_anomaly,
       (value >= 120)::INT + (k >= 60)::INT + (user_id >= 40)::INT AS n_votes FROM ({VOTE_BASE})""",
)
def vote_rule(spark, sf):
    counted = F.size(F.filter("votes", lambda v: v["is_anomaly"]))
    return votes(spark, sf).select("event_id", F.col("is_anomaly").cast("int").alias("is_anomaly"), counted.alias("n_votes"))


@query(
    "vote_text",
    f"""SELECT event_id, 'Anomaly detected on service ''' || event_type || ''' at ' || strftime(ts, '%Y-%m-%d %H:%M:%S') ||
  '. Model votes: isolation_forest score=' || printf('%.4f', value) || ' (threshold=120.0000, flagged=' || CASE WHEN value >= 120 THEN 'True' ELSE 'False' END ||
  '); one_class_svm score=' || printf('%.4f', k) || ' (threshold=60.0000, flagged=' || CASE WHEN k >= 60 THEN 'True' ELSE 'False' END ||
  '); autoencoder score=' || printf('%.4f', user_id::DOUBLE) || ' (threshold=40.0000, flagged=' || CASE WHEN user_id >= 40 THEN 'True' ELSE 'False' END || ').' AS description
FROM ({VOTE_BASE})""",
)
def vote_text(spark, sf):
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return votes(spark, sf).select("event_id", I.anomaly_text(F.col("event_type"), when, F.col("votes")).alias("description"))


@query(
    "alert_routing",
    f"""SELECT event_id, CASE WHEN value >= 120 AND user_id >= 40 THEN 'alert' ELSE 'pass' END AS route FROM ({VOTE_BASE})""",
)
def alert_routing(spark, sf):
    alerts, passed = new_table_path(spark, "alerts"), new_table_path(spark, "passed")
    writers.route(votes(spark, sf), F.col("is_anomaly"), alerts, passed)
    read = lambda path, name: spark.read.parquet(path).select("event_id", F.lit(name).alias("route"))
    return read(alerts, "alert").unionByName(read(passed, "pass"))


# --- contracts: records written from the events, with the defects that k selects -------------------

REQUEST_RAW = """CASE
 WHEN k < 40 THEN '{"account_id":"u' || user_id || '","arr":' || value || ',"top_3_shap_drivers":["csat","arr"],"churn_probability":0.' || k || '}'
 WHEN k < 50 THEN '{"account_id":"u1","arr":5.0,"top_3_shap_drivers":["arr"],"churn_probability":0.5,"note":"x"}'
 WHEN k < 60 THEN '{"account_id":"u1","arr":"' || value || '","top_3_shap_drivers":["arr"],"churn_probability":0.5}'
 WHEN k < 70 THEN '{"account_id":' || user_id || ',"arr":5,"churn_probability":0.5}'
 WHEN k < 80 THEN '{"account_id":"u1","arr":-' || value || ',"top_3_shap_drivers":[],"churn_probability":1.' || k || '}'
 WHEN k < 85 THEN '{"account_id":null,"arr":1,"top_3_shap_drivers":["a","b","c","d"],"churn_probability":0}'
 WHEN k < 90 THEN '{"account_id":"u1","arr":5.0,"top_3_shap'
 WHEN k < 95 THEN '{"account_id":"u1","arr":5.0,"top_3_shap_drivers":["arr"],"churn_probability":0.5} thanks'
 ELSE '["u1",5.0]' END"""
TRIAGE_RAW = """'{"prompt_id":"p' || event_id || '","attack_category":"' || CASE WHEN k = 1 THEN 'prompt-injection' ELSE 'roleplay' END ||
 '","classifier_risk_tier":"' || CASE WHEN value >= 150 THEN 'high' WHEN value >= 60 THEN 'medium' ELSE 'low' END ||
 '","disposition":"' || CASE WHEN k < 40 THEN 'allow' WHEN k < 80 THEN 'block' ELSE 'escalate' END ||
 '","justification":"' || CASE WHEN k = 2 THEN '   too short    ' ELSE 'reads like an attack' END ||
 '","triage_confidence":' || CASE WHEN k = 4 THEN '1.2' WHEN k = 6 THEN '"0.75"' WHEN k = 8 THEN '"sure"' ELSE '0.9' END ||
 ',"requires_sanitization":' || CASE WHEN k = 10 THEN '"yes"' WHEN k = 11 THEN '2' ELSE 'true' END ||
 CASE WHEN k = 12 THEN '' ELSE ',"requires_judge_review":false' END || CASE WHEN k = 14 THEN ',"why":"?"' ELSE '' END || '}'"""
JUDGE_RAW = """'{"prompt_id":"p' || event_id || '","triage_disposition_reviewed":"allow","judge_disposition":"' ||
 CASE WHEN k < 50 THEN 'allow' ELSE 'block' END || '","agrees_with_triage":' || CASE WHEN user_id < 75 THEN 'true' ELSE 'false' END ||
 ',"judge_reasoning":"looks fine to me","judge_confidence":0.5,"model_used":"local"}'"""
SANITIZER_RAW = """'{"prompt_id":"p' || event_id || '","original_prompt":"do it now","sanitized_prompt":"' ||
 CASE WHEN k < 30 THEN ' do it now ' WHEN k < 40 THEN '' ELSE 'do it' END || '","tokens_removed":' || CASE WHEN k = 50 THEN '[1]' ELSE '["now"]' END ||
 ',"sanitization_confidence":0.5,"residual_risk_detected":' || CASE WHEN user_id < 75 THEN 'true' ELSE 'false' END || '}'"""


def raw_sql(raw):
    return f"raw AS (SELECT event_id, {raw} AS raw FROM (SELECT event_id, event_type, user_id, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"


def listed(*marks):
    inner = ",\n".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in marks)
    return f"array_to_string(list_filter([{inner}], lambda x: x IS NOT NULL), ';')"


def js(name):
    return f"json_extract_string(raw, '$.{name}')"


def jt(name):
    return f"coalesce(json_type(raw, '$.{name}'), 'absent')"


def num(name):
    return f"TRY_CAST({js(name)} AS DOUBLE)"


NUM_TYPES = "('UBIGINT', 'BIGINT', 'DOUBLE')"


def contract_query(spark, sf, raw, contract):
    rows = spread(base_events(spark, sf)).select("event_id", F.expr(raw).alias("raw"))
    checked = K.check(rows, "raw", contract)
    return checked.select("event_id", F.array_join("violations", ";").alias("violations"))


def contract_sql(raw, marks):
    return f"""WITH {raw_sql(raw)}
SELECT event_id, CASE WHEN NOT json_valid(raw) OR json_type(raw) <> 'OBJECT' THEN 'not_an_object' ELSE {listed(*marks)} END AS violations
FROM (SELECT event_id, raw FROM raw)"""


def guard(sql):
    """json functions raise on text that is not JSON, so such text is replaced first."""
    return sql.replace("FROM (SELECT event_id, raw FROM raw)", "FROM (SELECT event_id, CASE WHEN json_valid(raw) THEN raw ELSE '[]' END AS raw FROM raw)")


@query(
    "contract_request",
    guard(contract_sql(REQUEST_RAW, [
        ("extra_keys", "len(list_filter(json_keys(raw), lambda x: x NOT IN ('account_id', 'arr', 'top_3_shap_drivers', 'churn_probability'))) > 0"),
        ("missing:account_id", f"{jt('account_id')} = 'absent'"), ("type:account_id", f"{jt('account_id')} NOT IN ('absent', 'VARCHAR')"),
        ("missing:arr", f"{jt('arr')} = 'absent'"), ("type:arr", f"{jt('arr')} NOT IN ('absent', 'UBIGINT', 'BIGINT', 'DOUBLE')"),
        ("range:arr", f"{jt('arr')} IN {NUM_TYPES} AND {num('arr')} <= 0"),
        ("missing:top_3_shap_drivers", f"{jt('top_3_shap_drivers')} = 'absent'"),
        ("type:top_3_shap_drivers", f"{jt('top_3_shap_drivers')} NOT IN ('absent', 'ARRAY')"),
        ("short:top_3_shap_drivers", "json_array_length(raw, '$.top_3_shap_drivers') < 1 AND json_type(raw, '$.top_3_shap_drivers') = 'ARRAY'"),
        ("long:top_3_shap_drivers", "json_array_length(raw, '$.top_3_shap_drivers') > 3"),
        ("missing:churn_probability", f"{jt('churn_probability')} = 'absent'"),
        ("type:churn_probability", f"{jt('churn_probability')} NOT IN ('absent', 'UBIGINT', 'BIGINT', 'DOUBLE')"),
        ("range:churn_probability", f"{num('churn_probability')} NOT BETWEEN 0 AND 1"),
    ])),
)
def contract_request(spark, sf):
    return contract_query(spark, sf, REQUEST_RAW, K.RISK_REQUEST)


TRIAGE_MARKS = [
    ("extra_keys", "list_contains(json_keys(raw), 'why')"),
    ("choice:attack_category", f"{js('attack_category')} NOT IN ('benign', 'direct_injection', 'instruction_override', 'obfuscation', 'roleplay')"),
    ("blank:justification", f"length(trim({js('justification')})) < 10"),
    ("type:triage_confidence", f"{num('triage_confidence')} IS NULL"),
    ("range:triage_confidence", f"{num('triage_confidence')} NOT BETWEEN 0 AND 1"),
    ("type:requires_sanitization", f"lower({js('requires_sanitization')}) NOT IN ('true', 'false', 'yes', 'no', '1', '0')"),
    ("missing:requires_judge_review", f"{jt('requires_judge_review')} = 'absent'"),
    ("low_tier_cannot_block", f"{js('classifier_risk_tier')} = 'low' AND {js('disposition')} IN ('block', 'escalate')"),
]


@query("contract_triage", contract_sql(TRIAGE_RAW, TRIAGE_MARKS))
def contract_triage(spark, sf):
    return contract_query(spark, sf, TRIAGE_RAW, K.TRIAGE)


@query(
    "contract_judge",
    contract_sql(JUDGE_RAW, [
        ("agreement_flag_lies", f"({js('judge_disposition')} = {js('triage_disposition_reviewed')}) <> ({js('agrees_with_triage')} = 'true')"),
    ]),
)
def contract_judge(spark, sf):
    return contract_query(spark, sf, JUDGE_RAW, K.JUDGE)


@query(
    "contract_sanitizer",
    contract_sql(SANITIZER_RAW, [
        ("short:sanitized_prompt", f"length({js('sanitized_prompt')}) < 1"),
        ("type:tokens_removed", "json_type(raw, '$.tokens_removed[0]') <> 'VARCHAR'"),
        ("unchanged_without_flag", f"trim({js('sanitized_prompt')}) = {js('original_prompt')} AND {js('residual_risk_detected')} = 'false'"),
    ]),
)
def contract_sanitizer(spark, sf):
    return contract_query(spark, sf, SANITIZER_RAW, K.SANITIZER)


@query(
    "contract_trace",
    f"""WITH {raw_sql(TRIAGE_RAW)}
SELECT event_id, {listed(
    ("range:total_latency_ms", "value < 20"),
    *[("triage." + name, cond) for name, cond in TRIAGE_MARKS],
    ("judge.agreement_flag_lies", "(k < 50) <> (user_id < 75)"),
)} AS violations
FROM (SELECT r.event_id, r.raw, e.user_id, e.value, CAST(json_extract_string(e.props, '$.k') AS INT) AS k
      FROM raw r JOIN events e ON r.event_id = e.event_id)""",
)
def contract_trace(spark, sf):
    """Whole traces: rules of the trace itself and of the records nested in it."""
    raw = F.concat(
        F.lit('{"prompt_id":"p'), "event_id", F.lit('","triage":'), F.expr(TRIAGE_RAW), F.lit(',"sanitizer":null,"judge":'),
        F.expr(JUDGE_RAW), F.lit(',"final_disposition":"allow","total_latency_ms":'), F.col("value") - 20, F.lit("}"),
    )
    checked = K.check(spread(base_events(spark, sf)).select("event_id", raw.alias("raw")), "raw", K.TRACE)
    return checked.select("event_id", F.array_join("violations", ";").alias("violations"))


DECISION_RAW = """'{"thread_id":' || CASE WHEN l_linenumber = 1 THEN l_orderkey || '' ELSE '"t' || l_orderkey || '"' END ||
 ',"approved":' || CASE WHEN l_returnflag = 'A' THEN 'true' WHEN l_returnflag = 'N' THEN 'false' ELSE '"yes"' END ||
 CASE WHEN l_linestatus = 'O' THEN '' WHEN l_linenumber = 2 THEN ',"human_feedback":5' WHEN l_linenumber = 3 THEN ',"human_feedback":null' ELSE ',"human_feedback":"ok"' END || '}'"""
TELEMETRY_RAW = """'{"service_name":"' || event_type || '","timestamp":"' || CASE WHEN k = 3 THEN 'soon' ELSE '2026-07-10T00:00:00' END ||
 '","cpu_pct":' || CASE WHEN k = 1 THEN '"n/a"' WHEN k = 4 THEN '"12.5"' ELSE '' || value END || ',"memory_pct":' || k || ',"latency_p50_ms":1.5,"latency_p95_ms":2,"latency_p99_ms":' ||
 CASE WHEN k = 5 THEN 'null' ELSE '3e2' END || ',"error_rate_pct":0.1' || CASE WHEN k = 2 THEN '' ELSE ',"queue_depth":4' END || ',"thread_count":50,"host":"h1"}'"""
ESCALATION_RAW = """'{"incident_id":"' || CASE WHEN k = 1 THEN 'X-' ELSE 'INC-' END || event_id || '","prompt_id":"' || CASE WHEN k = 2 THEN '' ELSE 'p' END ||
 '","original_prompt":"x","attack_category":"roleplay","classifier_risk_tier":"low","triage_disposition":' || CASE WHEN k = 3 THEN '"drop"' WHEN k = 4 THEN 'null' ELSE '"allow"' END ||
 ',"agents_disagreed":' || CASE WHEN k = 5 THEN '"maybe"' WHEN k = 6 THEN '"off"' ELSE 'false' END || ',"escalation_reason":"' || CASE WHEN k = 7 THEN 'short' ELSE 'routine pipeline pass' END ||
 '","severity":"' || CASE WHEN k = 8 THEN 'huge' ELSE 'low' END || '","recommended_action":"allow"}'"""


@query(
    "contract_decision",
    f"""WITH raw AS (SELECT l_orderkey, l_linenumber, l_partkey, {DECISION_RAW} AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {listed(
    ("type:thread_id", f"{jt('thread_id')} <> 'VARCHAR'"), ("type:approved", f"{jt('approved')} <> 'BOOLEAN'"),
    ("type:human_feedback", f"{jt('human_feedback')} NOT IN ('absent', 'NULL', 'VARCHAR')"))} AS violations FROM raw""",
)
def contract_decision(spark, sf):
    lines = spread(table(spark, sf, "lineitem"))
    rows = lines.select("l_orderkey", "l_linenumber", "l_partkey", F.expr(DECISION_RAW).alias("raw"))
    checked = K.check(rows, "raw", K.DECISION)
    return checked.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("violations", ";").alias("violations"))


@query(
    "contract_telemetry",
    contract_sql(TELEMETRY_RAW, [
        ("type:timestamp", f"TRY_CAST({js('timestamp')} AS TIMESTAMP) IS NULL"), ("type:cpu_pct", f"{num('cpu_pct')} IS NULL"),
        ("type:latency_p99_ms", f"{num('latency_p99_ms')} IS NULL"), ("missing:queue_depth", f"{jt('queue_depth')} = 'absent'"),
    ]),
)
def contract_telemetry(spark, sf):
    return contract_query(spark, sf, TELEMETRY_RAW, K.TELEMETRY)


@query(
    "contract_escalation",
    contract_sql(ESCALATION_RAW, [
        ("short:prompt_id", f"length({js('prompt_id')}) = 0"), ("choice:triage_disposition", f"{js('triage_disposition')} = 'drop'"),
        ("type:agents_disagreed", f"{js('agents_disagreed')} NOT IN ('true', 'false', 'off')"),
        ("short:escalation_reason", f"length({js('escalation_reason')}) < 10"), ("choice:severity", f"{js('severity')} NOT IN ('low', 'medium', 'high')"),
        ("incident_prefix", f"NOT starts_with({js('incident_id')}, 'INC-')"),
    ]),
)
def contract_escalation(spark, sf):
    return contract_query(spark, sf, ESCALATION_RAW, K.ESCALATION)


@query(
    "contract_prompt",
    """SELECT doc_id, CASE WHEN length(text) < 1 THEN 'short:text;blank:text' WHEN length(text) > 8000 THEN 'long:text' ELSE '' END AS violations FROM documents""",
)
def contract_prompt(spark, sf):
    """Whole documents as prompts: 1 to 8000 characters, not blank."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    checked = K.check(docs.select("doc_id", F.to_json(F.struct("text")).alias("raw")), "raw", K.PROMPT)
    return checked.select("doc_id", F.array_join("violations", ";").alias("violations"))


@query(
    "telemetry_casts",
    """SELECT event_id, CASE WHEN value >= 100 THEN 'type:value;type:at' WHEN event_type = 'view' THEN 'type:at' ELSE '' END AS violations FROM events""",
)
def telemetry_casts(spark, sf):
    """A table of strings: which values do not cast."""
    text = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("value") < 100, F.col("value").cast("string")).otherwise("n/a").alias("value"),
        F.when((F.col("value") < 100) & (F.col("event_type") != "view"), F.col("ts").cast("string")).alias("at"),
    )
    return K.cast_violations(text, {"value": "double", "at": "timestamp"}).select("event_id", F.array_join("violations", ";").alias("violations"))


MESSY_RAW = """CASE
 WHEN k < 20 THEN '{"prompt_id":"p","n":' || k || '}'
 WHEN k < 40 THEN '```json
{"prompt_id":"p","n":' || k || '}
```'
 WHEN k < 50 THEN 'Sure! Here it is: {"prompt_id":"p","n":' || k || '} Hope that helps.'
 WHEN k < 60 THEN '{"prompt_id":"p","n":' || k || ',}'
 WHEN k < 70 THEN '{''prompt_id'':''p'',''n'':' || k || '}'
 WHEN k < 80 THEN '{prompt_id:"p", n: ' || k || '}'
 WHEN k < 90 THEN '{"prompt_id":"p","n":'
 WHEN k < 95 THEN 'null' ELSE '[' || k || ']' END"""


@query(
    "messy_json",
    """SELECT event_id, CASE WHEN k < 80 THEN k END AS n FROM (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def messy_json(spark, sf):
    rows = spread(base_events(spark, sf)).select("event_id", F.expr(MESSY_RAW).alias("raw"))
    doc = K.extract_object(F.col("raw"))
    return rows.select("event_id", F.try_variant_get(doc, "$.n", "bigint").alias("n"))


CUT_RAW = """CASE event_id % 7
  WHEN 0 THEN concat('{"n": ', k, ', "tag": "a \\\\"b\\\\""}')
  WHEN 1 THEN concat('{"n": ', k, ', "tag": "a b')
  WHEN 2 THEN concat('Sure: {"n": ', k, ', "tag": "t", "list": [1, {"x": 2')
  WHEN 3 THEN concat('{"n": ', k, ', "tag":')
  WHEN 4 THEN concat('{"n": ', k, ', "tag": not sure, "x": {"y": [true, {"z": ')
  WHEN 5 THEN concat('{"n": ', k, ', "ta')
  ELSE concat('{"n": [', k, '}, "tag": "t"') END"""


@query(
    "completed_json",
    """SELECT event_id, CASE WHEN event_id % 7 < 6 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS n,
       CASE event_id % 7 WHEN 0 THEN 'a "b"' WHEN 1 THEN 'a b' WHEN 2 THEN 't' WHEN 4 THEN 'not sure' END AS tag FROM events""",
)
def completed_json(spark, sf):
    """Objects that were cut off anywhere, closed again; brackets that do not match give nothing."""
    rows = spread(base_events(spark, sf)).select("event_id", F.expr(CUT_RAW).alias("raw"))
    read = rows.withColumn("doc", K.extract_object(F.col("raw"), complete=True))
    return read.select("event_id", F.try_variant_get("doc", "$.n", "bigint").alias("n"), F.try_variant_get("doc", "$.tag", "string").alias("tag"))


@query(
    "correlation_ids",
    "SELECT event_id, 'PROMPT-' || upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 10)) AS prompt_id, 'INC-' || upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 10)) AS incident_id FROM events",
)
def correlation_ids(spark, sf):
    key = F.col("event_id")
    return table(spark, sf, "events").select("event_id", D.prompt_id(key).alias("prompt_id"), D.incident_id(key).alias("incident_id"))


@query(
    "failclosed_fill",
    f"""WITH {raw_sql(TRIAGE_RAW)}, seen AS (
  SELECT event_id, k, value,
         (k IN (1, 2, 4, 8, 11, 12, 14) OR (value < 60 AND k >= 40)) AS bad,
         CASE WHEN value >= 150 THEN 'high' WHEN value >= 60 THEN 'medium' ELSE 'low' END AS tier,
         CASE WHEN k < 40 THEN 'allow' WHEN k < 80 THEN 'block' ELSE 'escalate' END AS disposition
  FROM (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))
SELECT event_id, CASE WHEN bad THEN 'validation_failed' ELSE 'success' END AS agent_status,
       CASE WHEN bad THEN 'high' ELSE tier END AS classifier_risk_tier,
       CASE WHEN bad THEN 'escalate' ELSE disposition END AS disposition,
       CASE WHEN bad THEN 0.0 WHEN k = 6 THEN 0.75 ELSE 0.9 END AS triage_confidence,
       CASE WHEN bad THEN 1 ELSE 0 END AS requires_judge_review
FROM seen""",
)
def failclosed_fill(spark, sf):
    rows = spread(base_events(spark, sf)).select("event_id", F.expr(TRIAGE_RAW).alias("raw"))
    checked = K.check(rows, "raw", K.TRIAGE, repair=True)
    triage = K.typed(F.col("doc"), K.TRIAGE, {"agent_status": F.lit("success")})
    safe = K.triage_or_escalation(
        triage, F.size("violations") == 0, F.concat(F.lit("p"), "event_id"), F.lit("roleplay"), F.array_join("violations", ", ")
    )
    done = checked.select("event_id", safe.alias("t"))
    return done.select(
        "event_id", "t.agent_status", "t.classifier_risk_tier", "t.disposition", "t.triage_confidence",
        F.col("t.requires_judge_review").cast("int").alias("requires_judge_review"),
    )


JUDGE_BAD = f"({js('judge_disposition')} = {js('triage_disposition_reviewed')}) <> ({js('agrees_with_triage')} = 'true')"


@query(
    "failclosed_judge",
    f"""WITH {raw_sql(JUDGE_RAW)}, seen AS (SELECT event_id, raw, {JUDGE_BAD} AS bad FROM raw)
SELECT event_id, CASE WHEN bad THEN 'validation_failed' ELSE 'success' END AS agent_status,
       CASE WHEN bad THEN 'escalate' ELSE {js('judge_disposition')} END AS judge_disposition,
       (CASE WHEN bad THEN {js('triage_disposition_reviewed')} = 'escalate' ELSE {js('agrees_with_triage')} = 'true' END)::INT AS agrees_with_triage,
       CASE WHEN bad THEN 0.0 ELSE {num('judge_confidence')} END::DOUBLE AS judge_confidence FROM seen""",
)
def failclosed_judge(spark, sf):
    rows = spread(base_events(spark, sf)).select("event_id", F.expr(JUDGE_RAW).alias("raw"))
    checked = K.check(rows, "raw", K.JUDGE, repair=True)
    judge = K.typed(F.col("doc"), K.JUDGE, {"agent_status": F.lit("success")})
    safe = K.judge_or_escalation(
        judge, F.size("violations") == 0, F.concat(F.lit("p"), "event_id"), F.get_json_object("raw", "$.triage_disposition_reviewed"),
        F.array_join("violations", ", "), "rules",
    )
    done = checked.select("event_id", safe.alias("j"))
    return done.select(
        "event_id", "j.agent_status", "j.judge_disposition", F.col("j.agrees_with_triage").cast("int").alias("agrees_with_triage"), "j.judge_confidence"
    )


@query(
    "failclosed_sanitizer",
    f"""WITH {raw_sql(SANITIZER_RAW)}, seen AS (
  SELECT event_id, raw, coalesce(length({js('sanitized_prompt')}) < 1 OR json_type(raw, '$.tokens_removed[0]') <> 'VARCHAR', false)
         OR (trim({js('sanitized_prompt')}) = {js('original_prompt')} AND {js('residual_risk_detected')} = 'false') AS bad FROM raw)
SELECT event_id, CASE WHEN bad THEN 'validation_failed' ELSE 'success' END AS agent_status,
       CASE WHEN bad THEN {js('original_prompt')} ELSE {js('sanitized_prompt')} END AS sanitized_prompt,
       CASE WHEN bad THEN 1 ELSE ({js('residual_risk_detected')} = 'true')::INT END AS residual_risk_detected FROM seen""",
)
def failclosed_sanitizer(spark, sf):
    rows = spread(base_events(spark, sf)).select("event_id", F.expr(SANITIZER_RAW).alias("raw"))
    checked = K.check(rows, "raw", K.SANITIZER, repair=True)
    sanitizer = K.typed(F.col("doc"), K.SANITIZER, {"agent_status": F.lit("success")})
    safe = K.sanitizer_or_unchanged(
        sanitizer, F.size("violations") == 0, F.concat(F.lit("p"), "event_id"), F.get_json_object("raw", "$.original_prompt")
    )
    done = checked.select("event_id", safe.alias("s"))
    return done.select("event_id", "s.agent_status", "s.sanitized_prompt", F.col("s.residual_risk_detected").cast("int").alias("residual_risk_detected"))
