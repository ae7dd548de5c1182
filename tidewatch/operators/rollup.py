"""Trace documents to facts, and facts to daily rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import fixed_values as V
from tidewatch.operators.ordered import MAX_GROUP_ROWS, exact_quantiles, fits


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _B, _D = T.StringType(), T.BooleanType(), T.DoubleType()
TRACE_SCHEMA = _struct(
    prompt_id=_S,
    triage=_struct(
        prompt_id=_S, attack_category=_S, classifier_risk_tier=_S, disposition=_S, justification=_S,
        triage_confidence=_D, requires_sanitization=_B, requires_judge_review=_B, agent_status=_S, timestamp=_S,
    ),
    sanitizer=_struct(
        prompt_id=_S, original_prompt=_S, sanitized_prompt=_S, tokens_removed=T.ArrayType(_S),
        sanitization_confidence=_D, residual_risk_detected=_B, agent_status=_S, timestamp=_S,
    ),
    judge=_struct(
        prompt_id=_S, triage_disposition_reviewed=_S, judge_disposition=_S, agrees_with_triage=_B,
        judge_reasoning=_S, judge_confidence=_D, model_used=_S, agent_status=_S, timestamp=_S,
    ),
    escalation=_struct(
        incident_id=_S, prompt_id=_S, original_prompt=_S, attack_category=_S, classifier_risk_tier=_S,
        triage_disposition=_S, judge_disposition=_S, agents_disagreed=_B, escalation_reason=_S, severity=_S,
        recommended_action=_S, notify_slack=_B, agent_status=_S, timestamp=_S,
    ),
    final_disposition=_S,
    pipeline_status=_S,
    total_latency_ms=_D,
    timestamp=_S,
)


def parse_timestamp(text: Column) -> tuple[Column, Column]:
    """Time of an ISO text, the current time where it does not parse, and whether it did not."""
    parsed = F.when(F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}")), text.try_cast("timestamp"))
    return F.coalesce(parsed, F.current_timestamp()), parsed.isNull()


def sla_breached(latency: Column, threshold: float = V.SLA_LATENCY_MS) -> Column:
    return F.coalesce(latency > threshold, F.lit(False))


def flatten_traces(traces: DataFrame, sla_ms: float = V.SLA_LATENCY_MS) -> DataFrame:
    """One flat row per trace document; absent sub-documents give nulls or False."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    when, fell_back = parse_timestamp(F.col("timestamp"))
    return traces.select(
        "prompt_id",
        F.col("triage.attack_category").alias("attack_category"),
        F.col("triage.classifier_risk_tier").alias("classifier_risk_tier"),
        "final_disposition",
        "pipeline_status",
        F.col("triage.disposition").alias("triage_disposition"),
        F.col("judge.judge_disposition").alias("judge_disposition"),
        flag("escalation.agents_disagreed").alias("agents_disagreed"),
        F.col("escalation.severity").alias("escalation_severity"),
        flag("escalation.notify_slack").alias("notify_slack"),
        F.col("total_latency_ms").try_cast("decimal(12,2)").alias("total_latency_ms"),
        sla_breached(F.col("total_latency_ms"), sla_ms).alias("sla_breached"),
        when.alias("event_timestamp"),
        fell_back.alias("timestamp_fallback"),
    )


def well_formed() -> Column:
    """Facts need an id, a category, a tier and a disposition."""
    needed = ("prompt_id", "attack_category", "classifier_risk_tier", "final_disposition")
    ok = F.lit(True)
    for c in needed:
        ok = ok & F.coalesce(F.col(c) != "", F.lit(False))
    return ok


def split_facts(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    return flat.filter(well_formed()), flat.filter(~well_formed())


def first_per_key(batch: DataFrame, key: str, *order: str) -> DataFrame:
    """Copies are cut to one per map task before the shuffle."""
    window = Window.partitionBy(key).orderBy(*order) if order else Window.partitionBy(key).orderBy(F.lit(0))
    return batch.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def new_rows(batch: DataFrame, stored: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of the batch whose key is not stored yet, the first per key."""
    return first_per_key(batch, key, *order).join(stored.select(key), key, "left_anti")


def event_date(ts: str = "event_timestamp") -> Column:
    return F.to_date(ts)


def touched_dates(new_facts: DataFrame) -> DataFrame:
    return new_facts.select(event_date().alias("rollup_date")).distinct()


def _counts() -> list[Column]:
    return [
        F.count("*").alias("total_requests"),
        F.count_if(F.col("final_disposition") == "escalate").alias("escalated_count"),
        F.count_if("agents_disagreed").alias("disagreement_count"),
        F.count_if(F.col("pipeline_status") != "success").alias("fail_closed_count"),
        F.round(F.sum("total_latency_ms") / F.count("total_latency_ms"), 2).cast("decimal(12,2)").alias("avg_latency_ms"),
        F.count_if("sla_breached").alias("sla_breach_count"),
    ]


def daily_rollup(facts: DataFrame, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None) -> DataFrame:
    """One row per date, category and tier. The 95th percentile is exact; a group too large for one
    buffer gets it from value counts instead."""
    keys = ["rollup_date", "attack_category", "risk_tier"]
    rows = facts.withColumns({"rollup_date": event_date(), "risk_tier": F.col("classifier_risk_tier")}).withColumn(
        "_latency", F.col("total_latency_ms").cast("double")
    )
    two = lambda c: F.round(c.cast("decimal(20,6)"), 2).cast("decimal(12,2)")
    if fits(rows, keys, limit, group_rows):
        rolled = rows.groupBy(*keys).agg(*_counts(), two(F.percentile("_latency", F.lit(0.95))).alias("p95_latency_ms"))
    else:
        tails = exact_quantiles(rows, keys, "_latency", [0.95], limit)
        rolled = (
            rows.groupBy(*keys)
            .agg(*_counts())
            .join(tails.select(*keys, two(F.col("q0")).alias("p95_latency_ms")), keys, "left")
        )
    share = F.col("sla_breach_count").cast("decimal(18,0)") / F.nullif(F.col("total_requests"), F.lit(0))
    return rolled.withColumn("sla_breach_rate", F.round(share, 4).cast("decimal(5,4)"))


def rollup_of_dates(
    facts: DataFrame, dates: DataFrame, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """Rollup rows of the touched dates only, recomputed from all of their facts."""
    dated = facts.withColumn("rollup_date", event_date())
    return daily_rollup(dated.join(dates, "rollup_date", "left_semi").drop("rollup_date"), limit, group_rows)


def day_snapshot(facts: DataFrame, day: Column) -> DataFrame:
    """Counts of one day by category and tier. The bounds are on the timestamp itself, so a scan can
    skip other days."""
    start = day.cast("timestamp")
    rows = facts.filter((F.col("event_timestamp") >= start) & (F.col("event_timestamp") < start + F.expr("interval 1 day")))
    return rows.groupBy("attack_category", F.col("classifier_risk_tier").alias("risk_tier")).agg(*_counts())
