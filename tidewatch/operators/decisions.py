"""Decision rules and trace assembly as column expressions and joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import fixed_values as V
from tidewatch.operators.ordered import MAX_GROUP_ROWS, running_sums


def rank_of(value: Column, order: Sequence[str]) -> Column:
    """Zero-based place in the order; null for anything else."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), value)
    return F.nullif(place, F.lit(0)) - 1


def named(rank: Column, order: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in order]), rank.cast("int"))


# --- risk ----------------------------------------------------------------------------------------


def argmax_label(probabilities: Column, labels: Sequence[str]) -> tuple[Column, Column]:
    """First most likely class and its probability."""
    top = F.array_max(probabilities)
    return named(F.array_position(probabilities, top) - 1, labels), top


def attack_confidence(probabilities: Column, labels: Sequence[str]) -> Column:
    """One minus the benign probability; the top probability where there is no benign class."""
    if "benign" in labels:
        return 1.0 - F.get(probabilities, F.lit(list(labels).index("benign")))
    return F.array_max(probabilities)


def risk_tier(confidence: Column, medium: float = V.TIER_MEDIUM, high: float = V.TIER_HIGH) -> Column:
    return F.when(confidence >= high, "high").when(confidence >= medium, "medium").otherwise("low")


def upgraded_tier(tier: Column, near_duplicate: Column, implied: str = "medium") -> tuple[Column, Column]:
    """A near duplicate of a known attack lifts the tier to ``implied``, never lowers it."""
    own = rank_of(tier, V.RISK_TIERS)
    implied_rank = V.RISK_TIERS.index(implied)
    lifted = F.coalesce(near_duplicate, F.lit(False)) & (own < implied_rank)
    return F.when(lifted, implied).otherwise(tier), lifted


def prompt_decisions(rows: DataFrame, probabilities: str, labels: Sequence[str], near_duplicate: str = "is_near_duplicate") -> DataFrame:
    """From class probabilities and a near-duplicate mark to the decision: label, confidence, tier, the tier after
    the upgrade, whether it was upgraded, and whether the prompt goes to quarantine."""
    p = F.col(probabilities)
    label, top = argmax_label(p, labels)
    marked = rows.withColumns({"label": label, "confidence": top, "risk_tier": risk_tier(attack_confidence(p, labels))})
    upgraded, lifted = upgraded_tier(F.col("risk_tier"), F.col(near_duplicate))
    return marked.withColumns(
        {"final_tier": upgraded, "risk_tier_upgraded": lifted, "quarantine_triggered": upgraded != "low"}
    )


def policy_passed(arr: Column, minimum: float = V.POLICY_MIN_ARR) -> Column:
    return arr >= minimum


def agreement_severity(first: Column, second: Column, cut: float = 0.5) -> Column:
    """Offline rule on scores scaled to [0, 1]: both above the cut, one, or none."""
    a, b = first > cut, second > cut
    return F.when(a & b, "high").when(a | b, "medium").otherwise("low")


def vote_columns(scores: Mapping[str, Column], thresholds: Mapping[str, float | Column], deciding: Sequence[str]) -> tuple[Column, Column]:
    """Votes as an array of structs, and the alarm: all deciding models at or over their threshold.
    The other models vote but do not count."""
    over = {m: s >= thresholds[m] for m, s in scores.items()}
    votes = F.array(
        *[
            F.struct(
                F.lit(m).alias("model_name"),
                s.cast("double").alias("score"),
                (thresholds[m] if isinstance(thresholds[m], Column) else F.lit(float(thresholds[m]))).alias("threshold"),
                over[m].alias("is_anomaly"),
            )
            for m, s in scores.items()
        ]
    )
    alarm = F.lit(True)
    for m in deciding:
        alarm = alarm & over[m]
    return votes, alarm


# --- dispositions --------------------------------------------------------------------------------


def more_conservative(*dispositions: Column) -> Column:
    """The most severe of the dispositions that are there."""
    ranks = [rank_of(d, V.DISPOSITIONS) for d in dispositions]
    return named(F.greatest(*ranks) if len(ranks) > 1 else ranks[0], V.DISPOSITIONS)


def action_text(disposition: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in V.ACTION_TEXT.items() for x in pair])
    return F.try_element_at(lookup, disposition)


def _named_by(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(key.cast("string")), 1, 10)))


def incident_id(key: Column) -> Column:
    """Same key, same id: a rerun does not open a second incident."""
    return _named_by("INC-", key)


def prompt_id(key: Column) -> Column:
    """The id under which a request's records are kept together; same key, same id."""
    return _named_by("PROMPT-", key)


def escalation(
    key: Column,
    tier: Column,
    triage_disposition: Column,
    judge_disposition: Column,
    judge_agrees: Column,
    triage_status: Column,
    sanitizer_status: Column,
    judge_status: Column,
) -> dict[str, Column]:
    """The escalation record. Statuses of agents that did not run are null."""
    failed = F.array_compact(
        F.array(
            *[
                F.when(status != "success", F.lit(agent))
                for agent, status in (("triage", triage_status), ("sanitizer", sanitizer_status), ("judge", judge_status))
            ]
        )
    )
    any_failed = F.size(failed) > 0
    disagreed = F.coalesce(~judge_agrees, F.lit(False))
    is_high = tier == "high"
    reasons = F.concat_ws(
        "; ",
        F.when(is_high, F.lit(V.ESCALATION_HIGH)),
        F.when(
            disagreed,
            F.concat(
                F.lit(V.ESCALATION_DISAGREED[0]), triage_disposition,
                F.lit(V.ESCALATION_DISAGREED[1]), judge_disposition, F.lit(V.ESCALATION_DISAGREED[2]),
            ),
        ),
        F.when(any_failed, F.concat(F.lit(V.ESCALATION_FAILED), F.array_join(failed, ", "))),
    )
    action = F.when(any_failed, "escalate").otherwise(more_conservative(triage_disposition, judge_disposition))
    return {
        "incident_id": incident_id(key),
        "agents_disagreed": disagreed,
        "escalation_reason": F.when(reasons == "", V.ESCALATION_NONE).otherwise(reasons),
        "severity": tier,
        "recommended_action": action,
        "notify_slack": is_high | disagreed | any_failed,
        "agent_status": F.when(any_failed, "validation_failed").otherwise("success"),
        "failed_agents": failed,
    }


def pipeline_status(escalation_status: Column) -> Column:
    return F.when(escalation_status == "success", "success").otherwise("validation_failed")


def assemble_traces(prompts: DataFrame, triage: DataFrame, sanitizer: DataFrame, judge: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Prompts with their triage, sanitizer and judge records as nested structs, the latter two only
    where the triage asked for them. Each side is keyed by prompt, so all joins share one shuffle."""
    nested = lambda df, name: df.select(F.col(key), F.struct(*[c for c in df.columns if c != key]).alias(name))
    joined = (
        prompts.join(nested(triage, "triage"), key)
        .join(nested(sanitizer, "sanitizer"), key, "left")
        .join(nested(judge, "judge"), key, "left")
    )
    return joined.withColumns(
        {
            "sanitizer": F.when(F.col("triage.requires_sanitization"), F.col("sanitizer")),
            "judge": F.when(F.col("triage.requires_judge_review"), F.col("judge")),
        }
    )


# --- requests and human decisions ----------------------------------------------------------------


def first_decisions(decisions: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first decision per thread. An aggregate, so copies are combined before the shuffle."""
    rest = [c for c in decisions.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_d")
    return decisions.groupBy(key).agg(first, F.count("*").alias("n_decisions")).select(key, "_d.*", "n_decisions")


def known_decisions(requests: DataFrame, decisions: DataFrame, key: str, requested_at: str, decided_at: str) -> DataFrame:
    """Decisions with ``_known``: whether their thread had been requested by then."""
    opened = requests.select(key, F.col(requested_at).alias("_requested"))
    known = F.coalesce(F.col(decided_at) >= F.col("_requested"), F.lit(False))
    return decisions.join(opened, key, "left").withColumn("_known", known).drop("_requested")


def outcomes(
    requests: DataFrame, decisions: DataFrame, key: str, order: Sequence[str], requested_at: str, decided_at: str
) -> DataFrame:
    """Requests with the outcome of their first decision: approved, rejected, or still pending."""
    marked = known_decisions(requests, decisions, key, requested_at, decided_at)
    first = first_decisions(marked.filter("_known").drop("_known"), key, order)
    outcome = (
        F.when(F.col("approved").isNull(), "pending_human_approval")
        .when(F.col("approved"), "approved")
        .otherwise("rejected")
    )
    return requests.join(first, key, "left").withColumns(
        {"outcome": outcome, "n_decisions": F.coalesce("n_decisions", F.lit(0))}
    )


def refused_decisions(
    requests: DataFrame, decisions: DataFrame, key: str, order: Sequence[str], requested_at: str, decided_at: str
) -> DataFrame:
    """Decisions on a thread that did not exist by then, and all but the first on one that did.
    ``order`` identifies a decision within its thread."""
    marked = known_decisions(requests, decisions, key, requested_at, decided_at)
    first = first_decisions(marked.filter("_known").select(key, *order), key, order).select(
        key, F.struct(*order).alias("_first")
    )
    judged = marked.join(first, key, "left")
    reason = F.when(~F.col("_known"), "unknown_thread").when(~F.struct(*order).eqNullSafe(F.col("_first")), "inactive_thread")
    return judged.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_known", "_first")


def latest_states(audit: DataFrame, key: str, order: Sequence[str], state: str) -> DataFrame:
    """Last state per thread and the number of transitions; one value per task and key is shuffled."""
    return audit.groupBy(key).agg(
        F.max_by(state, F.struct(*order)).alias("last_state"), F.count("*").alias("n_transitions")
    )


def transitions(
    audit: DataFrame, key: str, order: Sequence[str], limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """Transitions numbered per thread, as rows: a thread's history is never gathered in one value."""
    return running_sums(audit, [key], list(order), {"step": F.lit(1)}, limit, group_rows)


# --- grounding -----------------------------------------------------------------------------------


def grounding_label(top_score: Column, threshold: float = V.GROUNDING_THRESHOLD) -> Column:
    return F.when(F.coalesce(top_score, F.lit(0.0)) < threshold, "low").otherwise("high")


def grounding_counts(results: DataFrame, label: str = "grounding_confidence", sources: str = "retrieved_sources") -> DataFrame:
    """Calls, grounded, escalated for low confidence or missing sources."""
    weak = F.lower(F.coalesce(F.col(label), F.lit(""))).isin(V.LOW_CONFIDENCE_LABELS)
    empty = F.coalesce(F.size(sources), F.lit(0)) <= 0
    return results.agg(
        F.count("*").alias("total_calls"),
        F.count_if(~(weak | empty)).alias("grounded"),
        F.count_if(weak | empty).alias("escalated_low_confidence"),
    )


# --- drivers -------------------------------------------------------------------------------------


def top_drivers(names: Sequence[str], contributions: Column, k: int = 3, default: str = V.DEFAULT_DRIVER) -> Column:
    """Names of the ``k`` largest contributions by size, then only the positive ones of those; the
    default if none is left. Of equal sizes the later feature comes first."""
    labels = F.array(*[F.lit(n) for n in names])
    pairs = F.transform(
        contributions,
        lambda c, i: F.struct(F.abs(c).alias("size"), i.alias("at"), c.alias("value"), F.get(labels, i).alias("name")),
    )
    largest = F.slice(F.sort_array(pairs, asc=False), 1, k)
    kept = F.transform(F.filter(largest, lambda p: p["value"] > 0), lambda p: p["name"])
    return F.when(F.size(kept) == 0, F.array(F.lit(default))).otherwise(kept)


def high_risk(scored: DataFrame, probability: str, arr: str, account: str, drivers: Column, above: float = V.HIGH_RISK_PROBABILITY) -> DataFrame:
    """Payload rows of the accounts above the probability cut."""
    return scored.filter(F.col(probability) > above).select(
        F.col(account).cast("string").alias("account_id"),
        F.round(probability, 3).alias("churn_probability"),
        F.round(arr, 2).alias("arr"),
        drivers.alias("top_3_shap_drivers"),
    )


def logistic(terms: Mapping[str, float], intercept: float) -> Column:
    """Probability of a weighted sum of columns."""
    z = F.lit(float(intercept))
    for column, weight in terms.items():
        z = z + F.lit(float(weight)) * F.col(column)
    return 1.0 / (1.0 + F.exp(-z))
