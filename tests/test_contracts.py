import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import contracts as K
from tidewatch.operators import decisions as D

REQUEST = {"account_id": "a", "arr": 10.0, "top_3_shap_drivers": ["csat"], "churn_probability": 0.5}
TRIAGE = {
    "prompt_id": "p", "attack_category": "roleplay", "classifier_risk_tier": "high", "disposition": "block",
    "justification": "reads like an attack", "triage_confidence": 0.9, "requires_sanitization": True, "requires_judge_review": False,
}
SANITIZER = {
    "prompt_id": "p", "original_prompt": "do it", "sanitized_prompt": "do", "tokens_removed": ["it"],
    "sanitization_confidence": 0.5, "residual_risk_detected": False,
}
JUDGE = {
    "prompt_id": "p", "triage_disposition_reviewed": "block", "judge_disposition": "block", "agrees_with_triage": True,
    "judge_reasoning": "agrees with the triage", "judge_confidence": 1, "model_used": "m",
}
ESCALATION = {
    "incident_id": "INC-1", "prompt_id": "p", "original_prompt": "x", "attack_category": "benign", "classifier_risk_tier": "low",
    "triage_disposition": None, "agents_disagreed": False, "escalation_reason": "nothing of note", "severity": "low", "recommended_action": "allow",
}
TRACE = {"prompt_id": "p", "triage": TRIAGE, "sanitizer": None, "judge": JUDGE, "final_disposition": "block", "total_latency_ms": 1.5}


def broken(spark, contract, records, repair=False):
    raw = [(i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)]
    checked = K.check(spark.createDataFrame(raw, "i int, raw string"), "raw", contract, repair)
    valid, rejected = K.split(checked)
    marks = {r["i"]: r["violations"] for r in rejected.collect()}
    assert {r["i"] for r in valid.collect()} | set(marks) == set(range(len(raw)))
    return [marks.get(i, []) for i in range(len(raw))]


def test_request(spark):
    got = broken(spark, K.RISK_REQUEST, [
        REQUEST, {**REQUEST, "arr": 5}, {**REQUEST, "arr": "5"}, {**REQUEST, "arr": 0}, {**REQUEST, "note": 1},
        {**REQUEST, "top_3_shap_drivers": []}, {**REQUEST, "top_3_shap_drivers": ["a", "b", "c", "d"]}, {**REQUEST, "top_3_shap_drivers": [1]},
        {**REQUEST, "churn_probability": 1.01}, {k: v for k, v in REQUEST.items() if k != "arr"}, {**REQUEST, "account_id": None}, {**REQUEST, "account_id": 7},
    ])
    assert got == [
        [], [], ["type:arr"], ["range:arr"], ["extra_keys"], ["short:top_3_shap_drivers"], ["long:top_3_shap_drivers"], ["type:top_3_shap_drivers"],
        ["range:churn_probability"], ["missing:arr"], ["type:account_id"], ["type:account_id"],
    ]


def test_decision(spark):
    ok = {"thread_id": "t", "approved": True}
    got = broken(spark, K.DECISION, [ok, {**ok, "human_feedback": None}, {**ok, "approved": "true"}, {**ok, "approved": 1}, {"approved": False}])
    assert got == [[], [], ["type:approved"], ["type:approved"], ["missing:thread_id"]]
    rows = spark.createDataFrame([(json.dumps(ok),)], "raw string")
    record = K.typed(K.parse_object(F.col("raw")), K.DECISION, {"human_feedback": F.lit("")})
    assert rows.select(record.alias("d")).first()["d"]["human_feedback"] == ""


def test_prompt_and_telemetry(spark):
    assert broken(spark, K.PROMPT, [{"text": "x"}, {"text": ""}, {"text": " \n "}, {"text": "x" * 8000}, {"text": "x" * 8001}]) == [
        [], ["short:text", "blank:text"], ["blank:text"], [], ["long:text"]]
    row = {"service_name": "s", "timestamp": "2026-07-10T00:00:00", **{m: 1.0 for m in K.TELEMETRY_METRICS}}
    assert broken(spark, K.TELEMETRY, [row, {**row, "cpu_pct": "12.5"}, {**row, "cpu_pct": "high"}, {**row, "timestamp": "soon"}]) == [
        [], [], ["type:cpu_pct"], ["type:timestamp"]]
    strings = spark.createDataFrame([("1.5", "2026-01-01"), ("x", "2026-01-01"), (None, "never")], "cpu string, at string")
    marked = K.cast_violations(strings, {"cpu": "double", "at": "timestamp"})
    assert [r["violations"] for r in marked.collect()] == [[], ["type:cpu"], ["type:cpu", "type:at"]]


def test_agents(spark):
    assert broken(spark, K.TRIAGE, [
        TRIAGE, {**TRIAGE, "classifier_risk_tier": "low"}, {**TRIAGE, "classifier_risk_tier": "low", "disposition": "allow"},
        {**TRIAGE, "justification": "  short    "}, {**TRIAGE, "attack_category": "other"}, {**TRIAGE, "requires_judge_review": "yes"}, {**TRIAGE, "requires_judge_review": "maybe"},
    ]) == [[], ["low_tier_cannot_block"], [], ["blank:justification"], ["choice:attack_category"], [], ["type:requires_judge_review"]]
    assert broken(spark, K.SANITIZER, [
        SANITIZER, {**SANITIZER, "sanitized_prompt": " do it "}, {**SANITIZER, "sanitized_prompt": "do it", "residual_risk_detected": True}, {**SANITIZER, "sanitized_prompt": ""},
    ]) == [[], ["unchanged_without_flag"], [], ["short:sanitized_prompt"]]
    assert broken(spark, K.JUDGE, [JUDGE, {**JUDGE, "agrees_with_triage": False}, {**JUDGE, "judge_disposition": "allow", "agrees_with_triage": False}]) == [
        [], ["agreement_flag_lies"], []]
    assert broken(spark, K.ESCALATION, [ESCALATION, {**ESCALATION, "incident_id": "X-1"}, {**ESCALATION, "escalation_reason": "short"}]) == [
        [], ["incident_prefix"], ["short:escalation_reason"]]


def test_trace(spark):
    assert broken(spark, K.TRACE, [
        TRACE, {**TRACE, "total_latency_ms": -1}, {**TRACE, "total_latency_ms": None}, {**TRACE, "triage": {**TRIAGE, "extra": 1}},
        {**TRACE, "judge": {**JUDGE, "agrees_with_triage": False}}, {**TRACE, "triage": "none"}, {k: v for k, v in TRACE.items() if k != "final_disposition"},
    ]) == [[], ["range:total_latency_ms"], [], ["triage.extra_keys"], ["judge.agreement_flag_lies"], ["type:triage"], ["missing:final_disposition"]]


def test_messy_text(spark):
    body = json.dumps(JUDGE)
    messy = [
        f"```json\n{body}\n```", f"Here you go: {body} Anything else?", body[:-1] + ",}", body.replace('"', "'"),
        body.replace('"prompt_id"', "prompt_id"), body[:40], f"[{body}]"[:-1], "null", "", None,
    ]
    got = broken(spark, K.JUDGE, messy, repair=True)
    assert got[:5] == [[]] * 5 and got[5] == ["not_an_object"] and got[7:] == [["not_an_object"]] * 3
    strict = broken(spark, K.JUDGE, [body, body + " tail", body + "}", body + "," + body, body + '}, "end": ['])
    assert strict == [[]] + [["not_an_object"]] * 4


def test_fail_closed(spark):
    df = spark.createDataFrame([(True,), (False,)], "ok boolean")
    triage = K.typed(K.parse_object(F.lit(json.dumps(TRIAGE))), K.TRIAGE, {"agent_status": F.lit("success")})
    safe = K.triage_or_escalation(triage, F.col("ok"), F.lit("p"), F.lit("roleplay"), F.lit("bad json"))
    good, bad = [r["t"] for r in df.select(safe.alias("t")).collect()]
    assert good["disposition"] == "block" and good["agent_status"] == "success"
    assert (bad["disposition"], bad["classifier_risk_tier"], bad["triage_confidence"], bad["requires_judge_review"]) == ("escalate", "high", 0.0, True)
    assert bad["justification"] == "Fail-closed escalation triggered: bad json. Triage agent output could not be validated after retries."
    judge = K.typed(K.parse_object(F.lit(json.dumps(JUDGE))), K.JUDGE, {"agent_status": F.lit("success")})
    for first, agrees in (("escalate", True), ("allow", False)):
        j = df.select(K.judge_or_escalation(judge, F.lit(False), F.lit("p"), F.lit(first), F.lit("r"), "m").alias("j")).first()["j"]
        assert (j["judge_disposition"], j["agrees_with_triage"]) == ("escalate", agrees)
    sane = K.typed(K.parse_object(F.lit(json.dumps(SANITIZER))), K.SANITIZER, {"agent_status": F.lit("success")})
    s = df.select(K.sanitizer_or_unchanged(sane, F.lit(False), F.lit("p"), F.lit("text")).alias("s")).first()["s"]
    assert (s["sanitized_prompt"], s["residual_risk_detected"], s["tokens_removed"]) == ("text", True, [])


def test_drivers(spark):
    names = ["a", "b", "c", "d"]
    rows = {0: [-3.0, -2.0, -1.0, -0.5], 1: [5.0, -4.0, 3.0, 2.0], 2: [1.0, 1.0, 1.0, 1.0], 3: [0.0, 0.0, 0.0, 0.0]}
    df = spark.createDataFrame(list(rows.items()), "i int, c array<double>")
    got = {r["i"]: r["d"] for r in df.select("i", D.top_drivers(names, F.col("c")).alias("d")).collect()}
    assert got == {0: ["overall_usage_pattern"], 1: ["a", "c"], 2: ["d", "c", "b"], 3: ["overall_usage_pattern"]}
    few = spark.createDataFrame([([0.5, -1.0],)], "c array<double>").select(D.top_drivers(["x", "y"], F.col("c"))).first()[0]
    assert few == ["x"]


def test_tiers_never_fall(spark):
    df = spark.createDataFrame([(t, n) for t in ("low", "medium", "high") for n in (True, False, None)], "tier string, near boolean")
    up, lifted = D.upgraded_tier(F.col("tier"), F.col("near"))
    for r in df.select("*", up.alias("up"), lifted.alias("lifted")).collect():
        order = ["low", "medium", "high"]
        assert order.index(r["up"]) >= order.index(r["tier"])
        assert r["lifted"] == (r["tier"] == "low" and r["near"] is True)
    edges = spark.createDataFrame([(0.49,), (0.5,), (0.79,), (0.8,)], "p double").select(D.risk_tier(F.col("p")))
    assert [r[0] for r in edges.collect()] == ["low", "medium", "medium", "high"]


def test_attack_confidence(spark):
    df = spark.createDataFrame([([0.7, 0.2, 0.1],)], "p array<double>")
    assert df.select(D.attack_confidence(F.col("p"), ["benign", "x", "y"])).first()[0] == pytest.approx(0.3)
    assert df.select(D.attack_confidence(F.col("p"), ["x", "y", "z"])).first()[0] == pytest.approx(0.7)


def test_approvals(spark):
    requests = spark.createDataFrame([("t1", 10), ("t2", 10), ("t3", 10), ("t4", 10)], "thread string, opened int")
    decisions = spark.createDataFrame(
        [("t1", True, 11, 1), ("t2", False, 12, 2), ("t2", True, 13, 3), ("t4", True, 9, 4), ("t9", True, 20, 5)],
        "thread string, approved boolean, at int, id int",
    )
    times = {"requested_at": "opened", "decided_at": "at"}
    got = {r["thread"]: r["outcome"] for r in D.outcomes(requests, decisions, "thread", ["at", "id"], **times).collect()}
    assert got == {"t1": "approved", "t2": "rejected", "t3": "pending_human_approval", "t4": "pending_human_approval"}
    refused = D.refused_decisions(requests, decisions, "thread", ["at", "id"], **times)
    assert {(r["id"], r["reason"]) for r in refused.collect()} == {(3, "inactive_thread"), (4, "unknown_thread"), (5, "unknown_thread")}


def test_grounding_counts(spark):
    rows = [("high", ["f"]), ("HIGH", ["f"]), ("low", ["f"]), ("unknown", []), ("high", []), (None, ["f"]), ("medium", None)]
    df = spark.createDataFrame(rows, "grounding_confidence string, retrieved_sources array<string>")
    assert tuple(D.grounding_counts(df).first()) == (7, 3, 4)


def test_cut_off_objects_are_closed(spark):
    """Every prefix of an object from its first value on is closed to an object that holds a part of it."""
    whole = '{"n": 1, "t": "a \\\\ \\"q\\" \\u00e9 {x", "l": [1, {"y": null}, "z"], "o": {"b": true}}'
    want = json.loads(whole)
    cuts = [whole[:i] for i in range(7, len(whole) + 1)]
    odd = [
        ('{"a": not sure, "b": [x y, 1', {"a": "not sure", "b": ["x y", 1]}), ("{'a': 'b', 'c", {"a": "b"}), ("{", {}), ("So: {a: 1, b", {"a": 1}),
        ('{"a": 1} and {"b', {"a": 1}), ('{"a": [1}', None), ('{"a": 1]', None), ("no object", None), ("", None), (None, None),
        ('{"a": "' + "x" * 200_000, {"a": "x" * 200_000}), ('{"a": "' + '\\\\\\"' * 20_000, {"a": '\\"' * 20_000}), ('{"a": ' + "[" * 50 + "1,", None),
    ]
    rows = spark.createDataFrame(list(enumerate([*cuts, *(t for t, _ in odd)])), "i int, raw string")
    made = [r["d"] for r in rows.select("i", F.to_json(K.extract_object(F.col("raw"), complete=True)).alias("d")).orderBy("i").collect()]
    assert json.loads(made[len(cuts) - 1]) == want
    for cut, text in zip(cuts, made):
        got = json.loads(text)
        assert set(got) <= set(want) and got["n"] == 1, cut
        assert "t" not in got or got["t"] is None or want["t"].startswith(got["t"]), cut
        assert "l" not in got or got["l"] is None or len(got["l"]) <= 3, cut
    for (text, expected), found in list(zip(odd, made[len(cuts):]))[:-1]:
        assert (json.loads(found) if found is not None else None) == expected, text and text[:40]
    assert json.loads(made[-1])["a"] is not None
    plain = [r["d"] for r in rows.select("i", K.extract_object(F.col("raw")).isNotNull().alias("d")).orderBy("i").collect()]
    assert sum(plain[: len(cuts)]) == 1


def test_each_way_is_worked_out_once(spark):
    rows = spark.createDataFrame([('{"a": 1',), ('x {"a": 1} y',), ("{'a': 1,}",), ("none",), ("",), (None,)], "raw string")
    found = rows.withColumn("doc", K.extract_object(F.col("raw"), complete=True))
    plan = found._jdf.queryExecution().analyzed().toString()
    # one parse for each way, and one list of tokens
    assert plan.count("try_parse_json") == 4 and plan.count("regexp_extract_all") == 1
    assert [r[0] for r in found.select(F.try_variant_get("doc", "$.a", "int")).collect()] == [1, 1, 1, None, None, None]


def test_heavy_rows_are_dealt_out_by_number(spark, tmp_path):
    """File splits do not count: a table of one row group has many, and one of them holds all rows."""
    from tidewatch.plans.registry import spread

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    done = spread(spark.read.parquet(str(tmp_path / "one")), rows=50)
    assert done.rdd.getNumPartitions() == 20 and done.count() == 1000
    assert spread(spark.range(0, 1000, 1, 8), rows=50).rdd.getNumPartitions() == 20
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert spread(many, rows=500).rdd.getNumPartitions() == many.rdd.getNumPartitions()
