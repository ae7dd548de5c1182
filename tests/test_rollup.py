import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import rollup as R
from tidewatch.session import new_table_path
from tidewatch.sources import readers, writers


def trace(pid, ts="2026-07-10T12:00:00+00:00", latency=100.0, category="roleplay", tier="low", final="allow", status="success"):
    return {
        "prompt_id": pid, "triage": {"attack_category": category, "classifier_risk_tier": tier, "disposition": "allow"},
        "escalation": {"agents_disagreed": False, "severity": tier, "notify_slack": False}, "final_disposition": final,
        "pipeline_status": status, "total_latency_ms": latency, "timestamp": ts,
    }


def flat(spark, tmp_path, docs):
    path = tmp_path / f"traces-{len(list(tmp_path.iterdir()))}.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return R.flatten_traces(readers.read_traces(spark, str(path)))


def test_flatten(spark, tmp_path):
    docs = [
        trace("a", latency=60000.0), trace("b", latency=60000.01), trace("c", latency=None), trace("d", ts="yesterday"), trace("e", category=None),
        {"prompt_id": "f", "final_disposition": "allow"}, trace("g", ts="2026-07-10T23:30:00-02:00"), trace("", ts=None),
    ]
    rows = flat(spark, tmp_path, docs)
    got = {r["prompt_id"]: r for r in rows.collect()}
    assert [got[p]["sla_breached"] for p in "abc"] == [False, True, False]
    assert got["d"]["timestamp_fallback"] and not got["a"]["timestamp_fallback"]
    assert got["f"]["agents_disagreed"] is False
    good, skipped = R.split_facts(rows)
    assert {r["prompt_id"] for r in good.collect()} == {"a", "b", "c", "d", "g"}
    assert {r["prompt_id"] for r in skipped.collect()} == {"e", "f", ""}
    # the date is the UTC one
    assert good.filter("prompt_id = 'g'").select(R.event_date().cast("string")).first()[0] == "2026-07-11"


def table(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_sync_is_repeatable(spark, tmp_path):
    facts, rolled = new_table_path(spark, "facts"), new_table_path(spark, "rollup")
    first = flat(spark, tmp_path, [trace("a"), trace("a", latency=999.0, ts="2026-07-10T13:00:00+00:00"), trace("b", ts="2026-07-11T00:00:00+00:00"), trace("c", status="validation_failed")])
    writers.sync_traces(first, facts, rolled)
    once = table(spark, facts), table(spark, rolled)
    writers.sync_traces(first, facts, rolled)
    assert (table(spark, facts), table(spark, rolled)) == once
    assert spark.read.parquet(facts).count() == 3
    # a known trace is not overwritten, another date is left alone, the touched one is recomputed
    writers.sync_traces(flat(spark, tmp_path, [trace("a", latency=5.0), trace("d", final="escalate", latency=300.0)]), facts, rolled)
    assert spark.read.parquet(facts).filter("prompt_id = 'a'").first()["total_latency_ms"] == 100
    days = {str(r["rollup_date"]): r for r in spark.read.parquet(rolled).collect()}
    assert days["2026-07-11"]["total_requests"] == 1
    day = days["2026-07-10"]
    assert (day["total_requests"], day["escalated_count"], day["fail_closed_count"]) == (3, 1, 1)
    assert float(day["avg_latency_ms"]) == pytest.approx(166.67)
    assert float(day["p95_latency_ms"]) == pytest.approx(280.0)


def test_snapshot(spark, tmp_path):
    good, _ = R.split_facts(flat(spark, tmp_path, [trace("a"), trace("b", ts="2026-07-11T00:00:00+00:00"), trace("c", ts="2026-07-10T00:00:00+00:00")]))
    assert [r["total_requests"] for r in R.day_snapshot(good, F.lit("2026-07-10").cast("date")).collect()] == [2]


def test_csv(spark, tmp_path):
    rows = [("plain", True, "s", "c"), ('quote "x", comma', False, "s", "c"), ("two\nlines", True, "s", "c"), ("  blanks  ", True, "s", "c"), (None, True, "s", "c")]
    path = str(tmp_path / "corpus")
    writers.write_csv(spark.createDataFrame(rows, readers.CORPUS_SCHEMA), path)
    assert {r["text"] for r in readers.read_csv(spark, path).collect()} == {r[0] for r in rows[:-1]}


def test_route_loses_nothing(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, alarm boolean")
    alerts, passed = new_table_path(spark, "alerts"), new_table_path(spark, "passed")
    writers.route(df, F.col("alarm"), alerts, passed)
    assert [r["i"] for r in spark.read.parquet(alerts).collect()] == [1]
    assert {r["i"] for r in spark.read.parquet(passed).collect()} == {2, 3}


def test_sorted_files(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.hash("id").alias("at"))
    path = new_table_path(spark, "sorted")
    writers.write_sorted(df, path, ["k"], ["at"], 4)
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("f")).collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r["f"], []).append((r["k"], r["at"]))
    assert all(rows == sorted(rows) for rows in by_file.values()) and len(by_file) > 1


def test_markdown(spark, tmp_path):
    from tidewatch.operators import similarity as S

    (tmp_path / "a.md").write_text("# Runbook: leak\n\n## Symptom Pattern\nclimbs\nslowly\n\n## REQUIRES HUMAN APPROVAL\n- restart\n")
    (tmp_path / "b.md").write_text("no heading at all")
    cut = S.sections(readers.read_markdown(spark, str(tmp_path)), "file_name", "content").collect()
    got = {(r["file_name"], r["section_no"]): (r["title"], r["text"].strip(), r["requires_approval"]) for r in cut}
    assert got["a.md", 1] == ("Symptom Pattern", "climbs\nslowly", False)
    assert got["a.md", 2] == ("REQUIRES HUMAN APPROVAL", "- restart", True)
    assert ("b.md", 0) in got and len(got) == 4
