"""Account features, risk payloads, approvals and boosted trees over the customer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import attribution as A
from tidewatch.operators import corpus as C
from tidewatch.operators import decisions as D
from tidewatch.operators import evaluate as E
from tidewatch.operators import metrics as M
from tidewatch.operators import models as Mo
from tidewatch.plans.registry import bound, dealt, query, spread, table
from tidewatch.session import new_table_path, stored

# Customers as accounts: revenue from orders, usage and support signals from line items.
ACCOUNT_SQL = """
ord AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS arr, count(*) AS sessions,
               count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS tickets FROM orders GROUP BY o_custkey),
lin AS (SELECT o.o_custkey, count(DISTINCT l.l_partkey) AS parts, max(l.l_discount) * 3 AS discount,
               count(*) FILTER (WHERE l.l_returnflag = 'R') AS returned, count(*) AS lines
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey),
acc AS (
  SELECT c.c_custkey AS account_id, ord.sessions AS weekly_active_sessions, lin.parts AS feature_adoption_counts,
         (c.c_acctbal + 1000) / 11000 AS seat_utilization_pct, ord.arr, 12 * (1 + c.c_nationkey // 10) AS contract_length_months,
         lin.discount AS discount_pct, ord.tickets AS ticket_count, 5.0 - 4.0 * lin.returned / lin.lines AS csat,
         (c.c_mktsegment = 'MACHINERY')::INT AS churn
  FROM customer c JOIN ord ON c.c_custkey = ord.o_custkey JOIN lin ON c.c_custkey = lin.o_custkey)"""


def accounts(spark, sf):
    orders = table(spark, sf, "orders")
    per_order = orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("arr"),
        F.count("*").alias("weekly_active_sessions"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("ticket_count"),
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_discount", "l_returnflag")
    per_line = (
        lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(
            F.countDistinct("l_partkey").alias("feature_adoption_counts"),
            (F.max("l_discount") * 3).alias("discount_pct"),
            F.count_if(F.col("l_returnflag") == "R").alias("_returned"),
            F.count("*").alias("_lines"),
        )
    )
    joined = (
        table(spark, sf, "customer")
        .join(per_order, F.col("c_custkey") == F.col("o_custkey"))
        .join(per_line, F.col("c_custkey") == F.col("custkey"))
    )
    return joined.select(
        F.col("c_custkey").alias("account_id"), "weekly_active_sessions", "feature_adoption_counts",
        ((F.col("c_acctbal") + 1000) / 11000).alias("seat_utilization_pct"), "arr",
        (12 * (1 + F.floor(F.col("c_nationkey") / 10))).cast("int").alias("contract_length_months"), "discount_pct", "ticket_count",
        (5.0 - 4.0 * F.col("_returned") / F.col("_lines")).alias("csat"), F.lit(None).cast("int").alias("nps"),
        (F.col("c_mktsegment") == "MACHINERY").cast("int").alias("churn"),
    )


@query(
    "account_features",
    f"""WITH {ACCOUNT_SQL}
SELECT account_id, weekly_active_sessions, feature_adoption_counts, seat_utilization_pct, arr, contract_length_months, ticket_count, csat, churn,
       ntile(4) OVER (ORDER BY arr DESC, account_id) AS arr_quartile,
       CASE WHEN discount_pct > 0.2 THEN 1 ELSE 0 END AS high_discount_flag,
       CASE WHEN seat_utilization_pct < 0.5 THEN 1 ELSE 0 END AS low_utilization_flag,
       weekly_active_sessions * 4 AS estimated_monthly_sessions
FROM acc""",
)
def account_features(spark, sf):
    return M.account_features(accounts(spark, sf), group_rows=bound(spark, sf, "customer"))


MODEL_COLUMNS = [
    "weekly_active_sessions", "feature_adoption_counts", "seat_utilization_pct", "arr", "contract_length_months", "ticket_count", "csat",
]


@query(
    "numeric_view",
    """SELECT o_totalprice, o_custkey, (o_orderstatus = 'F')::INT AS churn_label FROM orders""",
)
def numeric_view(spark, sf):
    """Target found by name in the raw table and attached by key; numeric columns in model order."""
    orders = table(spark, sf, "orders")
    raw = orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("Churn_Flag"))
    attached = M.attach_target(orders, raw, "o_orderkey")
    features = M.numeric_view(attached, drop=["o_orderkey"], word="churn")
    return M.model_order(attached, [*sorted(features.columns, reverse=True), "churn_label"])


@query(
    "high_risk_payload",
    f"""WITH {ACCOUNT_SQL}, s AS (
  SELECT account_id, arr, 1.5 * ticket_count AS c1, -1.5 * seat_utilization_pct AS c2, -2.0 * (csat - 3.7) AS c3,
         1.0 / (1.0 + exp(-(-1.0 + -1.5 * seat_utilization_pct + 1.5 * ticket_count + -2.0 * (csat - 3.7)))) AS p FROM acc)
SELECT account_id::VARCHAR AS account_id, round(p, 3) AS churn_probability, arr,
       array_to_string(CASE WHEN c1 > 0 AND c3 > 0 AND c1 > abs(c3) THEN ['ticket_count', 'csat']
            WHEN c1 > 0 AND c3 > 0 THEN ['csat', 'ticket_count']
            WHEN c1 > 0 THEN ['ticket_count'] WHEN c3 > 0 THEN ['csat'] ELSE ['overall_usage_pattern'] END, ',') AS top_3_shap_drivers
FROM s WHERE p > 0.6""",
)
def high_risk_payload(spark, sf):
    """A weighted-term score in place of a model, with its terms as contributions."""
    rows = accounts(spark, sf).withColumn("csat_gap", F.col("csat") - 3.7)
    weights = {"seat_utilization_pct": -1.5, "ticket_count": 1.5, "csat_gap": -2.0}
    terms = F.array(*[F.lit(w) * F.col(c) for c, w in weights.items()])
    drivers = D.top_drivers(["seat_utilization_pct", "ticket_count", "csat"], terms)
    scored = rows.withColumn("p", D.logistic(weights, -1.0))
    payload = D.high_risk(scored, "p", "arr", "account_id", drivers)
    return payload.withColumn("top_3_shap_drivers", F.array_join("top_3_shap_drivers", ","))


@query(
    "topk_array_drivers",
    """WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, unnest([
    {'n': 'quantity', 'i': 0, 'v': l_quantity - 25.0}, {'n': 'discount', 'i': 1, 'v': 100.0 * l_discount - 5.0},
    {'n': 'tax', 'i': 2, 'v': 4.0 - 100.0 * l_tax}, {'n': 'price', 'i': 3, 'v': 20.0 - l_extendedprice / 2000.0}]) AS d,
    l_extendedprice FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice ORDER BY abs(d.v) DESC, d.i DESC) AS rn FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(string_agg(d.n, ',' ORDER BY rn) FILTER (WHERE rn <= 3 AND d.v > 0), 'overall_usage_pattern') AS drivers
FROM r GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice""",
)
def topk_array_drivers(spark, sf):
    lines = spread(table(spark, sf, "lineitem"))
    terms = F.array(
        F.col("l_quantity") - 25.0, 100.0 * F.col("l_discount") - 5.0, 4.0 - 100.0 * F.col("l_tax"), 20.0 - F.col("l_extendedprice") / 2000.0
    )
    drivers = D.top_drivers(["quantity", "discount", "tax", "price"], terms)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(drivers, ",").alias("drivers"))


# --- approvals: orders that are not pending are requests, their line items human decisions -----------

DECISION_SQL = """
req AS (SELECT o_orderkey AS thread_id, o_totalprice AS arr, o_orderdate FROM orders WHERE o_orderstatus <> 'P'),
dec AS (
  SELECT l.l_orderkey AS thread_id, l_returnflag = 'A' AS approved, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         r.thread_id IS NOT NULL AND l.l_shipdate >= r.o_orderdate AS known
  FROM lineitem l LEFT JOIN req r ON l.l_orderkey = r.thread_id),
dr AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn,
              count(*) OVER (PARTITION BY thread_id) AS n FROM dec WHERE known)"""
DECISION_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
TIMES = {"requested_at": "o_orderdate", "decided_at": "l_shipdate"}


def approvals(spark, sf):
    requests = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("thread_id"), F.col("o_totalprice").alias("arr"), "o_orderdate"
    )
    decisions = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("thread_id"), (F.col("l_returnflag") == "A").alias("approved"), *DECISION_ORDER
    )
    return requests, decisions


@query(
    "approval_outcome",
    f"""WITH {DECISION_SQL}
SELECT r.thread_id, CASE WHEN d.approved IS NULL THEN 'pending_human_approval' WHEN d.approved THEN 'approved' ELSE 'rejected' END AS outcome,
       coalesce(d.n, 0) AS n_decisions, (r.arr >= 500)::INT AS policy_passed
FROM req r LEFT JOIN dr d ON r.thread_id = d.thread_id AND d.rn = 1""",
)
def approval_outcome(spark, sf):
    requests, decisions = approvals(spark, sf)
    done = D.outcomes(requests, decisions, "thread_id", DECISION_ORDER, **TIMES)
    return done.select("thread_id", "outcome", "n_decisions", D.policy_passed(F.col("arr")).cast("int").alias("policy_passed"))


@query(
    "refused_decisions",
    f"""WITH {DECISION_SQL}
SELECT thread_id, l_linenumber, l_partkey, 'unknown_thread' AS reason FROM dec WHERE NOT known
UNION ALL SELECT thread_id, l_linenumber, l_partkey, 'inactive_thread' FROM dr WHERE rn > 1""",
)
def refused_decisions(spark, sf):
    requests, decisions = approvals(spark, sf)
    done = D.refused_decisions(requests, decisions, "thread_id", DECISION_ORDER, **TIMES)
    return done.select("thread_id", "l_linenumber", "l_partkey", "reason")


@query(
    "thread_states",
    "SELECT conv_id, max_by(role, turn) AS last_state, count(*) AS n_transitions FROM conversations GROUP BY conv_id",
)
def thread_states(spark, sf):
    talk = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return D.latest_states(talk, "conv_id", ["turn"], "role")


@query(
    "thread_transitions",
    "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS step, role FROM conversations",
)
def thread_transitions(spark, sf):
    talk = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return D.transitions(talk, "conv_id", ["turn"], group_rows=bound(spark, sf, "conversations", "conv_id")).drop("turn")


# --- boosted trees -------------------------------------------------------------------------------


def boosted_rows(spark, sf):
    at_most = bound(spark, sf, "customer")
    known = accounts(spark, sf)
    if at_most is None:
        # counted and sampled before it is sorted
        known = stored(known)
    rows = C.stratified_split(M.account_features(known, group_rows=at_most), "churn", "account_id", group_rows=at_most)
    # every boosting round passes over these rows
    rows = dealt(rows.withColumn("label", F.col("churn").cast("double")), "account_id", table(spark, sf, "customer").count())
    ready = stored(Mo.with_vector(rows, MODEL_COLUMNS))
    train = Mo.pos_weight(ready.filter(F.col("split") == "train"))
    return ready, train


_TRAINED: dict[tuple[str, str], str] = {}


def trained(spark, sf):
    """Folder of the model fitted on these accounts at the library's settings: trained once a session, then loaded."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _TRAINED:
        ready, train = boosted_rows(spark, sf)
        model = Mo.boosted().fit(train)
        held = stored(Mo.scored(model, ready.filter(F.col("split") == "val")).select("churn", "arr", "churn_probability"))
        best = tuned_threshold(held)
        path = new_table_path(spark, "boosted")
        Mo.save_boosted(model, path, MODEL_COLUMNS, 0.5 if best is None else best)
        _TRAINED[at] = path
    return _TRAINED[at]


def tuned_threshold(rows):
    """Threshold tuned on the high-revenue accounts."""
    segment = rows.filter(F.col("arr") >= M.top_share_cutoff(rows, "arr"))
    found = E.best_segment_threshold(E.segment_sweep(segment, "churn", "churn_probability")).first()
    return None if found is None else found["threshold"]


@query("gbt_high_risk")
def gbt_high_risk(spark, sf):
    """The trained model scores every account; payload of the high-risk ones."""
    ready, _ = boosted_rows(spark, sf)
    model, columns, _ = Mo.load_boosted(spark, trained(spark, sf))
    scored = A.with_attributions(Mo.scored(model, ready), model)
    drivers = D.top_drivers(columns, F.col("contributions"))
    return D.high_risk(scored, "churn_probability", "arr", "account_id", drivers, above=0.5)


@query("scored_from_disk")
def scored_from_disk(spark, sf):
    """A table of accounts scored by a saved model, its inputs in the saved order, held against the saved threshold."""
    model, columns, threshold = Mo.load_boosted(spark, trained(spark, sf))
    features = M.account_features(accounts(spark, sf), group_rows=bound(spark, sf, "customer"))
    features = dealt(features, "account_id", table(spark, sf, "customer").count())
    rows = Mo.scored(model, Mo.with_vector(features, columns))
    return rows.select("account_id", "arr", "churn_probability", (F.col("churn_probability") >= threshold).alias("at_risk"))


@query("attribution_sums", f"WITH {ACCOUNT_SQL} SELECT account_id, 1 AS adds_up FROM acc")
def attribution_sums(spark, sf):
    """Contributions and base value add up to the model's margin for every account."""
    ready, _ = boosted_rows(spark, sf)
    model, _, _ = Mo.load_boosted(spark, trained(spark, sf))
    rows = A.with_attributions(Mo.scored(model, ready), model)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c) + F.col("base_value")
    return rows.select("account_id", (F.abs(total - F.col("margin")) < 1e-9).cast("int").alias("adds_up"))


@query("gbt_driver_ranking")
def gbt_driver_ranking(spark, sf):
    ready, _ = boosted_rows(spark, sf)
    model, columns, _ = Mo.load_boosted(spark, trained(spark, sf))
    return E.driver_ranking(A.with_attributions(ready, model), "contributions", columns)


@query("gbt_search")
def gbt_search(spark, sf):
    """Settings found by the random search at its stated size, and their validation area."""
    ready, train = boosted_rows(spark, sf)
    validation = Mo.pos_weight(ready.filter(F.col("split") == "val"))
    settings, area = Mo.search_boosted(train, validation)
    rows = [(name, str(value)) for name, value in {**settings, "validation_area": round(area, 6)}.items()]
    return spark.createDataFrame(rows, "setting string, value string")


@query("gbt_test_metrics")
def gbt_test_metrics(spark, sf):
    """Quality on the held-out split at 0.5, and at the threshold tuned on high-revenue accounts."""
    ready, _ = boosted_rows(spark, sf)
    model, _, _ = Mo.load_boosted(spark, trained(spark, sf))
    # scored once, read by every metric
    test = stored(Mo.scored(model, ready.filter(F.col("split") == "test")).select("churn", "arr", "churn_probability"))
    tuned = tuned_threshold(test)
    default = E.binary_metrics(test, "churn", F.col("churn_probability") >= 0.5).withColumn("rule", F.lit("default"))
    own = E.binary_metrics(test, "churn", F.col("churn_probability") >= tuned).withColumn("rule", F.lit("tuned"))
    area = E.areas(test, "churn", "churn_probability").select("roc_auc").scalar()
    return default.unionByName(own).withColumn("roc_auc", area)
