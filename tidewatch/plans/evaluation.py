"""Evaluation queries over labelled documents, customers and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import decisions as D
from tidewatch.operators import evaluate as E
from tidewatch.operators import metrics as M
from tidewatch.operators.ordered import over_rows
from tidewatch.plans.registry import bound, query, table

LABELLED_SQL = """
lab AS (
  SELECT d.doc_id, d.lang, l.quality, l.toxic, d.n_chars,
         (d.n_chars - min(d.n_chars) OVER ()) / CAST(max(d.n_chars) OVER () - min(d.n_chars) OVER () AS DOUBLE) AS p,
         length(d.text) - length(replace(d.text, ' ', '')) AS n_spaces,
         length(d.text) - length(replace(d.text, '.', '')) AS n_dots
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark, sf):
    docs = table(spark, sf, "documents")
    count = lambda ch: F.length("text") - F.length(F.replace("text", F.lit(ch), F.lit("")))
    rows = docs.select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"),
        count(" ").alias("n_spaces"), count(".").alias("n_dots"),
    ).join(table(spark, sf, "labels"), "doc_id")
    return M.min_max(rows, {"n_chars": "p"})


def score_sql(prefix=""):
    return f"""coalesce({prefix}tp / nullif({prefix}tp + {prefix}fp, 0), 0.0) AS precision,
       coalesce({prefix}tp / nullif({prefix}tp + {prefix}fn, 0), 0.0) AS recall,
       coalesce(2 * {prefix}tp / nullif(2 * {prefix}tp + {prefix}fp + {prefix}fn, 0), 0.0) AS f1"""


@query(
    "binary_metrics",
    f"""WITH {LABELLED_SQL}, c AS (
  SELECT lang, count(*) FILTER (WHERE p >= 0.05 AND quality = 1) AS tp, count(*) FILTER (WHERE p >= 0.05 AND quality <> 1) AS fp,
         count(*) FILTER (WHERE p < 0.05 AND quality = 1) AS fn, count(*) FILTER (WHERE p < 0.05 AND quality <> 1) AS tn
  FROM lab GROUP BY lang)
SELECT *, {score_sql()} FROM c""",
)
def binary_metrics(spark, sf):
    return E.binary_metrics(labelled(spark, sf), "quality", F.col("p") >= 0.05, by=["lang"])


@query(
    "roc_auc",
    f"""WITH {LABELLED_SQL}, r AS (
  SELECT quality, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS ar FROM lab),
n AS (SELECT count(*) FILTER (WHERE quality = 1) AS np, count(*) FILTER (WHERE quality = 0) AS nn,
             sum(ar) FILTER (WHERE quality = 1) AS sr FROM r)
SELECT round((sr - np * (np + 1) / 2.0) / (np * nn), 9) AS roc_auc FROM n""",
)
def roc_auc(spark, sf):
    return E.areas(labelled(spark, sf), "quality", "p", group_rows=bound(spark, sf, "labels")).select(F.round("roc_auc", 9).alias("roc_auc"))


CURVE_SQL = f"""{LABELLED_SQL}, s AS (
  SELECT p, sum(quality) AS pos, sum(1 - quality) AS neg FROM lab GROUP BY p),
c AS (SELECT p, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM s WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
n AS (SELECT sum(pos) AS np, sum(neg) AS nn FROM s)"""


@query("pr_ap", f"WITH {CURVE_SQL} SELECT round(sum(pos / np * tp / (tp + fp)), 9) AS average_precision FROM c, n")
def pr_ap(spark, sf):
    return E.areas(labelled(spark, sf), "quality", "p", group_rows=bound(spark, sf, "labels")).select(F.round("average_precision", 9).alias("average_precision"))


@query("roc_curve", f"WITH {CURVE_SQL} SELECT p AS threshold, fp / nn AS fpr, tp / np AS tpr FROM c, n")
def roc_curve(spark, sf):
    return E.roc_points(labelled(spark, sf), "quality", "p", group_rows=bound(spark, sf, "labels"))


@query("pr_curve", f"WITH {CURVE_SQL} SELECT p AS threshold, tp / (tp + fp) AS precision, tp / np AS recall FROM c, n")
def pr_curve(spark, sf):
    return E.pr_points(labelled(spark, sf), "quality", "p", group_rows=bound(spark, sf, "labels"))


@query(
    "calibration_bins",
    f"""WITH {LABELLED_SQL}
SELECT CAST(greatest(ceil(p * 10) - 1, 0) AS INT) AS bin, count(*) AS n, round(avg(p), 9) AS mean_predicted, avg(quality) AS observed_rate
FROM lab GROUP BY 1""",
)
def calibration_bins(spark, sf):
    return E.calibration(labelled(spark, sf), "quality", "p").withColumn("mean_predicted", F.round("mean_predicted", 9))


@query(
    "conditional_means",
    f"""WITH {LABELLED_SQL}
SELECT round(avg(p), 9) AS overall_mean, round(avg(p) FILTER (WHERE toxic = 1), 9) AS on_anomalies,
       round(avg(p) FILTER (WHERE toxic = 0), 9) AS on_normal FROM lab""",
)
def conditional_means(spark, sf):
    done = E.conditional_means(labelled(spark, sf), "p", "toxic")
    return done.select(*[F.round(c, 9).alias(c) for c in done.columns])


PERCENTILES_SQL = f"""{LABELLED_SQL},
grid AS (SELECT 80.0::DOUBLE + 0.5 * i AS percentile FROM range(39) t(i)),
thr AS (SELECT percentile, (SELECT quantile_cont(n_chars::DOUBLE, [{', '.join(f'{p / 100:.3f}' for p in E.percentile_grid())}]) FROM lab)[CAST((percentile - 80) * 2 AS INT) + 1] AS threshold FROM grid),
c AS (
  SELECT percentile, threshold, count(*) FILTER (WHERE n_chars >= threshold AND toxic = 1) AS tp,
         count(*) FILTER (WHERE n_chars >= threshold AND toxic = 0) AS fp,
         count(*) FILTER (WHERE n_chars < threshold AND toxic = 1) AS fn
  FROM thr CROSS JOIN lab GROUP BY percentile, threshold),
swept AS (SELECT *, {score_sql()} FROM c)"""


@query(
    "percentile_sweep",
    f"WITH {PERCENTILES_SQL} SELECT percentile, round(threshold, 6) AS threshold, tp, fp, fn, precision, recall, f1 FROM swept",
)
def percentile_sweep(spark, sf):
    done = E.percentile_sweep(labelled(spark, sf), "toxic", "n_chars", group_rows=bound(spark, sf, "labels"))
    return done.withColumn("threshold", F.round("threshold", 6))


@query(
    "calibrated_threshold",
    f"""WITH {PERCENTILES_SQL} SELECT percentile, round(threshold, 6) AS threshold, precision, recall, f1
FROM swept ORDER BY f1 DESC, percentile LIMIT 1""",
)
def calibrated_threshold(spark, sf):
    swept = E.percentile_sweep(labelled(spark, sf), "toxic", "n_chars", group_rows=bound(spark, sf, "labels"))
    return E.best_percentile(swept).withColumn("threshold", F.round("threshold", 6))


ACCOUNT_SQL = """
acc AS (
  SELECT c.c_custkey, (c.c_mktsegment = 'BUILDING')::INT AS y, round(sum(o.o_totalprice), 2) AS arr,
         (c.c_acctbal - min(c.c_acctbal) OVER ()) / (max(c.c_acctbal) OVER () - min(c.c_acctbal) OVER ()) AS p
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey, c.c_mktsegment, c.c_acctbal),
cut AS (SELECT quantile_cont(arr, 0.9) AS cutoff FROM acc),
top AS (SELECT acc.* FROM acc, cut WHERE arr >= cutoff)"""


def accounts(spark, sf):
    arr = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("arr"))
    rows = table(spark, sf, "customer").join(arr, F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.select("c_custkey", "c_acctbal", "arr", (F.col("c_mktsegment") == "BUILDING").cast("int").alias("y"))
    return M.min_max(rows, {"c_acctbal": "p"})


@query("top_decile_segment", f"WITH {ACCOUNT_SQL} SELECT c_custkey, arr FROM top")
def top_decile_segment(spark, sf):
    rows = accounts(spark, sf)
    return rows.filter(F.col("arr") >= M.top_share_cutoff(rows, "arr", group_rows=bound(spark, sf, "customer"))).select("c_custkey", "arr")


@query(
    "segment_recall_sweep",
    f"""WITH {ACCOUNT_SQL}, grid AS (SELECT unnest([{', '.join(repr(t) for t in E.recall_grid())}]::DOUBLE[]) AS threshold),
c AS (SELECT threshold, count(*) FILTER (WHERE p >= threshold) / nullif(count(*), 0) AS recall FROM grid CROSS JOIN top WHERE y = 1 GROUP BY threshold)
SELECT threshold, recall FROM c ORDER BY recall DESC, threshold DESC LIMIT 1""",
)
def segment_recall_sweep(spark, sf):
    rows = accounts(spark, sf)
    segment = rows.filter(F.col("arr") >= M.top_share_cutoff(rows, "arr", group_rows=bound(spark, sf, "customer")))
    return E.best_segment_threshold(E.segment_sweep(segment, "y", "p"))


PREVIOUS_SQL = """
pred AS (
  SELECT event_type AS truth, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS predicted FROM events),
pair AS (SELECT * FROM pred WHERE predicted IS NOT NULL)"""


def previous_type(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("truth"))
    done = over_rows(
        events, ["user_id"], ["ts", "event_id"], 1, lambda f, w: f.withColumn("predicted", F.lag("truth").over(w)),
        group_rows=bound(spark, sf, "events"),
    )
    return done.filter(F.col("predicted").isNotNull())


@query(
    "multiclass_report",
    f"""WITH {PREVIOUS_SQL}, c AS (SELECT DISTINCT truth AS class FROM pair),
k AS (
  SELECT class, (SELECT count(*) FROM pair WHERE truth = class AND predicted = class) AS tp,
         (SELECT count(*) FROM pair WHERE truth <> class AND predicted = class) AS fp,
         (SELECT count(*) FROM pair WHERE truth = class AND predicted <> class) AS fn FROM c),
m AS (SELECT class, tp, {score_sql()}, tp + fn AS support FROM k)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM m
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), sum(support) FROM m
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support) FROM m
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support) FROM m""",
)
def multiclass_report(spark, sf):
    done = E.class_report(previous_type(spark, sf), "truth", "predicted")
    return done.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "confusion",
    f"WITH {PREVIOUS_SQL} SELECT truth, "
    + ", ".join(f"count(*) FILTER (WHERE predicted = '{t}') AS \"{t}\"" for t in EVENT_TYPES)
    + " FROM pair GROUP BY truth",
)
def confusion(spark, sf):
    return E.confusion_matrix(previous_type(spark, sf), "truth", "predicted", EVENT_TYPES)


MODELS = {"length": ("n_chars", 3000.0), "spaces": ("n_spaces", 400.0), "dots": ("n_dots", 40.0)}


def four(expr):
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 12)), 4) AS DOUBLE)"


LEADER_SQL = f"""{LABELLED_SQL}, long AS (
  {" UNION ALL ".join(f"SELECT '{m}' AS model, {i} AS place, toxic AS y, {s}::DOUBLE AS score, {s} >= {t} AS predicted FROM lab" for i, (m, (s, t)) in enumerate(MODELS.items()))}),
c AS (
  SELECT model, place, count(*) FILTER (WHERE predicted AND y = 1) AS tp, count(*) FILTER (WHERE predicted AND y = 0) AS fp,
         count(*) FILTER (WHERE NOT predicted AND y = 1) AS fn FROM long GROUP BY model, place),
r AS (
  SELECT model, y, rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS ar FROM long),
a AS (
  SELECT model, (sum(ar) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
         / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc FROM r GROUP BY model),
board AS (
  SELECT model, place, {four('precision')} AS precision, {four('recall')} AS recall, {four('f1')} AS f1, {four('auc')} AS roc_auc
  FROM (SELECT c.*, a.auc, {score_sql()} FROM c JOIN a USING (model)))"""


@query("model_leaderboard", f"WITH {LEADER_SQL} SELECT model, place, precision, recall, f1, roc_auc FROM board")
def model_leaderboard(spark, sf):
    return E.model_comparison(labelled(spark, sf), "toxic", MODELS, group_rows=bound(spark, sf, "labels"))


@query("best_model", f"WITH {LEADER_SQL} SELECT model AS best_model FROM board ORDER BY f1 DESC, place LIMIT 1")
def best_model(spark, sf):
    return E.best_model(E.model_comparison(labelled(spark, sf), "toxic", MODELS, group_rows=bound(spark, sf, "labels")))


@query(
    "severity_distribution",
    f"""WITH {LABELLED_SQL}, n AS (
  SELECT p > 0.5 AS a, (n_spaces - min(n_spaces) OVER ()) / CAST(max(n_spaces) OVER () - min(n_spaces) OVER () AS DOUBLE) > 0.5 AS b FROM lab)
SELECT CASE WHEN a AND b THEN 'high' WHEN a OR b THEN 'medium' ELSE 'low' END AS severity, count(*) AS n FROM n GROUP BY 1""",
)
def severity_distribution(spark, sf):
    rows = M.min_max(labelled(spark, sf), {"n_spaces": "q"})
    return rows.groupBy(D.agreement_severity(F.col("p"), F.col("q")).alias("severity")).agg(F.count("*").alias("n"))


@query("class_weight", "SELECT count(*) FILTER (WHERE toxic = 0) / count(*) FILTER (WHERE toxic = 1) AS pos_weight FROM labels")
def class_weight(spark, sf):
    return E.class_weight(table(spark, sf, "labels"), "toxic")


@query(
    "table_profile",
    """SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE event_id IS NULL) + count(*) FILTER (WHERE ts IS NULL) + count(*) FILTER (WHERE user_id IS NULL)
       + count(*) FILTER (WHERE event_type IS NULL) + count(*) FILTER (WHERE value IS NULL) + count(*) FILTER (WHERE props IS NULL)
       + count(*) FILTER (WHERE event_type <> 'error') AS total_nulls,
       count(DISTINCT event_type) AS n_keys, avg((value >= 200)::INT) AS label_rate FROM events""",
)
def table_profile(spark, sf):
    rows = table(spark, sf, "events").withColumns(
        {"code": F.when(F.col("event_type") == "error", F.col("value")), "flag": (F.col("value") >= 200).cast("int")}
    )
    return E.table_profile(rows, "event_type", "flag")
