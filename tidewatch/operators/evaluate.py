"""Model evaluation from counts: every metric is read off an aggregate that shrinks the data first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordered import MAX_GROUP_ROWS, exact_quantiles, running_sums


def ratio0(a: Column, b: Column) -> Column:
    """``a / b``, 0 where ``b`` is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def with_scores(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> dict[str, Column]:
    t, p, n = F.col(tp), F.col(fp), F.col(fn)
    return {
        "precision": ratio0(t, t + p),
        "recall": ratio0(t, t + n),
        "f1": ratio0(2 * t, 2 * t + p + n),
    }


def binary_metrics(df: DataFrame, y: str, predicted: Column, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, precision, recall and F1, per group of ``by`` if given."""
    hit, truth = predicted, F.col(y) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
        F.count_if(~hit & ~truth).alias("tn"),
    )
    return counts.withColumns(with_scores())


# --- curves --------------------------------------------------------------------------------------


def score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(*by, score).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )


def curve(
    df: DataFrame, y: str, score: str, by: Sequence[str] = (), limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """One row per distinct score, from high to low: ``tp`` and ``fp`` when everything at or above
    it is predicted positive."""
    counts = score_counts(df, y, score, by)
    return running_sums(
        counts, list(by), [F.col(score).desc()], {"tp": F.col("pos"), "fp": F.col("neg")}, limit, group_rows
    )


def roc_points(df: DataFrame, y: str, score: str, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None) -> DataFrame:
    totals = df.agg(F.struct(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) != 1).alias("n"))).scalar()
    return curve(df, y, score, limit=limit, group_rows=group_rows).select(
        F.col(score).alias("threshold"),
        F.try_divide(F.col("fp"), totals.getField("n")).alias("fpr"),
        F.try_divide(F.col("tp"), totals.getField("p")).alias("tpr"),
    )


def pr_points(df: DataFrame, y: str, score: str, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None) -> DataFrame:
    positives = df.agg(F.count_if(F.col(y) == 1)).scalar()
    return curve(df, y, score, limit=limit, group_rows=group_rows).select(
        F.col(score).alias("threshold"),
        ratio0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), positives).alias("recall"),
    )


def areas(
    df: DataFrame, y: str, score: str, by: Sequence[str] = (), limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """ROC area (ties count half) and average precision; null where a class is missing."""
    steps = curve(df, y, score, by, limit, group_rows)
    above = F.col("tp") - F.col("pos")
    summed = steps.groupBy(*by).agg(
        F.sum(F.col("neg") * (above + F.col("pos") / 2.0)).alias("_pairs"),
        F.sum(F.col("pos") * ratio0(F.col("tp"), F.col("tp") + F.col("fp"))).alias("_prec"),
        F.sum("pos").cast("double").alias("n_pos"),
        F.sum("neg").cast("double").alias("n_neg"),
    )
    return summed.select(
        *by,
        F.try_divide("_pairs", F.col("n_pos") * F.col("n_neg")).alias("roc_auc"),
        F.try_divide("_prec", F.col("n_pos")).alias("average_precision"),
    )


def calibration(df: DataFrame, y: str, probability: str, bins: int = 10) -> DataFrame:
    """Equal-width bins closed on the right: rows, mean probability and observed rate. Bins without
    rows do not appear."""
    place = F.lit(0)
    for i in range(1, bins):
        place = place + F.when(F.col(probability) > i * (1.0 / bins), 1).otherwise(0)
    return df.groupBy(place.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(probability).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("observed_rate")
    )


# --- threshold sweeps ----------------------------------------------------------------------------


def counts_at(df: DataFrame, y: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """``step, threshold, tp, fp, fn`` for ``score >= threshold`` at every threshold, in one pass.

    Each row falls between two neighbouring thresholds; the counts per gap (one row per threshold)
    are then added up from the top.
    """
    cuts = sorted(set(thresholds))
    splits = [float("-inf"), *cuts, float("inf")]
    value = F.col(score).cast("double")
    # a missing score is over no threshold
    reached = F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)
    placed = Bucketizer(splits=splits, inputCol=score, outputCol="_level").transform(
        df.select(reached.alias(score), F.col(y).cast("int").alias(y))
    )
    gaps = placed.groupBy("_level").agg(
        F.count("*").alias("n"), F.sum(y).cast("long").alias("pos")
    ).agg(F.collect_list(F.struct("_level", "n", "pos")).alias("_gaps"))
    grid = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(cuts.index(t) + 1.0).alias("level")) for t in thresholds])
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("hits"), zero.alias("predicted"), zero.alias("pos"))

    def add(acc: Column, g: Column) -> Column:
        above = g["_level"] >= F.col("_t.level")
        return F.struct(
            (acc["hits"] + F.when(above, g["pos"]).otherwise(0)).alias("hits"),
            (acc["predicted"] + F.when(above, g["n"]).otherwise(0)).alias("predicted"),
            (acc["pos"] + g["pos"]).alias("pos"),
        )

    summed = gaps.select("_gaps", F.posexplode(grid).alias("step", "_t")).select(
        "step", F.col("_t.t").alias("threshold"), F.aggregate("_gaps", start, add).alias("_s")
    )
    swept = summed.select(
        "step",
        "threshold",
        F.col("_s.hits").alias("tp"),
        (F.col("_s.predicted") - F.col("_s.hits")).alias("fp"),
        (F.col("_s.pos") - F.col("_s.hits")).alias("fn"),
    )
    return swept.withColumns(with_scores())


def percentile_grid(first: float = 80.0, stop: float = 99.5, step: float = 0.5) -> list[float]:
    return [first + i * step for i in range(round((stop - first) / step))]


def percentile_sweep(
    df: DataFrame, y: str, score: str, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """Metrics at the score's percentiles 80, 80.5, … 99. The thresholds are numbers the caller
    keeps with the model, so they are read to the driver."""
    percentiles = percentile_grid()
    values = exact_quantiles(df, [], score, [p / 100 for p in percentiles], limit, group_rows).first()
    none = values is None or values[0] is None  # no scored row: an empty sweep
    swept = counts_at(df, y, score, [0.0 if none else float(v) for v in values or percentiles])
    swept = swept.filter(F.lit(not none))
    names = F.array(*[F.lit(p) for p in percentiles])
    return swept.withColumn("percentile", F.get(names, F.col("step"))).drop("step")


def best_percentile(swept: DataFrame) -> DataFrame:
    """The smallest percentile among those with the best F1."""
    fields = ["percentile", "threshold", "precision", "recall", "f1"]
    best = F.max_by(F.struct(*fields), F.struct(F.col("f1"), -F.col("percentile")))
    return swept.agg(best.alias("b")).select("b.*")


def recall_grid(low: float = 0.1, high: float = 0.9, points: int = 81) -> list[float]:
    step = (high - low) / (points - 1)
    return [low + i * step for i in range(points - 1)] + [high]


def segment_sweep(df: DataFrame, y: str, score: str) -> DataFrame:
    """Recall on a segment at 81 thresholds from 0.1 to 0.9."""
    return counts_at(df, y, score, recall_grid())


def best_segment_threshold(swept: DataFrame) -> DataFrame:
    """The largest threshold among those with the best recall."""
    best = F.max_by(F.struct("threshold", "recall"), F.struct("recall", "threshold"))
    return swept.agg(best.alias("b")).select("b.*")


# --- several classes -----------------------------------------------------------------------------


def confusion_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: Sequence) -> DataFrame:
    """One row per true class, one column per predicted class."""
    pivoted = df.groupBy(F.col(truth).alias("truth")).pivot(predicted, list(classes)).agg(F.count(F.lit(1)))
    return pivoted.na.fill(0)


def per_class(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the class-by-class counts."""
    n = F.col("n")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("truth").alias("c"), n.alias("support"), zero.alias("given"),
                 F.when(F.col("truth") == F.col("predicted"), n).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("c"), zero.alias("support"), n.alias("given"), zero.alias("tp")),
    )
    counted = (
        confusion_counts(df, truth, predicted)
        .select(F.explode(sides).alias("s"))
        .groupBy(F.col("s.c").alias("class"))
        .agg(F.sum("s.support").alias("support"), F.sum("s.given").alias("_given"), F.sum("s.tp").alias("tp"))
    )
    counted = counted.withColumns({"fp": F.col("_given") - F.col("tp"), "fn": F.col("support") - F.col("tp")})
    return counted.withColumns(with_scores()).select("class", "precision", "recall", "f1", "support")


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per-class rows and the accuracy, macro and weighted averages."""
    classes = per_class(df, truth, predicted).withColumn("class", F.col("class").cast("string"))
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    summary = classes.agg(
        F.struct(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support")).alias("macro"),
        F.struct(*[weighted(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support")).alias("weighted"),
        # hits over rows: recall weighted by support
        weighted("recall").alias("accuracy"),
    )
    lines = F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("accuracy").alias("precision"), F.col("accuracy").alias("recall"),
                 F.col("accuracy").alias("f1"), F.col("macro.support").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("macro.precision"), F.col("macro.recall"), F.col("macro.f1"), F.col("macro.support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("weighted.precision"), F.col("weighted.recall"), F.col("weighted.f1"), F.col("weighted.support")),
    )
    return classes.unionByName(summary.select(F.explode(lines).alias("l")).select("l.*"))


# --- tables --------------------------------------------------------------------------------------


def long_scores(df: DataFrame, y: str, models: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row per model and input row: ``model, y, score, predicted``; ``models`` maps a name to
    its score column and threshold."""
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.lit(i).alias("place"), F.col(s).cast("double").alias("score"), (F.col(s) >= t).alias("predicted"))
            for i, (m, (s, t)) in enumerate(models.items())
        ]
    )
    return df.select(F.col(y).alias("y"), F.explode(cells).alias("m")).select("y", "m.*")


def model_comparison(
    df: DataFrame, y: str, models: Mapping[str, tuple[str, float]], limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """Precision, recall, F1 and ROC area per model, four places."""
    long = long_scores(df, y, models)
    scored = binary_metrics(long, "y", F.col("predicted"), by=["model", "place"])
    joined = scored.join(areas(long, "y", "score", ["model"], limit, group_rows), "model")
    return joined.select("model", "place", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1", "roc_auc")])


def best_model(comparison: DataFrame) -> DataFrame:
    """Best F1; of equals the one listed first."""
    return comparison.agg(F.max_by("model", F.struct(F.col("f1"), -F.col("place"))).alias("best_model"))


def conditional_means(df: DataFrame, value: str, y: str) -> DataFrame:
    return df.agg(
        F.avg(value).alias("overall_mean"),
        F.avg(F.when(F.col(y) == 1, F.col(value))).alias("on_anomalies"),
        F.avg(F.when(F.col(y) == 0, F.col(value))).alias("on_normal"),
    )


def class_weight(df: DataFrame, y: str) -> DataFrame:
    """Negatives per positive, the training weight of the positive class."""
    return df.agg(F.try_divide(F.count_if(F.col(y) == 0), F.count_if(F.col(y) == 1)).alias("pos_weight"))


def table_profile(df: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Rows, nulls over all columns, distinct keys and the label's rate, in one pass."""
    nulls = F.lit(0).cast("long")
    for c in df.columns:
        nulls = nulls + F.count_if(F.col(c).isNull())
    fields = [F.count("*").alias("n_rows"), nulls.alias("total_nulls"), F.countDistinct(key).alias("n_keys")]
    if label:
        fields.append(F.avg(F.col(label).cast("double")).alias("label_rate"))
    return df.agg(*fields)


def driver_ranking(df: DataFrame, contributions: str, names: Sequence[str]) -> DataFrame:
    """Mean size of each feature's contribution over all rows."""
    labels = F.array(*[F.lit(n) for n in names])
    return (
        df.select(F.posexplode(contributions).alias("_at", "_value"))
        .groupBy(F.get(labels, F.col("_at")).alias("feature"))
        .agg(F.avg(F.abs("_value")).alias("mean_abs"))
    )
