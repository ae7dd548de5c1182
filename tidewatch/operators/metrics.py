"""Rolling features and global orderings of metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import fixed_values as V
from tidewatch.operators.ordered import (
    MAX_GROUP_ROWS,
    exact_quantiles,
    fits,
    global_index,
    over_rows,
    with_row_index,
)


class Rolled(NamedTuple):
    """A metric with the names of its rolling statistics and of its z-score."""

    column: str
    roll: str
    z: str


TELEMETRY_ROLLED = [
    Rolled("cpu_pct", "cpu", "cpu"),
    Rolled("memory_pct", "mem", "mem"),
    Rolled("latency_p95_ms", "lat_p95", "latency"),
    Rolled("error_rate_pct", "err", "error"),
    Rolled("queue_depth", "queue", "queue"),
    Rolled("thread_count", "thread", "thread"),
]
TELEMETRY_DELTAS = {
    "cpu_pct": ("cpu_prev", "cpu_rate_of_change"),
    "latency_p95_ms": ("lat_prev", "latency_rate_of_change"),
    "memory_pct": ("mem_prev", "memory_rate_of_change"),
}
TELEMETRY_RATIOS = {
    "latency_per_cpu_ratio": ("latency_p95_ms", "cpu_pct"),
    "queue_per_thread_ratio": ("queue_depth", "thread_count"),
}
MODEL_INPUTS = [
    "cpu_pct", "memory_pct", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms",
    "error_rate_pct", "queue_depth", "thread_count",
    "cpu_zscore", "mem_zscore", "latency_zscore", "error_zscore", "queue_zscore", "thread_zscore",
    "cpu_rate_of_change", "latency_rate_of_change", "memory_rate_of_change",
    "latency_per_cpu_ratio", "queue_per_thread_ratio",
]


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def rolling_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rolled: Sequence[Rolled],
    deltas: Mapping[str, tuple[str, str]] | None = None,
    ratios: Mapping[str, tuple[str, str]] | None = None,
    before: int = V.ROLLING_ROWS_BEFORE,
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Mean, sample deviation and z-score over the current row and ``before`` earlier ones, change
    from the previous row, and cross-metric ratios. One shuffle and one sort for all of them."""
    deltas = deltas or {}
    ratios = ratios or {}

    def compute(frame, window):
        frame_rows = window.rowsBetween(-before, 0)
        stats = {}
        for m in rolled:
            stats[f"{m.roll}_roll_mean"] = F.avg(m.column).over(frame_rows)
            stats[f"{m.roll}_roll_std"] = F.stddev_samp(m.column).over(frame_rows)
        for column, (previous, _) in deltas.items():
            stats[previous] = F.lag(column).over(window)
        return frame.withColumns(stats)

    done = over_rows(df, keys, order, max(before, 1), compute, limit, group_rows)
    derived = {
        f"{m.z}_zscore": ratio(
            F.col(m.column) - F.col(f"{m.roll}_roll_mean"), F.col(f"{m.roll}_roll_std")
        )
        for m in rolled
    }
    derived |= {change: F.col(c) - F.col(previous) for c, (previous, change) in deltas.items()}
    derived |= {name: ratio(F.col(a), F.col(b)) for name, (a, b) in ratios.items()}
    return done.withColumns(derived)


def telemetry_features(df: DataFrame, keys: Sequence[str] = ("service_name",), **options) -> DataFrame:
    """The full feature table of a telemetry table, gaps filled."""
    featured = rolling_features(
        df, list(keys), ["timestamp"], TELEMETRY_ROLLED, TELEMETRY_DELTAS, TELEMETRY_RATIOS, **options
    )
    return fill_gaps(featured)


def fill_gaps(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null, NaN and infinite numbers become 0."""
    names = columns or [
        f.name for f in df.schema if f.dataType.typeName() in ("double", "float", "integer", "long", "short")
    ]
    types = {f.name: f.dataType.typeName() for f in df.schema}
    cleaned = {}
    for name in names:
        value = F.col(name)
        if types[name] in ("double", "float"):
            bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
            value = F.when(bad, F.lit(0.0)).otherwise(value)
        cleaned[name] = F.coalesce(value, F.lit(0).cast(types[name] if types[name] != "integer" else "int"))
    return df.withColumns(cleaned)


def batch_local_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rolled: Sequence[Rolled],
    batch_rows: int = V.REPLAY_BATCH_ROWS,
    limit: int = MAX_GROUP_ROWS,
    table_rows: int | None = None,
    **options,
) -> DataFrame:
    """Rolling features that restart with every replay batch of ``batch_rows`` rows in time order."""
    batched = replay_batches(df, order, batch_rows, limit, table_rows)
    # a group is at most one batch
    return rolling_features(
        batched, ["batch_id", *keys], order, rolled, limit=limit, group_rows=batch_rows, **options
    )


def replay_batches(
    df: DataFrame,
    order: Sequence[str],
    batch_rows: int = V.REPLAY_BATCH_ROWS,
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    indexed = global_index(df, order, "row_index", limit, group_rows)
    return indexed.withColumn("batch_id", F.floor(F.col("row_index") / batch_rows).cast("long")).drop("row_index")


def first_rows(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first ``rows`` rows in time order (a replay that stops early): a distributed top-k."""
    return df.orderBy(*order).limit(rows)


def ntile(
    df: DataFrame,
    order: Sequence[Column],
    buckets: int,
    name: str,
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Equal-count buckets over the whole table, the first ones one row larger when uneven."""
    if fits(df, [], limit, group_rows):
        return df.withColumn(name, F.ntile(buckets).over(Window.orderBy(*order)))
    small, larger = divmod(df.count(), buckets)
    indexed = with_row_index(df, order, "_i")
    edge = larger * (small + 1)
    bucket = F.when(F.col("_i") < edge, F.floor(F.col("_i") / (small + 1))).otherwise(
        larger + F.floor((F.col("_i") - edge) / max(small, 1))
    )
    return indexed.withColumn(name, (bucket + 1).cast("int")).drop("_i")


def account_features(
    df: DataFrame, limit: int = MAX_GROUP_ROWS, tie: str = "account_id", group_rows: int | None = None
) -> DataFrame:
    """Revenue quartile (1 = largest), threshold flags and monthly sessions of an account table."""
    ranked = ntile(df, [F.col("arr").desc(), F.col(tie)], 4, "arr_quartile", limit, group_rows)
    return ranked.withColumns(
        {
            "high_discount_flag": F.when(F.col("discount_pct") > 0.2, 1).otherwise(0),
            "low_utilization_flag": F.when(F.col("seat_utilization_pct") < 0.5, 1).otherwise(0),
            "estimated_monthly_sessions": F.col("weekly_active_sessions") * 4,
        }
    ).drop("discount_pct", "nps")


def table_stats(df: DataFrame, columns: Mapping[str, Sequence[str]]) -> Column:
    """One struct of statistics as a scalar subquery: ``{column: ["avg", "min", …]}``.

    The subquery runs once and its single row is put into the plan; no join, no global window.
    """
    apply = {
        "avg": F.avg, "min": F.min, "max": F.max,
        "std": F.stddev_samp, "std_pop": F.stddev_pop, "sum": F.sum,
    }
    fields = [apply[s](c).alias(f"{c}_{s}") for c, stats in columns.items() for s in stats]
    return df.agg(F.struct(*fields).alias("stats")).scalar()


def corpus_zscore(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``{column: new name}``: z-scores by the sample deviation of the table, 0 if there is none."""
    stats = table_stats(df, {c: ["avg", "std"] for c in columns})
    return df.withColumns(
        {
            name: F.when(
                stats.getField(f"{c}_std") > 0,
                (F.col(c) - stats.getField(f"{c}_avg")) / stats.getField(f"{c}_std"),
            ).otherwise(0.0)
            for c, name in columns.items()
        }
    )


def min_max(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``{column: new name}`` scaled to [0, 1]; a constant column becomes 0."""
    stats = table_stats(df, {c: ["min", "max"] for c in columns})
    scaled = {}
    for c, name in columns.items():
        low, high = stats.getField(f"{c}_min"), stats.getField(f"{c}_max")
        scaled[name] = F.when(high == low, F.lit(0.0)).otherwise((F.col(c) - low) / F.nullif(high - low, F.lit(0)))
    return df.withColumns(scaled)


def standard_scaled(df: DataFrame, fit_on: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Population scaling fitted on ``fit_on`` and applied to ``df``; constant columns keep scale 1."""
    stats = table_stats(fit_on, {c: ["avg", "std_pop"] for c in columns})
    scaled = {}
    for c, name in columns.items():
        std = stats.getField(f"{c}_std_pop")
        scaled[name] = (F.col(c) - stats.getField(f"{c}_avg")) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumns(scaled)


def standard_scaled_array(df: DataFrame, fit_on: DataFrame, column: str, name: str) -> DataFrame:
    """As ``standard_scaled`` for an array column of any width; entries the fit never saw stay as they are."""
    entries = fit_on.select(F.posexplode(F.col(column).cast("array<double>")).alias("pos", "x"))
    stats = entries.groupBy("pos").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    # one entry per position of the array, in order
    fitted = stats.agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "std")))).scalar()
    scaled = F.transform(
        F.col(column).cast("array<double>"),
        lambda x, i: (x - F.coalesce(F.get(F.col("_fitted"), i)["mean"], F.lit(0.0)))
        / F.coalesce(F.nullif(F.get(F.col("_fitted"), i)["std"], F.lit(0.0)), F.lit(1.0)),
    )
    return df.withColumn("_fitted", fitted).withColumn(name, scaled).drop("_fitted")


def top_share_cutoff(
    df: DataFrame, column: str, share: float = 0.9, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> Column:
    """Linear-interpolated quantile of the table as a scalar subquery."""
    return exact_quantiles(df, [], column, [share], limit, group_rows).scalar()


# --- schema-driven projections -------------------------------------------------------------------


def resolve_target(df: DataFrame, word: str = "churn", name: str = "churn_label") -> DataFrame:
    """The first column whose name contains ``word`` becomes ``name``."""
    found = next((c for c in df.columns if word in c.lower()), None)
    if found is None:
        raise KeyError(f"no column contains {word!r}")
    return df.withColumnRenamed(found, name)


def attach_target(df: DataFrame, raw: DataFrame, key: str, word: str = "churn", name: str = "churn_label") -> DataFrame:
    """Target from the table itself, else from ``raw`` by an inner join on ``key``."""
    if any(word in c.lower() for c in df.columns):
        return resolve_target(df, word, name)
    found = resolve_target(raw, word, name)
    return df.join(found.select(key, name), key, "inner")


def numeric_view(df: DataFrame, drop: Sequence[str] = (), word: str = "churn") -> DataFrame:
    """Numeric columns only, without ids and without anything that names the target."""
    numeric = ("double", "float", "integer", "long", "short", "byte", "decimal")
    keep = [
        f.name for f in df.schema
        if f.name not in drop and word not in f.name.lower()
        and f.dataType.typeName().split("(")[0] in numeric
    ]
    return df.select(*keep)


def model_order(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)
