"""Incidents, truth windows and labelled injections on metric tables."""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import fixed_values as V
from tidewatch.operators.ordered import MAX_GROUP_ROWS, over_rows_then_sums
from tidewatch.session import stored

BROADCAST_ROWS = 10_000


def seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def mark_incidents(
    anomalies: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str] = (),
    gap_seconds: int = V.INCIDENT_GAP_SECONDS,
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Adds ``opens`` (1 for the first row of an incident) and ``incident_no`` per key. A row opens
    an incident if it is the first of its key or comes more than the gap after the previous one."""

    def compute(frame, window):
        previous = F.lag(ts).over(window)
        fresh = previous.isNull() | (F.col(ts) - previous > seconds(gap_seconds))
        return frame.withColumn("opens", F.when(fresh, 1).otherwise(0))

    return over_rows_then_sums(
        anomalies, [key], [ts, *tie], 1, compute, {"incident_no": F.col("opens")}, limit, group_rows
    )


def incidents(marked: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per incident; partial aggregation keeps a long incident off a single task."""
    return marked.groupBy(key, "incident_no").agg(
        F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count("*").alias("n_rows")
    )


def incident_counts(marked: DataFrame, *keys: str) -> DataFrame:
    return marked.groupBy(*keys).agg(
        F.count("*").alias("anomalous_rows"),
        F.sum("opens").alias("incidents_opened"),
        F.sum(1 - F.col("opens")).alias("rows_continued"),
    )


# --- interval matching ---------------------------------------------------------------------------


def epoch_micros(df: DataFrame, ts: str) -> Column:
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))
    return F.unix_micros(F.col(ts))


def interval_pairs(
    rows: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    low: str,
    high: str,
    cell: int,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Pairs of equal ``key`` with ``low <= at <= high``; all three are whole numbers.

    A counted, small ``spans`` is broadcast. A large one is joined on (key, cell): each span is
    listed in the cells it touches, so no task pairs a key's rows with all of its spans.
    """
    spans = spans.withColumnRenamed(key, "_k")
    inside = (rows[key] == F.col("_k")) & (F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))
    if spans.count() <= broadcast_rows:
        return rows.join(F.broadcast(spans), inside).drop("_k")
    touched = F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))
    listed = spans.withColumn("_span_cell", F.explode(touched))
    placed = rows.withColumn("_cell", F.floor(F.col(at) / cell))
    return placed.join(listed, (F.col("_cell") == F.col("_span_cell")) & inside).drop(
        "_k", "_cell", "_span_cell"
    )


def match_windows(
    rows: DataFrame,
    windows: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    tolerance: int = V.WINDOW_TOLERANCE_SECONDS,
    start: str = "start_ts",
    end: str = "end_ts",
    rank: str = "window_no",
    broadcast_rows: int = BROADCAST_ROWS,
    cell_seconds: int = 3600,
) -> DataFrame:
    """``(row_id, window_no)`` of the first window, by ``window_no``, whose interval, padded by the
    tolerance on both sides and closed, holds the row's time. Other rows are left out, and a row meets at most one
    piece of the windows, so what the join returns never exceeds the rows, however many windows overlap."""
    pad = tolerance * 1_000_000
    spans = windows.select(
        F.col(key).alias("_k"),
        F.col(rank),
        (epoch_micros(windows, start) - pad).alias("_low"),
        (epoch_micros(windows, end) + pad).alias("_high"),
    ).filter(f"_k IS NOT NULL AND _low <= _high AND `{rank}` IS NOT NULL")
    timed = rows.select(F.col(row_id), F.col(key).alias("_k"), epoch_micros(rows, ts).alias("_at"))
    if windows.count() <= broadcast_rows:
        pieces = first_pieces(spans, ["_k"], rank).withColumnRenamed("_k", "_key")
        held = (F.col("_k") == F.col("_key")) & (F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high"))
        return timed.join(F.broadcast(pieces), held).select(row_id, rank)
    cell = cell_length(spans, cell_seconds * 1_000_000)
    pieces = first_pieces(_clipped(spans, cell), ["_k", "_cell"], rank)
    # in time order within a cell, a row meets the last piece that begins at or before it
    placed = timed.filter("_k IS NOT NULL AND _at IS NOT NULL").withColumn("_cell", F.floor(F.col("_at") / cell))
    piece = F.struct("_high", rank)
    none = F.lit(None).cast(pieces.select(piece.alias("p")).schema["p"].dataType)
    begins = pieces.select("_k", "_cell", F.col("_low").alias("_at"), F.lit(0).alias("_kind"), piece.alias("_piece"), F.lit(None).cast(timed.schema[row_id].dataType).alias(row_id))
    asked = placed.select("_k", "_cell", "_at", F.lit(1).alias("_kind"), none.alias("_piece"), F.col(row_id))
    upto = Window.partitionBy("_k", "_cell").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = begins.unionByName(asked).withColumn("_piece", F.last("_piece", True).over(upto))
    return met.filter("_kind = 1 AND _piece._high >= _at").select(row_id, F.col("_piece")[rank].alias(rank))


def cell_length(spans: DataFrame, least: int) -> int:
    """A cell so long that the spans ``_low.._high`` touch at most about two cells each on average, however long one is."""
    mean = spans.agg(F.avg(F.col("_high") - F.col("_low"))).first()[0]
    return max(least, math.ceil(mean or 0))


def _clipped(spans: DataFrame, cell: int) -> DataFrame:
    """``spans`` cut at the borders of cells, each piece with the number of its ``_cell``."""
    touched = F.sequence(F.floor(F.col("_low") / cell), F.floor(F.col("_high") / cell))
    begins = F.col("_cell") * cell
    return spans.withColumn("_cell", F.explode(touched)).withColumns(
        {"_low": F.greatest("_low", begins), "_high": F.least("_high", begins + cell - 1)}
    )


def first_pieces(spans: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """Disjoint pieces ``_low.._high`` of each group's spans, each with the smallest ``rank`` among the spans that hold
    it: a sweep over a group's window bounds, so a group is as large as the windows of one key and cell."""
    slim = spans.select(*keys, "_low", "_high", rank)

    def sweep(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("_low", kind="stable")
        low, high, ranks = (ordered[c].tolist() for c in ("_low", "_high", rank))
        bounds = sorted({*low, *(h + 1 for h in high)})
        held, out, nxt = [], [], 0
        for begin, stop in zip(bounds, bounds[1:]):
            while nxt < len(low) and low[nxt] <= begin:
                heapq.heappush(held, (ranks[nxt], high[nxt]))
                nxt += 1
            while held and held[0][1] < begin:
                heapq.heappop(held)
            if held and out and out[-1][2] == held[0][0] and out[-1][1] == begin - 1:
                out[-1][1] = stop - 1
            elif held:
                out.append([begin, stop - 1, held[0][0]])
        pieces = pd.DataFrame(out, columns=["_low", "_high", rank])
        return pieces.assign(**{k: group[k].iloc[0] for k in keys})[[*keys, "_low", "_high", rank]]

    return slim.groupBy(*keys).applyInPandas(sweep, slim.schema)


def _merged(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans ``_low.._high`` of each group with overlapping ones joined into one."""
    order = Window.partitionBy(*keys).orderBy("_low", "_high")
    reach = F.max("_high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("_low") > reach), 1).otherwise(0)
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = spans.withColumn("_fresh", fresh).withColumn("_block", F.sum("_fresh").over(running))
    return numbered.groupBy(*keys, "_block").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high")).drop("_block")


def label_by_windows(
    rows: DataFrame,
    windows: DataFrame,
    key: str,
    ts: str,
    name: str = "is_anomaly",
    start: str = "start_ts",
    end: str = "end_ts",
    broadcast_rows: int = BROADCAST_ROWS,
    cell_micros: int = 3_600_000_000,
) -> DataFrame:
    """1 for rows inside any window, bounds included, else 0.

    Merged windows hold a row at most once, so one outer join does it and the rows are neither
    aggregated nor, with few windows, shuffled. Many windows are cut at time cells and merged within
    (key, cell), so that the windows of a hot key are never in one group.
    """
    spans = windows.select(key, epoch_micros(windows, start).alias("_low"), epoch_micros(windows, end).alias("_high"))
    spans = spans.filter("_low <= _high")
    timed = rows.withColumn("_at", epoch_micros(rows, ts))
    inside = (F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high"))
    if windows.count() <= broadcast_rows:
        merged = _merged(spans, [key]).withColumnRenamed(key, "_k")
        held = timed.join(F.broadcast(merged), (timed[key] == F.col("_k")) & inside, "left")
    else:
        cell = cell_length(spans, cell_micros)
        merged = _merged(_clipped(spans.distinct(), cell), [key, "_cell"]).withColumnsRenamed({key: "_k", "_cell": "_span_cell"})
        placed = timed.withColumn("_cell", F.floor(F.col("_at") / cell))
        same = (placed[key] == F.col("_k")) & (F.col("_cell") == F.col("_span_cell"))
        held = placed.join(merged, same & inside, "left").drop("_cell", "_span_cell")
    labelled = held.withColumn(name, F.when(F.col("_low").isNotNull(), 1).otherwise(0))
    return labelled.drop("_k", "_at", "_low", "_high")


def window_recall(
    rows: DataFrame, windows: DataFrame, key: str, ts: str, row_id: str, tolerance: int = V.WINDOW_TOLERANCE_SECONDS, **options
) -> DataFrame:
    """Detections, windows, detections inside a padded window, distinct windows hit and their share."""
    hits = match_windows(rows, windows, key, ts, row_id, tolerance, **options).agg(
        F.count("*").alias("matched"), F.countDistinct("window_no").alias("recalled")
    )
    detections = rows.agg(F.count("*")).scalar()
    total = windows.agg(F.count("*")).scalar()
    return hits.select(
        detections.alias("total_detections"),
        total.alias("total_windows"),
        F.col("matched").alias("detections_matched"),
        F.col("recalled").alias("windows_recalled"),
        F.coalesce(F.round(F.try_divide(100.0 * F.col("recalled"), total), 2), F.lit(0.0)).alias("recall_pct"),
    )


# --- labelled injection --------------------------------------------------------------------------


def inject(
    rows: DataFrame,
    windows: DataFrame,
    key: str,
    index: str,
    spike: Sequence[str],
    drift: Sequence[str],
    flat: Sequence[str],
    spike_size: float = 5.0,
    drift_size: float = 4.0,
    broadcast_rows: int = BROADCAST_ROWS,
    cell_rows: int = 1000,
) -> DataFrame:
    """Adds labelled anomalies to real metrics; ``is_anomaly`` marks the rows touched.

    ``windows`` holds ``(key, kind, start_idx, end_idx, window_no)`` over the position ``index`` of
    a row in its key, the end exclusive. A spike adds a Hann bump of ``spike_size`` deviations, a
    drift a ramp that ends ``drift_size`` deviations (of the first drift column) up, a flatline
    repeats the value at the window's start. Overlapping spikes and drifts add up; of overlapping
    flatlines the last one counts. Deviations are population ones, per key, of the metrics as given.
    """
    spans = windows.select(
        key, "kind", "start_idx", "end_idx", "window_no", (F.col("end_idx") - 1).alias("_last")
    )
    step = F.col(index) - F.col("start_idx")
    whole = F.nullif(F.col("_last") - F.col("start_idx"), F.lit(0))
    hann = F.coalesce(0.5 - 0.5 * F.cos(2 * F.pi() * step / whole), F.lit(1.0))
    ramp = F.coalesce(step / whole, F.lit(0.0))
    pairs = interval_pairs(
        rows.select(key, index), spans, key, index, "start_idx", "_last", cell_rows, broadcast_rows
    )
    effects = pairs.groupBy(key, index).agg(
        F.sum(F.when(F.col("kind") == "spike", hann)).alias("_bump"),
        F.sum(F.when(F.col("kind") == "slow_drift", ramp)).alias("_ramp"),
        F.max(F.when(F.col("kind") == "flatline", F.struct("window_no", "start_idx"))).alias("_flat"),
        F.lit(1).alias("_hit"),
    )
    # only rows in a window, read for their starts, for flatlines and for the rest
    effects = stored(effects, "effects")
    starts = (
        rows.join(
            effects.select(key, F.col("_flat.start_idx").alias(index)).filter(F.col(index).isNotNull()).distinct(),
            [key, index],
            "left_semi",
        )
        .select(key, F.col(index).alias("_start"), *[F.col(c).alias(f"_first_{c}") for c in flat])
    )
    sigma = rows.groupBy(key).agg(*[F.stddev_pop(c).alias(f"_sd_{c}") for c in sorted({*spike, *drift})])
    if rows.select(key).distinct().count() <= broadcast_rows:
        sigma = F.broadcast(sigma)
    # rows outside a flatline have no start: kept out of the join on it, they can not gather in one task
    level = effects.filter("_flat IS NOT NULL").withColumn("_start", F.col("_flat.start_idx"))
    effects = level.join(starts, [key, "_start"], "left").unionByName(
        effects.filter("_flat IS NULL"), allowMissingColumns=True
    )
    joined = rows.join(effects, [key, index], "left").join(sigma, key, "left")
    values = {}
    for c in sorted({*spike, *drift, *flat}):
        value = F.col(c)
        if c in spike:
            value = value + F.coalesce(spike_size * F.col(f"_sd_{c}") * F.col("_bump"), F.lit(0.0))
        if c in drift:
            value = value + F.coalesce(drift_size * F.col(f"_sd_{drift[0]}") * F.col("_ramp"), F.lit(0.0))
        if c in flat:
            value = F.when(F.col("_start").isNotNull(), F.col(f"_first_{c}")).otherwise(value)
        values[c] = value
    values["is_anomaly"] = F.coalesce("_hit", F.lit(0))
    return joined.withColumns(values).select(*rows.columns, "is_anomaly")


# --- message text --------------------------------------------------------------------------------


def wait_hint_seconds(message: Column, fallback: float) -> Column:
    """Seconds named by ``try again in 3m4.5s`` or ``try again in 4.5s``, else the fallback."""
    pattern = r"try again in (?:(\d+)m)?([\d.]+)s"
    minutes = F.nullif(F.regexp_extract(message, pattern, 1), F.lit("")).try_cast("double")
    secs = F.nullif(F.regexp_extract(message, pattern, 2), F.lit("")).try_cast("double")
    return F.coalesce(F.coalesce(minutes, F.lit(0.0)) * 60 + secs, F.lit(float(fallback)))


def anomaly_text(service: Column, ts: Column, votes: Column) -> Column:
    """Sentence that names the service, the time and each model's vote."""
    said = F.transform(
        votes,
        lambda v: F.format_string(
            "%s score=%s (threshold=%s, flagged=%s)",
            v["model_name"],
            F.format_string("%.4f", v["score"]),
            F.format_string("%.4f", v["threshold"]),
            F.when(v["is_anomaly"], "True").otherwise("False"),
        ),
    )
    return F.concat(
        F.lit("Anomaly detected on service '"), service, F.lit("' at "), ts,
        F.lit(". Model votes: "), F.concat_ws("; ", said), F.lit("."),
    )
