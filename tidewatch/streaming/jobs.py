"""Stream jobs: replay, rolling features, incidents, actions, approvals, trace ingest, late rows.

A job runs over what is there (``availableNow``) and may be started again on the same folder: it goes on with its state. Results are
appended to a table, a part per micro-batch; late rows lie in ``late`` in the job's folder unless another place is named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.functions import fixed_values as V
from tidewatch.operators import decisions as D
from tidewatch.operators import incidents as I
from tidewatch.operators import metrics as M
from tidewatch.operators import rollup as R
from tidewatch.operators.ordered import MAX_GROUP_ROWS
from tidewatch.session import new_table_path
from tidewatch.sources import writers
from tidewatch.streaming.state import DELAY_SECONDS, Kept, in_event_order, micros, put, run_batches

# --- replay --------------------------------------------------------------------------------------


def replay(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A stored parquet table as a stream, a few files per micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> str:
    """Runs the stream over what is there, into a new parquet table; the path of that table."""
    spark = stream.sparkSession
    path, progress = new_table_path(spark, name), new_table_path(spark, f"{name}-progress")
    query = (
        stream.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return path


# --- rolling features ----------------------------------------------------------------------------


def rolling_job(
    stream: DataFrame, key: str, ts: str, row_id: str, metrics: Sequence[str], out: str, folder: str,
    before: int = V.ROLLING_ROWS_BEFORE, delay_seconds: int = DELAY_SECONDS, limit: int = MAX_GROUP_ROWS,
) -> None:
    """Rolling mean, sample deviation, z-score and change of each metric into the table ``out``. The last ``before`` rows
    per key are carried from batch to batch, so windows do not break at their edges."""
    names = [key, ts, row_id, *metrics]
    tail = Kept(f"{folder}/tail", StructType([stream.schema[n] for n in names]))
    rolled = [M.Rolled(m, m, m) for m in metrics]

    def each(due: DataFrame, batch_id: int) -> None:
        old = tail.before(due.sparkSession, batch_id).withColumn("_new", F.lit(False))
        both = due.select(*names).withColumn("_new", F.lit(True)).unionByName(old)
        done = M.rolling_features(both, [key], [ts, row_id], rolled, {m: (f"{m}_previous", f"{m}_change") for m in metrics}, before=before, limit=limit)
        made = [f"{m}_{n}" for m in metrics for n in ("roll_mean", "roll_std", "zscore", "change")]
        put(done.filter("_new").select(key, ts, row_id, *made), out, batch_id)
        # of a hot key each task keeps its last rows before they are shuffled
        newest = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts), F.desc(row_id)))
        tail.leave(both.withColumn("_rank", newest).filter(F.col("_rank") <= before).select(*names), batch_id)

    in_event_order(stream, ts, folder, each, delay_seconds=delay_seconds)


# --- incidents -----------------------------------------------------------------------------------


def incident_job(
    anomalies: DataFrame, key: str, ts: str, row_id: str, out: str, folder: str, gap_seconds: int = V.INCIDENT_GAP_SECONDS,
    delay_seconds: int = DELAY_SECONDS, actions: str | None = None, limit: int = MAX_GROUP_ROWS,
) -> None:
    """Anomalous rows with ``opens`` and ``incident_no`` into the table ``out``. Per key the last row and its incident's
    number are carried on. With ``actions``, a table that gets one row per opened incident, however often a batch or the job is run."""
    names = [key, ts, row_id]
    schema = StructType([anomalies.schema[n] for n in names]).add("_number", "long")
    last = Kept(f"{folder}/last", schema)

    def each(due: DataFrame, batch_id: int) -> None:
        old = last.before(due.sparkSession, batch_id)
        both = due.select(*names).withColumn("_new", F.lit(True)).unionByName(old.select(*names, F.lit(False).alias("_new")))
        marked = I.mark_incidents(both, key, ts, [row_id], gap_seconds, limit)
        # the carried row counts as the first incident of its key here; one row per key
        numbers = old.select(F.col(key).alias("_key"), "_number")
        marked = marked.join(numbers, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
        number = F.col("incident_no") + F.coalesce(F.col("_number") - 1, F.lit(0))
        marked = marked.withColumn("incident_no", number.cast("long")).select(*names, "_new", F.col("opens").cast("int").alias("opens"), "incident_no")
        put(marked.filter("_new").drop("_new"), out, batch_id)
        newest = marked.groupBy(key).agg(F.max(F.struct(ts, row_id, "incident_no")).alias("_l"))
        last.leave(newest.select(key, f"_l.{ts}", f"_l.{row_id}", F.col("_l.incident_no").alias("_number")), batch_id)
        if actions:
            opened = due.sparkSession.read.parquet(f"{out}/batch={batch_id}").filter("opens = 1")
            named = opened.withColumn("incident_id", D.incident_id(F.concat_ws(":", key, "incident_no")))
            writers.append_new(named, actions, "incident_id")

    in_event_order(anomalies, ts, folder, each, delay_seconds=delay_seconds)


def closed_incidents(anomalies: DataFrame, key: str, ts: str, gap_seconds: int = V.INCIDENT_GAP_SECONDS, delay: str = f"{DELAY_SECONDS} seconds") -> DataFrame:
    """One row per incident, once the watermark has passed its end; no Python."""
    session = F.session_window(ts, f"{gap_seconds} seconds")
    return (
        # watermarks need a zoned timestamp
        anomalies.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .groupBy(key, session.alias("_s"))
        .agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count("*").alias("n_rows"))
        .drop("_s")
    )


# --- approvals -----------------------------------------------------------------------------------


def approval_job(
    events: DataFrame, key: str, ts: str, tie: Sequence[str], out: str, folder: str, expire_seconds: int | None = None,
    delay_seconds: int = DELAY_SECONDS,
) -> None:
    """Requests wait for their first decision and complete once; each event with its status into the table ``out``.

    ``events`` is the union of requests (``approved`` null) and decisions. A request is ``pending_human_approval``, or, when it
    is repeated, whatever its thread is by then; the decision that completes a thread is ``approved`` or ``rejected``, any
    other one ``unknown_thread`` or ``inactive_thread``. With ``expire_seconds`` a decision that comes later than that
    after the request is refused as inactive, too. Of the same instant, a request comes first; of equal events, the first completes.

    A thread's state is when it was asked for and what completed it: both are the least of its events in event order, so
    a batch needs no ordered pass and a thread may have any number of events.
    """
    order = StructType([StructField("at", LongType()), *[events.schema[c] for c in tie]])
    threads = Kept(f"{folder}/threads", StructType([events.schema[key]]).add("since", "long").add("done", order).add("final", "string"))

    def each(due: DataFrame, batch_id: int) -> None:
        due, at = due.filter(F.col(key).isNotNull()), micros(ts)
        order_of = F.struct(at.alias("at"), *tie)
        old = threads.before(due.sparkSession, batch_id)
        asked = due.filter(F.col("approved").isNull()).groupBy(key).agg(F.min(at).alias("_asked"))
        known = old.join(asked, key, "full").select(key, F.coalesce("since", "_asked").alias("since"), "done", "final")
        # copies of an event change no state
        told = due.filter(F.col("approved").isNotNull()).join(known, key)
        known_by = F.col("since").isNotNull() & (at >= F.col("since"))
        in_time = F.lit(True) if expire_seconds is None else at - F.col("since") <= expire_seconds * 1_000_000
        completes = F.col("done").isNull() & known_by & in_time
        # equal in order, an approval and a rejection: the rejection
        first = told.filter(completes).groupBy(key).agg(F.min(F.struct(order_of.alias("_order"), "approved")).alias("_first"))
        state = known.join(first, key, "left").select(
            key, "since", F.coalesce("done", "_first._order").alias("done"),
            F.coalesce("final", F.when(F.col("_first.approved"), "approved").when(~F.col("_first.approved"), "rejected")).alias("final"),
        )
        # worked out once: the events are judged by what was left
        threads.leave(state, batch_id)
        # equal events once, with their number; only their own columns are moved
        rows = due.groupBy(key, ts, "approved", *tie).agg(F.count("*").alias("_n"))
        judged = rows.join(threads.left(due.sparkSession, batch_id), key, "left")
        # events of earlier batches lie before all of this one, so an event equal to the completing one is of this batch
        is_first = order_of.eqNullSafe(F.col("done")) & (F.when(F.col("approved"), "approved").otherwise("rejected") == F.col("final"))
        status = (
            F.when(F.col("approved").isNull(), F.when(F.col("done.at") < at, F.col("final")).otherwise("pending_human_approval"))
            .when(~known_by, "unknown_thread").when(is_first, F.col("final")).otherwise("inactive_thread")
        )
        rest = F.when(is_first & F.col("approved").isNotNull(), F.lit("inactive_thread")).otherwise(status)
        copies = F.transform(F.sequence(F.lit(1).cast("long"), F.col("_n")), lambda i: F.when(i == 1, F.col("_status")).otherwise(F.col("_rest")))
        out_rows = judged.withColumn("_status", status).withColumn("_rest", rest).withColumn("status", F.explode(copies))
        put(out_rows.select(key, ts, *tie, "status"), out, batch_id)

    in_event_order(events, ts, folder, each, delay_seconds=delay_seconds)


# --- trace ingest and late rows ------------------------------------------------------------------


def trace_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(R.TRACE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def ingest_traces(traces: DataFrame, facts_path: str, rollup_path: str) -> None:
    """Trace documents to facts and daily rollup, micro-batch by micro-batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        writers.sync_traces(R.flatten_traces(batch), facts_path, rollup_path)

    run_batches(traces, new_table_path(traces.sparkSession, "ingest"), each)


def split_late(
    stream: DataFrame, keys: Sequence[str], ts: str, late_path: str, on_time_path: str, folder: str, delay_seconds: int = DELAY_SECONDS
) -> None:
    """Rows more than the delay behind the newest row that their key had in earlier micro-batches go to a side table, the
    others, also those without a time, to the main one. Per key the newest time is kept."""
    newest = Kept(f"{folder}/newest", StructType([stream.schema[k] for k in keys]).add("_newest", "long"))

    def each(batch: DataFrame, batch_id: int) -> None:
        old = newest.before(batch.sparkSession, batch_id)
        seen = old.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], "_newest")
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
        marked = batch.join(seen, same, "left").withColumn("is_late", F.coalesce(micros(ts) < F.col("_newest") - delay_seconds * 1_000_000, F.lit(False)))
        part = f"batch={batch_id}"
        writers.route(marked.select(*batch.columns, "is_late"), F.col("is_late"), f"{late_path}/{part}", f"{on_time_path}/{part}", mode="overwrite")
        every = batch.select(*keys, micros(ts).alias("_newest")).unionByName(old)
        newest.leave(every.groupBy(*keys).agg(F.max("_newest").alias("_newest")), batch_id)

    run_batches(stream, folder, each)
