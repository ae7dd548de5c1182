"""Writers and keyed table maintenance on parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import rollup as R


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> None:
    """Files sorted by (keys, order) and range-partitioned on them, so that a hot key spans files."""
    columns = [*keys, *order]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    ranged.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV that reads back as it was: quoted where needed, blanks kept."""
    (
        df.write.mode("overwrite").partitionBy(*partition_by)
        .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One CSV folder per split, read back with the split as a column."""
    write_csv(df, path, [split])


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or an empty one of the same schema before the first write."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def append_new(batch: DataFrame, path: str, key: str, *order: str, partition_by: Sequence[str] = ()) -> None:
    """Insert-if-absent: rows of the batch whose key the table does not hold are appended, the first
    per key. Stored rows are never changed, so a rerun adds nothing. Of the table only the key column
    is read."""
    new = R.new_rows(batch, existing(batch.sparkSession, path, batch), key, *order)
    if partition_by:
        # few files per folder; a hot folder is still written by several tasks
        columns = ", ".join(f"`{c}`" for c in partition_by)
        new = batch.sparkSession.sql(f"SELECT /*+ REBALANCE({columns}) */ * FROM {{new}}", new=new)
    new.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_dates(rollup: DataFrame, path: str, partition: str = "rollup_date") -> None:
    """Only the dates in ``rollup`` are overwritten."""
    (
        rollup.repartition(partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def sync_traces(flat: DataFrame, facts_path: str, rollup_path: str) -> None:
    """Flat traces to facts and to the rollup of the dates they touch.

    The rollup covers every date in the batch, also of rows that an earlier, broken-off run has
    already appended: recomputing a date from all its facts is repeatable. Facts are stored by date,
    so the rollup reads the touched dates' folders only.
    """
    good, _ = R.split_facts(flat)
    good = good.drop("timestamp_fallback").withColumn("event_date", R.event_date()).persist()
    try:
        append_new(good, facts_path, "prompt_id", "event_timestamp", partition_by=["event_date"])
        facts = flat.sparkSession.read.schema(good.schema).parquet(facts_path)
        # one value per calendar day
        days = [r[0] for r in good.select("event_date").distinct().collect()]
        if days:
            replace_dates(R.daily_rollup(facts.filter(F.col("event_date").isin(days))), rollup_path)
    finally:
        good.unpersist()


def append_audit(df: DataFrame, path: str, account: str, node: str, details: Sequence[str]) -> None:
    """Transitions with a JSON snapshot of the state."""
    df.select(
        F.col(account).alias("account_id"),
        F.lit(node).alias("transition_node"),
        F.to_json(F.struct(*details)).alias("state_snapshot"),
    ).write.mode("append").parquet(path)


def route(df: DataFrame, alarm: Column, alert_path: str, pass_path: str, mode: str = "append") -> None:
    """Rows where ``alarm`` holds go to the alert table, the others (also where it is null) to the
    pass-through table. The input is stored once and read twice."""
    kept = df.withColumn("_alarm", F.coalesce(alarm, F.lit(False))).persist()
    try:
        kept.filter("_alarm").drop("_alarm").write.mode(mode).parquet(alert_path)
        kept.filter("NOT _alarm").drop("_alarm").write.mode(mode).parquet(pass_path)
    finally:
        kept.unpersist()
