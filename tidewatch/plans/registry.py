"""Collects the registered queries: name -> (Spark callable, check SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.operators.ordered import MAX_GROUP_ROWS, largest_group

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> int | None:
    """Upper bound on the groups of a table. A table that fits one task is bounded by the row count in
    its footers; of a larger one the key columns are counted, or, without keys, nothing is known."""
    rows = table(spark, sf_dir, name).count()
    if rows <= MAX_GROUP_ROWS:
        return rows
    return largest_group(table(spark, sf_dir, name), keys) if keys else None


#: Rows of a task whose work is heavy per row.
SPREAD_ROWS = 100_000


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """For work that is heavy per row: dealt out to all cores, and to more tasks where these would get more than ``rows`` each.
    A table of as many files is left as it is; file splits alone do not count, since a row group cannot be cut."""
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    cut = min(len(df.inputFiles()), df.rdd.getNumPartitions()) >= wanted
    return df if cut else df.repartition(wanted)


#: Rows of a task that passes over its rows many times.
PASS_ROWS = 50_000


def dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``rows`` rows by key in tasks of equal size, for work that passes over them many times: after a window the tasks are few and unequal.
    The order within a task is the key's, so that what is drawn from it can be drawn again. Rows of one task stay where they are."""
    if rows <= PASS_ROWS:
        return df
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PASS_ROWS))
    return df.repartition(tasks, key).sortWithinPartitions(key)
