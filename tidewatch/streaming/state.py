"""Stream state as typed tables: what a micro-batch leaves for the next one.

A stateful operator of a stream puts all rows of a key into one task and drops rows behind the watermark. Here a micro-batch is
handled by DataFrame operators and leaves its state as a table in a folder of its own, by batch number: the next batch reads
it and writes another. A batch that runs again reads what it read before and replaces what it wrote, so state and output hold each
row once however often it fails; a key may hold any share of the rows, as in the batch operators.

``in_event_order`` keeps rows until the watermark (the newest time seen less the delay) passes them and then hands them on; what
comes at or behind a watermark that has already passed goes to a side table. No row is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DELAY_SECONDS = 600

# (released rows, batch id)
Step = Callable[[DataFrame, int], None]


def run_batches(stream: DataFrame, folder: str, each: Step) -> None:
    """Runs the stream over what is there, ``each(batch, batch_id)`` per micro-batch. ``folder`` holds its progress: a
    later run goes on where this one ended."""
    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()


class Kept:
    """A table that every micro-batch reads as the one before left it, and replaces."""

    def __init__(self, folder: str, schema: StructType | str):
        self.folder, self.schema = folder, schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return self.left(spark, batch_id - 1)

    def left(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self._path(batch_id))

    def leave(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._path(batch_id))
        # the batch may run again and then reads the one before; older ones are done with
        remove(df.sparkSession, self._path(batch_id - 2))

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/batch={batch_id}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table in any store that Spark reads; nothing if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def put(df: DataFrame, path: str, batch_id: int) -> None:
    """A micro-batch's part of an output table; run again, it replaces what it wrote."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def taken(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All parts of an output table."""
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{n}`") for n in schema.fieldNames()])


def micros(ts: str) -> Column:
    """Event time in microseconds since the epoch, of zoned and unzoned times."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def in_event_order(
    stream: DataFrame, ts: str, folder: str, each: Step, late_path: str | None = None, delay_seconds: int = DELAY_SECONDS
) -> None:
    """Runs the stream over what is there and hands ``each`` the rows that the watermark has passed, every row once and
    no row before an earlier one of a previous batch.

    Rows at or behind the watermark of the batches before, and rows without a time, go to ``late_path`` (by default
    ``late`` in ``folder``). Rows that still wait stay in ``folder`` for the next run."""
    late_path = late_path or f"{folder}/late"
    placed_schema = StructType(list(stream.schema.fields)).add("_place", "string")
    marks, edge = Kept(f"{folder}/mark", "newest long"), delay_seconds * 1_000_000

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = marks.before(spark, batch_id).agg(F.max("newest")).first()[0]
        newest = max([t for t in (seen, batch.agg(F.max(micros(ts))).first()[0]) if t is not None], default=None)
        at = micros(ts)
        behind = F.lit(False) if seen is None else at <= seen - edge
        passed = F.lit(False) if newest is None else at <= newest - edge
        own = batch.withColumn("_place", F.when(at.isNull() | behind, "late").when(passed, "due").otherwise("waiting"))
        if batch_id:
            held = spark.read.schema(placed_schema).parquet(f"{folder}/rows/batch={batch_id - 1}").filter("_place = 'waiting'")
            own = own.unionByName(held.withColumn("_place", F.when(passed, "due").otherwise("waiting")))
        # one pass over the batch; its three kinds of rows are read by folder
        here = f"{folder}/rows/batch={batch_id}"
        own.write.mode("overwrite").partitionBy("_place").parquet(here)
        rows = spark.read.schema(placed_schema).parquet(here)
        put(rows.filter("_place = 'late'").drop("_place"), late_path, batch_id)
        each(rows.filter("_place = 'due'").drop("_place"), batch_id)
        marks.leave(spark.createDataFrame([(newest,)], "newest long"), batch_id)
        remove(spark, f"{folder}/rows/batch={batch_id - 2}")

    run_batches(stream, folder, step)
