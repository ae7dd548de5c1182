"""Insert-if-absent tables that a batch need not read whole.

Rows lie in folders by a hash of their key. Beside them lies a Bloom filter per folder, as words of 64 bits: a batch asks
the filters first and reads the keys of those folders only that may hold one of its own. The filters only ever say "maybe"
too often, so the result is exact however full they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.rollup import first_per_key
from tidewatch.session import stored
from tidewatch.sources.writers import existing

#: folders of a table; a table keeps the numbers that it began with
BUCKETS = 256
#: words of a folder's filter: at ten bits a key, 100,000 keys a folder are told apart to one in a hundred
WORDS = 1 << 14
HASHES = 5


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(buckets)).cast("int")


def _marks(rows: DataFrame, key: str, buckets: int, words: int) -> DataFrame:
    """A row per key and hash: the folder, the word of its filter and the bit in it."""
    spot = lambda i: F.xxhash64(F.lit(i), F.col(key))
    marks = F.array(*[
        F.struct(
            F.pmod(F.shiftright(spot(i), 6), F.lit(words)).cast("int").alias("word"),
            F.pmod(spot(i), F.lit(64)).cast("int").alias("place"),
        )
        for i in range(HASHES)
    ])
    rows = rows.select(F.col(key).alias("_key"), _bucket(key, buckets).alias("_bucket"), F.explode(marks).alias("m"))
    return rows.select("_key", "_bucket", "m.word", F.expr("shiftleft(1L, m.place)").alias("bits"))


def _filters(spark: SparkSession, path: str) -> DataFrame:
    like = spark.createDataFrame([], "_bucket int, word int, bits long")
    parts = existing(spark, f"{path}/filters", like)
    return parts.groupBy("_bucket", "word").agg(F.bit_or("bits").alias("bits"))


def maybe_held(batch: DataFrame, path: str, key: str, buckets: int = BUCKETS, words: int = WORDS) -> DataFrame:
    """Keys of the batch that the filters cannot rule out, with their folder."""
    asked = _marks(batch.select(key).distinct(), key, buckets, words)
    found = asked.join(_filters(batch.sparkSession, path).withColumnRenamed("bits", "_held"), ["_bucket", "word"])
    hit = found.filter(F.col("bits").bitwiseAND(F.col("_held")) != 0)
    return hit.groupBy("_key", "_bucket").agg(F.count("*").alias("_hits")).filter(F.col("_hits") == HASHES).drop("_hits")


def append_new(batch: DataFrame, path: str, key: str, *order: str, buckets: int = BUCKETS, words: int = WORDS) -> list[int]:
    """Rows of the batch whose key the table does not hold yet are appended, the first per key; returns the folders that
    had to be read. No key is a key of its own. Filters are written before rows, so a run that breaks off between the two
    leaves filters that say "maybe" too often, and a rerun adds what is missing. One batch at a time writes a table."""
    spark = batch.sparkSession
    first = stored(first_per_key(batch, key, *order), "batch")
    maybe = stored(maybe_held(first, path, key, buckets, words), "maybe")
    # at most a number per folder
    read = sorted(r[0] for r in maybe.select("_bucket").distinct().collect())
    new = first
    if read:
        rows = existing(spark, f"{path}/rows", first.withColumn("_bucket", F.lit(0)))
        held = rows.filter(F.col("_bucket").isin(read)).select(F.col(key).alias("_held"))
        known = maybe.join(held, F.col("_key").eqNullSafe(F.col("_held")), "left_semi")
        new = first.join(known, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    new = stored(new, "new")
    fresh = _marks(new, key, buckets, words).groupBy("_bucket", "word").agg(F.bit_or("bits").alias("bits"))
    fresh.write.mode("append").parquet(f"{path}/filters")
    placed = new.withColumn("_bucket", _bucket(key, buckets))
    # few files per folder
    rows = spark.sql("SELECT /*+ REBALANCE(`_bucket`) */ * FROM {placed}", placed=placed)
    rows.write.mode("append").partitionBy("_bucket").parquet(f"{path}/rows")
    return read


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows."""
    return spark.read.parquet(f"{path}/rows").drop("_bucket")
