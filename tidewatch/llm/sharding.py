"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a key's hash. It starts as one bucket; a bucket over the byte limit is
split on the next bit, and only such buckets, until each fits. The sums that decide come from narrow (hash, bytes)
rows, ``STEP_BITS`` levels at a time, and below the first levels only of rows in buckets that are still too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import stored

LIMIT_BYTES = 32 << 20
HASH_BITS, STEP_BITS = 60, 10
#: A directory of at most so many entries goes to every task, a larger one is joined by shuffle.
BROADCAST_ENTRIES = 2_000_000
_PAGE_GROUP = 10_000


def key_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text; only repeated rows share it."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def _prefix(h: Column | str, bits: int) -> Column:
    return F.shiftright(h, HASH_BITS - bits)


def directory(keyed: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Buckets (depth, prefix, bytes, n, alone) over (h, bytes) rows. ``alone``: the bucket holds one hash value, so no
    bit can split it; it is over the limit if that key's rows are."""
    leaves, base, frontier = [], 0, None
    while base < HASH_BITS:
        depth = base + STEP_BITS
        pool = keyed
        if frontier is not None:
            pool = keyed.withColumn("__p", _prefix("h", base)).join(frontier.withColumnRenamed("prefix", "__p"), "__p", "left_semi")
        deep = pool.groupBy(_prefix("h", depth).alias("p")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        deep = stored(deep, "deep")
        first = base + 1 if frontier is not None else base
        levels = F.explode(F.sequence(F.lit(first), F.lit(depth))).alias("depth")
        nodes = deep.select("*", levels).withColumn("prefix", F.expr(f"shiftright(p, {depth} - depth)"))
        nodes = nodes.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), (F.min("lo") == F.max("hi")).alias("alone")
        )
        nodes = stored(nodes.withColumn("split", (F.col("bytes") > limit) & ~F.col("alone")), "nodes")
        parents = nodes.filter("split").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        last = nodes.filter("NOT split").withColumn("parent", F.shiftright("prefix", 1))
        under = last.join(parents, ["depth", "parent"], "left_semi")
        # the first level here has split parents, or none at all
        leaves.append(last.filter(F.col("depth") == first).unionByName(under).select("depth", "prefix", "bytes", "n", "alone"))
        frontier = nodes.filter((F.col("depth") == depth) & F.col("split")).select("prefix")
        if frontier.isEmpty():
            break
        base = depth
    return stored(reduce(DataFrame.unionByName, leaves), "directory")


def sharded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (replaced if there is one): name (the bits of its bucket after an "s"), depth, n_bytes
    (UTF-8 bytes of the row's text, 0 for null) and shard_bytes (of its bucket).

    Every bucket fits the limit, but a single text of more bytes than that, which is alone in its bucket. Repeated
    rows share a hash: where they do not fit one bucket, they are dealt to overflow pages ("-g.p" after the name), each
    within the limit, and shard_bytes is what the bucket and its pages hold. Empty texts count 0 bytes.
    An empty table gives no row.
    """
    h = key_hash(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    size = F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long")
    keyed = stored(docs.select(h.alias("h"), size.alias("bytes")), "keys")
    leaves = directory(keyed, limit)
    out = docs.withColumns({"__h": h, "__size": size, "__leaf": F.lit(None).cast("struct<depth:int,prefix:bigint,bytes:bigint,n:bigint>")})
    # classic directory entries, a table for each ten bits: a bucket stands in every entry that its bits lead to
    level = F.greatest(F.lit(STEP_BITS), F.ceil(F.col("depth") / STEP_BITS).cast("int") * STEP_BITS)
    for bits in sorted(r[0] for r in leaves.select(level.alias("l")).distinct().collect()):  # at most six
        mine = leaves.filter(level == bits)
        wide = F.expr(f"shiftleft(1L, {bits} - depth)")
        start = F.expr(f"shiftleft(prefix, {bits} - depth)")
        entries = mine.select(F.explode(F.sequence(start, start + wide - 1)).alias("__entry"), F.struct("depth", "prefix", "bytes", "n").alias("__found"))
        if entries.count() <= BROADCAST_ENTRIES:
            entries = F.broadcast(entries)
        out = out.withColumn("__entry", _prefix("__h", bits)).join(entries, "__entry", "left")
        out = out.withColumn("__leaf", F.coalesce("__leaf", "__found")).drop("__entry", "__found")
    bits = F.lpad(F.bin("__leaf.prefix"), F.col("__leaf.depth"), "0")
    name = F.concat(F.lit("s"), F.when(F.col("__leaf.depth") == 0, "").otherwise(bits))
    out = out.withColumn("__name", name)
    over = "alone AND n > 1 AND bytes > {limit}".format(limit=limit)
    if not leaves.filter(over).isEmpty():
        out = _paged(out, limit)
    shard = F.struct(F.col("__name").alias("name"), F.col("__leaf.depth").alias("depth"), F.col("__size").alias("n_bytes"), F.col("__leaf.bytes").alias("shard_bytes"))
    return out.withColumn("shard", shard).drop("__h", "__size", "__leaf", "__name")


def _paged(out: DataFrame, limit: int) -> DataFrame:
    """Rows of a key that does not fit a bucket, dealt to pages. All its rows have one size. They are numbered in groups
    of about ten thousand, so a key of any number of rows is no single task's."""
    over = (F.col("__leaf.bytes") > limit) & (F.col("__leaf.n") > 1)
    rest, many = out.filter(~over), out.filter(over)
    groups = F.ceil(F.col("__leaf.n") / _PAGE_GROUP)
    many = many.withColumn("__g", F.pmod(F.monotonically_increasing_id(), groups))
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("__size", F.lit(1))))
    row = F.row_number().over(Window.partitionBy("__name", "__g").orderBy("__h"))
    page = F.floor((row - 1) / per_page)
    many = many.withColumn("__name", F.concat("__name", F.lit("-"), F.col("__g").cast("string"), F.lit("."), page.cast("string"))).drop("__g")
    return rest.unionByName(many)
