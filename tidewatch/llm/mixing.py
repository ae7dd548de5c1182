"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Each source's target is its weight's share of all words, at most ``max_epochs`` times its size; what a capped
   source leaves is shared among the others by weight.
2. A source's documents are permuted by a keyed hash. It gives whole epochs, and of one more epoch a prefix of the
   permutation that fills the target; where a document would overflow it, smaller later ones fill the rest, until none
   fits or a thousandth of the target is open. The document left out whose size is nearest to the rest is taken too where
   that comes nearer to the target.
3. The copies taken form, per source, a second permuted stream of blocks of about ``block_words`` words. The tree
   starts with the block quotas of all sources and halves the output shards: the left half draws its blocks
   from the quotas without replacement (multivariate hypergeometric), the right half gets the rest, so the quotas
   of the shards add up exactly. A shard owns disjoint runs of blocks of each source's stream and orders
   what it got by another hash.

Every decision is a comparison of a document's hash with a number that belongs to its source, so documents and
texts are not moved. Only (source, hash, size) rows are aggregated; a source is never gathered in a task: its
prefix sums are taken over 4096 hash buckets and then inside the few buckets that hold a cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import words
from tidewatch.session import stored

WEIGHTS, MAX_EPOCHS = (5, 2, 1), 3
BLOCK_WORDS, SHARD_WORDS, SEED = 1 << 14, 1 << 22, "mix"
#: Hashes have 60 bits, of which the first 12 name a bucket. A room below this share of the target is filled by one document.
HASH_BITS, BUCKET_BITS, NEAR = 60, 12, 0.001
#: The table of sources goes to every task below this many (source, shard) entries, else it is joined by shuffle.
BROADCAST_ENTRIES = 2_000_000


def order_hash(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """60 bits of the MD5 of the seed, the id and the text: a permutation that any engine can repeat, and one that tells
    documents apart whose ids are null or repeated."""
    empty = F.lit("")
    named = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), empty), F.lit(":"), F.coalesce(text, empty))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def _key(source: Column) -> Column:
    """Sources in code point order, null last."""
    return F.struct(source.isNull().alias("none"), F.coalesce(source.cast("string"), F.lit("")).alias("name"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(key, source_size) rows, one per source, with ``target``: one row per source, so its windows are small.

    Sorted by size per weight, the capped sources come first; the level is the rest over the weights of the others
    at the first source that stays below its cap."""
    order = Window.orderBy("key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.lit(max_epochs) * F.col("source_size")
    ranked = sizes.withColumns({"weight": weight.cast("long"), "cap": cap})
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    every = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) - before).cast("double") / from_here
    ranked = ranked.withColumn("level", level).withColumn("place", F.row_number().over(by_room))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    found = F.coalesce(F.min(fits).over(every)["level"], F.lit(0.0))
    return ranked.select("key", "source_size", F.least(F.col("cap").cast("double"), found * F.col("weight")).alias("target"))


def cuts(pool: DataFrame, limits: DataFrame) -> DataFrame:
    """``limits`` (key, limit and others) with ``cut``, the greatest hash whose running size within ``pool`` (key, h,
    size) is at most the limit, and ``reached``, that running size; -1 and 0 where there is none.

    Equal hashes are taken together."""
    bucket = F.shiftright("h", HASH_BITS - BUCKET_BITS).alias("bucket")
    keyed = pool.select("key", bucket, "h", "size")
    totals = keyed.groupBy("key", "bucket").agg(F.sum("size").alias("s")).filter("s > 0")
    running = Window.partitionBy("key").orderBy("bucket")
    starts = totals.withColumn("before", F.sum("s").over(running) - F.col("s"))
    named = limits.withColumn("n", F.monotonically_increasing_id())
    named = stored(named, "limits")
    # the bucket that holds a limit: the last that starts at or below it
    marks = starts.select("key", F.col("before").cast("double").alias("at"), F.lit(0).alias("kind"), F.struct("bucket", "before").alias("b"), F.lit(None).cast("long").alias("n"))
    asks = named.select("key", F.col("limit").cast("double").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["b"].dataType).alias("b"), "n")
    upto = Window.partitionBy("key").orderBy("at", "kind", F.col("b.bucket")).rowsBetween(Window.unboundedPreceding, 0)
    edge = marks.union(asks).withColumn("b", F.last("b", True).over(upto)).filter("kind = 1 AND b IS NOT NULL")
    edge = stored(edge.select("key", "b.bucket", "b.before", "at", "n"), "edges")
    inside = keyed.join(F.broadcast(edge.select("key", "bucket", "before").distinct()), ["key", "bucket"])
    within = Window.partitionBy("key", "bucket").orderBy("h")
    points = inside.select("key", "bucket", (F.col("before") + F.sum("size").over(within)).alias("sum"), "h")
    marks = points.select("key", "bucket", F.col("sum").cast("double").alias("at"), F.lit(0).alias("kind"), F.struct("h", "sum").alias("p"), F.lit(None).cast("long").alias("n"))
    asks = edge.select("key", "bucket", "at", F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["p"].dataType).alias("p"), "n")
    upto = Window.partitionBy("key", "bucket").orderBy("at", "kind", F.col("p.h")).rowsBetween(Window.unboundedPreceding, 0)
    last = marks.union(asks).withColumn("p", F.last("p", True).over(upto)).filter("kind = 1").select("n", "p")
    # nothing of the bucket fits: all before it does
    found = edge.join(last, "n").select(
        "n", F.coalesce("p.h", F.shiftleft("bucket", HASH_BITS - BUCKET_BITS) - 1).alias("cut"), F.coalesce("p.sum", "before").alias("reached")
    )
    return named.join(found, "n", "left").drop("n").withColumns(
        {"cut": F.coalesce("cut", F.lit(-1).cast("long")), "reached": F.coalesce("reached", F.lit(0).cast("long"))}
    )


def _rounds(narrow: DataFrame, plan: DataFrame, max_epochs: int) -> DataFrame:
    """``plan`` (key, source_size, target) with epochs, steps (array of (cut, room): after the previous cut and up
    to this one, documents of at most ``room`` words are taken once more), over (the hash of the one document beyond the
    room that is taken, or null) and taken (words of the source).

    Each round's cut leaves out a document that the room does not hold, so rooms shrink until no document fits or the
    room is small."""
    whole = F.when(F.col("source_size") > 0, F.floor((F.col("target") + 0.5) / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", F.least(whole, F.lit(max_epochs)).cast("int"))
    rest = F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumns({
        "limit": F.when(F.col("epochs") < max_epochs, rest).otherwise(0.0), "last": F.lit(-1).cast("long"),
        "steps": F.lit([]).cast("array<struct<cut:bigint,room:double>>"), "taken": F.col("epochs") * F.col("source_size"),
    })
    while True:
        open_ = F.broadcast(plan.filter((F.col("limit") >= 1) & (F.col("limit") >= NEAR * F.col("target"))).select("key", "limit", "last"))
        pool = narrow.join(open_, "key").filter("h > last AND size > 0 AND size <= limit").select("key", "h", "size")
        found = cuts(pool, plan).withColumn("cut", F.greatest("cut", "last"))
        # nothing reached: the next hash is that of repeated rows which do not fit together, so it is passed over
        first = pool.groupBy("key").agg(F.min("h").alias("first"))
        step = F.when(F.col("reached") > 0, F.struct("cut", F.col("limit").alias("room"))).when(
            F.col("first").isNotNull(), F.struct(F.col("first").alias("cut"), F.lit(-1.0).alias("room"))
        )
        plan = found.join(F.broadcast(first), "key", "left").withColumn("step", step).select(
            "key", "source_size", "target", "epochs", (F.col("limit") - F.col("reached")).alias("limit"),
            F.coalesce("step.cut", "last").alias("last"),
            F.when(F.col("step").isNotNull(), F.array_append("steps", F.col("step"))).otherwise(F.col("steps")).alias("steps"),
            (F.col("taken") + F.col("reached")).alias("taken"), F.col("step").isNotNull().alias("moved"),
        )
        plan = stored(plan, "plan")
        if plan.filter("moved").isEmpty():
            break
        plan = plan.drop("moved")
    # one more of those left out
    room = F.broadcast(plan.filter("limit > 0").select("key", "limit", "steps"))
    left = narrow.join(room, "key").filter(~_again(F.col("h"), F.col("size"), F.col("steps")) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("limit")))
    left = left.groupBy("key", "h").agg(F.sum("size").alias("size"), F.max("limit").alias("limit")).filter("size < 2 * limit")
    over = left.groupBy("key").agg(F.min(F.struct(F.abs(F.col("size") - F.col("limit")).alias("off"), "size", "h")).alias("o"))
    plan = plan.join(F.broadcast(over), "key", "left").withColumns({"over": F.col("o.h"), "taken": F.col("taken") + F.coalesce("o.size", F.lit(0))})
    return stored(plan.drop("limit", "last", "moved", "o"), "plan")


def _again(h: Column, size: Column, steps: Column, over: Column | None = None) -> Column:
    """Whether a document is in the part epoch: the first cut at or after its hash has room for it, or it is the one
    beyond the room."""
    step = F.get(F.filter(steps, lambda s: s["cut"] >= h), F.lit(0))
    fits = F.coalesce(size <= step["room"], F.lit(False))
    return fits if over is None else fits | F.coalesce(h == over, F.lit(False))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked ones among ``drawn`` of ``total`` of which ``marked`` are, at the quantile ``u`` of the hypergeometric
    law. Weights grow from ten deviations below the mode by exact ratios; beyond that nothing is lost in doubles."""
    n, k, d = (c.cast("double") for c in (total, marked, drawn))
    low, high = F.greatest(F.lit(0.0), d - (n - k)), F.least(d, k)
    mode = F.least(high, F.greatest(low, F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")))
    deviation = F.sqrt(F.greatest(F.lit(0.0), d * (k / n) * (1 - k / n) * (n - d) / F.greatest(n - 1, F.lit(1.0))))
    first = F.greatest(low, F.floor(mode - 10 * deviation - 5).cast("double"))
    last = F.least(high, F.ceil(mode + 10 * deviation + 5).cast("double"))
    support = F.sequence(first.cast("long"), last.cast("long"))
    grown = lambda w, x: F.when(x == first.cast("long"), F.lit(1.0)).otherwise(w * (k - x + 1) * (d - x + 1) / (x * (n - k - d + x)))
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("sum"))

    def add(s, x):
        w = grown(s["w"], x)
        return F.struct(w.alias("w"), (s["sum"] + w).alias("sum"))

    whole = F.aggregate(support, zero, add, lambda s: s["sum"])
    start = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("sum"), first.cast("long").alias("x"))

    def walk(s, x):
        w = grown(s["w"], x)
        return F.struct(w.alias("w"), (s["sum"] + w).alias("sum"), F.when(s["sum"] <= u * whole, x).otherwise(s["x"]).alias("x"))

    return F.when((n > 0) & (d > 0) & (k > 0), F.aggregate(support, start, walk, lambda s: s["x"])).otherwise(F.lit(0).cast("long"))


def split_quotas(spark, quotas: Sequence[int], shards: int, seed: str = SEED) -> DataFrame:
    """(shard, position of the source, blocks): the tree's leaves. Sums over shards are the quotas, and shards get
    the same number of blocks but for one."""
    node = spark.createDataFrame([(0, shards, [int(q) for q in quotas])], "lo int, hi int, q array<bigint>")
    total = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda a, x: a + x)
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        # blocks are dealt evenly: shard i ends at floor(all * i / shards)
        everything = sum(int(q) for q in quotas)
        end = lambda i: F.floor(F.lit(everything) * i.cast("decimal(20,0)") / shards).cast("long")
        node = node.withColumn("mid", mid).withColumn("want", end(F.col("mid")) - end(F.col("lo")))

        def draw(state, entry):
            unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("lo"), F.col("hi"), entry["i"]), 11) / float(1 << 53)  # noqa: B023
            got = hypergeometric(state["n"], entry["q"], state["want"], unit)
            return F.struct(
                (state["n"] - entry["q"]).alias("n"), (state["want"] - got).alias("want"), F.array_append(state["left"], got).alias("left")
            )

        entries = F.transform("q", lambda q, i: F.struct(q.alias("q"), i.alias("i")))
        begin = F.struct(total(F.col("q")).alias("n"), F.col("want").alias("want"), F.lit([]).cast("array<bigint>").alias("left"))
        node = node.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, F.aggregate(entries, begin, draw, lambda s: s["left"])))
        right = F.zip_with("q", "left", lambda a, b: a - b)
        halves = F.when(
            F.col("left").isNotNull(),
            F.array(F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("q")), F.struct(F.col("mid").alias("lo"), "hi", right.alias("q"))),
        ).otherwise(F.array(F.struct("lo", "hi", "q")))
        node = node.select(F.explode(halves).alias("x")).select("x.*")
        node = stored(node.repartition("lo") if level > 7 else node, "quotas")
    return node.select(F.col("lo").alias("shard"), F.posexplode("q").alias("i", "blocks"))


def _copy_hash(h: Column, copy: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(h, copy), 64 - HASH_BITS)


def _lookup(narrow: DataFrame, plan: DataFrame, block_words: int, shard_words: int, seed: str) -> tuple[DataFrame, int]:
    """(key, table): for each leading bit pattern of a copy's hash, the shard it starts in and the cuts within."""
    order = Window.orderBy("key")
    blocks = F.ceil(F.col("taken") / block_words).cast("long")
    plan = stored(plan.withColumns({"blocks": blocks, "i": (F.row_number().over(order) - 1).cast("int")}), "quotas")
    quotas = [r[0] for r in plan.orderBy("i").select("blocks").collect()]  # one number per source
    words_taken = plan.agg(F.sum("taken")).first()[0] or 0
    shards = max(1, -(-words_taken // shard_words))
    dealt = split_quotas(plan.sparkSession, quotas or [0], shards, seed).join(F.broadcast(plan.select("i", "key", "blocks", "taken").withColumnRenamed("blocks", "all")), "i")
    upto = Window.partitionBy("key").orderBy("shard")
    ends = dealt.filter("all > 0").withColumn("end", F.sum("blocks").over(upto)).filter(F.col("shard") < shards - 1)
    limits = ends.select("key", "shard", F.floor(F.col("taken") * (F.col("end") / F.col("all"))).alias("limit"))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    pool = narrow.join(F.broadcast(plan.select("key", "epochs", "steps", "over")), "key")
    pool = pool.withColumn("copies", F.col("epochs") + _again(F.col("h"), F.col("size"), F.col("steps"), F.col("over")).cast("int"))
    pool = pool.filter("copies > 0").select("key", "h", "size", copies).select("key", _copy_hash(F.col("h"), F.col("copy")).alias("h"), "size")
    bits = min(BUCKET_BITS, max(1, math.ceil(math.log2(shards)) if shards > 1 else 1))
    if shards == 1:
        return plan.select("key", F.lit(None).cast("array<struct<base:int,cuts:array<bigint>>>").alias("table")), bits
    # a shard without blocks of the source ends where the one before it does
    found = stored(cuts(pool, limits), "cuts")
    listed = found.groupBy("key").agg(F.array_sort(F.collect_list("cut")).alias("all_cuts"))
    shift = HASH_BITS - bits
    entry = lambda b: F.struct(
        F.size(F.filter("all_cuts", lambda c: c < F.shiftleft(b, shift))).alias("base"),
        F.filter("all_cuts", lambda c: (c >= F.shiftleft(b, shift)) & (c < F.shiftleft(b + 1, shift))).alias("cuts"),
    )
    table = F.transform(F.sequence(F.lit(0).cast("long"), F.lit((1 << bits) - 1).cast("long")), entry)
    return stored(listed.select("key", table.alias("table")), "lookup"), bits


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``mix`` (replaced if there is one): size, source_size, target and the copies that the mix
    takes, each with its copy number, output shard and place (the order within the shard).

    A document's size is its number of words: 0 for a null or empty text, which is in the mix without words. A null
    source is a source of its own, the last. Ids may be null or repeated: only rows of one id and one text share a hash
    and are taken or left together. An empty table gives no row. The number of sources has to fit in memory.
    """
    size = F.size(words(F.col(f"`{text}`"))).cast("long")
    h = order_hash(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), seed)
    key = _key(F.col(f"`{source}`"))
    narrow = stored(docs.select(key.alias("key"), h.alias("h"), size.alias("size")), "sizes")
    sizes = narrow.groupBy("key").agg(F.sum("size").alias("source_size"))
    plan = _rounds(narrow, stored(targets(sizes, weights, max_epochs), "targets"), max_epochs)
    table, bits = _lookup(narrow, plan, block_words, shard_words, seed)
    plan = plan.join(table, "key", "left")
    entries = plan.agg(F.sum(F.coalesce(F.size("table"), F.lit(1)))).first()[0] or 0
    plan = plan.select(F.col("key").alias("__key"), F.struct("source_size", "target", "epochs", "steps", "over", "table").alias("__plan"))
    plan = F.broadcast(plan) if entries <= BROADCAST_ENTRIES else plan
    out = docs.withColumns({"__key": key, "__h": h, "__size": size}).join(plan, "__key")
    again = _again(F.col("__h"), F.col("__size"), F.col("__plan.steps"), F.col("__plan.over"))
    n = F.col("__plan.epochs") + again.cast("int")

    def copy(c):
        at = _copy_hash(F.col("__h"), c)
        entry = F.get("__plan.table", F.shiftright(at, HASH_BITS - bits).cast("int"))
        shard = F.coalesce(entry["base"] + F.size(F.filter(entry["cuts"], lambda x: x < at)), F.lit(0))
        return F.struct(c.alias("copy"), shard.alias("shard"), F.xxhash64(at, F.lit(seed)).alias("place"))

    none = F.lit([]).cast("array<struct<copy:int,shard:int,place:bigint>>")
    out = out.withColumn("__n", n)
    copies = F.when(F.col("__n") > 0, F.transform(F.sequence(F.lit(1), F.col("__n")), copy)).otherwise(none)
    mix = F.struct(F.col("__size").alias("size"), F.col("__plan.source_size").alias("source_size"), F.col("__plan.target").alias("target"), copies.alias("copies"))
    return out.withColumn("mix", mix).drop("__key", "__h", "__size", "__plan", "__n")


def taken(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, a row per copy, in the columns of ``docs``."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text", "source")
    return mixed(row, **options).select("__row", F.explode("mix.copies")).select("__row.*")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder per output shard, its rows in the shard's own order."""
    rows = mixed(docs, **options).withColumn("__copy", F.explode("mix.copies")).drop("mix")
    rows = rows.withColumns({"shard": F.col("__copy.shard"), "__place": F.col("__copy.place")}).drop("__copy")
    rows.repartition("shard").sortWithinPartitions("shard", "__place").drop("__place").write.partitionBy("shard").parquet(path)
