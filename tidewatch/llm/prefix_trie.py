"""Prefix trie of conversations by van Emde Boas recursion.

Turns are symbols; a conversation is their sequence. The depths are cut in half, the halves in half again, down to
single turns, so a conversation of any length needs a round per doubling of its length and no row ever holds a sequence:

1. Blocks are named by content, from single turns up: a block of 2^k turns is the digest of its two halves.
2. Cut prefixes are named, from the whole depth down: a block's root is the name of what stands before it. Its upper half keeps that
   root, its lower half gets the digest of the root and the upper half's content. Upper tries and lower forests of all
   blocks are built in the same round. At the end each turn knows the name of the prefix before it, so that equal prefixes meet.
3. Totals are grafted upward, in the same rounds backwards: what the lower forest below a cut prefix holds is added to
   the prefix and its ancestors in the upper trie, at most half a block of rows per cut prefix.

A node is (its smallest member, its depth): members of two nodes of one depth differ. Every round shuffles on a
conversation and a block, so one very long conversation is spread over the cluster; a node of very many members is a
sum or a minimum with partial aggregation.

Names are 128 bits of SHA-256. Rows without a conversation id belong to no conversation and are left out. Turns of the same
number are ordered by role and text, equal rows each count. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import words
from tidewatch.operators.ordered import MAX_GROUP_ROWS, fits, with_row_index
from tidewatch.session import stored

#: Every so many conversations share the beginning of the first of them, of at most HEAD turns.
FAMILY, HEAD = 20, 3
#: Ids of a node's ended conversations that are put into one text.
CHUNK = 1 << 16


def _name(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turns(conversations: DataFrame, limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """(conv_id, depth, symbol, tokens): the turns in order, depth from 1, the symbol a name of role and text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    if fits(rows, ["conv_id"], limit):
        placed = rows.withColumn("depth", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    else:
        every = with_row_index(rows, ["conv_id", *order], "at")
        first = every.groupBy("conv_id").agg(F.min("at").alias("first"))
        placed = every.join(first, "conv_id").withColumn("depth", F.col("at") - F.col("first") + 1)
    symbol = _name(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return placed.select("conv_id", "depth", symbol.alias("symbol"), F.size(words(F.col("text"))).cast("long").alias("tokens"))


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations, and (conv_id, length) of each, also of those that have none left.

    Conversation c begins with the first h turns of its family's first conversation, c - c % FAMILY, h a hash of c below
    HEAD + 1, and goes on with its own turns after its first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", h, base)
    heads = own.filter(F.col("depth") <= HEAD).filter(F.col("conv_id") % FAMILY == 0)
    bases = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("n_base"))
    given = F.least("h", F.coalesce("n_base", F.lit(0)))
    lengths = sizes.join(bases, "base", "left").select("conv_id", (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    begun = sizes.select("conv_id", "h", "base").join(heads.withColumnRenamed("conv_id", "base"), "base").filter("depth <= h")
    rest = own.select("*", h, base).filter("depth > h").join(bases, "base", "left").withColumn("depth", F.col("depth") - F.col("h") + given)
    columns = ["conv_id", "depth", "symbol", "tokens"]
    return begun.select(*columns).unionByName(rest.select(*columns)), lengths


def _contents(rows: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k the names (conv_id, block, content) of the full blocks of 2^k turns."""
    found = [rows.select("conv_id", (F.col("depth") - 1).alias("block"), F.col("symbol").alias("content"))]
    for _ in range(1, levels):
        left, right = (F.max(F.when(F.col("block") % 2 == side, F.col("content"))) for side in (0, 1))
        halves = found[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(left.alias("left"), right.alias("right"))
        full = halves.filter("left IS NOT NULL AND right IS NOT NULL")
        found.append(stored(full.select("conv_id", "block", _name(F.col("left"), F.col("right")).alias("content")), "blocks"))
    return found


def _roots(lengths: DataFrame, contents: list[DataFrame], levels: int) -> DataFrame:
    """(conv_id, block, root) of all single turns: the name of the prefix before each."""
    top = F.ceil(F.log2(F.col("length").cast("double"))).cast("int")
    entering = lengths.filter("length > 0").select("conv_id", "length", top.alias("top"))
    begin = entering.select("conv_id", "length", F.lit(0).cast("long").alias("block"), F.lit(b"\x00" * 16).alias("root"), "top")
    blocks = begin.filter(F.col("top") == levels).drop("top")
    for k in range(levels, 0, -1):
        upper = contents[k - 1].filter("block % 2 = 0").select("conv_id", F.shiftright("block", 1).alias("block"), "content")
        halves = F.array(
            F.struct((F.col("block") * 2).alias("block"), F.col("root").alias("root")),
            # nothing follows an upper half that the conversation does not fill
            F.when(
                F.col("length") > (F.col("block") * 2 + 1) * 2 ** (k - 1),
                F.struct((F.col("block") * 2 + 1).alias("block"), _name(F.lit(b"\x01"), F.col("root"), F.col("content")).alias("root")),
            ),
        )
        cut = blocks.join(upper, ["conv_id", "block"], "left").select("conv_id", "length", F.explode(halves).alias("half"))
        cut = cut.filter("half IS NOT NULL").select("conv_id", "length", "half.block", "half.root")
        blocks = cut.unionByName(begin.filter(F.col("top") == k - 1).drop("top"))
        if k % 6 == 0:
            blocks = stored(blocks, "roots")
    return blocks.select("conv_id", "block", "root")


def _grafted(paths: DataFrame, own: DataFrame, levels: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) summed over subtrees. ``paths`` (conv_id, depth, node, parent) holds the way to every node
    along its smallest member; ``own`` (conv_id, depth, parent, n_leaves, saved_tokens) what each node has itself."""
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    parts = [own]
    for k in range(1, levels + 1):
        half = 2 ** (k - 1)
        every = reduce(DataFrame.unionByName, parts)
        # the first depth of each lower half, by the cut prefix above it
        below = every.filter((F.col("depth") - 1) % (2 * half) == half).groupBy("parent", "depth").agg(*sums)
        below = below.select(F.col("parent").alias("conv_id"), F.floor((F.col("depth") - 2) / half).alias("block"), "n_leaves", "saved_tokens")
        way = paths.select("conv_id", F.floor((F.col("depth") - 1) / half).alias("block"), "node", "parent", "depth").filter("block % 2 = 0")
        grown = way.join(below, ["conv_id", "block"]).groupBy(F.col("node").alias("conv_id"), "depth", "parent").agg(*sums)
        parts.append(stored(grown, "grafts"))
    return reduce(DataFrame.unionByName, parts).groupBy("conv_id", "depth").agg(*sums)


def _ends(ended: DataFrame, chunk: int, limit: int) -> DataFrame:
    """(node, depth, ends_sha256): SHA-256 of the ids that end at a node, ascending, with commas between.

    Ids are put together a chunk at a time; a node's chunks pass through its digest in order, one after the other."""
    text = lambda ids: F.array_join(F.transform(F.sort_array(ids), lambda i: i.cast("string")), ",")
    if fits(ended, ["node", "depth"], min(chunk, limit)):
        return ended.groupBy("node", "depth").agg(F.sha2(text(F.collect_list("conv_id")), 256).alias("ends_sha256"))
    at = with_row_index(ended, ["depth", "node", "conv_id"], "at").withColumn("chunk", F.floor(F.col("at") / chunk))
    chunks = at.groupBy("node", "depth", "chunk").agg(text(F.collect_list("conv_id")).alias("ids"))
    ordered = chunks.repartition("node", "depth").sortWithinPartitions("node", "depth", "chunk")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids"))):
                if (node, depth) != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (node, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(done)
        if key is not None:
            yield _rows([(*key, digest.hexdigest())])

    return ordered.mapInArrow(digests, "node long, depth long, ends_sha256 string")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def trie(rows: DataFrame, lengths: DataFrame, chunk: int = CHUNK, limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows`` (conv_id, depth, symbol, tokens) are the turns, ``lengths`` (conv_id, length) all conversations. saved_tokens counts
    for a node and all below it the tokens of the last turn once for each member but one. The root has depth 0."""
    rows, lengths = stored(rows, "turns"), stored(lengths, "lengths")
    longest, root, n_convs = lengths.agg(F.max("length"), F.min("conv_id"), F.count("*")).first()
    levels = max((longest or 1) - 1, 0).bit_length()
    roots = _roots(lengths, _contents(rows, levels), levels)
    named = rows.withColumn("block", F.col("depth") - 1).join(roots, ["conv_id", "block"])
    named = stored(named.select("conv_id", "depth", "tokens", _name(F.lit(b"\x02"), F.col("root"), F.col("symbol")).alias("name")), "named")
    found = named.groupBy("name").agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"))
    named = named.join(found, "name").join(lengths, "conv_id")
    named = stored(named.select("conv_id", "depth", "node", "n_convs", "tokens", (F.col("depth") == F.col("length")).alias("last")), "members")
    # a conversation that is the smallest of a node is the smallest of every node further on, so of the one where it ends
    smallest = named.filter("last AND node = conv_id").select("conv_id")
    ways = named.join(smallest, "conv_id", "left_semi")
    above = ways.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    ways = ways.join(above, ["conv_id", "depth"], "left").withColumn("parent", F.coalesce("parent", F.lit(root).cast("long")))
    ways = stored(ways.select("conv_id", "depth", "node", "parent", "n_convs", "tokens"), "ways")
    nodes = ways.filter("node = conv_id").drop("node")
    children = nodes.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, ["conv_id", "depth"], "left").na.fill(0, ["n_children"]), "nodes")
    own = nodes.select(
        "conv_id", "depth", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"),
    )
    totals = _grafted(ways.select("conv_id", "depth", "node", "parent"), own, levels)
    below = nodes.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    whole = own.agg(
        F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"), F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    )
    top = whole.filter(F.lit(n_convs > 0)).select(
        F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(n_convs).cast("long").alias("n_convs"), "n_children", F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens",
    )
    ended = named.filter("last").select("node", "depth", "conv_id").unionByName(
        lengths.filter("length = 0").select(F.lit(root).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"), "conv_id")
    )
    ends = _ends(ended, chunk, limit).withColumnRenamed("node", "conv_id")
    return below.unionByName(top).join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
