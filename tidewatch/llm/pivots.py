"""SimHash near-duplicates through pivot distance tables.

Each distinct fingerprint gets a row of Hamming distances to reference fingerprints (pivots). Two
fingerprints within ``max_bits`` differ by at most ``max_bits`` in every coordinate of that table, so a pair
whose largest coordinate difference is greater is discarded; the pairs that survive are verified on the
fingerprints themselves.

Pivots over all 64 bits tell fingerprints apart, but a range over many coordinates is no join key. So the
pairs that are looked at come from pivots inside parts of the fingerprint: it is cut into ``parts`` blocks,
and the distances to the unit fingerprints of a block determine the block. Of two fingerprints within
``max_bits``, at least ``parts - max_bits`` blocks have equal distance rows; every choice of that many
blocks is one join key. No link can be missed, whatever the number of parts; six give 15 keys of about 21 bits, and beyond some
hundred million distinct fingerprints seven (35 keys of 27 bits) look at fewer pairs.

Copies cannot blow up the work: equal fingerprints are one node, a key group that is too large for a task is
cut into slices that meet pairwise, and a group returns at most one link per member (a spanning forest of
the links it verified), never the list of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components, with_component
from tidewatch.session import stored

SEED, SHINGLE_WORDS, MAX_BITS = 42, 4, 4
PARTS, PIVOTS, SLICE_ROWS = 6, 24, 1024
#: Shingles hashed at a time, texts handed to a task at a time.
_HASHES, _LINKS = 1 << 16, 1 << 20


def text_fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a whole text: a bit is set if it is set in over half of the shingle hashes."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle_words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _HASHES):
        stop = min(n, start + _HASHES)
        h = np.array(
            [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle_words]), SEED) for i in range(start, stop)], dtype="<u8"
        )
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without its text, with ``fp`` (the fingerprint as a signed long). Null and empty texts get 0."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*[F.col(f"`{c}`") for c in others]).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            fp = np.array([text_fingerprint(x.as_py(), shingle_words) for x in batch.column(at)], dtype=np.uint64)
            kept = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fp.view(np.int64))], [*names, "fp"])

    return docs.mapInArrow(run, schema)


def pivot_fingerprints(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints spread over the 64-bit space by a fixed rule."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(count)], dtype=np.uint64)


def _blocks(parts: int) -> list[int]:
    cuts = [64 * i // parts for i in range(parts + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row of each row's component under the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _forest(group: np.ndarray, fp: np.ndarray, pivots: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by ``group``: links (row, smallest row of its component) among rows of one group."""
    table = np.stack([np.bitwise_count(fp ^ p) for p in pivots]).astype(np.int8)
    n, rows = len(fp), np.arange(len(fp))
    label, found_a, found_b, held = rows, [], [], 0
    lag, at = 1, rows[:-1]
    while len(at):
        at = at[at + lag < n]
        at = at[group[at] == group[at + lag]]
        a, b = at, at + lag
        # the pivots discard a pair by its largest coordinate difference, one coordinate after the other
        for distances in table:
            near = np.abs(distances[a] - distances[b]) <= max_bits
            a, b = a[near], b[near]
        close = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        a, b = a[close], b[close]
        found_a.append(a)
        found_b.append(b)
        held += len(a)
        if held > _LINKS:
            label = _roots(np.concatenate([*found_a, rows]), np.concatenate([*found_b, label]), n)
            found_a, found_b, held = [], [], 0
        lag += 1
    label = _roots(np.concatenate([*found_a, rows]), np.concatenate([*found_b, label]), n)
    return rows[label != rows], label[label != rows]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS, pivots: int = PIVOTS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) of at most ``max_bits`` differing bits whose
    components are those of all such pairs."""
    if parts <= max_bits:
        raise ValueError("there must be more parts than differing bits")
    blocks = _blocks(parts)
    masks = [sum(c) for c in combinations(blocks, parts - max_bits)]
    table = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(table).alias("key")).select("fp", "key.k", "key.v")
    sizes = keyed.groupBy("k", "v").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(sizes, ["k", "v"])
    # a large group is cut into slices, each pair of which is a group of its own
    cut = F.ceil(F.col("n") / slice_rows).cast("int")
    met = met.withColumn("s", F.pmod(F.xxhash64("fp"), cut).cast("int"))
    met = met.withColumn("t", F.explode(F.sequence(F.lit(0), cut - 1)))
    # a slice meets itself once, as the pair (s, s)
    group = F.struct("k", "v", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j"))
    sliced = met.select(F.xxhash64(group).alias("g"), group.alias("group"), "fp")
    sliced = sliced.repartition(F.col("g")).sortWithinPartitions("g", "group")
    reference = pivot_fingerprints(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(g, fp):
            number = np.cumsum(np.r_[0, np.any(g[1:] != g[:-1], axis=1)]) if len(g) else np.zeros(0, int)
            a, b = _forest(number, fp, reference, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])

        tail_g, tail_fp = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            parts_of = [batch.column(0).field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            g = np.concatenate([tail_g, np.stack(parts_of, axis=1)])
            fp = np.concatenate([tail_fp, batch.column(1).to_numpy().view(np.uint64)])
            # the last group may go on in the next batch; it has at most two slices
            last = np.flatnonzero(np.any(g != g[-1], axis=1))
            whole = last[-1] + 1 if len(last) else 0
            tail_g, tail_fp = g[whole:], fp[whole:]
            yield linked(g[:whole], fp[:whole])
        yield linked(tail_g, tail_fp)

    return sliced.select("group", "fp").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``max_bits`` bits; component_id is the
    smallest doc_id that links reach. Texts without words (null, empty, blanks) have fingerprint 0 and are
    linked like any other; repeated rows and ties are members of one component; an empty table gives no row;
    other columns are not read. A null doc_id is linked but never names a component unless all its ids are null.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = stored(fingerprints(narrow), "fingerprints")
    found = links(marked.select("fp").distinct(), max_bits, **options)
    named = with_component(marked, "doc_id", "fp", components(found))
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, in the columns of ``docs``: the one of the smallest id, a row without an id only if its
    component has no other; of rows with equal ids the one whose digest comes first. Equal rows are one."""
    every = [F.col(f"`{c}`") for c in docs.columns]
    digest = F.unhex(F.md5(F.to_json(F.struct(*every), {"ignoreNullFields": "false"})))
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), digest.alias("digest"))
    found = near_duplicates(docs.select(row.alias("doc_id"), "text"), **options)
    chosen = found.filter("doc_id <=> component_id").select(F.col("doc_id.digest").alias("__digest")).distinct()
    kept = docs.select(F.struct(*every).alias("__row"), digest.alias("__digest")).join(chosen, "__digest", "left_semi")
    return kept.groupBy("__digest").agg(F.first("__row").alias("__row")).select(*[F.col("__row")[c].alias(c) for c in docs.columns])
