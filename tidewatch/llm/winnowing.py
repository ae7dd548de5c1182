"""Benchmark decontamination by winnowing.

Of every window of ``span`` words, that is of ``span - k + 1`` successive k-grams, the k-gram of the least
hash (the last of equals) is kept as a fingerprint. A span of ``span`` or more words that a document shares
with an item has such a window in both, which keeps the same k-gram in both; so fingerprints are joined, each
hit is extended word by word to both sides, and extensions of ``span`` words or more are shared text. Items
of fewer words are one window: there the k-gram is the item, and each is kept.

Documents stay where they are and meet the items in blocks: the table of items is cut into segments and these
into blocks of at most about ``block_words`` words, so what is sent to the tasks has a fixed bound whatever
the number of items; more blocks are more passes.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower
from tidewatch.llm.tokens import ALPHANUMERIC, Words, grams, words_of
from tidewatch.session import stored

SPAN, K = 10, 5
BLOCK_WORDS, SEGMENT_WORDS = 500_000, 4096
#: ASCII digits, lower-case letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOUND = "struct<n_words: bigint, spans: array<struct<start: bigint, stop: bigint>>, items: array<string>>"


def window_minima(h: np.ndarray, doc: np.ndarray, span: int, k: int) -> np.ndarray:
    """Positions of the k-grams kept: in each window of ``span`` words of one text, the last of the least."""
    g, n = grams(h, k), len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    whole = doc[:n] == doc[span - 1 :]
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, span - k + 1):
        later = g[j : j + n]
        less = later <= best
        best = np.where(less, later, best)
        at = np.where(less, np.arange(n) + j, at)
    return np.unique(at[whole])


@dataclass
class Index:
    """Fingerprints of a block of segments: by gram length, the sorted hashes with (segment, position)."""

    words: list[list[bytes]]
    ids: list[list[str]]
    table: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def of(segments: list[tuple[str, list[str]]], span: int, k: int) -> Index:
        by_text: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, ws in segments:
            by_text[tuple(w.encode() for w in ws)].add(item)
        index = Index([list(x) for x in by_text], [sorted(x) for x in by_text.values()])
        found = defaultdict(list)
        for s, ws in enumerate(index.words):
            (w,) = words_of(pa.array([b" ".join(ws).decode()]), ALPHANUMERIC)
            short = len(ws) < span
            length = len(ws) if short else k
            kept = np.zeros(1, np.int64) if short else window_minima(w.hash, w.doc, span, k)
            found[length].append((grams(w.hash, length)[kept], np.full(len(kept), s), kept, short))
        # short items are whole grams, apart from the k-grams of longer ones
        for short in (False, True):
            for length, parts in found.items():
                if mine := [p for p in parts if p[3] == short]:
                    h, s, at = (np.concatenate([p[i] for p in mine]) for i in range(3))
                    order = np.argsort(h, kind="stable")
                    index.table[-length if short else length] = (h[order], s[order], at[order])
        return index


def _extended(w: Words, lo: int, hi: int, i: int, ws: list[bytes], j: int) -> tuple[int, int]:
    """The largest span around word i of a text (its words lo to hi) that equals the segment around j."""
    if w.word(i) != ws[j]:
        return i, i
    start, stop = i, i + 1
    while start > lo and j - (i - start) > 0 and w.word(start - 1) == ws[j - (i - start) - 1]:
        start -= 1
    while stop < hi and j + (stop - i) < len(ws) and w.word(stop) == ws[j + (stop - i)]:
        stop += 1
    return start, stop


def _search(w: Words, index: Index, span: int) -> list[tuple[list[dict[str, int]], list[str]]]:
    """Per text: merged shared spans as word ranges, and the items they come from."""
    edges = np.searchsorted(w.doc, np.arange(w.count + 1))
    spans: list[list[tuple[int, int]]] = [[] for _ in range(w.count)]
    items: list[set[str]] = [set() for _ in range(w.count)]
    done: dict[tuple[int, int], int] = {}
    for length, (hashes, segment, position) in index.table.items():
        k = abs(length)
        g = grams(w.hash, k)
        if length > 0:
            at = window_minima(w.hash, w.doc, span, k)
        else:
            at = np.flatnonzero(w.doc[: len(g)] == w.doc[k - 1 :]) if len(g) else np.zeros(0, np.int64)
        first = np.searchsorted(hashes, g[at], "left")
        last = np.searchsorted(hashes, g[at], "right")
        for i, a, b in zip(*(x[last > first].tolist() for x in (at, first, last)), strict=True):
            d = int(w.doc[i])
            lo, hi = int(edges[d]), int(edges[d + 1])
            for s, j in zip(segment[a:b].tolist(), position[a:b].tolist(), strict=True):
                if done.get((s, i - j), -1) > i:  # inside a span that is known
                    continue
                start, stop = _extended(w, lo, hi, i, index.words[s], j)
                if stop - start >= min(span, len(index.words[s])):
                    done[s, i - j] = stop
                    spans[d].append((start - lo, stop - lo))
                    items[d].update(index.ids[s])
    out = []
    for own, ids in zip(spans, items, strict=True):
        merged: list[list[int]] = []
        for start, stop in sorted(own):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], stop)
            else:
                merged.append([start, stop])
        out.append(([{"start": a, "stop": b} for a, b in merged], sorted(ids)))
    return out


def _finder(index, span: int):
    """An Arrow UDF from texts to FOUND. ``index``: the broadcast block."""
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string()))])

    def found(text: pa.Array) -> pa.Array:
        rows = []
        for w in words_of(text, ALPHANUMERIC):
            counts = np.bincount(w.doc, minlength=w.count).tolist()
            rows += [{"n_words": n, "spans": s, "items": i} for n, (s, i) in zip(counts, _search(w, index.value, span), strict=True)]
        return pa.array(rows, kind)

    return F.arrow_udf(found, FOUND)


def _segments(items: DataFrame, item_id: str, text: str, span: int, length: int) -> DataFrame:
    """(item, words): runs of at most ``length`` words that overlap by span - 1, so each window is in one."""
    w = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(WORD), F.lit(0))
    cut = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"), w.alias("w")).filter("size(w) > 0")
    step = length - span + 1
    at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - span), F.lit(step))
    return cut.select("item", "w", F.explode(at).alias("at")).select("item", F.slice("w", F.col("at") + 1, length).alias("words"))


def _merged(old: Column, new: Column) -> Column:
    """Two results of one text as one. Spans may overlap; ``hit_words`` counts their union."""
    return F.struct(
        old["n_words"].alias("n_words"),
        F.array_union(old["spans"], new["spans"]).alias("spans"),
        F.array_union(old["items"], new["items"]).alias("items"),
    )


def shared_spans(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    span: int = SPAN, k: int = K, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``found`` (replaced if there is one): n_words, the word ranges [start, stop) that are
    shared with an item over ``span`` words or the whole of a shorter item, and the ids of those items as texts.

    Null and empty texts have no words and no hits. Items of equal text are all named; rows of one item_id are
    one item; a null item_id is named "null"; items without words match nothing. Every row of ``docs`` gives one
    row, repeated rows too. An empty table of either kind is allowed.
    """
    if not 1 <= k <= span or span > SEGMENT_WORDS:
        raise ValueError("1 <= k <= span <= segment length")
    cut = stored(_segments(items, item_id, item_text, span, SEGMENT_WORDS), "segments")
    total = cut.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    out = None
    for b in range(blocks):
        # a block's size is bounded by block_words (and its hash spread), not by the number of items
        mine = cut.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b).collect()
        index = docs.sparkSession.sparkContext.broadcast(Index.of([(r[0], r[1]) for r in mine], span, k))
        found = _finder(index, span)(F.col(f"`{text}`"))
        if out is None:
            out = docs.withColumn("found", found)
        else:
            out = stored(out, "spans").withColumn("__new", found)
            out = out.withColumn("found", _merged(F.col("found"), F.col("__new"))).drop("__new")
    return out


def hit_words(found: Column) -> Column:
    """Words of a text that lie in any of its spans."""
    inside = F.flatten(F.transform(found["spans"], lambda s: F.sequence(s["start"], s["stop"] - 1)))
    return F.size(F.array_distinct(inside)).cast("long")


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that share nothing with the items, in the columns of ``docs``."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))
    return shared_spans(row, items, **options).filter(F.size("found.spans") == 0).select("__row.*")
