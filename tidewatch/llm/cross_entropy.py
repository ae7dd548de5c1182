"""Cross-entropy difference: per-token loss under a target model less that under a background model.

Both are interpolated trigram models over one vocabulary, the 256 bytes of UTF-8 and an end mark that shares byte 0, so
each has at most 2**24 trigrams whatever the corpus: that bound is why the table of loss differences may go to every
task. They are matched: same order, vocabulary and smoothing, and background counts are scaled to the target's
number of tokens. The counts cover the whole text of every document; map tasks add them up before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER, VOCABULARY = 3, 256
GRAMS = VOCABULARY**ORDER
#: Pseudo-counts that the shorter context's distribution adds to a context.
SMOOTHING = 8.0
#: Bytes of a text that are counted at a time.
_CHUNK = 4 << 20


def text_grams(text: str) -> Iterator[np.ndarray]:
    """Trigram numbers of a text in order, a chunk at a time: one for each byte and one for the end. Two marks (byte 0)
    stand before the text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    for lo in range(0, len(data) + 1, _CHUNK):
        hi = min(len(data) + 1, lo + _CHUNK)
        head = np.concatenate([np.zeros(max(0, 2 - lo), np.uint8), data[max(0, lo - 2) : lo]])
        tail = np.zeros(1 if hi == len(data) + 1 else 0, np.uint8)
        b = np.concatenate([head, data[lo:hi], tail]).astype(np.uint32)
        yield (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


def _grams_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Trigrams of many texts, small ones joined."""
    held, size = [], 0
    for text in texts:
        for g in text_grams(text) if text else ():
            held.append(g)
            size += len(g)
            if size >= _CHUNK:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def gram_counts(docs: DataFrame, text: str, target: str) -> DataFrame:
    """(gram, target, background): counts over the texts whose ``target`` is true and over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, GRAMS), np.uint32)
        for batch in batches:
            mine = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for k, chosen in ((0, mine), (1, ~mine)):
                for g in _grams_of(batch.column(0).filter(pa.array(chosen)).to_pylist()):
                    counts[k] += np.bincount(g, minlength=GRAMS).astype(np.uint32)
        seen = np.flatnonzero(counts.any(axis=0))
        for lo in range(0, len(seen), 1 << 16):
            g = seen[lo : lo + (1 << 16)]
            own = counts[0][g].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(own), pa.array(own + counts[1][g])], ["gram", "target", "background"])

    narrow = docs.select(F.col(f"`{text}`").alias("text"), F.col(target).alias("target"))
    parts = narrow.mapInArrow(run, "gram int, target long, background long")
    return parts.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def _log_probabilities(counts: np.ndarray, smoothing: float) -> np.ndarray:
    """Natural log of P(c | a, b) for each trigram, from (scaled) counts."""
    c3 = counts.reshape(VOCABULARY, VOCABULARY, VOCABULARY)
    c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
    p1 = (c1 + 1.0 / VOCABULARY) / (c1.sum() + 1.0)
    p2 = (c2 + smoothing * p1) / (c2.sum(axis=1, keepdims=True) + smoothing)
    out = np.empty((VOCABULARY, VOCABULARY, VOCABULARY), np.float32)
    for a in range(VOCABULARY):
        out[a] = np.log((c3[a] + smoothing * p2) / (c3[a].sum(axis=1, keepdims=True) + smoothing))
    return out.reshape(-1)


def loss_differences(counts: DataFrame, smoothing: float = SMOOTHING) -> np.ndarray:
    """Per trigram, loss under the target model less loss under the background model, in nats. The table of counts has at
    most GRAMS rows."""
    rows = counts.toArrow()
    gram = rows["gram"].to_numpy()
    target, background = np.zeros(GRAMS, np.float32), np.zeros(GRAMS, np.float32)
    target[gram], background[gram] = rows["target"].to_numpy(), rows["background"].to_numpy()
    n_target, n_background = target.sum(dtype=np.float64), background.sum(dtype=np.float64)
    if n_target == 0:  # no target text: nothing to tell the models apart
        return np.zeros(GRAMS, np.float32)
    background *= np.float32(n_target / n_background)
    return _log_probabilities(background, smoothing) - _log_probabilities(target, smoothing)


def scored(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", smoothing: float = SMOOTHING) -> DataFrame:
    """(doc_id, n_tokens, score): the mean loss difference of each text; the lower, the more like the target.

    ``target_ids`` (doc_id) names the target's documents; repeated or null ids and ids of no document do no harm. The
    background is every document, the target's among them. A null or empty text has no tokens and a null score;
    others have one per UTF-8 byte and one for the end. Every row of ``docs`` gives one row, repeated rows count each.
    Without target texts every score is 0; an empty table gives no row; other columns are not read.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    chosen = target_ids.select(F.col("doc_id"), F.lit(True).alias("__target")).filter("doc_id IS NOT NULL").distinct()
    # one plan at every size: ids that a broadcast could hold today are many tomorrow
    marked = narrow.join(chosen.hint("merge"), "doc_id", "left").withColumn("__target", F.coalesce("__target", F.lit(False)))
    table = loss_differences(gram_counts(marked, "text", "__target"), smoothing)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = shared.value
        for batch in batches:
            n, score = [], []
            for text in batch.column(1).to_pylist():
                total, tokens = 0.0, 0
                for g in text_grams(text) if text else ():
                    total += float(loss[g].sum(dtype=np.float64))
                    tokens += len(g)
                n.append(tokens)
                score.append(total / tokens if tokens else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(score, pa.float64())], ["doc_id", "n_tokens", "score"])

    schema = narrow.select("doc_id").schema.add("n_tokens", "long").add("score", "double")
    return narrow.mapInArrow(run, schema)
