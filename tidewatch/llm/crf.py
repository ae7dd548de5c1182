"""Language identification of code-switched text by a linear-chain conditional random field.

Every word is labelled: its features are prefixes and suffixes (affixes), inner byte n-grams and the word itself
(lexicon), hashed into one weight table; learned transitions tie a word's label to the one before. Word posteriors come
from an exact forward-backward pass and are summed over a text. Training texts are spliced in pairs, so that
sequences switch language and the transitions are learned from switches. ``labelled`` returns the words' labels as runs,
``predicted`` what they add up to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.tokens import Words, byte_table, mixed, words_of

#: Documents per language that the model is fitted on: the bound of the fit.
SAMPLE_DOCS = 150
TABLE_BITS, AFFIX, NGRAMS = 16, 4, (2, 3)
EPOCHS, BATCHES, RATE, DECAY = 6, 8, 0.2, 1e-6
UNKNOWN = "und"
#: Words that a scan step handles side by side.
_SEGMENT = 64
_SPACES = byte_table(b" ")


def letters(text: Column) -> Column:
    """The text lowered, with each run of non-letters as one blank."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " ")


def _slots(h: np.ndarray, kind: int) -> np.ndarray:
    salted = mixed(h + np.uint64((kind * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    return (salted >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


def features(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (word, slot), words ascending within a pair."""
    every = np.arange(len(w.start))
    yield every, _slots(w.hash, 1)
    text = w.text.astype(np.uint64)
    end = w.start + w.length
    for n in range(1, AFFIX + 1):
        has = every[w.length >= n]
        head, tail = np.zeros(len(has), np.uint64), np.zeros(len(has), np.uint64)
        for j in range(n):
            head = head * np.uint64(257) + text[w.start[has] + j]
            tail = tail * np.uint64(257) + text[end[has] - n + j]
        yield has, _slots(head, 10 + n)
        yield has, _slots(tail, 20 + n)
    word = np.repeat(every, w.length)
    at = np.arange(len(word)) - np.repeat(np.cumsum(w.length) - w.length, w.length) + np.repeat(w.start, w.length)
    left = np.repeat(end, w.length) - at
    for n in NGRAMS:
        fits = left >= n
        p, gram = at[fits], np.zeros(int(fits.sum()), np.uint64)
        for j in range(n):
            gram = gram * np.uint64(257) + text[p + j]
        yield word[fits], _slots(gram, 30 + n)


def emissions(w: Words, table: np.ndarray) -> np.ndarray:
    """(words, labels) scores: the weights of each word's features added up."""
    out = np.zeros((len(w.start), table.shape[1]), np.float32)
    for word, slot in features(w):
        if len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[first]] += np.add.reduceat(table[slot], first, axis=0)
    return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.max(axis=tuple(range(1, x.ndim)), keepdims=True), 1e-30)


def posteriors(scores: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word posteriors (words, labels) and summed pair posteriors (labels, labels) of sequences of the given lengths (none
    empty) that follow each other in ``scores``.

    The exact forward-backward pass, cut into segments of 64 words: transfer matrices of all segments are built side by side,
    messages run from segment to segment, then within all segments side by side."""
    n, k = scores.shape
    if not n:
        return scores, np.zeros((k, k))
    e, t = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64), np.exp(transitions)
    parts = -(-lengths // _SEGMENT)
    of = np.repeat(np.arange(len(lengths)), parts)
    order = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(np.cumsum(lengths) - lengths, parts) + order * _SEGMENT
    size = np.minimum(_SEGMENT, np.repeat(lengths, parts) - order * _SEGMENT)
    steps = int(size.max())
    inside = np.arange(steps)[None, :] < size[:, None]
    place = np.where(inside, start[:, None] + np.arange(steps)[None, :], 0)
    x = e[place]
    transfer = np.broadcast_to(np.eye(k), (len(of), k, k)).copy()
    for j in range(steps):
        m = inside[:, j]
        transfer[m] = _scaled((transfer[m] @ t) * x[m, j][:, None, :])
    before, after = np.full((len(of), k), 1.0 / k), np.ones((len(of), k))
    # rank of a segment within its sequence, ascending then descending
    by_rank = np.argsort(order, kind="stable")
    edges = np.cumsum(np.bincount(order))
    for r in range(1, len(edges)):
        s = by_rank[edges[r - 1] : edges[r]]
        before[s] = _scaled(np.einsum("si,sij->sj", before[s - 1], transfer[s - 1]))
    for r in range(len(edges) - 1, 0, -1):
        s = by_rank[edges[r - 1] : edges[r]]
        after[s - 1] = _scaled(np.einsum("sij,sj->si", transfer[s], after[s]))
    forward = np.empty((len(of), steps + 1, k))
    forward[:, 0] = before
    for j in range(steps):
        forward[:, j + 1] = np.where(inside[:, j, None], _scaled((forward[:, j] @ t) * x[:, j]), forward[:, j])
    post, pairs, b = np.zeros((n, k), np.float32), np.zeros((k, k)), after
    for j in range(steps - 1, -1, -1):
        m = inside[:, j]
        both = forward[m, j + 1] * b[m]
        post[place[m, j]] = both / both.sum(axis=1, keepdims=True)
        message = x[m, j] * b[m]
        inner = (order[m] > 0) | (j > 0)  # the first word of a sequence has none before it
        joint = forward[m, j][inner][:, :, None] * t * message[inner][:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = b.copy()
        b[m] = _scaled(message @ t.T)
    return post, pairs


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray
    transitions: np.ndarray


def fit(texts: list[str], langs: list[str]) -> Model:
    """The model of maximal conditional likelihood by AdaGrad over a few batches of spliced sequences."""
    labels = sorted(set(langs))
    k = len(labels)
    table, transitions = np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((k, k))
    square, square_t = np.full_like(table, 1e-6), np.full((k, k), 1e-6)
    number = {x: i for i, x in enumerate(labels)}
    batches = []
    for b in range(min(BATCHES, len(texts))):
        mine = range(b, len(texts), min(BATCHES, len(texts)))
        # the first half of each text is followed by the second half of the next
        halves = [texts[i].split(" ") for i in mine]
        joined, y, lengths = [], [], []
        for i, (own, d) in enumerate(zip(halves, mine, strict=True)):
            j = (i + 1) % len(halves)
            other, o = halves[j], mine[j]
            a, c = [x for x in own[: (len(own) + 1) // 2] if x], [x for x in other[(len(other) + 1) // 2 :] if x]
            if a or c:
                joined += a + c
                y += [number[langs[d]]] * len(a) + [number[langs[o]]] * len(c)
                lengths.append(len(a) + len(c))
        if not joined:
            continue
        ws = list(words_of(pa.array([" ".join(joined)]), _SPACES))[0]
        batches.append((ws, list(features(ws)), np.array(y), np.array(lengths)))
    for _ in range(EPOCHS):
        for ws, found, y, lengths in batches:
            post, pairs = posteriors(emissions(ws, table), transitions, lengths)
            off = -post
            off[np.arange(len(y)), y] += 1
            gradient = -DECAY * len(y) * table
            for word, slot in found:
                for label in range(k):
                    gradient[:, label] += np.bincount(slot, weights=off[word, label], minlength=1 << TABLE_BITS)
            inner = np.ones(len(y), bool)
            inner[np.cumsum(lengths) - lengths] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
            square += gradient**2
            table += (RATE * gradient / np.sqrt(square)).astype(np.float32)
            change = seen - pairs - DECAY * len(y) * transitions
            square_t += change**2
            transitions += RATE * change / np.sqrt(square_t)
    return Model(labels, table, transitions)


def fitted(docs: DataFrame, doc_id: str, text: str, lang: str, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The model of ``sample_docs`` documents per language (all, if it has fewer): those of the smallest hashes of id and text, copies
    once. Null languages and texts without a letter teach nothing. None if there is nothing to learn from."""
    h = F.xxhash64(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.col(f"`{text}`"), F.lit("fit"))
    named = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), h.alias("h"))
    named = named.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # a task hands on at most so many hashes of a language
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    first = named.select("lang", "h").distinct().withColumn("n", place).filter(F.col("n") <= sample_docs)
    chosen = named.join(first, ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["h"], r["text"], r["lang"]) for batch in batches for r in batch.to_pylist())
        if rows:
            m = fit([r[1] for r in rows], [r[2] for r in rows])
            yield pa.RecordBatch.from_pylist([{"labels": m.labels, "weights": m.table.tobytes(), "transitions": m.transitions.tobytes()}])

    # the sample is bounded, so one task fits the model
    one = chosen.select("h", letters(F.col("text")).alias("text"), "lang").repartition(1)
    row = one.mapInArrow(run, "labels array<string>, weights binary, transitions binary").first()
    if row is None:
        return None
    k = len(row[0])
    return Model(list(row[0]), np.frombuffer(row[1], np.float32).reshape(-1, k), np.frombuffer(row[2], np.float64).reshape(k, k))


def labelled(docs: DataFrame, model: Model | None, text: str = "text", runs: str = "runs") -> DataFrame:
    """``docs`` with ``runs`` (replaced if there is one): the text's words in order as runs of one label, each (start, stop, lang,
    score, mass).

    Words are those of ``letters``, numbered from 0; a run holds the words from start up to, without, stop. A word's label is the
    one of its greatest posterior, ties going to the first label by name; score is the mean of that posterior over the
    run's words. mass has, in the labels' order by name, the posteriors of the run's words, each word weighing its bytes. A null text, or one without a letter, has no run, as has every text if nothing was learned.
    """
    fields = "array<struct<start: int, stop: int, lang: string, score: double, mass: array<double>>>"
    if model is None:
        return docs.withColumn(runs, F.array().cast(fields))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([
        ("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string()), ("score", pa.float64()), ("mass", pa.list_(pa.float64())),
    ]))

    def run(column: pa.Array) -> pa.Array:
        m = shared.value
        k = len(m.labels)
        labels = pa.array(m.labels, pa.string())
        made = []
        for w in words_of(column, _SPACES):
            counts = np.bincount(w.doc, minlength=w.count)
            post, _ = posteriors(emissions(w, m.table), m.transitions, counts[counts > 0])
            best = post.argmax(axis=1)
            changes = np.ones(len(best), bool)
            changes[1:] = (best[1:] != best[:-1]) | (w.doc[1:] != w.doc[:-1])
            first = np.flatnonzero(changes)
            stop, of, doc = np.r_[first[1:], len(best)][: len(first)], np.cumsum(changes) - 1, w.doc[first]
            total = lambda x, of=of, n=len(first): np.bincount(of, weights=x, minlength=n)
            before = (np.cumsum(counts) - counts)[doc]
            score = total(post[np.arange(len(best)), best]) / np.maximum(stop - first, 1)
            mass = np.stack([total(post[:, j] * w.length) for j in range(k)], axis=1)
            spans = pa.StructArray.from_arrays([
                pa.array((first - before).astype(np.int32)), pa.array((stop - before).astype(np.int32)), labels.take(pa.array(best[first])),
                pa.array(score.clip(0, 1)), pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * k), pa.array(mass.reshape(-1))),
            ], names=["start", "stop", "lang", "score", "mass"])
            offsets = np.r_[0, np.cumsum(np.bincount(doc, minlength=w.count))].astype(np.int32)
            made.append(pa.ListArray.from_arrays(pa.array(offsets), spans))
        return pa.concat_arrays(made) if made else pa.array([], kind)

    some = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    found = F.arrow_udf(run, fields)(letters(F.col(f"`{text}`")))
    return docs.withColumn(runs, F.when(some, found).otherwise(F.array().cast(fields)))


def predicted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replaced if there are such): the label of the greatest posterior over the
    whole text, each word weighing its bytes, and its share, from 0 to 1: what the runs of ``labelled`` add up to.

    A null text, or one without a letter, is "und" with score 0, as is every text if nothing was learned. Ties go to the
    first label by name. Repeated rows are predicted alike; an empty table gives no row.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    out = labelled(docs, model, text, "__runs")
    label = lambda j: F.aggregate("__runs", F.lit(0.0), lambda total, r: total + F.get(r["mass"], F.lit(j)))
    out = out.withColumn("__mass", F.array(*[label(j) for j in range(len(model.labels))]))
    most, total = F.array_max("__mass"), F.aggregate("__mass", F.lit(0.0), lambda a, b: a + b)
    name = F.element_at(F.array(*map(F.lit, model.labels)), F.array_position("__mass", most).cast("int"))
    some = F.size("__runs") > 0
    return out.withColumns({
        "lang_pred": F.when(some, name).otherwise(UNKNOWN), "score": F.when(some, F.least(most / total, F.lit(1.0))).otherwise(0.0),
    }).drop("__runs", "__mass")
