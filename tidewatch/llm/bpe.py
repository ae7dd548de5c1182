"""Byte-level BPE by a rank queue of hierarchical bitmaps.

Pre-tokens start as linked lists of bytes. Every neighbouring pair with a merge rank waits in the bucket of that
rank; a bitmap over the ranks, with a bit per 64 bits below on each level above, names the lowest rank in use by one
find-first-set a level. The places of that bucket are merged from left to right, the new pairs are queued, and places
whose pair has changed since are skipped when they come up. A merge costs a constant number of steps whatever the
length, so a pre-token of a megabyte takes time in proportion to its bytes.

One queue serves all new pre-tokens of a batch of texts: pre-tokens do not touch, so the lowest rank of all is the lowest
of its own pre-token too, and a bucket is merged at once in numpy. Where a merge uncovers a pair of a still lower rank (rank files
that were not trained by merging can hold such), that pre-token is done again place by place.

Texts are independent: the work is a column function without a shuffle. Ids are packed as little-endian
unsigned 32-bit integers. A null text is an empty one, which has no ids; null ids decode to no bytes. Classes of
characters (letter, number, blank) are those of the installed ``regex``.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Characters of pre-tokens that a worker remembers between batches; a full memory starts anew.
REMEMBERED = 1 << 21
#: Bytes of texts split together, bytes of pre-tokens merged in one queue, parts of texts put together at a time.
BATCH, TOGETHER, GROUP = 1 << 21, 1 << 20, 1 << 17


def vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """A rank file (a base64 token and its rank a line), read on the driver, with its split pattern, for all tasks. Its size is
    the vocabulary's, not the data's."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), pattern))


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines.splitlines()))}


class RankQueue:
    """Buckets of whatever waits, by rank; the lowest rank in use is found through the bitmaps."""

    def __init__(self, ranks: int):
        self.levels, n = [], ranks
        while True:
            n = (n + 63) >> 6
            self.levels.append([0] * n)
            if n <= 1:
                break
        self.buckets: dict[int, list] = {}

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, marked as in use."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = []
            for level in self.levels:
                word = level[rank >> 6]
                level[rank >> 6] = word | 1 << (rank & 63)
                if word:
                    break
                rank >>= 6
        return found

    def lowest(self) -> int:
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | ((word & -word).bit_length() - 1)
        return rank

    def drop(self, rank: int) -> list:
        """Takes a bucket out."""
        found, at = self.buckets.pop(rank), rank
        for level in self.levels:
            word = level[at >> 6] = level[at >> 6] & ~(1 << (at & 63))
            if word:
                break
            at >>= 6
        return found


class Encoder:
    """Ids by the ranks of one vocabulary."""

    def __init__(self, lines: bytes, pattern: str):
        self.ranks = read_ranks(lines)
        self.size = max(self.ranks.values()) + 1
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks.get(bytes([b]), self.size) for b in range(256)], np.int64)
        # pairs of tokens that together are a token, as left * (size + 1) + right
        splits = [
            (self.ranks[t[:i]] * (self.size + 1) + self.ranks[t[i:]], r)
            for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        splits.append((1 << 62, 0))
        self.pairs, self.made = np.array(sorted(splits), np.int64).T.copy()
        self.forget()

    def forget(self) -> None:
        self.pieces, self.piece_ids = _Numbers(), _Lists()

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 where they make none."""
        key = left.astype(np.int64) * (self.size + 1) + right
        at = self.pairs.searchsorted(key)
        return np.where(self.pairs[at] == key, self.made[at], -1)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, one after the other, and how many each has; all in one queue."""
        none, queue = self.size, RankQueue(self.size)
        # a place that pairs with nothing stands before, between and after the pre-tokens
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths + 1)
        token = np.full(1 + ends[-1], none, np.int32)
        inside = np.ones(len(token), bool)
        inside[0] = False
        inside[ends] = False
        token[inside] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.arange(1, len(token) + 1, dtype=np.int32), np.arange(-1, len(token) - 1, dtype=np.int32)
        waiting = np.full(len(token), -1, np.int32)
        waiting[:-1] = self.pair_ranks(token[:-1], token[1:])
        uncovered: set[int] = set()

        def push(places: np.ndarray, ranks: np.ndarray) -> None:
            order = ranks.argsort(kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            start = 0
            for rank, stop in zip(ranks[np.r_[0, cuts]].tolist(), [*cuts.tolist(), len(ranks)]):
                queue.bucket(rank).append(places[start:stop])
                start = stop

        paired = np.flatnonzero(waiting >= 0)
        if len(paired):
            push(paired, waiting[paired])
        while queue.buckets:
            rank = queue.lowest()
            bucket = queue.drop(rank)
            p = np.concatenate(bucket) if len(bucket) > 1 else bucket[0]
            p = p[waiting[p] == rank]
            if not len(p):
                continue
            if len(p) > 1:
                p = np.sort(p)
                p = p[np.r_[True, p[1:] != p[:-1]]]
                chained = np.r_[False, after[p[:-1]] == p[1:]]
                if chained.any():
                    # of a run of overlapping pairs, every other one from the left
                    at = np.arange(len(p))
                    p = p[(at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0]
            q = after[p]
            end = after[q]
            # merges side by side: one by one, the left one would first have met the right one's old token
            beside = np.flatnonzero(end[:-1] == p[1:])
            if len(beside):
                met = self.pair_ranks(np.full(len(beside), rank), token[p[beside + 1]])
                uncovered.update(np.searchsorted(ends, p[beside[(met >= 0) & (met < rank)]]).tolist())
            token[p] = rank
            waiting[q] = -1
            inside[q] = False
            after[p] = end
            before[end] = p
            left = np.concatenate((before[p], p))
            ranks = self.pair_ranks(token[left], token[after[left]])
            waiting[left] = ranks
            new = ranks >= 0
            if new.any():
                left, ranks = left[new], ranks[new]
                low = ranks < rank
                if low.any():
                    uncovered.update(np.searchsorted(ends, left[low]).tolist())
                push(left, ranks)
        ids = token[inside].astype(np.uint32)
        length = np.diff(np.cumsum(inside)[ends], prepend=0)
        alone = uncovered.union(i for i, n in enumerate(length.tolist()) if n > 1 and pieces[i] in self.ranks)
        if alone:
            found = np.split(ids, np.cumsum(length)[:-1])
            for i in alone:
                found[i] = np.array(self.merged_by_place(pieces[i]), np.uint32)
            ids, length = np.concatenate(found), np.array([len(f) for f in found])
        return ids, length

    def merged_by_place(self, piece: bytes) -> list[int]:
        """The ids of one pre-token by single merges, in a queue of its own."""
        ranks, queue, n = self.ranks, RankQueue(self.size), len(piece)
        if piece in ranks:
            return [ranks[piece]]
        after, before, waiting = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n

        def look(i: int) -> None:
            """Queues the pair that starts at place i."""
            gone = after[i]
            rank = ranks.get(piece[i : after[gone]]) if gone < n else None
            waiting[i] = -1 if rank is None else rank
            if rank is not None:
                heappush(queue.bucket(rank), i)

        for i in range(n - 1):
            look(i)
        while queue.buckets:
            rank = queue.lowest()
            i = heappop(queue.buckets[rank])
            if not queue.buckets[rank]:
                queue.drop(rank)
            if waiting[i] != rank:
                continue
            gone = after[i]
            waiting[gone] = -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, texts: pa.Array) -> pa.Array:
        """The packed ids of texts."""
        texts = texts.cast(pa.large_string()).fill_null("")
        upto = np.r_[0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]
        done, start = [pa.array([], pa.binary())], 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(upto, upto[start] + BATCH, "right")) - 1)
            done += self._encode(texts.slice(start, stop - start))
            start = stop
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(done)

    def _encode(self, texts: pa.Array) -> list[pa.Array]:
        """The packed ids of some texts.

        No pre-token reaches over a space between two characters that are no blanks. Texts are cut at their spaces and what follows
        a space is split by the pattern once a batch; a text with a space beside another blank is split whole."""
        if self.pieces.chars > REMEMBERED:
            self.forget()
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        unit, spaced = coded.indices.to_numpy(zero_copy_only=False).copy(), coded.dictionary.to_pylist()
        first, counts = bounds[:-1], np.diff(bounds)
        starts = [spaced[i] for i in unit[first].tolist()]
        edge = np.array([not c or c[0].isspace() or c[-1].isspace() for c in spaced], bool)[unit]
        edge[first] = [not c or c[-1].isspace() for c in starts]
        whole = np.flatnonzero(np.logical_or.reduceat(edge, first) & (counts > 1)) if len(first) else first
        # a text's first unit is its own: what stands before its first space, or all of it
        unit[first] = len(spaced) + np.arange(len(first))
        for i in whole.tolist():
            starts[i] = texts[i].as_py()
            unit[first[i] + 1 : bounds[i + 1]] = -1
        counts[whole] = 1
        units = self._split([" " + c for c in spaced] + starts)
        unit = unit[unit >= 0]
        cuts, done, start = np.r_[0, np.cumsum(counts)], [], 0
        while start < len(counts):
            stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + GROUP, "right")) - 1)
            ids, length = units.read(unit[cuts[start] : cuts[stop]])
            offsets = np.r_[0, np.cumsum(length)][cuts[start : stop + 1] - cuts[start]] * 4
            packed = ids.astype("<u4", copy=False)
            done.append(pa.Array.from_buffers(pa.binary(), stop - start, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(packed)]))
            start = stop
        return done

    def _split(self, units: list[str]) -> _Lists:
        """The ids of each unit: its matches of the pattern, the new ones of them merged."""
        counts, found, number = [], [], self.pieces.__getitem__
        for unit in units:
            matches = self.pattern.findall(unit)
            counts.append(len(matches))
            found += map(number, matches)
        new = [piece.encode() for piece in self.pieces.new]
        self.pieces.new.clear()
        start = 0
        while start < len(new):
            stop, held = start, 0
            while stop < len(new) and (stop == start or held + len(new[stop]) <= TOGETHER):
                held += len(new[stop])
                stop += 1
            self.piece_ids.add(*self.merged(new[start:stop]))
            start = stop
        ids, length = self.piece_ids.read(np.array(found, np.int32))
        lists = _Lists()
        lists.add(ids, np.diff(np.r_[0, np.cumsum(length)][np.cumsum(counts, dtype=np.int64)], prepend=0))
        return lists


class Decoder:
    """Bytes of the ids of one vocabulary."""

    def __init__(self, lines: bytes):
        ranks = read_ranks(lines)
        tokens = dict(zip(ranks.values(), ranks))
        self.known = np.array([i in tokens for i in range(max(tokens) + 1)])
        tokens = [tokens.get(i, b"") for i in range(len(self.known))]
        self.tokens = _Lists(np.uint8)
        self.tokens.add(np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int64, len(tokens)))

    def decode(self, packed: pa.Array) -> pa.Array:
        """The texts' bytes; an id without a token is an error."""
        packed, done, start = packed.cast(pa.large_binary()).fill_null(b""), [pa.array([], pa.binary())], 0
        upto = np.r_[0, np.cumsum(pc.binary_length(packed).to_numpy(zero_copy_only=False))]
        while start < len(packed):
            stop = max(start + 1, int(np.searchsorted(upto, upto[start] + 4 * GROUP, "right")) - 1)
            ids = np.frombuffer(b"".join(packed.slice(start, stop - start).to_pylist()), "<u4")
            if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
                raise ValueError("an id that no token has")
            text, length = self.tokens.read(ids)
            offsets = np.r_[0, np.cumsum(length)][(upto[start : stop + 1] - upto[start]) // 4]
            done.append(pa.Array.from_buffers(pa.binary(), stop - start, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text)]))
            start = stop
        return pa.concat_arrays(done)


class _Lists:
    """Lists of ids, all in one array."""

    def __init__(self, kind: type = np.uint32):
        self.first = self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, kind)

    def add(self, ids: np.ndarray, length: np.ndarray) -> None:
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(length) - length))
        self.length = np.concatenate((self.length, length))
        self.ids = np.concatenate((self.ids, ids))

    def read(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some lists, one after the other, and how many each has."""
        length = self.length[lists]
        at = np.repeat(self.first[lists] - np.cumsum(length) + length, length)
        at += np.arange(len(at))
        return self.ids[at], length


class _Numbers(dict):
    """Text to a running number."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        self.chars += len(part) + 1
        return number


#: The encoders and decoders of this worker.
_CODECS: dict[tuple[type, int], Encoder | Decoder] = {}


def _codec(kind: type, vocab: Broadcast, *more: str) -> Encoder | Decoder:
    key = (kind, hash(vocab.value))
    if key not in _CODECS:
        _CODECS[key] = kind(vocab.value[0], *more)
    return _CODECS[key]


def encoded(text: Column, vocab: Broadcast) -> Column:
    """Packed ids of a text column (binary, never null)."""

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return _codec(Encoder, vocab, vocab.value[1]).encode(texts)

    # else every later use of the column would encode again
    return ids.asNondeterministic()(text)


def decoded(ids: Column, vocab: Broadcast) -> Column:
    """The bytes that packed ids stand for (binary, never null)."""

    @F.arrow_udf("binary")
    def texts(packed: pa.Array) -> pa.Array:
        return _codec(Decoder, vocab).decode(packed)

    return texts(ids)


def round_trip(text: Column, vocab: Broadcast) -> Column:
    """Both, decoded where the ids were made: a struct of ids and decoded."""

    @F.arrow_udf("ids binary, decoded binary")
    def both(texts: pa.Array) -> pa.Array:
        ids = _codec(Encoder, vocab, vocab.value[1]).encode(texts)
        return pa.StructArray.from_arrays([ids, _codec(Decoder, vocab).decode(ids)], ["ids", "decoded"])

    return both.asNondeterministic()(text)


def n_tokens(ids: Column) -> Column:
    return F.shiftright(F.length(ids), 2).cast("long")
