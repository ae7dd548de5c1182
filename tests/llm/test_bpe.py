"""Byte-level BPE against the tiktoken library and against merging by definition."""

import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.frames import odd
from tidewatch.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Encoder(file.read(), P.PATTERN)


@pytest.fixture(scope="module")
def decoder():
    with open(PATH, "rb") as file:
        return bpe.Decoder(file.read())


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def by_definition(ranks, piece):
    """Merges the leftmost pair of the lowest rank until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_queue_gives_the_lowest_rank():
    rng, queue, held = random.Random(1), bpe.RankQueue(70_000), {}
    for _ in range(3000):
        rank = rng.randrange(70_000)
        queue.bucket(rank).append(rank)
        held[rank] = held.get(rank, 0) + 1
        if rng.random() < 0.4:
            low = queue.lowest()
            assert low == min(held) and len(queue.drop(low)) == held.pop(low)
    while held:
        low = queue.lowest()
        assert low == min(held) and len(queue.drop(low)) == held.pop(low)
    assert not queue.buckets and not any(map(any, queue.levels))


def test_ids_are_the_librarys(codec, decoder, library):
    rng = random.Random(2)
    draw = lambda n: "".join(rng.choice("aab bcé  \n\t'sß漢字123٣😀.,!-—tionthe\x00\x1c ") for _ in range(n))
    texts = [draw(rng.randrange(60)) for _ in range(3000)] + ["", " ", "  a", "a  ", "a \n b", "\n", " 's", "x  y"]
    got = codec.encode(pa.array(texts)).to_pylist()
    assert got == [packed(library.encode_ordinary(t)) for t in texts]
    assert [t.decode() for t in decoder.decode(pa.array(got)).to_pylist()] == texts


@pytest.mark.parametrize("text", ["a" * 300_000, "ab" * 200_000, " " * 200_001 + "x", "漢" * 100_000, "the" * 100_000], ids=lambda t: t[:3])
def test_very_long_pretokens(codec, decoder, library, text):
    got = codec.encode(pa.array([text]))[0].as_py()
    assert got == packed(library.encode_ordinary(text)) and decoder.decode(pa.array([got, None])).to_pylist() == [text.encode(), b""]


def test_any_rank_file():
    """Ranks dealt at random: merges uncover lower ranks, overlap, and leave whole tokens unreachable."""
    rng = random.Random(5)
    for _ in range(60):
        tokens = {bytes([b]) for b in b"abc"} | {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(40))}
        tokens = sorted(tokens)
        rng.shuffle(tokens)
        ranks = {t: i for i, t in enumerate(tokens)}
        lines = b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items())
        own = bpe.Encoder(lines, r"\S+|\s+")
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30))) for _ in range(40)] + [b"a" * 17, b"ab" * 9]
        want = [by_definition(ranks, p) for p in pieces]
        ids, length = own.merged(pieces)
        assert length.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
        assert [own.merged_by_place(p) for p in pieces] == want


def test_small_batches_and_unknown_ids(codec, decoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH", 50)
    monkeypatch.setattr(bpe, "GROUP", 3)
    monkeypatch.setattr(bpe, "TOGETHER", 9)
    texts = ["", "a b c d e f", None, "wörter und Sätze " * 9, "x" * 99, "  ", "was it  there?"]
    got = codec.encode(pa.array(texts)).to_pylist()
    assert got == [packed(library.encode_ordinary(t or "")) for t in texts]
    assert [t.decode() for t in decoder.decode(pa.array(got)).to_pylist()] == [t or "" for t in texts]
    with pytest.raises(ValueError):
        decoder.decode(pa.array([packed([2**31])]))


def test_a_full_memory_starts_anew(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 100)
    rng = random.Random(7)
    for _ in range(5):
        texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)) for _ in range(4)]
        assert codec.encode(pa.array(texts)).to_pylist() == [packed(library.encode_ordinary(t)) for t in texts]


def test_odd_tables(spark, library):
    vocab = bpe.vocabulary(spark, PATH, P.PATTERN)
    df = odd(spark).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(1))
    ids = bpe.encoded(F.col("text"), vocab)
    got = df.select("text", ids.alias("own"), bpe.n_tokens(ids).alias("n"), bpe.decoded(ids, vocab).alias("back")).collect()
    assert len(got) == df.count()
    for r in got:
        text = r["text"] or ""
        assert bytes(r["own"]) == packed(library.encode_ordinary(text)) and 4 * r["n"] == len(r["own"]) and bytes(r["back"]) == text.encode()
    assert df.limit(0).select(ids.alias("own")).count() == 0


def test_the_query_matches_the_library(spark, library):
    from tidewatch.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha(packed(ids)), sha((r["text"] or "").encode()))
    got = QUERIES["op12_rank_queue_bpe"](spark, sf)
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == want
