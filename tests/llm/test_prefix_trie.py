"""The conversation trie against a trie built in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from tests.llm.frames import clashing
from tidewatch.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    """conv_id -> list of (role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def by_definition(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = {}
    for path in sorted(members, key=len, reverse=True):
        children = [p for p in members if len(p) == len(path) + 1 and p[: len(path)] == path]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves = sum(nodes[p][5] for p in children) or 1
        saved = (len(members[path]) - 1) * words + sum(nodes[p][6] for p in children)
        ends = ",".join(str(c) for c in sorted(members[path]) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        nodes[path] = (min(members[path]), len(path), parent, len(members[path]), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(nodes.values(), key=lambda n: n[:2])


def draw(seed, n=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([turn, turn, turn + 0]), rng.choice(["user", "bot"]) if rng.random() < 0.3 else "user", rng.choice(["a b", "a b", "c", " d\t e f "])))
    return rows


def run(spark, rows, limit=T.MAX_GROUP_ROWS, chunk=T.CHUNK, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = T.trie(*T.rebuilt(T.turns(df, limit)), chunk, limit)
    assert sorted(found.columns) == sorted(COLUMNS)
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=lambda n: n[:2])


@pytest.mark.parametrize("seed", [1])
def test_nodes_are_those_of_the_trie(spark, seed):
    rows = draw(seed)
    assert run(spark, rows) == by_definition(rebuilt(rows))


def test_large_groups_and_long_conversations(spark):
    """One conversation of 150 turns, and forty equal ones, whose rows and ids are cut into small pieces."""
    rng = random.Random(4)
    rows = draw(3, 30) + [(40, i, "user", rng.choice("ab")) for i in range(150)] + [(41, i, "user", "a") for i in range(64)]
    rows += [(c, i, "user", "same" if i else "first") for c in range(100, 140) for i in range(2)]
    assert run(spark, rows, limit=10, chunk=7) == by_definition(rebuilt(rows))


def test_odd_rows(spark):
    """Nulls everywhere, repeated rows and turns, a turnless conversation (21: all of its turns are the base's, which is
    absent), ids without a turn of their own left, negative ids, an empty and a very long text."""
    gone = next(c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = draw(5, 10) + [
        (None, 1, "user", "x"), (50, None, None, None), (50, None, None, None), (50, 2, "bot", ""), (50, 2, "bot", "b"), (50, 2, "Bot", "a"),
        (gone, 1, "user", "x"), (gone, 2, "user", "y"), (-3, 0, "user", "a b"), (-3, 1, None, "c"), (60, 0, "user", "w " * 100_000), (61, 0, "user", "w " * 100_000),
        (62, 0, "a", "b:1"), (63, 0, "a:1", "b"), (64, 0, "ab", ""), (65, 0, "", "ab"),
    ]
    want = rebuilt([r for r in rows if r[0] is None or r[0] >= 0])
    assert want[gone] == []
    assert run(spark, [r for r in rows if r[0] is None or r[0] >= 0]) == by_definition(want)
    assert {r[0] for r in run(spark, rows)} >= {-3}


def test_empty_and_clashing_tables(spark):
    assert run(spark, []) == []
    rows = draw(6, 25, 4)
    df = clashing(spark.createDataFrame(rows, SCHEMA), "depth", "symbol", "tokens", "block", "node", "base", "h", "at")
    found = T.trie(*T.rebuilt(T.turns(df)))
    assert sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=lambda n: n[:2]) == by_definition(rebuilt(rows))


def test_only_turnless_conversations(spark):
    gone = [c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4 == 3]
    rows = [(c, 1, "user", "x") for c in gone]
    assert run(spark, rows) == by_definition(rebuilt(rows)) and len(run(spark, rows)) == 1


def test_the_query_matches_the_definition(spark):
    from tidewatch.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_prefix_trie"](spark, sf).select(*COLUMNS).collect()), key=lambda n: n[:2])
    assert got == by_definition(rebuilt(rows))
