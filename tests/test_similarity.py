import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import similarity as S


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(90, 6))
    rows[10] = rows[3]  # an exact copy: the smaller id wins
    return rows, spark.createDataFrame([(i, [float(x) for x in v], f"c{i % 4}") for i, v in enumerate(rows)], "id long, embedding array<float>, category string").cache()


def brute(rows, k, metric, skip_same):
    x = rows.astype(np.float32).astype(np.float64)
    if metric == "cosine":
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        d = 1 - u @ u.T
    else:
        d = ((x[:, None] - x[None]) ** 2).sum(-1)
    if skip_same:
        np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), np.round(d, 9)), axis=1)
    return {i: list(order[i, :k]) for i in range(len(x))}


@pytest.mark.parametrize("metric", ["cosine", "squared_l2"])
@pytest.mark.parametrize("block_bytes,query_rows", [(1 << 20, 1000), (600, 25)])
def test_nearest(vectors, metric, block_bytes, query_rows):
    rows, df = vectors
    got = S.nearest(df, df, "id", "id", k=3, metric=metric, skip_same=True, block_bytes=block_bytes, query_rows=query_rows)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["id"]
    assert {q: [f[1], f[2], f[3]] for q, f in found.items()} == brute(rows, 3, metric, True)


@pytest.mark.parametrize("metric", ["cosine", "squared_l2"])
def test_balls_give_the_same_with_ties_zeros_and_copies(spark, metric):
    rng = np.random.default_rng(7)
    rows = np.round(rng.normal(size=(80, 3)), 1)
    rows[20:50] = rows[20]  # one ball of copies, larger than a part
    rows[60:64] = 0.0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, embedding array<float>")
    got = lambda **options: sorted(map(tuple, S.nearest(df, df, "id", "id", k=4, metric=metric, skip_same=True, **options).select("query_id", "rank", "id").collect()))
    assert got(block_bytes=8 * 3 * 9, query_rows=11) == got()


def test_excluded_balls_are_not_visited(spark):
    """Eight far clusters: a query meets its own, and only queries and rows of it."""
    from tidewatch.operators import metric_index as X

    rng = np.random.default_rng(9)
    spots = rng.normal(size=(8, 5)) * 100
    rows = np.vstack([s + rng.normal(size=(40, 5)) for s in spots])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, embedding array<double>")
    q, i = df.select(F.col("id").alias("_q"), F.col("embedding").alias("_qv")), df.select(F.col("id").alias("_i"), F.col("embedding").alias("_iv"))
    held, balls = X.indexed(i, "squared_l2", 320, 10)
    assert len(balls.value.centers) == 32 and balls.value.count.sum() == 320
    met, found = X.visits(q, balls, held, 3, "squared_l2", True, "q long, id long, distance double, rank int", 10, 50)
    assert met.count() == met.distinct().count() < 320 * 8
    best = {}
    for r in sorted(found.collect(), key=lambda r: (r["q"], round(r["distance"], 9), r["id"])):
        best.setdefault(r["q"], []).append(r["id"])
    assert {a: b[:3] for a, b in best.items()} == brute(rows, 3, "squared_l2", True)


@pytest.mark.parametrize("group_bytes", [1 << 23, 8 * 3 * 25, 8])
@pytest.mark.parametrize("metric", ["cosine", "squared_l2"])
def test_a_query_is_sent_once_to_a_group_of_balls(spark, monkeypatch, metric, group_bytes):
    """Vectors without clusters, where bounds exclude little: a row per query and group, not per query and ball."""
    from tidewatch.operators import metric_index as X

    monkeypatch.setattr(X, "GROUP_BYTES", group_bytes)
    rng = np.random.default_rng(13)
    rows = np.round(rng.normal(size=(120, 3)), 1)
    rows[50:90] = rows[50]
    rows[100:103] = 0.0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, embedding array<float>")
    sent, searched = [], X._searched
    monkeypatch.setattr(X, "_searched", lambda asked, *a: sent.append(asked) or searched(asked, *a))
    got = lambda **options: sorted(map(tuple, S.nearest(df, df, "id", "id", k=4, metric=metric, skip_same=True, **options).select("query_id", "rank", "id").collect()))
    assert got(block_bytes=8 * 3 * 6, query_rows=11) == got()
    near, far = sent
    assert far.count() == far.select("_q", "_group").distinct().count()
    if group_bytes == 1 << 23:
        assert near.count() == 120 and far.count() <= 120


def test_distances_are_held_by_tile(monkeypatch):
    """Memory does not grow with the known vectors, and ties across tiles go to the smaller id."""
    import tracemalloc

    from tidewatch.functions import vectors as N

    rng = np.random.default_rng(11)
    known = rng.normal(size=(20_000, 4))
    tracemalloc.start()
    got = N.nearest_rows(np.arange(2048), known[:2048], np.arange(20_000), known, 2, "cosine", True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 4096 and peak < 250e6
    rows = np.round(rng.normal(size=(70, 3)), 1).astype(np.float32).astype(float)
    rows[30:60] = rows[5]
    for metric in ("cosine", "squared_l2"):
        whole = N.nearest_rows(np.arange(70), rows, np.arange(70), rows, 4, metric, True)
        with monkeypatch.context() as m:
            m.setattr(N, "TILE", 7)
            cut = N.nearest_rows(np.arange(70), rows, np.arange(70), rows, 4, metric, True)
        for found in (whole, cut):
            best = {q: list(part.sort_values("rank")["id"]) for q, part in found.groupby("q")}
            assert best == brute(rows.astype(np.float32), 4, metric, True)
        assert cut["distance"].to_numpy() == pytest.approx(whole["distance"].to_numpy(), abs=1e-12)


def test_near_duplicates(spark, vectors):
    _, df = vectors
    empty = df.filter("id < 0")
    none = S.near_duplicates(df.select("id", "embedding"), empty, "id", "id").collect()
    assert len(none) == 90 and not any(r["is_near_duplicate"] for r in none) and none[0]["nearest_category"] is None
    known = spark.createDataFrame([(1, [1.0, 0.0], "x")], "k long, embedding array<float>, category string")
    # the squared distance of the second query is exactly at the threshold
    asked = spark.createDataFrame([(1, [2.0, 0.0]), (2, [1.5, 0.0]), (3, [0.0, 1.0]), (4, None)], "id long, embedding array<float>")
    got = S.near_duplicates(asked, known, "id", "k", metric="squared_l2", threshold=0.25)
    assert {r["id"]: r["is_near_duplicate"] for r in got.collect()} == {1: False, 2: True, 3: False, 4: False}


def test_gate(spark):
    hits = spark.createDataFrame(
        [(1, 1, 0.4, "a.md", "A"), (1, 2, 0.2, "b.md", "B"), (2, 1, 0.39999, "a.md", "A")], "q long, rank int, score double, file_name string, text string"
    )
    asked = spark.createDataFrame([(1,), (2,), (3,)], "q long")
    got = {r["q"]: r for r in S.grounding_gate(asked, S.retrieve(hits, "q"), "q").collect()}
    assert got[1]["grounding_confidence"] == "high" and [s["file"] for s in got[1]["retrieved_sources"]] == ["a.md", "b.md"]
    assert got[1]["result"] == "[Source: a.md]\nA\n\n---\n\n[Source: b.md]\nB"
    assert got[2]["grounding_confidence"] == "low" and got[2]["retrieved_sources"] == [] and got[2]["top_similarity_score"] == 0.4
    assert got[3]["grounding_confidence"] == "low" and got[3]["top_similarity_score"] == 0.0


def test_index_refresh(spark):
    docs = spark.createDataFrame([(1, "memory climbs"), (2, "latency spikes"), (3, "memory climbs")], "id long, text string").withColumn("content_hash", S.content_hash("text"))
    stored = docs.filter("id = 2")
    assert [r["id"] for r in S.refresh_index(stored, docs).collect()] == [1]
    assert S.refresh_index(docs, docs).count() == 0


def test_text_vectors_find_their_text(spark):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["memory climbs slowly", "latency spikes with flat cpu", "disk is full"])], "id long, text string")
    model = S.text_vectors(256).fit(items)
    index = S.embed(model, items)
    asked = spark.createDataFrame([(0, "why is the disk full", 2), (1, "cpu flat but latency", 1)], "q long, text string, expected long")
    hits = S.nearest(S.embed(model, asked), index, "q", "id", k=2)
    rate = S.hit_rate(hits, asked, "q", "id", "expected", (1,)).first()
    assert tuple(rate) == (2, 1.0)
    norms = [float(np.linalg.norm(r["embedding"])) for r in index.collect()]
    assert norms == pytest.approx([1.0] * 3, abs=1e-6)
