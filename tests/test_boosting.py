"""Histogram boosting against boosting by definition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import boosting as B


def table(spark, rng, n, classes):
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int) + (classes > 2) * (x[:, 2] > 0.5)
    w = rng.integers(1, 4, n).astype(float)
    rows = [([float(v) for v in a], int(b), float(c)) for a, b, c in zip(x, y, w)]
    return x, y, w, spark.createDataFrame(rows, "x array<double>, y int, w double").repartition(3)


def by_definition(x, y, w, s, classes, cuts):
    """Margins after all rounds, every split tried on the raw values."""
    margins = np.zeros((len(x), classes))
    for _ in range(s.rounds):
        if classes == 1:
            p, t = 1 / (1 + np.exp(-margins)), (y == 1)[:, None]
        else:
            e = np.exp(margins)
            p, t = e / e.sum(1, keepdims=True), y[:, None] == np.arange(classes)
        g, h = w[:, None] * (p - t), w[:, None] * p * (1 - p)
        step = np.zeros_like(margins)
        for c in range(classes):

            def grow(rows, depth):
                score = lambda r: g[r, c].sum() ** 2 / (h[r, c].sum() + s.l2)
                best = (1e-9, None)
                if depth < s.depth:
                    for f in range(x.shape[1]):
                        for cut in cuts[f]:
                            left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                            if min(h[left, c].sum(), h[right, c].sum()) >= s.least_weight:
                                gain = score(left) + score(right) - score(rows)
                                if gain > best[0] + 1e-12:
                                    best = (gain, (left, right))
                if best[1] is None:
                    step[rows, c] = -s.step * g[rows, c].sum() / (h[rows, c].sum() + s.l2)
                else:
                    for part in best[1]:
                        grow(part, depth + 1)

            grow(np.arange(len(x)), 0)
        margins += step
    return margins


@pytest.mark.parametrize("classes", [1, 3])
@pytest.mark.parametrize("direct", [16, 1])
def test_margins_by_definition(spark, monkeypatch, classes, direct):
    """Two models at once, margins written in between, sums added by the driver or by tasks."""
    monkeypatch.setattr(B, "KEEP", 2)
    monkeypatch.setattr(B, "DIRECT_TASKS", direct)
    x, y, w, df = table(spark, np.random.default_rng(3), 150, classes)
    settings = [B.Settings(depth=2, rounds=5, step=0.3), B.Settings(depth=3, rounds=3, step=0.5, l2=0.1, least_weight=3.0)]
    models = B.fit(df, settings, "x", "y", classes, "w", bins=8)
    for s, model in zip(settings, models):
        assert len(model.trees) == s.rounds
        got = model.margins(B.binned(x.tolist(), model.cuts))
        assert got == pytest.approx(by_definition(x, y, w, s, classes, model.cuts), abs=1e-8)


def test_driver_gets_splits_not_sums(spark, monkeypatch):
    """Sums above the limit are added and split by tasks: the same trees, and a task's sums never reach the driver."""
    x, y, w, df = table(spark, np.random.default_rng(6), 150, 3)
    s = [B.Settings(depth=3, rounds=3, step=0.3)]
    direct = B.fit(df, s, "x", "y", 3, "w", bins=8)[0]
    monkeypatch.setattr(B, "DIRECT_BYTES", 0)
    seen, split = [], B.best_splits
    monkeypatch.setattr(B, "best_splits", lambda *a: seen.append(a) or split(*a))
    spread = B.fit(df, s, "x", "y", 3, "w", bins=8)[0]
    assert not seen
    got = lambda m: m.margins(B.binned(x.tolist(), m.cuts))
    assert got(spread) == pytest.approx(got(direct), abs=1e-12)
    assert got(spread) == pytest.approx(by_definition(x, y, w, s[0], 3, spread.cuts), abs=1e-8)


def test_shares_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    x, y, w, df = table(spark, rng, 200, 2)
    odd = df.union(spark.createDataFrame([(None, 1, 1.0), ([1.0, None, float("nan")], 1, None), ([0.0, 0.0, 0.0], None, 1.0)], df.schema))
    s = B.Settings(depth=3, rounds=6, step=0.3, rows=0.7, columns=0.67)
    one, again = (B.fit(odd.repartition(p), [s], "x", "y", weight="w")[0] for p in (2, 5))
    margins = lambda m: m.margins(B.binned(x.tolist(), m.cuts))
    assert margins(one) == pytest.approx(margins(again), abs=1e-8)
    used = [set(t.feature[t.feature >= 0]) for (t,) in one.trees]
    assert all(len(u) <= 2 for u in used) and set.union(*used) == {0, 1, 2}
    done = B.with_margins(odd, one, "x").select("x", "y", "margins", B.predicted_class())
    assert done.filter("x IS NULL AND margins IS NULL").count() == 1
    assert done.filter("prediction = y").count() > 170
    assert B.fit(df.limit(0), [s], "x", "y")[0].trees == []


def test_areas_and_patience(spark):
    x, y, w, df = table(spark, np.random.default_rng(5), 300, 2)
    s = B.Settings(depth=2, rounds=4, step=0.4)
    models = B.fit(df, [s, B.Settings(depth=1, rounds=2, step=0.4)], "x", "y")
    areas = B.areas_by_round(df.withColumn("x", F.col("x")), models, "x", "y")
    assert areas.shape == (2, 4)
    binned = B.binned(x.tolist(), models[0].cuts)
    for n in range(4):
        part = B.Model(s, 1, models[0].cuts, models[0].trees[: n + 1]).margins(binned)[:, 0]
        pairs = part[y == 1][:, None] - part[y == 0][None, :]
        assert areas[0, n] == pytest.approx((pairs > 0).mean() + (pairs == 0).mean() / 2, abs=0.01)
    assert B.stopped(np.array([0.5, 0.7, 0.6, 0.6, 0.9]), 2) == 2 and B.stopped(np.array([0.5, 0.7, 0.6, 0.8]), 2) == 4


def test_trials_as_tasks(spark, monkeypatch):
    """Trials held by tasks give the areas of models fitted by passes."""
    x, y, w, df = table(spark, np.random.default_rng(8), 400, 2)
    odd = df.union(spark.createDataFrame([(None, 1, 1.0), ([1.0, None, float("nan")], 1, None), ([0.0, 0.0, 0.0], None, 1.0)], df.schema))
    train, held = odd, odd.filter("w < 3 OR w IS NULL")
    settings = [B.Settings(depth=3, rounds=6, step=0.3), B.Settings(depth=5, rounds=4, step=0.2, rows=0.7, columns=0.67, least_weight=0.5)]
    got = B.search_areas(train, held, settings, "x", "y", "w", patience=10, bins=16)
    expected = B.areas_by_round(held, B.fit(train, settings, "x", "y", weight="w", bins=16), "x", "y")
    assert [len(a) for a in got] == [6, 4]
    for a, e in zip(got, expected):
        assert a == pytest.approx(e[: len(a)], abs=1e-12)
    # rows beyond what a task holds
    monkeypatch.setattr(B, "HELD_BYTES", 0)
    assert np.array(B.search_areas(train, held, settings, "x", "y", "w", bins=16)) == pytest.approx(expected, abs=1e-12)
    monkeypatch.undo()
    # as far as patience goes
    short = B.search_areas(train, held, [B.Settings(depth=3, rounds=40, step=0.3, rows=0.6)], "x", "y", "w", patience=2, bins=16)[0]
    whole = B.areas_by_round(held, B.fit(train, [B.Settings(depth=3, rounds=40, step=0.3, rows=0.6)], "x", "y", weight="w", bins=16), "x", "y")[0]
    assert len(short) == min(40, B.stopped(whole, 2) + 2)
    assert short == pytest.approx(whole[: len(short)], abs=1e-12) and B.stopped(short, 2) == B.stopped(whole, 2)
    assert B.search_areas(df.limit(0), held, settings, "x", "y")[0].size == 0


@pytest.mark.parametrize("difference", [1, 1 << 14])
def test_blocks_by_definition(monkeypatch, difference):
    """Rows in several blocks, larger children from differences or summed: margins by definition."""
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y, w = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=300) > 0).astype(int), rng.integers(1, 4, 300).astype(float)
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, 8) / 8)) for f in range(3)]
    monkeypatch.setattr(B, "DIFFERENCE_ROWS", difference)
    s = B.Settings(depth=4, rounds=5, step=0.3)
    u, cells = np.zeros(300, np.uint64), B.binned(x.tolist(), cuts)
    blocks = [B._Block(cells[i : i + 70], y[i : i + 70], w[i : i + 70], u[i : i + 70]) for i in range(0, 300, 70)]
    areas = B._trial(blocks, [B._Block(cells, y, w, u)], s, B.random.Random(1), 3, 8, 10)
    got = np.concatenate([b.margin for b in blocks])
    assert got == pytest.approx(by_definition(x, y, w, s, 1, cuts)[:, 0], abs=1e-8)
    pairs = got[y == 1][:, None] - got[y == 0][None, :]
    assert len(areas) == 5 and areas[-1] == pytest.approx((pairs > 0).mean() + (pairs == 0).mean() / 2, abs=0.01)
