"""Second-order boosted trees on histograms, many models at once.

Features are cut into bins at their quantiles. A level of a tree needs, per node, feature and bin, the sums of the loss's first and
second derivatives: one pass over the rows, of which a task returns only those sums. One pass serves the same level of all models
that are fitted together (trials of a search) and of all classes (softmax: a tree per class and round), so that a search of twenty
trials reads the rows as often as its deepest trial alone. Trees live on the driver; their size depends on settings only. Margins are
written with the rows every KEEP rounds, so a pass evaluates few trees and a lost executor costs no earlier round.

A search keeps of each trial only what its area on other rows says, so up to HELD_BYTES of rows (``search_areas``) a trial is one task:
it reads the rows once, holds them in blocks, and ends where its patience does. No job per level is started then.

Row shares are drawn by a hash of the row and the round, column shares per round; a null or NaN value lies in the lowest bin.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stored
from tidewatch.streaming.state import remove

BINS, KEEP = 32, 4
#: Up to so many tasks and bytes of a pass the driver adds the sums and splits the nodes, beyond it tasks do, by model and class.
DIRECT_TASKS, DIRECT_BYTES = 16, 1 << 18
#: Rows of a task of a pass.
TASK_ROWS = 100_000
#: Score classes in which a round's area is measured.
AREA_BINS = 1000
ROWS_AT_ONCE = 1 << 15
#: Bytes of rows that the task of a trial holds at most.
HELD_BYTES = 1 << 29
#: Rows of a node from which on only its smaller child is summed, the other one being the difference.
DIFFERENCE_ROWS = 1 << 14


@dataclass(frozen=True)
class Settings:
    depth: int = 4
    rounds: int = 200
    step: float = 0.05
    rows: float = 1.0
    columns: float = 1.0
    l2: float = 1.0
    least_weight: float = 1.0


@dataclass
class Tree:
    """A complete tree by levels: node i has the children 2i + 1 and 2i + 2; a leaf has feature -1. A row whose bin is above the cut goes right."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node that each row reaches."""
        node, flat, first = np.zeros(len(x), np.int64), x.ravel(), np.arange(len(x)) * x.shape[1]
        split = np.flatnonzero(self.feature >= 0)
        # down to the deepest split
        for _ in range(int(split[-1] + 1).bit_length() if len(split) else 0):
            f = self.feature.take(node)
            node = np.where(f >= 0, 2 * node + 1 + (flat.take(first + np.maximum(f, 0)) > self.cut.take(node)), node)
        return node


@dataclass
class Model:
    """``trees[round][class]``; ``cuts[feature]`` are the upper edges of all bins but the last."""

    settings: Settings
    classes: int
    cuts: list[np.ndarray]
    trees: list[list[Tree]] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.classes))
        for trees in self.trees:
            for c, tree in enumerate(trees):
                out[:, c] += tree.value[tree.leaves(x)]
        return out


def quantile_cuts(df: DataFrame, features: str, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the upper edges of its bins; features of few values get a bin for each."""
    values = df.select(F.posexplode(features).alias("f", "v")).filter("v IS NOT NULL AND NOT isnan(v)")
    at = [i / bins for i in range(1, bins)]
    found = {r["f"]: np.unique(r["q"]) for r in values.groupBy("f").agg(F.percentile_approx("v", at, 10_000).alias("q")).collect()}
    return [found.get(f, np.zeros(0)) for f in range(max(found, default=-1) + 1)]


def binned(values: list, cuts: list[np.ndarray]) -> np.ndarray:
    x = np.array([[np.nan if v is None else v for v in row] for row in values], np.float64).reshape(len(values), -1)
    out = np.zeros((len(x), len(cuts)), np.uint8)
    for f, edges in enumerate(cuts):
        column = np.where(np.isnan(x[:, f]), -np.inf, x[:, f])
        out[:, f] = np.searchsorted(edges, column)
    return out


_ROW = "x binary, y int, w double, u long, m binary"


def _prepared(df: DataFrame, features: str, label: str, weight: str | None, cuts: list[np.ndarray], width: int) -> DataFrame:
    """Rows as bins, label, weight, a hash, and margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(width).tobytes()
        for batch in batches:
            x = binned(batch.column("f").to_pylist(), cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y"), batch.column("w"), batch.column("u"), pa.array([empty] * len(x), pa.binary())],
                ["x", "y", "w", "u", "m"],
            )

    w = F.lit(1.0) if weight is None else F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    rows = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        F.col(features).alias("f"), F.col(label).cast("int").alias("y"), w.alias("w"), F.xxhash64(features, label).alias("u")
    )
    return rows.mapInArrow(run, _ROW)


def _even(rows: DataFrame, total: int) -> DataFrame:
    """``total`` rows in equal tasks, whatever the files of the rows."""
    parts = min(max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS)), max(1, total // 1000))
    return rows.repartition(parts)


class _Rows:
    """Some rows of a task as arrays."""

    def __init__(self, batch: pa.RecordBatch, n_features: int, width: int):
        n, whole = batch.num_rows, lambda c, kind, k: np.frombuffer(b"".join(batch.column(c).to_pylist()), kind).reshape(n, k)
        self.x, self.m = whole("x", np.uint8, n_features), whole("m", np.float64, width).copy()
        self.y, self.w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
        self.u = batch.column("u").to_numpy().view(np.uint64)


def drawn(w: np.ndarray, u: np.ndarray, share: float, number: int) -> np.ndarray:
    """Weights of the rows drawn in a round by their hashes, 0 for the others."""
    if share >= 1.0:
        return w
    h = (u ^ np.uint64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return np.where((h >> np.uint64(11)).astype(np.float64) / (1 << 53) < share, w, 0.0)


def derivatives(y: np.ndarray, margins: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss (one margin) or of the softmax loss."""
    if margins.shape[1] == 1:
        p = 1.0 / (1.0 + np.exp(-np.clip(margins, -500, 500)))
        y = (y == 1)[:, None]
    else:
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        y = y[:, None] == np.arange(margins.shape[1])
    return weight[:, None] * (p - y), weight[:, None] * p * (1.0 - p)


def columns_drawn(draw: random.Random, share: float, n: int) -> np.ndarray:
    """Which features a round of a model uses."""
    chosen = np.zeros(n, bool)
    chosen[draw.sample(range(n), max(1, round(share * n)))] = True
    return chosen


def _splits(rows: DataFrame, tasks: int, fresh: list[list[list[Tree]]], growing: list[list[Tree]], active: list[list[np.ndarray]], columns: list[np.ndarray], settings: Sequence[Settings], number: int, n_features: int, bins: int) -> dict:
    """(model, class) -> ``best_splits`` of its active nodes, from the sums over all rows. ``fresh`` are the models' trees that the
    rows' margins do not hold yet. Sums of all tasks reach the driver only where they are small; else it gets the splits."""
    classes = len(growing[0])
    width = classes * len(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {(m, c): np.zeros(len(nodes) * n_features * bins * 2) for m, own in enumerate(active) for c, nodes in enumerate(own) if len(nodes)}
        place = np.arange(n_features) * bins
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                r = _Rows(batch.slice(start, ROWS_AT_ONCE), n_features, width)
                cells = r.x + place
                for m, s in enumerate(settings):
                    if not any(len(nodes) for nodes in active[m]):
                        continue
                    margins = r.m[:, m * classes : (m + 1) * classes]
                    for trees in fresh[m]:
                        for c, tree in enumerate(trees):
                            margins[:, c] += tree.value[tree.leaves(r.x)]
                    g, h = derivatives(r.y, margins, drawn(r.w, r.u, s.rows, number))
                    for c, nodes in enumerate(active[m]):
                        if not len(nodes):
                            continue
                        at = np.full(len(growing[m][c].feature), -1)
                        at[nodes] = np.arange(len(nodes))
                        slot = at[growing[m][c].leaves(r.x)]
                        inside = np.flatnonzero((slot >= 0) & (h[:, c] != 0))
                        index = (slot[inside, None] * (n_features * bins) + cells[inside]).ravel()
                        size = len(nodes) * n_features * bins
                        for side, d in enumerate((g, h)):
                            totals[m, c][side * size : (side + 1) * size] += np.bincount(index, np.repeat(d[inside, c], n_features), size)
        if totals:
            own = [pa.array([k[i] for k in totals], pa.int32()) for i in (0, 1)] + [pa.array([TaskContext.get().partitionId()] * len(totals), pa.int32())]
            yield pa.RecordBatch.from_arrays([*own, pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["m", "c", "p", "sums"])

    def split(m: int, c: int, parts: list[dict]) -> tuple[np.ndarray, ...]:
        # in the tasks' order, so that a rerun adds alike
        total = sum(np.frombuffer(r["sums"]) for r in sorted(parts, key=lambda r: r["p"]))
        return best_splits(total.reshape(2, len(active[m][c]), n_features, bins), columns[m], settings[m])

    def add(key: tuple, part: pa.Table) -> pa.Table:
        m, c = (k.as_py() for k in key)
        flat = np.concatenate([np.asarray(a, np.float64).ravel() for a in split(m, c, part.to_pylist())])
        return pa.table({"m": pa.array([m], pa.int32()), "c": pa.array([c], pa.int32()), "found": pa.array([flat.tobytes()], pa.binary())})

    partial = rows.mapInArrow(run, "m int, c int, p int, sums binary")
    size = sum(len(nodes) for own in active for nodes in own) * n_features * bins * 16
    if tasks <= DIRECT_TASKS and tasks * size <= DIRECT_BYTES:
        parts: dict = {}
        for r in partial.toArrow().to_pylist():
            parts.setdefault((r["m"], r["c"]), []).append(r)
        return {k: split(*k, own) for k, own in parts.items()}
    found = {}
    for r in partial.groupBy("m", "c").applyInArrow(add, "m int, c int, found binary").toArrow().to_pylist():
        flat = np.frombuffer(r["found"])
        n = len(active[r["m"]][r["c"]])
        feature, cut = flat[: 2 * n].astype(np.int64).reshape(2, n)
        found[r["m"], r["c"]] = (feature, cut, *flat[2 * n :].reshape(3, 2, n))
    return found


def best_splits(sums: np.ndarray, columns: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """Per node: feature (-1: none gains), cut, and the (g, h) of the node and of its left and right part.

    Of equal gains the first feature and cut wins."""
    total = sums[:, :, 0].sum(axis=2)
    left = np.cumsum(sums, axis=3)[..., :-1]
    right = total[:, :, None, None] - left
    score = lambda t: t[0] ** 2 / (t[1] + s.l2)
    gain = score(left) + score(right) - score(total)[:, None, None]
    gain[(left[1] < s.least_weight) | (right[1] < s.least_weight)] = -np.inf
    gain[:, ~columns] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    feature, cut = np.divmod(best, gain.shape[2])
    feature = np.where(flat[np.arange(len(flat)), best] > 1e-9, feature, -1)
    node = np.arange(len(best))
    return feature, cut, total, left[:, node, np.maximum(feature, 0), cut], right[:, node, np.maximum(feature, 0), cut]


def fit(df: DataFrame, settings: Sequence[Settings], features: str, label: str, classes: int = 1, weight: str | None = None, bins: int = BINS, seed: int = 42) -> list[Model]:
    """A model per settings, fitted together. ``features`` is an array of numbers; labels are 0 and 1 (``classes`` = 1) or class numbers.
    Rows without label or features teach nothing; without rows there are no trees."""
    cuts = quantile_cuts(df, features, bins)
    models = [Model(s, classes, cuts) for s in settings]
    if not cuts:
        return models
    n, width = len(cuts), classes * len(settings)
    rows = stored(_even(_prepared(df, features, label, weight, cuts, width), df.count()), "boosting")
    tasks = rows.rdd.getNumPartitions()
    draws = [random.Random(f"{seed}-{m}") for m in range(len(settings))]
    kept = 0
    for number in range(max(s.rounds for s in settings)):
        live = [number < s.rounds for s in settings]
        growing = [[Tree.empty(s.depth) for _ in range(classes)] for s in settings]
        active = [[np.zeros(1 if on else 0, np.int64) for _ in range(classes)] for on in live]
        columns = [columns_drawn(draw, s.columns, n) for s, draw in zip(settings, draws)]
        while any(len(nodes) for own in active for nodes in own):
            found = _splits(rows, tasks, [model.trees[kept:] for model in models], growing, active, columns, settings, number, n, bins)
            for m, s in enumerate(settings):
                for c, nodes in enumerate(active[m]):
                    if len(nodes):
                        active[m][c] = _split(growing[m][c], nodes, found[m, c], s)
        for model, on, trees in zip(models, live, growing):
            if on:
                model.trees.append(trees)
        if number + 1 - kept >= KEEP and number + 1 < max(s.rounds for s in settings):
            rows, kept = _with_margins(rows, [model.trees[kept:] for model in models], classes, n), number + 1
            tasks = rows.rdd.getNumPartitions()
    return models


def _split(tree: Tree, nodes: np.ndarray, found: tuple[np.ndarray, ...], s: Settings) -> np.ndarray:
    """Splits the nodes of a level and sets their values; the nodes of the next level that may be split."""
    feature, cut, total, left, right = found
    value = lambda t: -s.step * t[0] / (t[1] + s.l2)
    tree.value[nodes] = value(total)
    at = np.flatnonzero(feature >= 0)
    tree.feature[nodes[at]], tree.cut[nodes[at]] = feature[at], cut[at]
    children = 2 * nodes[at] + 1
    tree.value[children], tree.value[children + 1] = value(left[:, at]), value(right[:, at])
    below = np.sort(np.concatenate((children, children + 1)))
    # the children of the last level stay leaves
    return below if len(below) and 2 * below[0] + 2 < len(tree.feature) else below[:0]


def _with_margins(rows: DataFrame, fresh: list[list[list[Tree]]], classes: int, n_features: int) -> DataFrame:
    """The rows with the fresh trees in their margins, stored; the rows before are deleted."""
    width = classes * len(fresh)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r = _Rows(batch, n_features, width)
            for m, rounds in enumerate(fresh):
                for trees in rounds:
                    for c, tree in enumerate(trees):
                        r.m[:, m * classes + c] += tree.value[tree.leaves(r.x)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([v.tobytes() for v in r.m], pa.binary())], batch.schema.names)

    done = stored(rows.mapInArrow(run, _ROW), "boosting")
    for path in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        remove(rows.sparkSession, path)
    return done


def with_margins(df: DataFrame, model: Model, features: str, output: str = "margins") -> DataFrame:
    """Adds the class margins (an array) of every row; null where the features are."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def score(values: pa.Array) -> pa.Array:
        there = [v for v in values.to_pylist() if v is not None]
        own = iter(held.value.margins(binned(there, held.value.cuts)).tolist() if there else [])
        return pa.array([None if v is None else next(own) for v in values.to_pylist()], pa.list_(pa.float64()))

    return df.withColumn(output, score(F.col(features).cast("array<double>")))


def predicted_class(margins: str = "margins", output: str = "prediction"):
    """The class of the largest margin, of equal ones the first; with one margin whether it is above 0."""
    m = F.col(margins)
    first = F.array_position(m, F.array_max(m)) - 1
    return F.when(F.size(m) == 1, (m[0] > 0).cast("double")).otherwise(first.cast("double")).alias(output)


def areas_by_round(df: DataFrame, models: Sequence[Model], features: str, label: str) -> np.ndarray:
    """(model, round) -> area under the ROC curve of the first round + 1 trees of each binary model, in one pass: a row's margin runs
    on tree by tree, and tasks return counts by round and class of score."""
    rounds = max((len(m.trees) for m in models), default=0)
    held = df.sparkSession.sparkContext.broadcast(list(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = rounds * AREA_BINS * 2
        totals = np.zeros((len(held.value), size), np.int64)
        for batch in batches:
            x, y = binned(batch.column("f").to_pylist(), held.value[0].cuts), batch.column("y").to_numpy()
            for i, model in enumerate(held.value):
                margin = np.zeros(len(x))
                for number, (tree,) in enumerate(model.trees):
                    margin += tree.value[tree.leaves(x)]
                    totals[i] += np.bincount((number * AREA_BINS + _score_class(margin)) * 2 + (y == 1), minlength=size)
        model, cell = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), pa.array(cell, pa.int64()), pa.array(totals[model, cell])], ["model", "cell", "n"])

    rows = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull()).select(F.col(features).alias("f"), F.col(label).cast("int").alias("y"))
    found = rows.mapInArrow(run, "model int, cell long, n long").groupBy("model", "cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(models), rounds * AREA_BINS * 2), np.int64)
    counts[found.column("model").to_numpy(), found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return _areas(counts.reshape(len(models), rounds, AREA_BINS, 2))


def _areas(counts: np.ndarray) -> np.ndarray:
    """Areas from counts by (.., class of score, label)."""
    no, yes = np.moveaxis(counts, -1, 0).astype(np.float64)
    below = np.cumsum(no, axis=-1) - no
    pairs = no.sum(axis=-1) * yes.sum(axis=-1)
    return np.divide((yes * (below + no / 2)).sum(axis=-1), pairs, out=np.full(pairs.shape, 0.5), where=pairs > 0)


def _score_class(margin: np.ndarray) -> np.ndarray:
    return np.minimum((AREA_BINS / (1.0 + np.exp(-np.clip(margin, -500, 500)))).astype(np.int64), AREA_BINS - 1)


def stopped(areas: np.ndarray, patience: int) -> int:
    """Rounds that are kept: up to the best one, looking no farther than ``patience`` rounds without a better one."""
    best = 0
    for number, area in enumerate(areas):
        if area > areas[best]:
            best = number
        elif number - best >= patience:
            break
    return best + 1


# --- a search's trials as tasks ------------------------------------------------------------------


_FIRST = np.arange(ROWS_AT_ONCE)


class _Block:
    """Some rows that a task holds through all rounds of one binary model; ``x`` lies by feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, u: np.ndarray):
        self.x, self.y, self.w, self.u = np.ascontiguousarray(x.T), y == 1, w, u
        self.margin, self.node = np.zeros(len(y)), np.zeros(len(y), np.int64)

    def begin(self, share: float, number: int) -> None:
        """A round begins: the rows that it draws, and their derivatives."""
        g, h = derivatives(self.y, self.margin[:, None], drawn(self.w, self.u, share, number))
        self.used = np.flatnonzero(h[:, 0] != 0)
        # side by side, as one complex number, both are added in one go
        self.gh = (g + 1j * h)[:, 0].take(self.used)
        self.node[:] = 0

    def descend(self, tree: Tree) -> None:
        """A level down, where there is one."""
        split = tree.feature >= 0
        # a leaf's row meets a cut that none is above and stays
        cell = np.where(split, tree.feature * len(self.node), 0).take(self.node)
        cell += _FIRST[: len(cell)]
        right = self.x.ravel().take(cell) > np.where(split, tree.cut, 255).astype(np.uint8).take(self.node)
        self.node = np.where(split, 2 * np.arange(len(split)) + 1, np.arange(len(split))).take(self.node)
        self.node += right

    def add(self, at: np.ndarray, asked: np.ndarray, bins: int, sums: np.ndarray) -> None:
        """Adds the asked features' sums to those of the nodes to which ``at`` gives a place; others have -1."""
        place, rows, gh = at.take(self.node.take(self.used)), self.used, self.gh
        inside = np.flatnonzero(place >= 0)
        if len(inside) < len(rows):
            place, rows, gh = place.take(inside), rows.take(inside), gh.take(inside)
        place *= bins
        for f in asked:
            np.add.at(sums[f], place + self.x[f].take(rows), gh)

    def end(self, tree: Tree) -> None:
        """A round ends; all rows have come down the tree."""
        self.margin += tree.value.take(self.node)


def _level_sums(blocks: list[_Block], tree: Tree, active: np.ndarray, above: tuple[np.ndarray, np.ndarray] | None, columns: np.ndarray, bins: int) -> np.ndarray:
    """Sums (2, node, feature, bin) of the active nodes; of features not drawn 0, but the first, by which nodes are totalled. ``above`` are the nodes and sums of the level before: where a node had many rows,
    the larger of its children gets what the smaller one leaves."""
    size = len(tree.feature)
    count = sum(np.bincount(b.node, minlength=size) for b in blocks)
    sums = np.zeros((2, len(active), len(columns), bins))
    summed = np.ones(len(active), bool)
    if above is not None:
        # children lie side by side
        left, right = np.arange(0, len(active), 2), np.arange(1, len(active), 2)
        less = count[active[left]] <= count[active[right]]
        small, large = np.where(less, left, right), np.where(less, right, left)
        many = count[active[left]] + count[active[right]] >= DIFFERENCE_ROWS
        small, large = small[many], large[many]
        summed[large] = False
    own = np.flatnonzero(summed)
    at = np.full(size, -1)
    at[active[own]] = np.arange(len(own))
    part = np.zeros((len(columns), len(own) * bins), np.complex128)
    asked = np.union1d(0, np.flatnonzero(columns))
    for b in blocks:
        b.add(at, asked, bins, part)
    for side, d in enumerate((part.real, part.imag)):
        sums[side, own] = d.reshape(len(columns), len(own), bins).swapaxes(0, 1)
    if len(own) < len(active):
        whole = above[1][:, np.searchsorted(above[0], (active[large] - 1) // 2)]
        rest = whole - sums[:, small]
        # what rounding leaves of an empty bin
        empty = (np.abs(rest[1]) <= 1e-12 * whole[1]) & (np.abs(rest[0]) <= 1e-9 * whole[1])
        rest[:, empty] = 0.0
        sums[:, large] = rest
    return sums


def _trial(train: list[_Block], held: list[_Block], s: Settings, draw: random.Random, n_features: int, bins: int, patience: int) -> np.ndarray:
    """Area by round over the held rows of one binary model, fitted to the others until patience ends."""
    areas: list[float] = []
    for number in range(s.rounds):
        columns, tree = columns_drawn(draw, s.columns, n_features), Tree.empty(s.depth)
        for b in train:
            b.begin(s.rows, number)
        active, above = np.zeros(1, np.int64), None
        while len(active):
            sums = _level_sums(train, tree, active, above, columns, bins)
            above = active, sums
            active = _split(tree, active, best_splits(sums, columns, s), s)
            for b in train:
                b.descend(tree)
        count = np.zeros(AREA_BINS * 2, np.int64)
        for b in held:
            b.node[:] = 0
            for _ in range(s.depth):
                b.descend(tree)
            b.end(tree)
            count += np.bincount(_score_class(b.margin) * 2 + b.y, minlength=AREA_BINS * 2)
        for b in train:
            b.end(tree)
        areas.append(float(_areas(count.reshape(AREA_BINS, 2))))
        if number + 1 - stopped(areas, patience) >= patience:
            break
    return np.array(areas)


def _blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> tuple[list[_Block], list[_Block]]:
    """The rows to learn from and the held ones."""
    found: tuple[list[_Block], list[_Block]] = [], []
    waiting: tuple[list[pa.RecordBatch], list[pa.RecordBatch]] = [], []

    def flush(side: int) -> None:
        table = pa.Table.from_batches(waiting[side])
        for start in range(0, table.num_rows, ROWS_AT_ONCE):
            t = table.slice(start, ROWS_AT_ONCE)
            x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.uint8).reshape(-1, n_features)
            found[side].append(_Block(x, *(t.column(c).to_numpy().copy() for c in ("y", "w")), t.column("u").to_numpy().view(np.uint64).copy()))
        waiting[side].clear()

    for batch in batches:
        for side in (0, 1):
            own = batch.filter(pc.equal(batch.column("held"), bool(side)))
            if own.num_rows:
                waiting[side].append(own)
            if sum(b.num_rows for b in waiting[side]) >= ROWS_AT_ONCE:
                flush(side)
    for side in (0, 1):
        if waiting[side]:
            flush(side)
    return found


def search_areas(train: DataFrame, held: DataFrame, settings: Sequence[Settings], features: str, label: str, weight: str | None = None, patience: int = 10, bins: int = BINS, seed: int = 42) -> list[np.ndarray]:
    """Per settings the areas by round, over the held rows, of a binary model fitted to the others: of all rounds, or of those up to
    which ``stopped`` looks. The areas are those of ``fit`` and ``areas_by_round``."""
    rows, others, cuts = train.count(), held.count(), quantile_cuts(train, features, bins)
    if not cuts:
        return [np.zeros(0) for _ in settings]
    if (rows + others) * (len(cuts) + 64) > HELD_BYTES:
        return list(areas_by_round(held, fit(train, settings, features, label, weight=weight, bins=bins, seed=seed), features, label))
    own = _even(_prepared(train, features, label, weight, cuts, 0), rows).withColumn("held", F.lit(False))
    other = _even(_prepared(held, features, label, None, cuts, 0), others).withColumn("held", F.lit(True))
    table = stored(own.unionByName(other).drop("m"), "boosting")

    def task(m: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            areas = _trial(*_blocks(batches, len(cuts)), settings[m], random.Random(f"{seed}-{m}"), len(cuts), bins, patience)
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([areas.tobytes()], pa.binary())], ["m", "areas"])

        return table.coalesce(1).mapInArrow(run, "m int, areas binary")

    # one job, the longest trials first; a union of frames of one task each would be planned as one task
    order = sorted(range(len(settings)), key=lambda m: -settings[m].depth * settings[m].rounds)
    done = train.sparkSession.sparkContext.union([task(m).rdd for m in order]).collect()
    found = {r["m"]: np.frombuffer(r["areas"]) for r in done}
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        remove(table.sparkSession, path)
    return [found[m] for m in range(len(settings))]
