"""Model jobs: distributed fit, distributed scoring.

Boosted trees, logistic regression and PCA are MLlib's. The isolation forest and the one-class
boundary have no MLlib version and are built here, and so is the small autoencoder, which starts from
the linear reconstruction; the random-feature boundary stands in for a kernel one. Scores rank rows in
the same way but are not equal to those models' scores.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import boosting as B
from tidewatch.operators import metrics as M
from tidewatch.session import stored

# --- inputs --------------------------------------------------------------------------------------


def label_index(df: DataFrame, column: str, output: str = "label") -> DataFrame:
    """Classes numbered in alphabetical order."""
    indexer = StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc")
    return indexer.fit(df).transform(df)


def aligned(corpus: DataFrame, features: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Corpus rows with their features and vector, matched by key."""
    return corpus.join(features, key).join(vectors, key)


def joined_vector(vector: str, columns: Sequence[str]) -> Column:
    """Vector entries followed by the named columns, as an array of doubles."""
    return F.concat(F.col(vector).cast("array<double>"), F.array(*[F.col(c).cast("double") for c in columns]))


def with_vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


# --- boosted trees and logistic regression -------------------------------------------------------


def pos_weight(df: DataFrame, label: str = "label", output: str = "weight") -> DataFrame:
    """Positives weighted by negatives per positive, so that both classes weigh the same."""
    ratio = df.agg(F.try_divide(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))).scalar()
    return df.withColumn(output, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)).cast("double"))


def boosted(depth: int = 6, rounds: int = 150, step: float = 0.1, rows: float = 1.0, columns: str = "all", seed: int = 42, **extra) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxDepth=depth, maxIter=rounds,
        stepSize=step, subsamplingRate=rows, featureSubsetStrategy=columns, seed=seed, **extra,
    )


def search_boosted(train: DataFrame, validation: DataFrame, trials: int = 20, rounds: int = 100, patience: int = 10, seed: int = 42) -> tuple[dict, float]:
    """Best settings of a random search by validation ROC area: depth 3 to 9, log-uniform step, row and column shares of 0.6
    to 1. The trials are fitted side by side; a trial keeps the rounds up to its best area, stopping after ``patience`` rounds without a
    better one."""
    draw = random.Random(seed)
    chosen = []
    for _ in range(trials):
        depth, step = draw.randint(3, 9), math.exp(draw.uniform(math.log(0.01), math.log(0.3)))
        chosen.append(B.Settings(depth=depth, rounds=rounds, step=step, rows=draw.uniform(0.6, 1.0), columns=draw.uniform(0.6, 1.0)))
    array = lambda df: df.withColumn("_x", vector_to_array("features"))
    areas = B.search_areas(array(train), array(validation), chosen, "_x", "label", "weight", patience, seed=seed)
    kept = [B.stopped(a, patience) for a in areas]
    best = max(range(trials), key=lambda t: areas[t][kept[t] - 1])
    s = chosen[best]
    settings = {"depth": s.depth, "step": s.step, "rows": s.rows, "columns": s.columns, "rounds": kept[best]}
    return settings, float(areas[best][kept[best] - 1])


def multiclass_boosted(train: DataFrame, classes: int, rounds: int = 200, step: float = 0.05, depth: int = 4, seed: int = 42) -> B.Model:
    """Softmax boosting: a tree per class and round."""
    rows = train.withColumn("_x", vector_to_array("features"))
    return B.fit(rows, [B.Settings(depth=depth, rounds=rounds, step=step)], "_x", "label", classes, seed=seed)[0]


def classified(df: DataFrame, model: B.Model, output: str = "prediction") -> DataFrame:
    """Rows with the class of the largest margin."""
    done = B.with_margins(df.withColumn("_x", vector_to_array("features")), model, "_x", "_margins")
    return done.withColumn(output, B.predicted_class("_margins", output)).drop("_x", "_margins")


def multinomial(train_rows: int, c: float = 1.0, iterations: int = 2000) -> LogisticRegression:
    """L2 strength ``1 / (C n)`` on features that are already scaled."""
    return LogisticRegression(
        featuresCol="features", labelCol="label", family="multinomial", maxIter=iterations,
        regParam=1.0 / (c * train_rows), elasticNetParam=0.0, standardization=False,
    )


def scored(model: Model, df: DataFrame, name: str = "churn_probability") -> DataFrame:
    """Probability of class 1 and the margin behind it."""
    done = model.transform(df)
    return done.withColumns(
        {name: vector_to_array("probability")[1], "margin": vector_to_array("rawPrediction")[1]}
    )


def save_boosted(model: GBTClassificationModel, path: str, columns: Sequence[str], threshold: float) -> None:
    """The model with the order of its inputs and its tuned threshold, for jobs that score later."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    settings = spark.createDataFrame([(list(columns), float(threshold))], "columns array<string>, threshold double")
    settings.coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def load_boosted(spark: SparkSession, path: str) -> tuple[GBTClassificationModel, list[str], float]:
    settings = spark.read.schema("columns array<string>, threshold double").json(f"{path}/settings").first()
    return GBTClassificationModel.load(f"{path}/model"), list(settings["columns"]), settings["threshold"]


# --- isolation forest ----------------------------------------------------------------------------

TREES, TREE_ROWS = 200, 256


def _average_path(n):
    """Mean depth of an unsuccessful search among ``n`` rows (Liu, Ting and Zhou 2008)."""
    n = np.asarray(n, dtype=np.float64)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(rows: np.ndarray, rng: np.random.Generator, height: int) -> list[tuple]:
    """Nodes ``(node, feature, cut, left, right, path)`` of one tree; a leaf has feature -1."""
    nodes: list[tuple] = []
    waiting = [(0, rows, 0)]
    count = 1
    while waiting:
        node, held, depth = waiting.pop()
        low, high = held.min(axis=0), held.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= height or len(held) <= 1 or not len(usable):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(_average_path(len(held)))))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = held[:, feature] < cut
        nodes.append((node, feature, cut, count, count + 1, 0.0))
        waiting.append((count, held[goes_left], depth + 1))
        waiting.append((count + 1, held[~goes_left], depth + 1))
        count += 2
    return nodes


def fit_isolation_forest(df: DataFrame, features: str, key: str, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 42) -> DataFrame:
    """Node table of the forest. Each tree sees up to ``tree_rows`` rows, drawn from the whole table by
    a hash of the tree and the key; each tree is one bounded group."""
    total = df.count()
    drawn = lambda *parts: F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 30)) / float(1 << 30)
    pool = df.select(F.col(features).alias("x"), F.col(key).alias("k"))
    share = min(1.0, 1.25 * tree_rows / max(1, total))
    # how many trees a row belongs to is one draw, so that the many rows of none go before any is repeated
    upto, reached = [], 0.0
    for n in range(trees + 1):
        upto.append(reached)
        reached += math.comb(trees, n) * share**n * (1 - share) ** (trees - n)
    number = F.size(F.filter(F.array(*map(F.lit, upto)), lambda edge: drawn("k") >= edge)) - 1
    # rows of none are told by one comparison; how many trees the others belong to takes one for each tree
    belonging = pool.filter(drawn("k") >= upto[1]).withColumn("_n", number)
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(F.xxhash64(F.lit(seed), F.lit("tree"), t, "k").alias("h"), t.alias("t"))))
    members = belonging.withColumn("tree", F.explode(F.transform(F.slice(ranked, F.lit(1), F.col("_n")), lambda r: r["t"])))
    members = members.drop("_n").withColumn("_d", drawn("tree", "k"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_d", "k"]).head(tree_rows)
        tree = int(part["tree"].iloc[0])
        rows = np.stack(part["x"].to_numpy())
        height = math.ceil(math.log2(max(2, tree_rows)))
        nodes = _grow(rows, np.random.default_rng([seed, tree]), height)
        out = pd.DataFrame(nodes, columns=["node", "feature", "cut", "left", "right", "path"])
        out.insert(0, "tree", tree)
        return out.assign(rows=len(rows))

    schema = "tree int, node int, feature int, cut double, left int, right int, path double, rows int"
    return members.groupBy("tree").applyInPandas(build, schema)


def isolation_scores(df: DataFrame, forest: DataFrame, features: str, output: str = "iso_score") -> DataFrame:
    """Anomaly score in (0, 1], higher is more anomalous. The forest is at most ``trees * 2 *
    tree_rows`` nodes whatever the table's size, so it is broadcast."""
    nodes = forest.toPandas()
    trees = []
    for _, part in nodes.groupby("tree"):
        part = part.sort_values("node")
        trees.append(tuple(part[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")))
    normal = float(_average_path(nodes["rows"].max()))
    held = df.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="float64")
        x = np.stack(vectors.to_numpy())
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        for feature, cut, left, right, path in held.value:
            at = np.zeros(len(x), dtype=np.int64)
            # down to the leaves, however deep the forest was grown
            while (inner := (split := feature[at]) >= 0).any():
                below = x[rows, np.where(inner, split, 0)] < cut[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += path[at]
        return pd.Series(2.0 ** (-(total / len(held.value)) / normal))

    return df.withColumn(output, score(F.col(features)))


# --- one-class boundary --------------------------------------------------------------------------


class OneClassBoundary:
    """Linear one-class boundary on random Fourier features of an RBF kernel (Rahimi and Recht).

    ``gap`` bounds how far the fit's objective is from its optimum, as a share of the squared normal; ``passes`` says how
    often the rows were read for it."""

    def __init__(self, weights: np.ndarray, shifts: np.ndarray, normal: np.ndarray, offset: float):
        self.weights, self.shifts, self.normal, self.offset = weights, shifts, normal, offset
        self.gap, self.passes = math.inf, 0

    def features(self, x: np.ndarray) -> np.ndarray:
        return math.sqrt(2.0 / len(self.shifts)) * np.cos(x @ self.weights + self.shifts)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Distance outside the boundary: higher is more anomalous."""
        return self.offset - self.features(x) @ self.normal


def outside_share(rate: float) -> float:
    """Share of the rows that the boundary may leave outside, from the share of anomalies."""
    return min(1.5 * rate, 0.3) or 0.01


def _least_norm(points: np.ndarray, shares: np.ndarray, moves: int = 2000) -> np.ndarray:
    """Shares of the points whose mean of shares lies nearest to zero; mass moves from the worst point to the best."""
    gram = points @ points.T
    for _ in range(moves):
        slope = gram @ shares
        to, away = int(slope.argmin()), int(np.where(shares > 0, slope, -np.inf).argmax())
        bend = gram[to, to] - 2 * gram[to, away] + gram[away, away]
        if slope[away] - slope[to] < 1e-12 or bend <= 0:
            break
        move = min(shares[away], (slope[away] - slope[to]) / bend)
        shares[to] += move
        shares[away] -= move
    return shares


def fit_one_class(
    df: DataFrame, features: str, rate: float, width: int = 128, steps: int = 200, seed: int = 42, tolerance: float = 0.02
) -> OneClassBoundary:
    """The boundary's normal is the shortest mean of rows in which no row weighs more than one of the ``share * n`` that may
    lie outside. Every pass over the rows, which are stored once, adds the mean of the rows lowest along the normal as a
    corner and finds the shortest mix of all corners so far. The same pass sums the gap to the optimum; the fit stops where
    that is at most ``tolerance`` of the squared normal, or after ``steps`` passes (the gap then says so). A partition
    gives counts and sums of a few intervals of the score, whatever its rows; only those reach the driver. An empty table
    gives a boundary that scores every row zero."""
    share = outside_share(rate)
    rows = stored(df.select(features), "boundary")
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size(features)).alias("d")).first()
    inputs = shape.d or 1
    rng = np.random.default_rng(seed)
    # the kernel width that unit-variance inputs call for
    model = OneClassBoundary(
        rng.normal(0.0, math.sqrt(2.0 / inputs), (inputs, width)),
        rng.uniform(0.0, 2 * math.pi, width),
        np.zeros(width), 0.0,
    )
    if not shape.n:
        return model
    held = df.sparkSession.sparkContext.broadcast((model.weights, model.shifts))

    def by_interval(normal: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Per interval of the score: rows, and the sum of their features."""

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            weights, shifts = held.value
            maker = OneClassBoundary(weights, shifts, normal, 0.0)
            total = np.zeros((len(edges) + 1, 1 + width))
            for batch in batches:
                if not len(batch):
                    continue
                z = maker.features(np.stack(batch[features].to_numpy()))
                one = np.zeros((len(z), len(edges) + 1))
                one[np.arange(len(z)), np.searchsorted(edges, z @ normal, side="right")] = 1.0
                total[:, 0] += one.sum(axis=0)
                total[:, 1:] += one.T @ z
            yield pd.DataFrame({"grad": [total.ravel()]})

        return _summed(rows.mapInPandas(sums, "grad array<double>")).reshape(-1, 1 + width)

    mass = max(1.0, share * shape.n)
    corners = [by_interval(np.zeros(width), np.zeros(0))[0, 1:] / shape.n]
    shares = np.ones(1)
    model.normal, model.passes = corners[0], 1
    around, reach = 0.0, 1.0
    while True:
        square = float(model.normal @ model.normal)
        # no feature vector is longer than the square root of two
        limit = math.sqrt(2.0 * square)
        edges = np.linspace(around - reach, around + reach, 17) * limit
        counted = by_interval(model.normal, edges)
        model.passes += 1
        left, corner, least = mass, np.zeros(width), 0.0
        for i, interval in enumerate(counted):
            count, used = interval[0], min(interval[0], left)
            if not used:
                continue
            part = interval[1:] * (used / count)
            corner += part
            # of an interval that is taken in part, the lowest rows could all lie at its lower edge
            floor = float(part @ model.normal) if used == count else used * (edges[i - 1] if i else -limit)
            least += floor
            left -= used
            if left <= 1e-9 * mass:
                break
        model.offset = float(edges[i - 1] if i else -limit)
        model.gap = max(0.0, square - least / mass) / max(square, 1e-12)
        if model.gap <= tolerance or model.passes >= steps:
            return model
        inside = 0 < i < len(edges)
        reach = max(0.02, reach * 0.6) if inside else min(1.0, 2.5 * reach)
        corners.append(corner / mass)
        shares = _least_norm(np.stack(corners), np.append(shares, 0.0))
        model.normal = shares @ np.stack(corners)
        # the next pass looks closely where this one found the quantile
        around = float(np.clip(model.offset / limit if limit else 0.0, -1.0, 1.0))


def _summed(parts: DataFrame) -> np.ndarray:
    """Entry-wise sum of the partitions' vectors, as decimals: the order in which partitions arrive does not matter."""
    entries = parts.select(F.posexplode("grad").alias("at", "value")).groupBy("at")
    sums = entries.agg(F.sum(F.col("value").cast("decimal(38,14)")).cast("double").alias("value"))
    return np.array([r["value"] for r in sums.orderBy("at").collect()], dtype=np.float64)


def one_class_scores(df: DataFrame, model: OneClassBoundary, features: str, output: str = "svm_score") -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="float64")
        return pd.Series(held.value.score(np.stack(vectors.to_numpy())))

    return df.withColumn(output, score(F.col(features)))


# --- reconstruction error ------------------------------------------------------------------------


def fit_reconstruction(df: DataFrame, columns: Sequence[str], normal: Column, k: int = 4) -> tuple[list[float], list[list[float]]]:
    """Means and the first ``k`` principal directions of the normal rows."""
    rows = df.filter(normal).select(array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])).alias("x"), *columns)
    pca = PCA(k=min(k, len(columns)), inputCol="x", outputCol="_p").fit(rows)
    means = rows.agg(*[F.avg(c) for c in columns]).first()
    return [float(m) for m in means], pca.pc.toArray().T.tolist()


def reconstruction_error(df: DataFrame, columns: Sequence[str], fitted: tuple[list[float], list[list[float]]], output: str = "ae_rmse") -> DataFrame:
    """Root mean squared distance of a row to its projection; column arithmetic only."""
    means, directions = fitted
    shifted = df.withColumns({f"_c{i}": F.col(c) - F.lit(m) for i, (c, m) in enumerate(zip(columns, means))})
    plus = lambda terms: sum(terms[1:], terms[0])
    projected = shifted.withColumns(
        {f"_p{j}": plus([F.col(f"_c{i}") * F.lit(v) for i, v in enumerate(d)]) for j, d in enumerate(directions)}
    )
    errors = [
        F.pow(F.col(f"_c{i}") - plus([F.col(f"_p{j}") * F.lit(d[i]) for j, d in enumerate(directions)]), F.lit(2.0))
        for i in range(len(columns))
    ]
    made = [f"_c{i}" for i in range(len(columns))] + [f"_p{j}" for j in range(len(directions))]
    return projected.withColumn(output, F.sqrt(plus(errors) / len(columns))).drop(*made)


class Autoencoder:
    """The principal plane of the normal rows and a small net for what bends away from it: two layers down to the plane's
    width, two back. With the last layer of each half at zero it is the plane itself."""

    def __init__(self, means: np.ndarray, directions: np.ndarray, weights: Sequence[np.ndarray], loss: float = math.inf):
        self.means, self.directions, self.weights, self.loss = means, directions, list(weights), loss

    def with_flat(self, flat: np.ndarray, loss: float = math.inf) -> "Autoencoder":
        """The same plane with other weights, given in one vector."""
        cuts = np.cumsum([w.size for w in self.weights])[:-1]
        return Autoencoder(self.means, self.directions, [part.reshape(w.shape) for part, w in zip(np.split(flat, cuts), self.weights)], loss)

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights])

    def layers(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        down, down_shift, code, up, up_shift, back, back_shift = self.weights
        centred = x - self.means
        first = np.tanh(centred @ down + down_shift)
        middle = centred @ self.directions.T + first @ code
        second = np.tanh(middle @ up + up_shift)
        return centred, first, middle, second, middle @ self.directions + second @ back + back_shift

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Mean squared error of each row."""
        centred, *_, made = self.layers(x)
        return ((made - centred) ** 2).mean(axis=1)

    def gradients(self, x: np.ndarray) -> np.ndarray:
        """Mean gradient of the rows' errors, as one vector."""
        _, _, code, up, _, back, _ = self.weights
        centred, first, middle, second, made = self.layers(x)
        off = 2.0 * (made - centred) / made.size
        at_second = (off @ back.T) * (1.0 - second**2)
        at_middle = off @ self.directions.T + at_second @ up.T
        at_first = (at_middle @ code.T) * (1.0 - first**2)
        parts = [
            centred.T @ at_first, at_first.sum(axis=0), first.T @ at_middle,
            middle.T @ at_second, at_second.sum(axis=0), second.T @ off, off.sum(axis=0),
        ]
        return np.concatenate([p.ravel() for p in parts])


def fit_autoencoder(
    df: DataFrame, columns: Sequence[str], normal: Column, k: int = 4, hidden: int = 16, passes: int = 25,
    batch: int = 256, updates: int = 64, rate: float = 0.01, patience: int = 4, seed: int = 42,
) -> Autoencoder:
    """A net fitted on the normal rows, which are stored once. In a pass every partition takes the shared weights, sums
    their error over its rows and trains on by batches, ``updates`` steps for each Arrow batch or once over it; the driver averages the weights by rows. Weights that did worse are
    taken half the way back to the best ones; the fit ends after ``patience`` passes without a gain of a thousandth.
    The best weights are kept, and the first ones are the principal plane's, so that the error is never above the plane's.
    Columns hold no nulls; without normal rows there is no plane, which raises as it does there."""
    means, directions = fit_reconstruction(df, columns, normal, k)
    rows = stored(df.filter(normal).select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x")), "normal-rows")
    plane = np.array(directions)
    wide, k = len(columns), len(plane)
    rng = np.random.default_rng(seed)
    draw = lambda n, m: rng.normal(0.0, 1.0 / math.sqrt(n), (n, m))
    start = [draw(wide, hidden), np.zeros(hidden), np.zeros((hidden, k)), draw(k, hidden), np.zeros(hidden), np.zeros((hidden, wide)), np.zeros(wide)]
    current = Autoencoder(np.array(means), plane, start)

    def trained(model: Autoencoder, rate: float) -> np.ndarray:
        held = df.sparkSession.sparkContext.broadcast(model)

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            given = held.value
            own, loss, n, t = given.flat(), 0.0, 0, 0
            mean, square = np.zeros_like(own), np.zeros_like(own)
            for frame in batches:
                if not len(frame):
                    continue
                x = np.stack(frame["x"].to_numpy())
                loss += float(given.errors(x).sum())
                n += len(x)
                starts = range(0, len(x), batch)
                for at in list(starts) * max(1, updates // len(starts)):
                    t += 1
                    slope = given.with_flat(own).gradients(x[at : at + batch])
                    mean = 0.9 * mean + 0.1 * slope
                    square = 0.999 * square + 0.001 * slope**2
                    own = own - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
            if n:
                yield pd.DataFrame({"grad": [np.concatenate([[loss, n], n * own])]})

        return _summed(rows.mapInPandas(part, "grad array<double>"))

    best, idle = current, 0
    for _ in range(passes):
        total = trained(current, rate)
        loss, after = total[0] / total[1], total[2:] / total[1]
        idle = 0 if loss < best.loss * (1 - 1e-3) else idle + 1
        if loss < best.loss:
            best = current.with_flat(current.flat(), loss)
            current = current.with_flat(after)
        else:
            rate /= 2
            current = current.with_flat((best.flat() + current.flat()) / 2)
        if idle >= patience:
            break
    return best


def autoencoder_error(df: DataFrame, columns: Sequence[str], model: Autoencoder, output: str = "ae_rmse") -> DataFrame:
    """Root mean squared distance of a row to what the net makes of it."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="float64")
        return pd.Series(np.sqrt(held.value.errors(np.stack(vectors.to_numpy()))))

    return df.withColumn(output, score(F.array(*[F.col(c).cast("double") for c in columns])))


# --- the three together --------------------------------------------------------------------------


def ensemble_scores(df: DataFrame, columns: Sequence[str], key: str, label: str, trees: int = TREES, steps: int = 200, seed: int = 42) -> DataFrame:
    """Scaled inputs and the three model scores per row: forest and boundary fitted without labels,
    the net on normal rows only."""
    names = [f"_s{i}" for i in range(len(columns))]
    filled = M.fill_gaps(df, list(columns))
    # the fits pass over the inputs many times
    rows = stored(M.standard_scaled(filled, filled, dict(zip(columns, names))).withColumn("_x", F.array(*names)), "inputs")
    rate = float(rows.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)
    forest = fit_isolation_forest(rows, "_x", key, trees=trees, seed=seed)
    boundary = fit_one_class(rows, "_x", rate, steps=steps, seed=seed)
    net = fit_autoencoder(rows, names, F.col(label) == 0, seed=seed)
    scored = autoencoder_error(one_class_scores(isolation_scores(rows, forest, "_x"), boundary, "_x"), names, net)
    return scored.drop("_x", *names)
