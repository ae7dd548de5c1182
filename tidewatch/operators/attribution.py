"""Additive per-row attributions of a boosted-tree model in margin space.

Path-dependent Shapley values of tree ensembles (Lundberg et al. 2018). The value of a leaf is
shared among the features on its path; how depends only on which of them the row satisfies, so the
shares of all patterns are worked out once and looked up for the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import new_table_path


#: Path features up to which all patterns are tabled.
TABLE_FEATURES = 8


class Leaf(NamedTuple):
    """A leaf with the distinct features on its path: the interval each must lie in (above ``low``,
    up to ``high``) and the share of training weight that follows the path at its splits."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    share: list[float]


def model_leaves(model: GBTClassificationModel, df: DataFrame) -> list[Leaf]:
    """Leaves of all trees, read from the saved node table. Their number is set by depth and rounds."""
    path = new_table_path(df.sparkSession, "model")
    model.save(path)
    rows = (
        df.sparkSession.read.parquet(f"{path}/data")
        .select(
            "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
            "nodeData.split.featureIndex",
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"),
            F.get("nodeData.impurityStats", F.lit(0)).alias("cover"),
        )
        .collect()
    )
    trees: dict[int, dict[int, object]] = {}
    for r in rows:
        trees.setdefault(r.treeID, {})[r.id] = r
    leaves = []
    for tree, weight in enumerate(model.treeWeights):
        leaves.extend(_tree_leaves(trees[tree], float(weight)))
    return leaves


def _tree_leaves(nodes: dict, weight: float) -> Iterator[Leaf]:
    waiting = [(0, {})]
    while waiting:
        at, bounds = waiting.pop()
        node = nodes[at]
        if node.leftChild < 0:
            order = sorted(bounds)
            yield Leaf(
                node.prediction * weight, order, [bounds[f][0] for f in order],
                [bounds[f][1] for f in order], [bounds[f][2] for f in order],
            )
            continue
        feature = node.featureIndex
        low, high, share = bounds.get(feature, (-math.inf, math.inf, 1.0))
        for child, span in (
            (node.leftChild, (low, min(high, node.cut))),
            (node.rightChild, (max(low, node.cut), high)),
        ):
            part = nodes[child].cover / node.cover if node.cover else 0.0
            waiting.append((child, {**bounds, feature: (*span, share * part)}))


def _weights(m: int) -> np.ndarray:
    """Shapley weight of a subset of size ``s`` out of the other ``m - 1`` features."""
    f = math.factorial
    return np.array([f(s) * f(m - s - 1) / f(m) for s in range(m)])


def _shares(leaf: Leaf, followed: np.ndarray) -> np.ndarray:
    """Shapley share of the leaf per pattern (row) and path feature (column)."""
    zero = np.array(leaf.share)
    patterns, m = followed.shape
    out = np.zeros((patterns, m))
    weights = _weights(m)
    for j in range(m):
        # coefficients by subset size of the product over the other features
        poly = np.zeros((patterns, m))
        poly[:, 0] = 1.0
        for other in range(m):
            if other != j:
                moved = np.zeros_like(poly)
                moved[:, 1:] = poly[:, :-1] * followed[:, [other]]
                poly = poly * zero[other] + moved
        out[:, j] = leaf.value * (followed[:, j] - zero[j]) * (poly @ weights)
    return out


def share_table(leaf: Leaf) -> np.ndarray | None:
    """Shapley shares of the leaf for all patterns, a column per path feature; none for a path of too many features."""
    m = len(leaf.features)
    return _shares(leaf, ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(np.float64)) if m <= TABLE_FEATURES else None


def attributions_of(leaves: Sequence[Leaf], tables: Sequence[np.ndarray | None], x: np.ndarray) -> np.ndarray:
    columns = np.ascontiguousarray(x.T, dtype=np.float64)
    phi = np.zeros_like(columns)
    for leaf, table in zip(leaves, tables):
        code = np.zeros(len(x), dtype=np.int64)
        for at, (feature, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high)):
            inside = columns[feature] > low
            inside &= columns[feature] <= high
            code += inside * np.int64(1 << at)
        if table is None:
            codes, code = np.unique(code, return_inverse=True)
            table = _shares(leaf, ((codes[:, None] >> np.arange(len(leaf.features))) & 1).astype(np.float64))
        for at, feature in enumerate(leaf.features):
            phi[feature] += table[:, at].take(code)
    return phi.T


def base_value(leaves: Sequence[Leaf]) -> float:
    """Margin of no information: leaf values weighted by the training weight that reaches them."""
    return float(sum(leaf.value * math.prod(leaf.share) for leaf in leaves))


def with_attributions(df: DataFrame, model: GBTClassificationModel, features: str = "features", output: str = "contributions") -> DataFrame:
    """Adds one contribution per feature, and ``base_value``; together they sum to the margin."""
    leaves = model_leaves(model, df)
    held = df.sparkSession.sparkContext.broadcast((leaves, [share_table(leaf) for leaf in leaves]))

    @F.pandas_udf("array<double>")
    def attribute(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="object")
        return pd.Series(list(attributions_of(*held.value, np.stack(vectors.to_numpy()))))

    return df.withColumns(
        {output: attribute(vector_to_array(features)), "base_value": F.lit(base_value(leaves))}
    )
