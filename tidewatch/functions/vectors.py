"""Nearest vectors of a batch: numpy inside a Spark task."""

from __future__ import annotations

import numpy as np
import pandas as pd

# scores that agree to this many places are ties and go to the smaller id
TIE_PLACES = 9
# queries and known vectors whose distances are held at once: 32 MB
TILE = 2048


def as_matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def distances(queries: np.ndarray, known: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        found = unit_rows(queries) @ unit_rows(known).T
        return np.subtract(1.0, found, out=found)
    if metric == "squared_l2":
        squares = (queries**2).sum(1)[:, None] + (known**2).sum(1)[None, :]
        return np.maximum(squares - 2.0 * queries @ known.T, 0.0)
    raise ValueError(f"unknown metric {metric!r}")


def nearest_rows(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int, metric: str, skip_same: bool
) -> pd.DataFrame:
    """The ``k`` nearest known vectors of each query as ``q, id, distance, rank``; ``ids`` ascend."""
    query, place, distance, rank = nearest_places(query_ids, queries, ids, known, k, metric, skip_same)
    return pd.DataFrame({"q": query_ids[query], "id": ids[place], "distance": distance, "rank": rank})


def nearest_places(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int, metric: str, skip_same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the queries and of their ``k`` nearest known vectors, distances and ranks; ``ids`` ascend.

    Distances are held for ``TILE`` known vectors and queries at a time, whatever the number of either."""
    k = min(k, len(known))
    parts = [
        _nearest_tiles(query_ids[at : at + TILE], queries[at : at + TILE], ids, known, k, metric, skip_same)
        for at in range(0, len(queries) if k else 0, TILE)
    ]
    if not parts:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0, int)
    place, exact = (np.concatenate(found) for found in zip(*parts))
    rank, query = np.nonzero(np.isfinite(exact.T))
    return query, place[query, rank], exact[query, rank], rank + 1


def _nearest_tiles(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int, metric: str, skip_same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``k`` nearest of each query, in order; an infinite distance where there are fewer."""
    place, exact = np.zeros((len(queries), k), dtype=np.int64), np.full((len(queries), k), np.inf)
    for at in range(0, len(known), TILE):
        own = ids[at : at + TILE]
        tile = distances(queries, known[at : at + TILE], metric)
        if skip_same:
            tile[query_ids[:, None] == own[None, :]] = np.inf
        least = tile.min(axis=1)
        if np.isnan(least).any():
            # what is no number takes a rank and returns no row
            tile[np.isnan(tile)] = -np.inf
            least = tile.min(axis=1)
        # an equal score of a later tile has a larger id; most queries find nothing nearer in most tiles
        better = np.flatnonzero(np.round(least, TIE_PLACES) < np.round(exact[:, -1], TIE_PLACES))
        tile = tile[better]
        left = np.round(tile, TIE_PLACES)
        rows = np.arange(len(better))
        places, values = [place[better]], [exact[better]]
        for _ in range(min(k, len(own))):
            best = left.argmin(axis=1)  # the first of equals, so the smallest id
            places.append((at + best)[:, None])
            values.append(np.where(left[rows, best] == np.inf, np.inf, tile[rows, best])[:, None])
            left[rows, best] = np.inf
        places, values = np.hstack(places), np.hstack(values)
        order = np.argsort(np.round(values, TIE_PLACES), axis=1, kind="stable")[:, :k]
        place[better], exact[better] = np.take_along_axis(places, order, 1), np.take_along_axis(values, order, 1)
    return place, exact
