"""Approximate vector search (R24): an inverted file over spherical k-means cells."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from sifterra.operators.search import cosine, top_k
from sifterra.session import bounded_sample, broadcast_if_small, few_files


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def fit_cells(df: DataFrame, key: str, vec: str, cells: int | None = None, bound: int = 20_000, rounds: int = 15, seed: int = 1) -> np.ndarray:
    """Unit centroids of spherical k-means, fitted on at most ``bound`` vectors chosen by the hash of their keys.

    Without ``cells`` there are about as many as the square root of the rows, 64 at least and a tenth of ``bound`` at most, so that a probe reads a
    like share of a table that has grown.
    """
    if cells is None:
        cells = max(64, min(bound // 10, int(df.count() ** 0.5)))
    rows = bounded_sample(few_files(df).where(F.col(vec).isNotNull()).select(key, vec), [key], bound)
    x = _unit(np.array([r[1] for r in sorted(rows, key=lambda r: str(r[0]))], dtype=np.float64)) if rows else np.zeros((0, 1))
    if len(x) <= cells:
        return x
    rng = np.random.default_rng(seed)
    c = [x[rng.integers(len(x))]]
    far = 1 - x @ c[0]
    for _ in range(cells - 1):
        p = np.maximum(far, 0) + 1e-12
        c.append(x[rng.choice(len(x), p=p / p.sum())])
        far = np.minimum(far, 1 - x @ c[-1])
    c = np.array(c)
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        empty = np.bincount(near, minlength=len(c)) == 0
        sums[empty] = x[rng.integers(len(x), size=int(empty.sum()))]
        c = _unit(sums)
    return c


def fit_probes(df: DataFrame, key: str, vec: str, centroids: np.ndarray, k: int = 10, target: float = 0.95, bound: int = 5_000, queries: int = 100) -> int:
    """The fewest cells to probe for a recall of ``target`` at k, measured by brute force inside a bounded sample."""
    rows = bounded_sample(few_files(df).where(F.col(vec).isNotNull()).select(key, vec), [key], bound, seed=29)
    if not rows or not len(centroids):
        return 1
    x = _unit(np.array([r[1] for r in sorted(rows, key=lambda r: str(r[0]))], dtype=np.float64))
    q = x[:: max(1, len(x) // queries)]
    best = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]
    cell = (x @ centroids.T).argmax(1)
    place = np.argsort(np.argsort(-(q @ centroids.T), axis=1, kind="stable"), axis=1)
    need = np.sort(np.take_along_axis(place, cell[best], 1).ravel())
    return int(need[min(len(need) - 1, int(np.ceil(target * len(need))) - 1)]) + 1


def nearest_cells(centroids: np.ndarray, n: int):
    """A UDF: the n nearest cells of each vector, nearest first; null for a null vector."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def run(v: pd.Series) -> pd.Series:
        out = [None] * len(v)
        have = [i for i, x in enumerate(v) if x is not None]
        if have and len(centroids):
            s = np.stack([v.iloc[i] for i in have]).astype(np.float64) @ centroids.T
            order = np.argsort(-s, axis=1, kind="stable")[:, :n]
            for i, row in zip(have, order):
                out[i] = row.tolist()
        return pd.Series(out)

    return run


def ann_search(vectors: DataFrame, queries: DataFrame, key: str, vec: str, query_key: str, query_vec: str, centroids: np.ndarray, k: int, probes: int = 8, salts: int = 8) -> DataFrame:
    """``query, key, score, rank``: the best k by cosine among the vectors in each query's ``probes`` nearest cells.

    Every vector is indexed, in its nearest cell. The join runs on (cell, salt): a cell that holds a third of
    all vectors is spread over ``salts`` parts, to each of which its queries are sent. Each map task keeps
    its best k of a query before the shuffle. Null vectors are neither found nor searched.
    """
    index = vectors.select(F.col(key), F.col(vec), nearest_cells(centroids, 1)(vec)[0].alias("_cell"), F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt")).where("_cell is not null")
    asked = queries.select(F.col(query_key), F.col(query_vec), F.explode(nearest_cells(centroids, probes)(query_vec)).alias("_cell"))
    asked = asked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    pairs = index.join(broadcast_if_small(asked), ["_cell", "_salt"])
    scored = pairs.select(query_key, key, F.round(cosine(F.col(vec), F.col(query_vec)), 6).alias("score"))
    return top_k(scored, [query_key], [F.desc("score"), F.asc(key)], k)


def recall_at_k(found: DataFrame, exact: DataFrame, query_key: str, key: str) -> DataFrame:
    """One row: the share of the exact results that were found."""
    hit = exact.select(query_key, key).join(found.select(query_key, key, F.lit(1).alias("_h")), [query_key, key], "left")
    return hit.agg(F.count("*").alias("wanted"), F.count("_h").alias("found"), (F.count("_h") / F.count("*")).alias("recall"))
