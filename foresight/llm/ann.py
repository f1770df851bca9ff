"""Nearest neighbours from low-dimensional stable projections indexed by kd-trees.

Gaussian projections to a few dimensions keep distances as d^2 times a chi-square variable. An upper kd-tree, cut from a
bounded sample, deals all vectors into cells; a cell is indexed by a kd-tree in its task. A query takes the leaves of its
own cell in order of projected distance, checks their original vectors, and stops when a vector as near as the k-th found
would lie so far out in projection with probability below 1 - CONFIDENCE. With the distance so found it then visits the
other cells that the same test does not rule out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from foresight.llm.arrow import by_group
from foresight.llm.vectors import matrix, sample, valid
from foresight.session import materialize

DIMENSIONS = 8          # even: the chi-square distribution then has a closed form
CONFIDENCE = 0.98
CELL_ROWS = 16_384
LEAF_ROWS = 64
SAMPLE = 20_000


def chi_square(x: np.ndarray, m: int = DIMENSIONS) -> np.ndarray:
    """Distribution function with an even number m of degrees of freedom."""
    h, term, total = np.asarray(x, float) / 2, 1.0, 1.0
    for k in range(1, m // 2):
        term = term * h / k
        total = total + term
    with np.errstate(invalid="ignore"):
        return np.where(np.isinf(h), 1.0, 1 - np.exp(-h) * total)


def _boxes(points: np.ndarray, leaves_of: int) -> list[np.ndarray]:
    """Row sets of the leaves of a kd-tree: the widest dimension is cut at its median."""
    todo, out = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(1)
        if len(own) <= leaves_of or spread.max() == 0:
            out += [own[a:a + leaves_of] for a in range(0, len(own), leaves_of)]
            continue
        order = np.argpartition(points[own, spread.argmax()], len(own) // 2)
        todo += [own[order[len(own) // 2:]], own[order[:len(own) // 2]]]
    return out


class Cells:
    """Upper kd-tree: cut points in heap order, cells numbered from the left."""

    def __init__(self, projected: np.ndarray, cells: int):
        self.levels = max(0, math.ceil(math.log2(max(1, cells))))
        self.axis, self.cut = np.zeros(1 << self.levels, np.int64), np.zeros(1 << self.levels)
        own = {1: projected}
        for node in range(1, 1 << self.levels):
            p = own.pop(node)
            if len(p):
                self.axis[node] = np.ptp(p, axis=0).argmax()
                self.cut[node] = np.median(p[:, self.axis[node]])
            right = p[:, self.axis[node]] > self.cut[node]
            own[2 * node], own[2 * node + 1] = p[~right], p[right]

    def place(self, projected: np.ndarray) -> np.ndarray:
        node = np.ones(len(projected), np.int64)
        for _ in range(self.levels):
            node = 2 * node + (projected[np.arange(len(node)), self.axis[node]] > self.cut[node])
        return node - (1 << self.levels)

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance of a point to every cell."""
        m = len(q)
        low, high = np.full((2 << self.levels, m), -np.inf), np.full((2 << self.levels, m), np.inf)
        for node in range(1, 1 << self.levels):
            for child in (2 * node, 2 * node + 1):
                low[child], high[child] = low[node], high[node]
            high[2 * node, self.axis[node]] = low[2 * node + 1, self.axis[node]] = self.cut[node]
        low, high = low[1 << self.levels:], high[1 << self.levels:]
        return (np.maximum(np.maximum(low - q, q - high), 0) ** 2).sum(1)


def _search(ids, x, projected, queries, k):
    """(query position, ids, distances) within one cell; queries: (id, vector, projection, k-th distance so far)."""
    leaves = _boxes(projected, LEAF_ROWS)
    low = np.array([projected[o].min(0) for o in leaves])
    high = np.array([projected[o].max(0) for o in leaves])
    for n, (own, q, pq, limit) in enumerate(queries):
        away = (np.maximum(np.maximum(low - pq, pq - high), 0) ** 2).sum(1)
        order = np.argsort(away, kind="stable")
        found_d, found_i = np.zeros(0), np.zeros(0, np.int64)
        for a in range(0, len(order), 8):
            if limit < math.inf and (limit == 0 and away[order[a]] > 0 or limit > 0 and chi_square(away[order[a]] / limit**2) >= CONFIDENCE):
                break
            rows = np.concatenate([leaves[j] for j in order[a:a + 8]])
            rows = rows[ids[rows] != own]
            d = np.sqrt(((x[rows] - q) ** 2).sum(1))
            found_d, found_i = np.concatenate([found_d, d]), np.concatenate([found_i, ids[rows]])
            if len(found_d) > k:
                best = np.lexsort((found_i, found_d))[:k]
                found_d, found_i = found_d[best], found_i[best]
            if len(found_d) == k:
                limit = min(limit, float(found_d.max()))
        yield n, found_i, found_d


def nearest(df: DataFrame, is_query: str, k: int = 10, key: str = "vec_id", vector: str = "embedding", seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which the SQL condition on `id` holds.

    Euclidean distance in double precision; ties go to the smaller id; a query's own id is no candidate. Rows that take
    no part are those `vectors.valid` leaves out. Repeated ids are candidates row by row; a repeated query is asked once."""
    spark = df.sparkSession
    v = materialize(valid(df, key, vector), "vectors")
    rows = v.count()
    some = sample(v, rows, SAMPLE)
    planes = np.random.default_rng(seed).normal(size=(some.shape[1] if len(some) else 1, DIMENSIONS))
    tree = Cells(some @ planes if len(some) else np.zeros((0, DIMENSIONS)), -(-rows // CELL_ROWS))

    def place(batches):
        for b in batches:
            x = matrix(b.column(1))
            cell = tree.place(x @ planes) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell, pa.int64())], names=["id", "vector", "cell"])

    placed = materialize(v.mapInArrow(place, "id bigint, vector array<double>, cell bigint"), "cells")
    # a cell that many equal vectors fill is dealt over several tasks
    split = placed.groupBy("cell").agg(F.ceil(F.count("*") / (4 * CELL_ROWS)).cast("int").alias("parts"))
    split = materialize(split, "cell-parts")
    data = placed.join(split, "cell").select("cell", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), F.lit(0).alias("ask"), "id", "vector", F.lit(None).cast("double").alias("bound"))
    queries = placed.where(is_query).dropDuplicates(["id"])

    def ask(asked):
        q = asked.join(split, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("ask"), "id", "vector", "bound")

        def cell(t):
            x, asks, ids = matrix(t["vector"]), t["ask"].to_numpy() == 1, t["id"].to_numpy()
            if not asks.any() or asks.all():
                return
            p = x @ planes
            bound = t["bound"].to_numpy()
            todo = [(ids[i], x[i], p[i], math.inf if np.isnan(bound[i]) else float(bound[i])) for i in np.flatnonzero(asks)]
            for n, found, d in _search(ids[~asks], x[~asks], p[~asks], todo, k):
                if len(found):
                    yield pa.table({"query_id": np.full(len(found), todo[n][0]), "vec_id": found, "score": d})

        both = data.union(q).repartition("cell", "part").sortWithinPartitions("cell", "part", "ask", "id")
        return both.mapInArrow(lambda b: by_group(b, ["cell", "part"], cell), "query_id bigint, vec_id bigint, score double")

    first = materialize(ask(queries.withColumn("bound", F.lit(None).cast("double"))), "near")
    bounds = _best(first, k).groupBy("query_id").agg(F.when(F.count("*") == k, F.max("score")).alias("bound"))

    def others(batches):
        for b in batches:
            x, home, bound = matrix(b.column(1)), b.column(2).to_numpy(), b.column(3).to_numpy(zero_copy_only=False)
            for i in range(len(home)):
                away = tree.distances(x[i] @ planes)
                near = np.ones(len(away), bool) if np.isnan(bound[i]) else (away == 0) if bound[i] == 0 else chi_square(away / bound[i] ** 2) < CONFIDENCE
                near[home[i]] = False
                cells = np.flatnonzero(near)
                if len(cells):
                    take = pa.array(np.full(len(cells), i))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(cells, pa.int64()), pa.array(np.full(len(cells), bound[i]), pa.float64(), from_pandas=True)], names=["id", "vector", "cell", "bound"])

    again = queries.join(bounds.withColumnRenamed("query_id", "id"), "id", "left").select("id", "vector", "cell", "bound")
    second = ask(again.mapInArrow(others, "id bigint, vector array<double>, cell bigint, bound double"))
    return _best(first.union(second), k).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
