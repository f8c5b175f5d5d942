"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by a pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) and names the nearest signed axis.  A query probes the ``probes`` signed axes nearest to it
in every table.  The queries go to the workers in blocks of bounded size, sorted into the buckets they
probe; the rows stay where they are scanned, meet the queries that probe their buckets and are
reranked by exact distance.  A task passes on ``k`` rows a query, so nothing but those is shuffled.
A query that meets fewer than ``k`` ids in its buckets is then compared with all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import materialize


@dataclass(frozen=True)
class CrossPolytope:
    """``query_block``: queries broadcast at once, at most (64 components: 50 MB)."""

    tables: int = 4
    probes: int = 40
    seed: int = 11
    query_block: int = 100_000


def hadamard(values: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of every row; the width is a power of two."""
    width = values.shape[1]
    half = 1
    while half < width:
        pairs = values.reshape(len(values), -1, 2, half)
        values = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(values), width)
        half *= 2
    return values / np.sqrt(width)


def rotated(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    width = 1 << max(vectors.shape[1] - 1, 0).bit_length()
    turned = np.zeros((len(vectors), width))
    turned[:, : vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rng = np.random.default_rng([seed, table, width])
    for _ in range(3):
        turned = hadamard(turned * rng.choice([-1.0, 1.0], width))
    return turned


def buckets(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Number of the nearest signed axis: 2 * axis, plus 1 on the negative side."""
    turned = rotated(vectors, table, seed)
    axis = np.abs(turned).argmax(1)
    return 2 * axis + (turned[np.arange(len(turned)), axis] < 0)


def probed(vectors: np.ndarray, table: int, spec: CrossPolytope) -> np.ndarray:
    """The signed axes each query probes, nearest first."""
    turned = rotated(vectors, table, spec.seed)
    sides = np.stack([turned, -turned], 2).reshape(len(turned), -1)
    return np.argsort(-sides, 1, kind="stable")[:, : spec.probes]


def nearest_ids(ids: np.ndarray, exact: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest different ids with their least distances, ties to smaller ids."""
    order = np.lexsort((ids, exact))
    order = order[np.sort(np.unique(ids[order], return_index=True)[1])[:k]]
    return ids[order], exact[order]


class QueryBlock:
    """Queries of one dimension; ``wanted[t]``: signed axis by query, true where the query probes it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, spec: CrossPolytope):
        self.ids, self.vectors = ids, vectors
        width = 2 << max(vectors.shape[1] - 1, 0).bit_length()
        self.wanted = np.zeros((spec.tables, width, len(ids)), bool)
        for t in range(spec.tables):
            self.wanted[t][probed(vectors, t, spec).T, np.arange(len(ids))] = True

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, k: int, spec: CrossPolytope) -> list[tuple[np.ndarray, ...]]:
        """(query position, ids, distances) of the k nearest ids among the given rows, ties to smaller ids."""
        names, firsts = np.unique(ids, return_index=True)
        repeated = len(names) < len(ids)
        if repeated:
            # Equal ids side by side; of equal rows one stays.
            both = np.unique(np.column_stack([ids, vectors.view(np.int64)]), axis=0)
            ids, vectors = both[:, 0].copy(), both[:, 1:].copy().view(np.float64)
            names, firsts = np.unique(ids, return_index=True)
        codes = [buckets(vectors, t, spec.seed) for t in range(spec.tables)]
        squares = (vectors**2).sum(1)
        found = []
        # Queries a step: the distance table has at most 4 million cells.
        step = max(1, 4_000_000 // len(ids))
        for at in range(0, len(self.ids), step):
            some = self.vectors[at : at + step]
            seen = np.zeros((len(some), len(ids)), bool)
            for t, code in enumerate(codes):
                seen |= self.wanted[t][:, at : at + step].T[:, code]
            seen &= self.ids[at : at + step, None] != ids[None]
            rough = (some**2).sum(1)[:, None] + squares[None] - 2 * some @ vectors.T
            rough[~seen] = np.inf
            if len(names) > k:
                smallest = np.minimum.reduceat(rough, firsts, axis=1) if repeated else rough
                edge = np.partition(smallest, k - 1, axis=1)[:, k - 1]
            else:
                edge = np.full(len(some), np.inf)
            # Rounding of the expanded square; rows this close to the k-th are measured exactly.
            slack = 1e-9 * ((some**2).sum(1) + squares.max())
            for i in range(len(some)):
                near = np.flatnonzero(np.isfinite(rough[i]) & (rough[i] <= edge[i] + slack[i]))
                exact = np.sqrt(((vectors[near] - some[i]) ** 2).sum(1))
                if len(near):
                    found.append((at + i, *nearest_ids(ids[near], exact, k)))
        return found


def by_width(ids: pd.Series, vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    widths = vectors.map(len).to_numpy()
    for width in np.unique(widths):
        here = widths == width
        yield ids.to_numpy()[here].astype(np.int64), np.stack(vectors.to_numpy()[here]).astype(np.float64)


def usable(vector: str) -> Column:
    """Not NULL or zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    spec: CrossPolytope = CrossPolytope(),
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, <id_column>, score: the ``k`` nearest rows found of every query, by Euclidean distance.

    A query is no candidate of its own id.  Vectors that are NULL, zero or hold NULL or non-finite
    components, and NULL ids, take no part; vectors of different lengths never meet.  An id that stands on
    several rows counts once, with its nearest vector; a query gets all candidates if there are fewer than ``k``.
    Hashing looks at directions only, so recall is measured for vectors of about equal length.  Other columns
    are ignored.
    """
    spark = rows.sparkSession
    pick = [F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")]
    asked = queries.select(*pick).where(usable("v") & F.col("id").isNotNull()).distinct()
    points = rows.select(*pick).where(usable("v") & F.col("id").isNotNull())

    def found(asked: DataFrame, number: int, blocks: int, spec: CrossPolytope) -> DataFrame:
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toPandas()
        shared = spark.sparkContext.broadcast(
            {v.shape[1]: QueryBlock(i, v, spec) for i, v in by_width(mine["id"], mine["v"])}
        )

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for ids, vectors in by_width(batch["id"], batch["v"]):
                    block = shared.value.get(vectors.shape[1])
                    for at, near, exact in block.nearest(ids, vectors, k, spec) if block else ():
                        key = vectors.shape[1], at
                        if key in best:
                            near, exact = nearest_ids(np.append(best[key][0], near), np.append(best[key][1], exact), k)
                        best[key] = near, exact
            for (width, at), (near, exact) in best.items():
                yield pd.DataFrame({"query_id": shared.value[width].ids[at], "id": near, "score": exact})

        return points.mapInPandas(task, "query_id long, id long, score double")

    def best(asked: DataFrame, spec: CrossPolytope) -> DataFrame:
        blocks = max(1, -(-asked.count() // (spec.query_block // 2)))
        everything = reduce(DataFrame.unionAll, [found(asked, n, blocks, spec) for n in range(blocks)])
        return everything.groupBy("query_id", "id").agg(F.min("score").alias("score"))

    nearest = materialize(best(asked, spec))
    enough = nearest.groupBy("query_id").agg(F.count("*").alias("many")).where(F.col("many") >= k)
    short = materialize(asked.join(enough, asked["id"] == enough["query_id"], "left_anti"))
    if not short.isEmpty():
        # Every signed axis of one table: all rows.
        nearest = nearest.unionAll(best(short, replace(spec, tables=1, probes=1 << 31)))
        nearest = nearest.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "id")
    ranked = nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
