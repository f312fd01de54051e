"""Approximate nearest neighbours with an inverted multi-index.

Vectors are quantised in two halves, each by its own centroids; a pair of
centroids is a cell of the index. A query walks the pairs by the sum of the two
distances, with a heap, until the cells it has passed hold enough vectors, and
those vectors are ranked by their exact distance.

How far a query walks is measured: sampled vectors are searched in the sample
exactly, and the walk is as long as finds the wanted recall of their neighbours
there. Neighbours lie nearer in a larger table, so a sample asks for no shorter
a walk than the table does. Vectors without any structure (uniform on a sphere)
have neighbours in very many cells, clustered ones in few.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.common import scratch, stored


@dataclass(frozen=True)
class Index:
    """Parameters of the index.

    A half has as many centroids as make cells of ``filling`` vectors, up to
    ``centroids``; they are fitted on at most ``sample`` vectors. The walk is
    measured on ``trials`` of these and finds ``recall`` of their neighbours; a
    recall of 1 walks all cells. ``block``: rows that are ranked together.
    """

    centroids: int = 256
    filling: int = 16
    sample: int = 8192
    rounds: int = 15
    recall: float = 0.97
    trials: int = 256
    block: int = 4096

    def size(self, vectors: int) -> int:
        return max(1, min(self.centroids, math.ceil(math.sqrt(vectors / self.filling))))


def fit_half(points: np.ndarray, count: int, rounds: int) -> np.ndarray:
    """k-means from the first distinct points."""
    _, first = np.unique(points, axis=0, return_index=True)
    centres = points[np.sort(first)[:count]].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * points @ centres.T


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return squares(points, centres).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by ascending sum of the halves' distances until they hold ``enough`` vectors."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out, held = [(float(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if counts[cell]:
            out.append(cell)
            held += int(counts[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(first) and y < len(second) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (float(first[a[x]] + second[b[y]]), x, y))
    return out


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the different rows that can take part, all of the most common length."""
    v = F.col("embedding").cast("array<double>")
    good = vectors.select("vec_id", v.alias("v")).where(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("v") == (sizes["n"] if sizes else 0)).distinct()


def share_to_walk(points: np.ndarray, parts: tuple, centres: list[np.ndarray], k: int, index: Index) -> float:
    """The share of ``points`` that a walk passes before it has found ``index.recall`` of all near neighbours."""
    if index.recall >= 1 or len(points) < 2:
        return 1.0
    halves = [squares(points[:, p], c) for p, c in zip(parts, centres, strict=True)]
    cells = halves[0].argmin(1) * len(centres[1]) + halves[1].argmin(1)
    counts = np.bincount(cells, minlength=len(centres[0]) * len(centres[1]))
    passed = []
    for i in range(min(index.trials, len(points))):
        far = ((points - points[i]) ** 2).sum(1)
        far[i] = np.inf
        near = np.argsort(far, kind="stable")[: min(k, len(points) - 1)]
        order = np.argsort((halves[0][i][:, None] + halves[1][i][None]).ravel(), kind="stable")
        before = np.empty(len(order), np.int64)
        before[order] = np.cumsum(counts[order]) - counts[order]
        passed.extend(before[cells[near]].tolist())
    passed.sort()
    return passed[math.ceil(index.recall * len(passed)) - 1] / len(points)


def search(
    vectors: DataFrame, every: int = 100, k: int = 10, index: Index = Index(), folder: str | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest vectors found; score is the Euclidean distance.

    Queries are the ids divisible by ``every``; all rows of other ids are
    candidates. Ties go to the smaller id. Vectors that are null, zero, or hold
    null or non-finite numbers, rows without an id, and vectors of another
    length than most take no part. Of rows that repeat an id, the nearest one is
    the candidate and the smallest vector asks. Equal vectors are indexed with
    their ``k`` + 1 smallest ids, which is all that a result can hold of them.
    """
    folder = folder or scratch(vectors.sparkSession, "neighbours")
    rows = stored(usable(vectors), f"{folder}/vectors")
    ids = Window.partitionBy("v").orderBy("vec_id")
    entries = rows.withColumn("n", F.row_number().over(ids)).where(F.col("n") <= k + 1).drop("n")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(index.sample).toArrow()
    schema = "query_id long, rank int, vec_id long, score double"
    points = matrix(sample.column("v").combine_chunks())
    if not len(points):
        return vectors.sparkSession.createDataFrame([], schema)
    _, first = np.unique(points, axis=0, return_index=True)
    points = points[np.sort(first)]
    half, size = points.shape[1] // 2, index.size(rows.count())
    parts = (slice(0, half or 1), slice(half, None))
    centres = [fit_half(points[:, p], size, index.rounds) for p in parts]
    regions, wide = len(centres[0]), len(centres[1])
    share = share_to_walk(points, parts, centres, k, index)

    def assign(batches):
        for batch in batches:
            x = matrix(batch.column("v"))
            near = [pa.array(nearest(x[:, p], c).astype(np.int32)) for p, c in zip(parts, centres, strict=True)]
            yield pa.RecordBatch.from_arrays([*near, *batch.columns], ["region", "cell", "vec_id", "v"])

    listed = stored(
        entries.mapInArrow(assign, "region int, cell int, vec_id long, v array<double>"), f"{folder}/index"
    )
    counts = np.zeros(regions * wide, np.int64)  # as many numbers as cells, whatever the table
    for region, cell, n in listed.groupBy("region", "cell").count().collect():
        counts[region * wide + cell] = n
    enough = int(share * counts.sum()) + 1

    def visit(batches):
        # A query goes once to each region (first half) with the cells to read there (second half).
        for batch in batches:
            x = matrix(batch.column("v"))
            far = [squares(x[:, p], c) for p, c in zip(parts, centres, strict=True)]
            for i in range(len(x)):
                found = np.sort(np.array(walk(far[0][i], far[1][i], counts, enough), np.int64))
                seen, starts = np.unique(found // wide, return_index=True)
                cells = [(found[a:b] % wide).tolist() for a, b in zip(starts, [*starts[1:], len(found)], strict=True)]
                where = pa.array(np.full(len(seen), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen, pa.int32()), pa.array(cells, pa.list_(pa.int32())),
                     batch.column("vec_id").take(where), batch.column("v").take(where)],
                    ["region", "cells", "query_id", "q"],
                )

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    visits = stored(
        asked.mapInArrow(visit, "region int, cells array<int>, query_id long, q array<double>"), f"{folder}/visits"
    )
    held, seen = counts.reshape(regions, wide).sum(1), np.zeros(regions, np.int64)
    for region, n in visits.groupBy("region").count().collect():
        seen[region] = n
    # A crowded region is cut into blocks on both sides; every block of one meets every block of the other.
    cuts = [np.maximum(1, -(-n // index.block)).tolist() for n in (held, seen)]
    blocks = [F.element_at(F.array(*[F.lit(int(c)) for c in cut]), F.col("region") + 1) for cut in cuts]

    def dealt(df: DataFrame, key: str, own: str, other: str, mine, theirs) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), mine).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), theirs - 1))
        )

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("cell", kind="stable")
            v, ids = np.stack(right["v"].to_list()), right["vec_id"].to_numpy()
            starts = np.searchsorted(right["cell"].to_numpy(), np.arange(wide + 1))
            for query, q, cells in zip(left["query_id"], left["q"], left["cells"], strict=True):
                rows = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in cells])
                rows = rows[ids[rows] != query]
                far = np.sqrt(((v[rows] - np.asarray(q)) ** 2).sum(1))
                best = np.lexsort((ids[rows], far))
                _, nearest_row = np.unique(ids[rows][best], return_index=True)
                best = best[np.sort(nearest_row)[:k]]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[rows][best], "score": far[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    queries = dealt(visits, "query_id", "qb", "vb", blocks[1], blocks[0])
    stock = dealt(listed, "vec_id", "vb", "qb", blocks[0], blocks[1])
    keys = ["region", "qb", "vb"]
    found = (
        queries.groupBy(*keys).cogroup(stock.groupBy(*keys))
        .applyInPandas(rank, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    )
    order = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
