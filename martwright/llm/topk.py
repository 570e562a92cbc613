"""Operator 3, exact top-k search by inner product with a pivot-distance index.

Vectors are turned into integers.  Appending sqrt(M^2 - |x|^2) to each, with M
the longest vector, and 0 to a query q puts all vectors on one sphere, where
|q - x|^2 = |q|^2 + M^2 - 2 q.x: the largest inner products are the nearest
neighbours, and the triangle inequality holds.

1. ``PIVOTS`` pivots are chosen, far apart, from a bounded sample.  Each vector
   is keyed by its nearest pivot and the annulus of its distance (quantiles of
   the sample).  A cell (pivot, annulus) of many vectors is dealt over several
   sub-cells of about ``CELL``, so a vector that is everywhere is no hot task.
2. Each query expands the annuli in order of their lower bounds
   |d(q, p) - d(x, p)| until it has met ``FIRST`` vectors, which gives its first
   k-th best score, and then every other annulus whose bound is within that
   radius; the rest can hold nothing better.
3. Queries go into blocks with others of their cell, so that a block asks for
   few cells, and a vector is sent to a block only if a query there asks for its
   cell.  In a sub-cell, blocks of queries meet the vectors in one matrix product,
   and each query keeps at most k of them that reach its k-th best score so far.

All vectors are indexed, and the result is exact: scores are integers, bounds
have slack for rounding, and equal scores are settled by the smaller id.  The
driver gets the sample and one line for each cell (both bounded by parameters).

Defined results: rows without id or vector, or with a null or non-finite
component, take no part; shorter vectors are filled up with zeros; rows that
repeat an id are separate candidates, but none for a query with this id, and
queries that repeat an id are one query (any of its rows); an empty table gives
an empty table; extra columns are not read, whatever their names; very long
vectors are rows like others, two bytes for each component where these fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from martwright.llm.common import map_batches, only, ship, stored

PIVOTS, RINGS, SAMPLE = 16, 8, 4096
CELL, FIRST, QUERIES = 2048, 4096, 8192  # vectors in a sub-cell, met at first; queries in a block
SLACK = 1e-6


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = max(1.0, float(np.abs(a).max(initial=0))) * max(1.0, float(np.abs(b).max(initial=0))) * a.shape[1]
    if most < 2 ** 53:  # whole numbers that doubles hold
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def encode(whole: np.ndarray) -> bytes:
    """The size of a component and the components, two bytes each if they fit."""
    kind = np.int16 if np.abs(whole).max(initial=0) < 2 ** 15 else np.int64
    return bytes([np.dtype(kind).itemsize]) + whole.astype(kind).tobytes()


def decode(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.int16 if b[0] == 2 else np.int64, offset=1)


def vectors(table: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``id, v, n, norm``: floor(scale * x) of each valid row as bytes, its
    length and squared norm."""
    def run(batch):
        out = {"id": [], "v": [], "n": [], "norm": []}
        for i, x in zip(batch.column(id_col).to_pylist(), batch.column(vector_col)):
            if i is None or not x.is_valid:
                continue
            x = x.values
            values = x.to_numpy(zero_copy_only=False).astype(float) if not x.null_count else np.array([np.nan])
            if not np.isfinite(values).all():
                continue
            whole = np.floor(scale * values).astype(np.int64)
            for k, value in zip(out, (i, encode(whole), len(whole), int((whole * whole).sum()))):
                out[k].append(value)
        return out

    return map_batches(only(table, id_col, vector_col), "id long, v binary, n int, norm long", run)


class Index:
    """Pivots, annuli and cells; small, sent to all tasks."""

    def __init__(self, size: int, longest: int, sample: np.ndarray):
        self.size, self.longest, self.first = size, longest, FIRST
        lifted = self.lift(sample)
        chosen = [0] if len(sample) else []
        apart = np.full(len(sample), np.inf)
        while chosen and len(chosen) < min(PIVOTS, len(sample)):
            apart = np.minimum(apart, self.between(lifted, lifted[chosen[-1:]])[:, 0])
            if apart.max() <= SLACK:
                break
            chosen.append(int(apart.argmax()))
        self.pivots = lifted[chosen]
        if len(sample):
            d = self.between(lifted, self.pivots)
            nearest = d.argmin(1)
            inside = np.linspace(0, 1, RINGS + 1)[1:-1]
            self.edges = np.stack([np.quantile(d[nearest == p, p] if (nearest == p).any() else [0.0], inside)
                                   for p in range(len(self.pivots))])

    def matrix(self, column) -> np.ndarray:
        """Vectors from their bytes, filled up with zeros."""
        out = np.zeros((len(column), self.size), np.int64)
        for row, b in enumerate(column):
            x = decode(b)
            out[row, :len(x)] = x
        return out

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x.astype(float)
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.longest - (x * x).sum(1)))
        return np.concatenate([x, more[:, None]], 1)

    @staticmethod
    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of all rows of a to all of b."""
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return np.sqrt(np.maximum(0, square))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and its distance to the cell's pivot."""
        d = self.between(self.lift(x), self.pivots)
        nearest = d.argmin(1)
        distance = d[np.arange(len(x)), nearest]
        ring = (distance[:, None] > self.edges[nearest]).sum(1)
        return nearest * RINGS + ring, distance

    def hold(self, cells: list[tuple[int, int, float, float]]) -> None:
        """Takes the cells: number, count, smallest and largest distance."""
        self.cell, self.count, self.low, self.high = (np.array(c) for c in zip(*sorted(cells)))
        self.parts = -(-self.count // CELL)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the lower bound of the distance to each cell, and
        the cells that its first expansion takes, as a mask."""
        d = self.between(self.lift(q, query=True), self.pivots)[:, self.cell // RINGS]
        bound = np.maximum(0, np.maximum(d - self.high, self.low - d))
        order = np.lexsort((d, bound), axis=1)
        met = np.cumsum(self.count[order], 1)
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, order, (met - self.count[order]) < self.first, 1)
        return bound, first


def deal(placed: DataFrame, pairs: DataFrame) -> DataFrame:
    """The index's rows, one for each block that asks for their sub-cell."""
    return placed.select("id", "v", "cell", "part").join(pairs, ["cell", "part"])


def top_k(table: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score``: for each row of ``table`` for which
    ``is_query`` (of its ``id``) is true its k best other rows."""
    spark = table.sparkSession
    ship(spark)
    rows = stored(vectors(table, scale, id_col, vector_col), "vectors")
    size, longest = rows.agg(F.max("n"), F.max("norm")).first()
    result = "query_id long, id long, score long"
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    some = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).select("v").collect()
    made = Index(size, longest, np.zeros((0, size), np.int64))
    made = Index(size, longest, made.matrix([r["v"] for r in some]))
    index = spark.sparkContext.broadcast(made)

    def keyed(batch):
        cell, distance = index.value.place(index.value.matrix(batch.column("v").to_pylist()))
        return {"id": batch.column("id"), "v": batch.column("v"), "cell": cell.astype(np.int32), "distance": distance}

    placed = stored(map_batches(rows.select("id", "v"), "id long, v binary, cell int, distance double", keyed), "index")
    made.hold([tuple(r) for r in placed.groupBy("cell").agg(
        F.count("id"), F.min("distance"), F.max("distance")).collect()])
    held = spark.sparkContext.broadcast(made)
    parts = np.zeros(PIVOTS * RINGS, np.int64)
    parts[made.cell] = made.parts

    def of_cell(numbers: np.ndarray) -> Column:
        return F.get(F.array(*[F.lit(int(p)) for p in numbers]), F.col("cell"))

    placed = placed.withColumn("part", F.pmod(F.xxhash64("id", "distance"), of_cell(parts)).cast("int"))
    queries = stored(placed.where(is_query).dropDuplicates(["id"]).select("id", "v", "cell"), "queries")
    inside, before = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    for cell, n in queries.groupBy("cell").count().collect():
        inside[cell] = n
    before[1:] = np.cumsum(inside)[:-1]
    # cell after cell, ``QUERIES`` to a block, about
    queries = queries.withColumn("block", F.floor(
        (of_cell(before) + F.pmod(F.xxhash64("id"), of_cell(inside))) / QUERIES).cast("int"))

    def visits(first: bool):
        def run(batch):
            ix = held.value
            q = ix.matrix(batch.column("v").to_pylist())
            bound, met = ix.bounds(q)
            least = np.array([np.iinfo(np.int64).min if s is None else s for s in batch.column("least").to_pylist()], np.int64)
            if first:
                go = met
            else:
                square = (q.astype(float) ** 2).sum(1) + ix.longest - 2.0 * least.astype(float)
                radius = np.where(least == np.iinfo(np.int64).min, np.inf, np.sqrt(np.maximum(0, square)))
                go = ~met & (bound <= (radius * (1 + SLACK) + SLACK)[:, None])
            return {"id": batch.column("id"), "v": batch.column("v"), "block": batch.column("block"), "least": least,
                    "cells": [ix.cell[row].tolist() for row in go]}
        return run

    def meet(key, asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        ix = held.value
        if not len(asked) or not len(there):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype=np.int64)
        there = there.sort_values("id")
        x, ids = ix.matrix(there["v"]), there["id"].to_numpy()
        out = []
        for at in range(0, len(asked), 512):
            some = asked.iloc[at:at + 512]
            query, least = some["query_id"].to_numpy(), some["least"].to_numpy()
            scores = _inner(ix.matrix(some["q"]), x)
            good = (scores >= least[:, None]) & (ids[None, :] != query[:, None])
            for row in np.flatnonzero(good.any(1)):
                hit = np.flatnonzero(good[row])
                if len(hit) > k:  # ids are in order, so a stable sort settles ties
                    hit = hit[np.argsort(-scores[row, hit], kind="stable")[:k]]
                out.append((np.full(len(hit), query[row]), ids[hit], scores[row, hit]))
        if not out:
            return pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype=np.int64)
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), map(np.concatenate, zip(*out)))))

    def search(asked: DataFrame, first: bool) -> DataFrame:
        asks = stored(map_batches(asked.select("id", "v", "least", "block"),
                                  "id long, v binary, least long, block int, cells array<int>", visits(first)), "asks")
        every_part = F.explode(F.sequence(F.lit(0), of_cell(parts).cast("int") - 1)).alias("part")
        pairs = stored(asks.select("block", F.explode("cells").alias("cell")).distinct()
                       .select("block", "cell", every_part), "pairs")
        requests = (asks.select(F.col("id").alias("query_id"), F.col("v").alias("q"), "least", "block",
                                F.explode("cells").alias("cell"))
                    .select("query_id", "q", "least", "block", "cell", every_part))
        dealt = deal(placed, pairs)
        key = ["cell", "part", "block"]
        found = requests.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(meet, result)
        return best(found)

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    near = stored(search(queries.withColumn("least", F.lit(None).cast("long")), True), "near")
    radius = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    rest = search(queries.join(radius, "id", "left").select("id", "v", "block", "least"), False)
    return best(near.select("query_id", "id", "score").union(rest.select("query_id", "id", "score"))).select(
        "query_id", "rank", "id", "score")
