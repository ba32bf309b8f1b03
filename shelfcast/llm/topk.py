"""Exact top-k search by inner product, over vectors in descending order of length.

Queries and candidates meet in a grid: a group of queries that fits in memory, and a slice of the candidates. A cell
streams its candidates from the longest to the shortest and keeps the k best of each query. Coordinates are rotated by
the right singular vectors of all candidates, so that a few leading ones hold most of a product; what the others can
add is at most the product of the residual lengths. A candidate is only scored if that bound reaches the k-th best
score, and a cell ends where the lengths alone cannot reach it. Bounds are floating-point with a margin for their
rounding, scores are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, giving_back, spark_schema, written
from shelfcast.llm.vectors import dimension, in_one_place, integer_vectors, unpacked

#: Bytes of one copy of the queries of a group, pairs that are bounded at a time, candidates of the only slice at most.
GROUP_BYTES, BLOCK_PAIRS, SLICE_ROWS = 32 << 20, 1 << 22, 1024
#: Shares of the coordinates after which bounds are taken; share of pairs left below which they are scored one by one.
CUTS, SPARSE = (0.125, 0.25, 0.5), 0.05
LEAST = np.iinfo(np.int64).min
EXACT = 2.0**53


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """The right singular vectors of all packed vectors as columns, by falling singular value. Only speed depends on them."""
    fields = [("j", T.IntegerType()), ("k", T.IntegerType()), ("s", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = unpacked(batch.column(0), d).astype(np.float64)
            total += x.T @ x
        j, k = np.triu_indices(d)
        for at in range(0, len(j), 1 << 16):
            some = slice(at, at + (1 << 16))
            yield batch_of(arrow_schema(fields), j[some].astype(np.int32), k[some].astype(np.int32), total[j[some], k[some]])

    def solve(sums: pa.Table) -> bytes:
        square = np.zeros((d, d))
        j, k = sums["j"].to_numpy(), sums["k"].to_numpy()
        square[j, k] = square[k, j] = sums["s"].to_numpy()
        return np.ascontiguousarray(np.linalg.eigh(square)[1][:, ::-1]).tobytes()

    sums = vectors.select("x").mapInArrow(giving_back(run), spark_schema(fields)).groupBy("j", "k").agg(F.sum("s").alias("s"))
    return np.frombuffer(in_one_place(sums, solve)).reshape(d, d)


def residuals(rotated: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The length of what each row has beyond each cut."""
    square = rotated**2
    return np.sqrt(np.stack([square[:, c:].sum(axis=1) for c in cuts], axis=1))


class Cell:
    """The k best candidates of each query of a group, among those seen so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, turn: np.ndarray, k: int, pairs: int = BLOCK_PAIRS):
        self.ids, self.x, self.turn, self.k, self.pairs = ids, x, turn, k, pairs
        d = x.shape[1]
        self.cuts = sorted({max(1, round(d * c)) for c in CUTS})
        self.rotated = x @ turn
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.residual = residuals(self.rotated, self.cuts)
        self.margin = 16 * d * np.finfo(float).eps
        self.score = np.full((len(ids), k), LEAST)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.size = max(16, pairs // max(1, len(ids)))
        self.over = False

    def see(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Candidates that are no longer than those before."""
        for at in range(0, len(ids), self.size):
            if not self.over:
                self._block(ids[at : at + self.size], x[at : at + self.size])

    def _block(self, ids: np.ndarray, x: np.ndarray) -> None:
        length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        worst = self.score[:, -1]
        open_ = np.flatnonzero((worst == LEAST) | (self.length * length[0] * (1 + self.margin) + 1 >= worst))
        if not len(open_):
            self.over = True
            return
        q, c = self._near(open_, x, length, worst)
        score = self._scores(q, c, x, length, len(open_))
        keep = (score > worst[q]) | ((score == worst[q]) & (ids[c] < self.found[q, -1]))
        keep &= ids[c] != self.ids[q]
        if keep.any():
            self._take(q[keep], ids[c[keep]], score[keep])

    def _near(self, open_: np.ndarray, x: np.ndarray, length: np.ndarray, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose bounds reach the k-th best score of their query."""
        alive = np.ones((len(open_), len(x)), dtype=bool)
        if (worst[open_] > LEAST).all():
            rotated = x @ self.turn
            residual = residuals(rotated, self.cuts)
            slack = self.margin * np.outer(self.length[open_], length) + 1
            need = worst[open_].astype(np.float64)[:, None] - slack
            part, last = np.zeros(alive.shape), 0
            for i, cut in enumerate(self.cuts):
                part += self.rotated[open_, last:cut] @ rotated[:, last:cut].T
                alive &= part + np.outer(self.residual[open_, i], residual[:, i]) >= need
                last = cut
                if alive.mean() < SPARSE:
                    break
        q, c = np.nonzero(alive)
        return open_[q], c

    def _scores(self, q: np.ndarray, c: np.ndarray, x: np.ndarray, length: np.ndarray, queries: int) -> np.ndarray:
        """The exact products of the pairs (query, candidate)."""
        small = len(q) and float(self.length[q].max()) * float(length.max()) < EXACT / 2
        if small and len(q) > SPARSE * queries * len(x):
            rows, place = np.unique(q, return_inverse=True)
            return (self.x[rows].astype(np.float64) @ x.T.astype(np.float64))[place, c].astype(np.int64)
        step = max(1, self.pairs // x.shape[1])
        parts = [np.einsum("ij,ij->i", self.x[q[i : i + step]], x[c[i : i + step]]) for i in range(0, len(q), step)]
        return np.concatenate([*parts, np.zeros(0, dtype=np.int64)])

    def _take(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        rows = np.unique(q)
        q = np.concatenate([q, np.repeat(rows, self.k)])
        ids = np.concatenate([ids, self.found[rows].ravel()])
        score = np.concatenate([score, self.score[rows].ravel()])
        order = np.lexsort((ids, -1 - score, q))  # -1 - s does not overflow
        first = np.searchsorted(q[order], rows)
        best = order[first[:, None] + np.arange(self.k)]
        self.score[rows], self.found[rows] = score[best], ids[best]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate, score) of what was found."""
        real = self.found < np.iinfo(np.int64).max
        real |= self.score > LEAST
        return np.repeat(self.ids, self.k)[real.ravel()], self.found[real], self.score[real]


def top_inner_products(queries: DataFrame, candidates: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k candidates with the largest integer product, ties to the smaller id.

    Entries count as ``floor(scale * c)``. Both tables have whole-number ids; a candidate with the query's own id is
    none of its candidates. Repeated candidate rows count as often as they occur, repeated query ids give one list.
    Left out are rows with a null id, a null vector, a null or non-finite entry, another length than most candidates
    have, or a sum of squares beyond 64 bits; all other products fit. Empty tables and sole rows give no rows.
    """
    d = dimension(candidates, vec_col)

    def numbers(df: DataFrame, label: str) -> DataFrame:
        known = df.where(df[id_col].isNotNull()).select(df[id_col].cast("long").alias("vec_id"), df[vec_col].alias("v"))
        return written(integer_vectors(known, "vec_id", "v", max(d, 1), scale).where("length2 is not null"), label)

    asked, offered = numbers(queries, "queries"), numbers(candidates, "candidates")
    n_asked, n_offered = asked.count(), offered.count()
    fields = [("query_id", T.LongType()), ("vec_id", T.LongType()), ("score", T.LongType())]
    turn = rotation(offered, d) if n_asked and n_offered else np.zeros((d, d))
    groups = max(1, -(-n_asked * d * 8 // GROUP_BYTES))
    slices = 1 + math.isqrt(n_offered // SLICE_ROWS)  # each cell hands on k rows a query, so slices grow with the root
    number = F.monotonically_increasing_id()
    each_slice, each_group = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (slices, groups))
    left = asked.select("vec_id", "x", "length2", F.pmod(number, F.lit(groups)).cast("int").alias("group")).select("*", each_slice.alias("slice"), F.lit(0).alias("kind"))
    right = offered.select("vec_id", "x", "length2", F.pmod(number, F.lit(slices)).cast("int").alias("slice")).select("*", each_group.alias("group"), F.lit(1).alias("kind"))
    cells = left.unionByName(right).repartition("group", "slice").sortWithinPartitions("group", "slice", "kind", F.desc("length2"), "vec_id")

    pairs = BLOCK_PAIRS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        here, cell, ids, xs = None, None, [], []
        for batch in batches:
            at = np.stack([batch.column(n).to_numpy() for n in ("group", "slice", "kind")], axis=1)
            cuts = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                if start == end:
                    continue
                *place, kind = at[start].tolist()
                if place != here:
                    if cell is not None:
                        yield batch_of(schema, *cell.rows())
                    here, cell, ids, xs = place, None, [], []
                part = batch.slice(start, end - start)
                some, x = part.column("vec_id").to_numpy(), unpacked(part.column("x"), d)
                if kind == 0:
                    ids.append(some)
                    xs.append(x)
                elif ids or cell is not None:
                    if cell is None:
                        cell = Cell(np.concatenate(ids), np.concatenate(xs), turn, k, pairs)
                        ids, xs = [], []
                    cell.see(some, x)
        if cell is not None:
            yield batch_of(schema, *cell.rows())

    found = cells.select("group", "slice", "kind", "vec_id", "x").mapInArrow(giving_back(run), spark_schema(fields))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
