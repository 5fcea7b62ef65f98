"""Blocks of query vectors against all rows of a table, in tasks.

Queries grow with the table, so they are dealt into blocks of at most ``BLOCK``
vectors.  One block is broadcast at a time (its size is bounded by the parameter,
not by the data), and every task runs its rows past it in pieces of ``PIECE``
rows.  What a task keeps is a bounded number of rows for each query of the block.

Components are scaled and floored to integers.  Products are taken in the
narrowest of float32, float64 and int64 that holds every partial sum exactly; a
sum that might not fit 64 bits raises ``OverflowError``.  A vector that is shorter
than another counts as filled up with zeros.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Queries broadcast at once, and rows that a task runs past them at a time.
BLOCK, PIECE = 4096, 2048
#: Rows a task gathers before it cuts them down to the best of each query.
GATHERED = 2_000_000


@dataclass(frozen=True)
class Rows:
    """Vectors of whole numbers (float64), with their ids, whether the id is null,
    and labels (zeros where none are read)."""

    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, start: int, end: int) -> Rows:
        return Rows(self.ids[start:end], self.no_id[start:end], self.labels[start:end], self.matrix[start:end])


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, all components finite numbers."""
    def odd(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return vector.isNotNull() & ~F.coalesce(F.exists(vector, odd), F.lit(True))


def decoded(ids: pa.Array, vectors: pa.Array, labels: pa.Array | None, scale: int) -> Rows:
    """The rows of a batch that take part (see ``usable``)."""
    n = len(vectors)
    offsets = np.asarray(vectors.offsets, np.int64)
    values = vectors.values
    missing = np.asarray(values.is_null())
    flat = np.asarray(values.cast(pa.float64()).fill_null(0.0), np.float64)
    odd = np.concatenate(([0], np.cumsum(missing | ~np.isfinite(flat))))
    start, end = offsets[:-1], offsets[1:]
    keep = np.flatnonzero(np.asarray(vectors.is_valid()) & (odd[end] == odd[start])) if n else np.zeros(0, np.int64)
    start, length = start[keep], (end - start)[keep]
    width = int(length.max()) if len(keep) else 0
    if width and (length == width).all():
        matrix = flat[start[:, None] + np.arange(width)]
    else:
        matrix = np.zeros((len(keep), width))
        row = np.repeat(np.arange(len(keep)), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        matrix[row, place] = flat[start[row] + place]
    with np.errstate(over="ignore"):
        matrix = np.floor(scale * matrix)
    if matrix.size and not (np.abs(matrix).max() < 2.0**63):
        raise OverflowError("a scaled component does not fit 64 bits")
    no_id = np.asarray(ids.is_null())[keep]
    taken = np.asarray(ids.fill_null(0), np.int64)[keep]
    kinds = np.zeros(len(keep), np.int64) if labels is None else np.asarray(labels.fill_null(0), np.int64)[keep]
    return Rows(taken, no_id, kinds, matrix)


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The narrowest type in which all products of rows of both add up exactly."""
    largest = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    bound = max(largest[0] * largest[1] * min(a.shape[1], b.shape[1]), *largest)
    if bound < 1 << 24:
        return np.float32
    if bound < 1 << 53:
        return np.float64
    if bound < 1 << 63:
        return np.int64
    raise OverflowError("an inner product might not fit 64 bits")


def pieces(queries: Rows, batches: Iterator[pa.RecordBatch], scale: int, slices: int = 1, labelled: bool = False) -> Iterator[tuple[Rows, list[np.ndarray]]]:
    """For each piece of rows of (id, vector[, label]) batches: the rows, and for
    each slice of the components the products of all queries with all rows."""
    for batch in batches:
        rows = decoded(batch.column(0), batch.column(1), batch.column(2) if labelled else None, scale)
        if not len(rows):
            continue
        width = min(queries.matrix.shape[1], rows.matrix.shape[1])
        kind = exact_type(queries.matrix, rows.matrix)
        q, c = queries.matrix[:, :width].astype(kind), rows.matrix[:, :width].astype(kind)
        ends = [width * j // slices for j in range(slices + 1)]
        for start in range(0, len(rows), PIECE):
            some = c[start : start + PIECE]
            yield rows.part(start, start + PIECE), [q[:, i:j] @ some[:, i:j].T for i, j in zip(ends, ends[1:], strict=False)]


class Best:
    """The best ``k`` rows of each group (highest score, then smallest id, null
    ids last) of all rows offered; holds ``GATHERED`` rows and ``k`` a group."""

    def __init__(self, groups: int, k: int):
        self.k = k
        #: The k-th best score so far, below which nothing need be offered.
        self.floor = np.full(groups, -(1 << 63), np.int64)
        self.held = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]
        self.new: list[list[np.ndarray]] = []
        self.gathered = 0

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        score = score.astype(np.int64)
        good = score >= self.floor[group]
        self.new.append([x[good] for x in (group, score, ids, no_id)])
        self.gathered += int(good.sum())
        if self.gathered > GATHERED or self.gathered > 4 * self.k * len(self.floor):
            self.cut()

    def cut(self) -> None:
        group, score, ids, no_id = found = [np.concatenate([h, *parts]) for h, *parts in zip(self.held, *self.new, strict=True)]
        order = np.lexsort((ids, no_id, -score, group))
        rank = np.arange(len(order)) - np.searchsorted(group[order], group[order])
        last = order[rank == self.k - 1]
        self.floor[group[last]] = score[last]
        self.held = [x[order[rank < self.k]] for x in found]
        self.new, self.gathered = [], 0

    def rows(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(group, score, id) of what is left."""
        self.cut()
        group, score, ids, no_id = self.held
        return group, score, pa.array(ids, mask=no_id)


def blocks(queries: DataFrame, scale: int, size: int = BLOCK) -> Iterator[Rows]:
    """The usable rows of (id, vector, label), dealt into blocks of at most ``size``."""
    n = queries.count()
    if not n:
        return
    parts = -(-n // size)
    dealt = written(queries.repartition(parts).withColumn("_part", F.spark_partition_id()), "queries")
    for part in range(parts):
        found = dealt.where(F.col("_part") == part).drop("_part").toArrow().combine_chunks()
        one = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in found.columns]
        rows = decoded(one[0], one[1], one[2], scale)
        for start in range(0, len(rows), size):
            yield rows.part(start, start + size)


def first_k(df: DataFrame, groups: list[str], k: int) -> DataFrame:
    """The best ``k`` rows of each group by score, then by id (null last), with ``rank``."""
    order = Window.partitionBy(*groups).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def union_of(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    """All rows of the parts; ``empty`` where there is none."""
    return reduce(DataFrame.unionByName, parts) if parts else empty
