"""Exact top-k inner-product search by the three-phase uniform threshold.

The components are cut into ``lists`` slices; a slice's products with a query are
a list of local scores, and a row's score is the sum of its scores in all lists.
The lists are spread over the tasks by rows, so a row's other local scores are
found in the task that holds it.

1. *Gather.*  Each task takes the ``k`` highest of each list for each query, and
   sends the totals of the ``k`` best of those rows.  The k-th best total of all
   is a score that the query's k-th best row reaches for certain.
2. *Cut off.*  That total ``t`` is broadcast.  A row that reaches ``t`` has a local
   score of at least ``t / lists`` in some list (uniform threshold), so the rows
   at or above it in any list are enough.
3. *Resolve.*  Only for those the remaining local scores are looked up and summed;
   rows whose total reaches ``t`` are sent, at most ``k`` a query and task.

Nothing is approximated: the cutoff only spares rows that ``k`` others beat.
Queries are dealt into blocks (see ``vectors``); each block's cutoffs are as many
numbers as it has queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .common import map_batches, table, written

K, SCALE, LISTS = 20, 64, 2
NONE = -(1 << 63)


def _gathered(queries, k: int, scale: int, lists: int):
    """Phase 1: (query, total) of at most ``k`` rows a query and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        best = V.Best(len(block), k)
        every = np.arange(len(block))[:, None]
        for rows, local in V.pieces(block, batches, scale, lists):
            take = min(k, len(rows))
            seen = np.zeros(local[0].shape, bool)
            for scores in local:
                top = np.argpartition(scores, len(rows) - take, axis=1)[:, len(rows) - take :]
                # a row that another list has given already, or the query's own
                fresh = ~np.take_along_axis(seen, top, 1) & ((rows.ids[top] != block.ids[:, None]) | rows.no_id[top])
                np.put_along_axis(seen, top, True, 1)
                totals = sum(np.take_along_axis(s, top, 1).astype(np.int64) for s in local)
                at = fresh & (totals >= best.floor[:, None])
                best.offer(np.broadcast_to(every, top.shape)[at], totals[at], rows.ids[top][at], rows.no_id[top][at])
        group, score, _ = best.rows()
        yield pa.RecordBatch.from_pydict({"query": pa.array(group), "score": pa.array(score)})

    return run


def _resolved(queries, cutoffs, k: int, scale: int, lists: int):
    """Phases 2 and 3: (query, id, score) of rows that reach the cutoff, at most
    ``k`` a query and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least = queries.value, cutoffs.value
        best = V.Best(len(block), k)
        best.floor = least.copy()
        # The smallest whole number that is t / lists or more.
        share = np.where(least == NONE, NONE, -(-np.maximum(least, NONE + 1) // lists))
        for rows, local in V.pieces(block, batches, scale, lists):
            kind = local[0].dtype
            bar = share[:, None] if kind.kind == "i" else share[:, None].astype(kind)
            enough = local[0] >= bar
            for scores in local[1:]:
                enough |= scores >= bar
            q, c = np.nonzero(enough)
            totals = sum(scores[q, c].astype(np.int64) for scores in local)
            good = (totals >= best.floor[q]) & ((rows.ids[c] != block.ids[q]) | rows.no_id[c])
            q, c, totals = q[good], c[good], totals[good]
            best.offer(q, totals, rows.ids[c], rows.no_id[c])
        group, score, ids = best.rows()
        yield pa.RecordBatch.from_pydict({"query": pa.array(group), "id": ids, "score": pa.array(score)})

    return run


def cutoffs(gathered: DataFrame, k: int, n: int) -> np.ndarray:
    """The k-th best total of each query (the lowest number where there are fewer):
    at most a block's number of rows."""
    found = V.first_k(gathered.withColumn("id", F.lit(None).cast("bigint")), ["query"], k).where(F.col("rank") == k)
    out = np.full(n, NONE, np.int64)
    for r in found.select("query", "score").collect():
        out[r.query] = r.score
    return out


def exact_top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, lists: int = LISTS, id_col: str = "vec_id", vector_col: str = "embedding", block: int = V.BLOCK) -> DataFrame:
    """(query_id, rank, <id>, score): for each row that ``is_query`` holds for, the
    ``k`` other rows (all, if fewer) of the highest inner product of the vectors,
    whose components are floor(scale * x).  Ties go to the smaller id, null ids last.

    Null vectors and those with a null or non-finite component take no part; an
    empty vector has the score 0 with all; see ``vectors`` for vectors of different
    lengths and for overflow.  A row with the query's id is the query's own.  A row
    whose ``is_query`` or id is null is no query; repeated query rows give their
    rows each.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    queries = rows.where(is_query & F.col(id_col).isNotNull() & V.usable(F.col(vector_col)))
    queries = queries.select(F.col(id_col).cast("bigint"), F.col(vector_col), F.lit(0).cast("bigint").alias("_label"))
    all_rows = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    parts = []
    for held in V.blocks(queries, scale, block):
        shared = spark.sparkContext.broadcast(held)
        gathered = map_batches(all_rows, _gathered(shared, k, scale, lists), "query bigint, score bigint")
        safe = spark.sparkContext.broadcast(cutoffs(gathered, k, len(held)))
        found = map_batches(all_rows, _resolved(shared, safe, k, scale, lists), "query bigint, id bigint, score bigint")
        names = spark.createDataFrame(pa.table({"query": np.arange(len(held)), "query_id": held.ids}))
        parts.append(written(V.first_k(found, ["query"], k).join(names, "query").drop("query"), "top-k"))
        shared.destroy()
        safe.destroy()
    none = spark.createDataFrame([], "id bigint, score bigint, rank int, query_id bigint")
    return V.union_of(parts, none).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op12_topk_search(spark, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP12_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score
from scored
qualify rank <= 20
"""
