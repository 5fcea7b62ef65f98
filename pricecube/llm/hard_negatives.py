"""Hard negatives by slots between the positives' scores.

For each anchor and each of its positives, the best rows of another label whose
score is at most the positive's and at least a share of it.  The windows of an
anchor's positives overlap, and are answered together:

1. One pass finds each anchor's positives: the best rows of its label.
2. The positives' scores are the windows' upper limits.  Sorted, they cut the
   scores into disjoint slots: slot i holds the scores up to limit i and above
   limit i + 1 (limit 0 is the highest).  A row of another label falls into one
   slot, or above all of them.
3. A second pass keeps the best ``k`` rows of each slot, first in each task
   (combiner), then of all tasks.
4. The best ``k`` rows up to limit i are the best of slot i and of those up to
   limit i + 1.  So merging the slots from the lowest up gives every window's
   rows, of which those under its lower limit fall away.  They are the highest
   ones within the upper limit, so none that belongs to the window is missed.

An anchor has at most as many slots as positives, and a task sends ``k`` rows a
slot, whatever the number of rows of a label.  Anchors are dealt into blocks
(see ``vectors``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import map_batches, table, written

K, POSITIVES, SCALE = 5, 5, 256
#: Lower limit of a window, in hundredths of the positive's score.
SHARE = 80
FOUND = "anchor bigint, id bigint, score bigint"


def _positives(anchors, count: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = anchors.value
        best = V.Best(len(block), count)
        for rows, (scores,) in V.pieces(block, batches, scale, labelled=True):
            a, c = np.nonzero(block.labels[:, None] == rows.labels)
            score = scores[a, c].astype(np.int64)
            good = (score >= best.floor[a]) & ((rows.ids[c] != block.ids[a]) | rows.no_id[c])
            a, c = a[good], c[good]
            best.offer(a, score[good], rows.ids[c], rows.no_id[c])
        anchor, score, ids = best.rows()
        yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor), "id": ids, "score": pa.array(score)})

    return run


def limits(found: list, n: int, count: int) -> np.ndarray:
    """A row an anchor: its positives' different scores from the highest down, then
    the lowest number."""
    out = np.full((n, count), -(1 << 63), np.int64)
    for r in found:
        out[r.anchor, : len(r.limits)] = r.limits
    return out


def _slots(anchors, uppers, k: int, share: int, scale: int):
    """(anchor, slot, id, score) of the best ``k`` rows of each slot in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, upper = anchors.value, uppers.value
        n, count = upper.shape
        best = V.Best(n * count, k)
        top, real = upper[:, 0], upper > -(1 << 63)
        # What reaches no window's lower limit, the smallest whole number of share / 100 or more, is left out.
        least = np.where(real, share * (upper // 100) - (-share * (upper % 100) // 100), 1 << 62).min(axis=1)
        for rows, (scores,) in V.pieces(block, batches, scale, labelled=True):
            low, high = (x[:, None] if scores.dtype.kind == "i" else x[:, None].astype(scores.dtype) for x in (least, top))
            a, c = np.nonzero((scores >= low) & (scores <= high))
            other = block.labels[a] != rows.labels[c]
            a, c = a[other], c[other]
            score = scores[a, c].astype(np.int64)
            # An anchor's own row has its label, so it is not among these.
            slot = (upper[a] >= score[:, None]).sum(axis=1) - 1
            best.offer(a * count + slot, score, rows.ids[c], rows.no_id[c])
        group, score, ids = best.rows()
        yield pa.RecordBatch.from_pydict({"anchor": pa.array(group // count), "slot": pa.array((group % count).astype(np.int32)), "id": ids, "score": pa.array(score)})

    return run


def suffix_merges(slots: DataFrame, k: int, count: int) -> DataFrame:
    """(anchor, slot, rows): for each slot the best ``k`` rows of it and all lower
    ones, merged from the lowest slot up.  ``slots`` has (anchor, slot, id, score),
    at most ``k`` rows a slot."""
    # Sorted arrays of (-score, null id, id) have the best first.
    entry = F.struct((-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    held = slots.groupBy("anchor").agg(F.collect_list(F.struct(F.col("slot").alias("slot"), entry.alias("entry"))).alias("held"))

    def of(slot: Column) -> Column:
        return F.transform(F.filter("held", lambda e: e["slot"] == slot), lambda e: e["entry"])

    kind = "array<struct<down:bigint,no_id:boolean,id:bigint>>"
    merged = F.aggregate(
        F.sequence(F.lit(count - 1), F.lit(0), F.lit(-1)),
        F.array().cast(f"array<struct<slot:int,rows:{kind}>>"),
        lambda done, slot: F.concat(
            done,
            F.array(
                F.struct(
                    slot.alias("slot"),
                    F.slice(F.array_sort(F.concat(of(slot), F.coalesce(F.get(done, F.size(done) - 1)["rows"], F.array().cast(kind)))), 1, k).alias("rows"),
                )
            ),
        ),
    )
    return held.select("anchor", F.explode(merged).alias("m")).select("anchor", "m.slot", "m.rows")


def hard_negatives(rows: DataFrame, is_anchor: Column, k: int = K, positives: int = POSITIVES, share: int = SHARE, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = V.BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is its inner product with the anchor, components being
    floor(scale * x).  Higher scores come first, ties by the smaller id, null ids
    last.  An anchor's positives are its first ``positives`` other rows of its
    label; a positive of score p has the first ``k`` rows of other labels whose
    score n has ``share`` * p <= 100 * n <= 100 * p.

    Rows with a null label, a null vector or a null or non-finite component take
    no part; see ``vectors`` for vectors of different lengths and for overflow.
    A row with the anchor's id is no positive of it.  A row whose ``is_anchor`` or id
    is null is no anchor; repeated anchor rows give their rows each.  Other columns
    are ignored; an empty table gives an empty result.
    """
    if not 0 <= share <= 100:
        raise ValueError("share is a number of hundredths")
    spark = rows.sparkSession
    labelled = rows.where(F.col(label_col).isNotNull())
    anchors = labelled.where(is_anchor & F.col(id_col).isNotNull() & V.usable(F.col(vector_col)))
    three = [F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("bigint").alias("label")]
    all_rows = labelled.select(*three)
    parts = []
    for held in V.blocks(anchors.select(*three), scale, block):
        shared = spark.sparkContext.broadcast(held)
        found = written(V.first_k(map_batches(all_rows, _positives(shared, positives, scale), FOUND), ["anchor"], positives), "positives")
        upper = limits(found.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits")).collect(), len(held), positives)
        uppers = spark.sparkContext.broadcast(upper)
        slots = map_batches(all_rows, _slots(shared, uppers, k, share, scale), "anchor bigint, slot int, id bigint, score bigint")
        answers = suffix_merges(V.first_k(slots, ["anchor", "slot"], k), k, positives)
        # The window of a positive is answered by the slot that its score limits.
        names = spark.createDataFrame(pa.table({"anchor": np.arange(len(held)), "anchor_id": held.ids}))
        wanted = found.withColumn("slot", (F.dense_rank().over(Window.partitionBy("anchor").orderBy(F.desc("score"))) - 1).cast("int"))
        wanted = wanted.select("anchor", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        over = F.pmod("positive_score", F.lit(100))
        least = F.expr("(positive_score - pmod(positive_score, 100)) div 100") * share + F.ceil(over * share / 100)
        within = F.filter("rows", lambda e: e["down"] <= -least)
        mined = wanted.join(answers, ["anchor", "slot"]).join(names, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(within).alias("at", "e"))
        mined = mined.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("e.id").alias("negative_id"), "positive_score", (-F.col("e.down")).alias("negative_score"))
        parts.append(written(mined, "negatives"))
        shared.destroy()
        uppers.destroy()
    none = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return V.union_of(parts, none)


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.e, c.e)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id
  where a.vec_id % 100 = 0
), positive as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by n.score desc, n.vec_id))::integer as rank,
       n.vec_id as negative_id, positive_score, n.score as negative_score
from positive p join scored n using (anchor_id)
where not n.same and 80 * positive_score <= 100 * n.score and n.score <= positive_score
qualify rank <= 5
"""
