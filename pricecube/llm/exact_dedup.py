"""Exact deduplication with the heavy hitters taken out first.

1. Each text is folded (A-Z to lower case) and digested once; only (id, SHA-256)
   goes on, as a table in the shared folder.
2. A frequent-items summary of the Misra-Gries family (``approx_top_k``: counters
   that are decremented together, merged from all partitions) names at most
   ``k`` digests.  Every digest with more than n / (0.75 * counters) rows is
   among those tracked.
3. One map-side combined aggregate counts those digests exactly.  Verified
   winners (at most ``k`` rows of about 60 bytes, so the broadcast is bounded by
   the parameter) are broadcast and settle their rows without a shuffle.
4. All remaining digests, each of bounded frequency, shuffle as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, fold_ascii, table, written

#: Winners at most, and counters of the frequent-items summary.
WINNERS = 1000
COUNTERS = 20_000


def text_digest(text):
    return F.sha2(fold_ascii(text), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", winners: int = WINNERS, counters: int = COUNTERS) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per input row.

    Of equal texts the row with the largest id stays.  Null text is empty text.
    A null id is smaller than any other; rows that share id and text share their
    fate, so a group of rows without any id stays whole.  Other columns of
    ``docs`` are ignored.  An empty table gives an empty result.
    """
    digests = written(
        docs.select(F.col(id_col).alias("id"), F.unhex(text_digest(F.col(text_col))).alias("digest")), "digests"
    )
    found = digests.agg(F.expr(f"approx_top_k(hex(digest), {int(winners)}, {int(counters)})").alias("top"))
    found = found.select(F.explode("top").alias("t")).select(F.unhex("t.item").alias("digest"))
    verified = written(
        digests.join(F.broadcast(found), "digest")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1"),
        "winners",
    )
    told = digests.join(F.broadcast(verified), "digest", "left")
    hot = told.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    rest = (
        told.where(F.col("group_size").isNull())
        .select("id", "digest")
        .withColumns({"keep_id": F.max("id").over(group), "group_size": F.count(F.lit(1)).over(group)})
    )
    return hot.unionByName(rest).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP2_SQL = f"""
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) as text_sha256 from documents
)
select doc_id,
       max(doc_id) over g as keep_id,
       count(*) over g as group_size,
       doc_id is not distinct from max(doc_id) over g as kept,
       text_sha256
from t window g as (partition by text_sha256)
"""
