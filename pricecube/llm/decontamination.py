"""Benchmark decontamination: short test items inside long documents.

Items are partitioned by their number of distinct shingles.  For each size class
the length of the MinHash signature (the smallest hash values of an item) is
chosen so that containment of at least ``threshold`` cannot miss: of n shingles
at most m = floor((1 - threshold) * n) may be absent, so among the m + 1
smallest one must be present.  The signatures are looked up in the shingles of
all documents.  A document is not sketched: of 20,000 shingles its own minima
would say nothing about a passage of twenty.  Each candidate is then verified on
the exact shingle texts of the whole document and the whole item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SHINGLE, SPACES, UPPER, table, words, written

THRESHOLD = 0.75


def shingle_texts(word_array: Column) -> Column:
    """The distinct shingles as texts; fewer words than five make one shingle."""
    return _shingles(word_array, lambda w, i: F.array_join(F.slice(w, i, SHINGLE), " "))


def shingle_keys(word_array: Column) -> Column:
    """64-bit hashes of all shingles (repeats stay)."""
    return _shingles(
        word_array,
        lambda w, i: F.xxhash64(*[F.coalesce(F.get(w, i + F.lit(k - 1)), F.lit("")) for k in range(SHINGLE)]),
        distinct=False,
    )


def _shingles(word_array: Column, make, distinct: bool = True) -> Column:
    # transform over a one-element array gives the words a name, so that they
    # are split once for a text and not once for each shingle.
    def of(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.greatest(F.size(w) - F.lit(SHINGLE - 1), F.lit(1))))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: make(w, i))

    out = F.get(F.transform(F.array(word_array), of), F.lit(0))
    return F.array_distinct(out) if distinct else out


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """(key, item_id) with the MinHash values of each item, by size class."""
    sized = items.withColumn("n", F.size("keys")).where("n > 0")
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n")) + F.lit(1)) - F.lit(1)
    length = F.floor(F.lit(1 - threshold + 1e-9) * upper).cast("int") + F.lit(1)
    return sized.select("item", F.explode(F.slice(F.array_sort("keys"), F.lit(1), length)).alias("key"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, n_item_shingles, n_shared, containment): every document and
    item of which the document holds at least ``threshold`` of the distinct
    shingles, once each.

    Null and blank texts hold and are held by nothing.  An item of fewer than
    five words is in a document only if it is that document's whole sequence of
    words.  Null ids are ids like others.  Documents that share an id count as
    one for each distinct text; repeated rows give one result row.  Items that share an id
    count as one for each distinct text, of which the largest containment is
    given.  Other columns are ignored.
    """
    items = written(
        benchmark.select(F.col(item_id_col).alias("item_id"), words(F.col(item_text_col)).alias("w"))
        .select("item_id", shingle_texts(F.col("w")).alias("texts"), F.array_distinct(shingle_keys(F.col("w"))).alias("keys"))
        .withColumn("item", F.xxhash64("item_id", "texts"))
        .dropDuplicates(["item"]),
        "items",
    )
    probes = written(signatures(items.select("item", "keys"), threshold).groupBy("key").agg(F.collect_set("item").alias("items")), "signatures")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    candidates = written(
        texts.select("id", F.xxhash64("text").alias("digest"), F.explode(shingle_keys(words(F.col("text")))).alias("key"))
        .join(probes, "key")
        .select("id", "digest", F.explode("items").alias("item"))
        .distinct(),
        "candidates",
    )
    # Only candidates are read again; each meets the whole item.
    met = (
        texts.withColumn("digest", F.xxhash64("text"))
        .join(candidates, (texts["id"].eqNullSafe(candidates["id"])) & (F.xxhash64(texts["text"]) == candidates["digest"]))
        .select(texts["id"], texts["text"], "item")
        .join(items.select("item", "item_id", F.col("texts").alias("wanted")), "item")
    )
    shared = met.select(
        "id",
        "item_id",
        F.size("wanted").alias("n_item_shingles"),
        F.size(F.array_intersect("wanted", shingle_texts(words(F.col("text"))))).alias("n_shared"),
    ).where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item_shingles"))
    return (
        shared.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))
        .groupBy("id", "item_id")
        .agg(F.max(F.struct("containment", "n_item_shingles", "n_shared")).alias("m"))
        .select(F.col("id").alias(id_col), "item_id", "m.n_item_shingles", "m.n_shared", "m.containment")
    )


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACES}'), lambda x: x <> '')"
OP3_SQL = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
ds as (
  select distinct doc_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) as i from d where len(w) > 0)
),
bs as (
  select distinct item_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) as i from b where len(w) > 0)
),
n as (select item_id, count(*) as n from bs group by item_id),
hit as (select doc_id, item_id, count(*) as k from ds join bs using (s) group by doc_id, item_id)
select doc_id, item_id, cast(n as int) as n_item_shingles, cast(k as int) as n_shared, k / n as containment
from hit join n using (item_id) where k >= {THRESHOLD} * n
"""
