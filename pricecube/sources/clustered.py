"""A raw layout clustered on several columns, and reads that skip files.

Rows are range-partitioned by an interleaved key: the ranks of their geo, period and
band, bit by bit in turn (the first bits of all columns before the second bits of any).
Rows that are close in all columns are then close in the key, so a file holds few values
of each, and filters on any of the columns leave most files out, not only filters on a
first sort column.

Ranks come from a dictionary of each column's values and rows, cut at equal shares of the
rows into at most ``2 ** BITS`` classes, so a value that holds a third of the rows does not
squeeze the others into one class.  The rows of one key may still be many: other columns
follow the key, so its rows are split over files all the same.

An index beside the files has each file's least and greatest values; ``read`` asks it
which files can hold wanted rows and opens only those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of a column's class in the key.
BITS = 8
CLUSTER = ["geo", "time", "nrg_cons"]


def classes(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(value, class): each value's share of the rows before it, in steps of 2 ** -bits.
    The window's one task sees the distinct values (countries, periods, bands), not rows:
    cluster on columns of few values."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    before = F.sum("n").over(Window.orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    ranked = counted.withColumn("before", F.coalesce(before, F.lit(0)))
    share = F.floor(F.col("before") * F.lit(1 << bits) / total.scalar())
    return ranked.select("value", share.cast("bigint").alias("class"))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all ranks in turn, highest first, as one number."""
    key, n = F.lit(0).cast("bigint"), len(ranks)
    for b in range(bits):
        for i, rank in enumerate(ranks):
            key = key + F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)), b * n + n - 1 - i)
    return key


def keyed(df: DataFrame, columns: Sequence[str] = CLUSTER, bits: int = BITS) -> DataFrame:
    """``df`` with its interleaved key ``_key``."""
    if bits * len(columns) > 62:
        raise ValueError("the key does not fit 62 bits")
    out = df
    for i, c in enumerate(columns):
        of = classes(df, c, bits).select(F.col("value").alias(f"_v{i}"), F.col("class").alias(f"_c{i}"))
        out = out.join(of, F.col(c).eqNullSafe(F.col(f"_v{i}")), "left").drop(f"_v{i}")
    key = interleaved([F.coalesce(F.col(f"_c{i}"), F.lit(0)) for i in range(len(columns))], bits)
    return out.withColumn("_key", key).drop(*[f"_c{i}" for i in range(len(columns))])


def write(df: DataFrame, root: str, columns: Sequence[str] = CLUSTER, files: int = 64, bits: int = BITS) -> None:
    """Writes ``df`` under ``root`` as about ``files`` files, clustered on ``columns``, and
    their index.  ``df`` should be a stored table: it is read once for the dictionaries of
    each column and once for the rows."""
    path = root.rstrip("/")
    rest = [c for c in df.columns if c not in columns]
    order = [F.col("_key"), *[F.col(c) for c in [*columns, *rest]]]
    rows = keyed(df, columns, bits).repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_key")
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    held = [x for c in columns for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))]
    index = stored.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"), *held)
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")  # a row a file


def files_for(spark: SparkSession, root: str, wanted: Mapping[str, Sequence[str] | tuple[str | None, str | None]]) -> list[str]:
    """The files that can hold wanted rows: for each column a list of values, or a pair
    (least, greatest) of which either may be None."""
    index = spark.read.parquet(f"{root.rstrip('/')}/index")
    for c, w in wanted.items():
        low, high = F.col(f"min_{c}"), F.col(f"max_{c}")
        if isinstance(w, tuple):
            least, greatest = w
            can = (F.lit(True) if least is None else high >= least) & (F.lit(True) if greatest is None else low <= greatest)
        else:
            can = F.exists(F.array(*[F.lit(v) for v in w]), lambda v: (v >= low) & (v <= high)) if w else F.lit(False)
        index = index.where(can)
    return [r.path for r in index.select("path").collect()]  # at most the table's files


def read(spark: SparkSession, root: str, wanted: Mapping[str, Sequence[str] | tuple[str | None, str | None]]) -> DataFrame:
    """The wanted rows; only files that can hold some are opened, and within them the
    filters reach Parquet's row groups."""
    path = root.rstrip("/")
    schema = spark.read.parquet(f"{path}/rows").schema
    paths = files_for(spark, root, wanted)
    out = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    for c, w in wanted.items():
        if isinstance(w, tuple):
            least, greatest = w
            out = out if least is None else out.where(F.col(c) >= least)
            out = out if greatest is None else out.where(F.col(c) <= greatest)
        else:
            out = out.where(F.col(c).isin(list(w)))
    return out
