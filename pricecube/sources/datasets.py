"""Dataset assembly: tag and union datasets, filter countries and years, look
up country names, and tidy the raw table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecube.constants import COUNTRIES, END_YEAR, RAW_PRIORITY, RAW_SORT, START_YEAR
from pricecube.functions import in_year_range
from pricecube.session import scratch_path

#: Rows that one task sorts at most; a raw row takes about half a kilobyte there.
SORT_ROWS = 1_000_000


class NoDataError(RuntimeError):
    """Raised when none of the datasets produced a row."""


def tag(df: DataFrame, label: str, column: str = "consumer_type") -> DataFrame:
    return df.withColumn(column, F.lit(label))


def union_datasets(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate datasets by column name, keeping duplicates; a column missing
    from one dataset is NULL there.  No job runs: an empty dataset adds no rows,
    and ``require_rows`` at the sink tells whether any had some."""
    if not frames:
        raise NoDataError("no dataset was given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def require_rows(df: DataFrame) -> DataFrame:
    """Raise when no dataset produced a row (a job; call it before a sink)."""
    if df.isEmpty():
        raise NoDataError("no dataset produced any observation")
    return df


def filter_geo_in(df: DataFrame, codes: Sequence[str], column: str = "geo") -> DataFrame:
    """Source-side restriction to a list of countries (an IN list, pushed to
    the scan of a parquet source)."""
    return df.where(F.col(column).isin(list(codes)))


def filter_year_range(
    df: DataFrame, start: int = START_YEAR, end: int = END_YEAR, column: str = "time"
) -> DataFrame:
    """Inclusive year range on the label prefix; passes through a frame
    without the column.  A malformed label fails (ANSI cast)."""
    if column not in df.columns:
        return df
    return df.where(in_year_range(F.col(column), start, end))


def dictionary(spark: SparkSession, mapping: Mapping[str, str], key: str = "geo", value: str = "name") -> DataFrame:
    """A code -> name dictionary as a (small, literal) DataFrame."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def lookup_country(
    df: DataFrame,
    names: DataFrame | Mapping[str, str] = COUNTRIES,
    code_col: str = "geo",
    out_col: str = "country_name",
) -> DataFrame:
    """Insert the looked-up name; a miss is NULL.

    A Python mapping becomes a literal map expression (no join at all); a
    dictionary DataFrame is left-joined, and Spark picks the strategy from its
    size.  The result has the rows of ``df``: of several names for one code the
    first in order counts.
    """
    if isinstance(names, Mapping):
        if not names:
            return df.withColumn(out_col, F.lit(None).cast("string"))
        m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        return df.withColumn(out_col, F.try_element_at(m, F.col(code_col)))
    key, value = names.columns[:2]
    d = names.groupBy(F.col(key).alias("_lk")).agg(F.min(value).alias("_lv"))
    joined = df.join(d, F.col(code_col) == F.col("_lk"), "left")
    return joined.drop("_lk", out_col).withColumnRenamed("_lv", out_col)


def reorder(df: DataFrame, priority: Sequence[str] = RAW_PRIORITY) -> DataFrame:
    """Move ``priority`` columns first, keep the others in their order."""
    first = [c for c in priority if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def sort_ranges(spark: SparkSession, rows: int) -> int | None:
    """Into how many ranges to deal rows for a sort, where the session's number of shuffle
    partitions would give a task more than ``SORT_ROWS``."""
    ranges = -(-rows // SORT_ROWS)
    return ranges if ranges > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def tidy(frames: Sequence[DataFrame], names=COUNTRIES, sort: Sequence[str] = RAW_SORT, stored: bool = False) -> DataFrame:
    """Union, look up names, reorder, sort (ascending, NULLs last).

    The sort is a distributed range-partitioned sort.  All other columns follow
    ``sort`` as tie-breaks, so the rows of one hot sort key can still be split
    over partitions, and the order is the same on every run.  With ``stored`` the
    rows are stored first (a job): Spark reads them twice, to find the ranges and to deal
    them, and their number says into how many ranges, so a task's share does not grow.
    """
    df = reorder(lookup_country(union_datasets(frames), names))
    keys = [F.col(c).asc_nulls_last() for c in [*sort, *[c for c in df.columns if c not in sort]]]
    if not stored:
        return df.orderBy(*keys)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "untidy")
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    ranges = sort_ranges(spark, held.count())  # from the files' footers
    return held.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys) if ranges else held.orderBy(*keys)
