"""Serving queries over the staging and mart tables, as DataFrames.

Each takes the tables as DataFrames and returns a lazy plan; nothing is
collected.  Result ordering follows the original endpoints, with the grain
keys added as tie-breaks where the original left ties open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecube.constants import CONSUMER_TYPES, YOY_HIGHLIGHTS
from pricecube.operators.annual import MART_COLUMNS

MART_ORDER = ["country_code", "consumer_type", "year"]
SUMMARY_COLUMNS = [
    "country_code",
    "country_name",
    "year",
    "consumer_type",
    "avg_price_eur_per_kwh",
    "price_category_mode",
]
YOY_COLUMNS = [
    "country_code",
    "country_name",
    "year",
    "consumer_type",
    "avg_price_eur_per_kwh",
    "prior_year_avg_price",
    "yoy_change_pct",
]


def check_consumer_type(consumer_type: str | None, accepted=CONSUMER_TYPES) -> None:
    """Reject an unknown consumer type before any job runs (case-sensitive)."""
    if consumer_type and consumer_type not in accepted:
        raise ValueError(f"consumer_type must be one of {list(accepted)}, got {consumer_type!r}")


def prices(
    mart: DataFrame,
    country: str | None = None,
    year: int | None = None,
    consumer_type: str | None = None,
) -> DataFrame:
    """Mart rows with optional filters ANDed; falsy arguments mean 'absent'.

    The filters are plain equality predicates: on a parquet-backed mart they
    are pushed to the scan (and prune partitions when the mart is laid out by
    year).
    """
    check_consumer_type(consumer_type)
    cond = F.lit(True)
    if country:
        cond = cond & (F.col("country_code") == country.upper())
    if year:
        cond = cond & (F.col("year") == int(year))
    if consumer_type:
        cond = cond & (F.col("consumer_type") == consumer_type)
    return mart.where(cond).select(*MART_COLUMNS).orderBy(*MART_ORDER)


def prices_count(
    mart: DataFrame,
    country: str | None = None,
    year: int | None = None,
    consumer_type: str | None = None,
) -> DataFrame:
    """Row count of the filtered result as a one-row DataFrame."""
    return prices(mart, country, year, consumer_type).agg(F.count(F.lit(1)).alias("count"))


def prices_summary(mart: DataFrame) -> DataFrame:
    """Mart rows at the table's latest year.

    The latest year is a scalar subquery, so the filter is evaluated against a
    single value instead of joining a one-row relation.
    """
    latest = mart.select(F.max("year")).scalar()
    return (
        mart.where(F.col("year") == latest)
        .select(*SUMMARY_COLUMNS)
        .orderBy("country_code", "consumer_type")
    )


def prices_summary_count(mart: DataFrame) -> DataFrame:
    """The summary's year and number of rows: the rows of each year, of which the
    latest is taken (one pass; a row per year)."""
    per_year = mart.groupBy("year").agg(F.count(F.lit(1)).alias("count"))
    return per_year.agg(F.max("year").alias("year"), F.coalesce(F.max_by("count", "year"), F.lit(0)).alias("count"))


def prices_yoy_count(mart: DataFrame) -> DataFrame:
    """Number of rows with a YoY change."""
    return mart.agg(F.count("yoy_change_pct").alias("count"))


def prices_yoy(mart: DataFrame) -> DataFrame:
    """Rows with a YoY change, biggest change first."""
    return (
        mart.where(F.col("yoy_change_pct").isNotNull())
        .select(*YOY_COLUMNS)
        .orderBy(F.col("yoy_change_pct").desc(), *MART_ORDER)
    )


def yoy_extremes(mart: DataFrame, k: int = YOY_HIGHLIGHTS, increases: bool = True) -> DataFrame:
    """Top-k increases (or decreases) - plans as TakeOrderedAndProject."""
    y = F.col("yoy_change_pct")
    return (
        mart.where(y.isNotNull())
        .select("country_code", "consumer_type", "year", "yoy_change_pct")
        .orderBy(y.desc() if increases else y.asc(), *MART_ORDER)
        .limit(k)
    )


def latest_period(stg: DataFrame) -> DataFrame:
    """MAX(period) (fixed-width labels sort chronologically); WARN when empty."""
    return stg.agg(F.max("period").alias("latest_period")).select(
        "latest_period",
        F.when(F.col("latest_period").isNull(), "WARN").otherwise("OK").alias("status"),
    )


def health(stg: DataFrame, mart: DataFrame) -> DataFrame:
    """One row: staging rows, mart rows, latest period.

    One aggregate over staging (count and max in a single pass); the mart's
    count enters as a scalar subquery, so no join is involved.
    """
    mart_rows = mart.agg(F.count(F.lit(1))).scalar()
    return stg.agg(F.count(F.lit(1)).alias("stg_rows"), F.max("period").alias("latest_period")).select(
        F.lit("ok").alias("status"), "stg_rows", mart_rows.alias("mart_rows"), "latest_period"
    )


def rows_per_country(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("country_code", "country_name")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("country_code")
    )
