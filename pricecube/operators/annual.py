"""Annual mart: averages, extremes, modal tier, prior year and YoY change.

The flagship ``mart`` does in one hash aggregation what the original SQL does
with two aggregates, a first-row-per-group and a join:

    group by (country_code, country_name, year, consumer_type):
        exact decimal sum + count -> mean as DOUBLE, min, max,
        one count per label of the tier dictionary -> mode with priority tie-break

followed by one window (LAG) over the aggregated rows, which are bounded by
countries x consumer types x years however large the input grows.  Partial
aggregation runs map-side, so the shuffle carries one row per group per task.
It is exact when country_name is a function of country_code (it is looked up
from the code); ``annual_with_mode`` is the general two-step form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricecube.constants import MART_BAND, TIER_PRIORITY
from pricecube.functions import decimal_mean, pct_change, round_half_away, tier_rank, year_of
from pricecube.functions.tiers import LABELS

#: Labels that the one-pass form counts; with more, the two-step form is used.
MAX_LABELS = 64
KEYS = ["country_code", "year", "consumer_type"]
MART_COLUMNS = [
    "country_code",
    "country_name",
    "year",
    "consumer_type",
    "avg_price_eur_per_kwh",
    "min_price",
    "max_price",
    "price_category_mode",
    "prior_year_avg_price",
    "yoy_change_pct",
]


def _band(stg: DataFrame, band: str | None) -> DataFrame:
    return stg if band is None else stg.where(F.col("nrg_cons") == band)


def _with_year(stg: DataFrame) -> DataFrame:
    return stg.withColumn("year", year_of(F.col("period")))


def _stats() -> list[Column]:
    p = F.col("price_eur_per_kwh")
    return [
        F.sum(p).alias("_sum"),
        F.count(p).alias("_n"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"),
    ]


def _avg() -> Column:
    return round_half_away(decimal_mean(F.col("_sum"), F.col("_n")), 4)


def annual_prices(stg: DataFrame, band: str | None = MART_BAND) -> DataFrame:
    """AGG-1: annual mean (rounded to 4), min, max per (code, name, year, type)."""
    g = _with_year(_band(stg, band)).groupBy("country_code", "country_name", "year", "consumer_type")
    return g.agg(*_stats()).select(
        "country_code",
        "country_name",
        "year",
        "consumer_type",
        _avg().alias("avg_price_eur_per_kwh"),
        "min_price",
        "max_price",
    )


def tier_counts(stg: DataFrame, band: str | None = MART_BAND) -> DataFrame:
    """AGG-2: rows per (code, year, type, tier)."""
    return (
        _with_year(_band(stg, band))
        .groupBy("country_code", "year", "consumer_type", "price_category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def labels_of(stg: DataFrame, priority: Sequence[str] = TIER_PRIORITY, column: str = "price_category") -> list[str] | None:
    """The dictionary of the tier column: the priority list, then all other labels by
    name.  ``staging`` notes the labels that its rules can give with the column, and
    Parquet keeps the note; without one, a job looks at that column.  None when there
    are more than ``MAX_LABELS``."""
    noted = stg.schema[column].metadata.get(LABELS)
    if noted is None:
        # at most one row more than are counted reaches the driver
        found = stg.select(column).where(F.col(column).isNotNull()).distinct().limit(MAX_LABELS + 1).collect()
        noted = [r[0] for r in found]
    labels = [*priority, *sorted(set(noted).difference(priority))]
    return labels if len(labels) <= MAX_LABELS else None


def _tier_count_cols(labels: Sequence[str]) -> list[Column]:
    """A count for each label of the dictionary, in its order, and for NULL: a buffer of
    fixed width, whatever the labels.  What the dictionary lacks is counted apart."""
    c = F.col("price_category")
    known = c.isNull() | c.isin(list(labels))
    counts = [F.count_if(c == t) for t in labels]
    return [*[n.alias(f"_t{i}") for i, n in enumerate(counts)], F.count_if(c.isNull()).alias("_tnull"), F.count_if(~known).alias("_tx")]


def _mode(labels: Sequence[str]) -> Column:
    """The label with the highest count of an aggregate of ``_tier_count_cols``; of
    equal ones the first of the dictionary, NULL last.  Fails where rows have a label
    that the dictionary lacks, rather than leave them out."""
    counts = [*[F.col(f"_t{i}") for i in range(len(labels))], F.col("_tnull")]
    first = F.array_position(F.array(*counts), F.greatest(*counts)).cast("int")
    label = F.get(F.array(*map(F.lit, labels), F.lit(None).cast("string")), first - 1)
    fails = F.raise_error(F.lit(f"tier labels other than {', '.join(labels)}: pass labels=, or drop the note on the column"))
    return F.when(F.col("_tx") > 0, fails.cast("string")).otherwise(label)


def tier_mode(
    stg: DataFrame, band: str | None = MART_BAND, priority: Sequence[str] = TIER_PRIORITY, labels: Sequence[str] | None = None
) -> DataFrame:
    """AGG-3 in one hash aggregate: mode of the tier, of any label, with priority
    tie-break; labels outside the list come after it, by name."""
    labels = labels or labels_of(stg, priority)
    if labels is None:
        return tier_mode_general(stg, band, priority)
    tiers = _with_year(_band(stg, band)).groupBy(*KEYS).agg(*_tier_count_cols(labels))
    return tiers.select(*KEYS, _mode(labels).alias("price_category_mode"))


def tier_mode_general(
    stg: DataFrame, band: str | None = MART_BAND, priority: Sequence[str] = TIER_PRIORITY
) -> DataFrame:
    """WIN-2: first row per group by (count desc, tier rank) over tier counts; labels
    outside the list come after it, by name.

    ``row_number() == 1`` plans as a WindowGroupLimit (partial + final) on the
    small per-tier count table.
    """
    counts = tier_counts(stg, band)
    label = F.col("price_category")
    unlisted = ~F.coalesce(label.isin(list(priority)), F.lit(False))
    w = Window.partitionBy(*KEYS).orderBy(F.col("n").desc(), tier_rank(label, priority), unlisted, label.asc_nulls_last())
    return (
        counts.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select(*KEYS, F.col("price_category").alias("price_category_mode"))
    )


def annual_with_mode(
    stg: DataFrame, band: str | None = MART_BAND, priority: Sequence[str] = TIER_PRIORITY
) -> DataFrame:
    """JOIN-1: annual stats inner-joined to the general tier mode (NULL keys drop)."""
    y = annual_prices(stg, band)
    m = tier_mode_general(stg, band, priority)
    return y.join(m, on=KEYS, how="inner").select(
        "country_code",
        "country_name",
        "year",
        "consumer_type",
        "avg_price_eur_per_kwh",
        "min_price",
        "max_price",
        "price_category_mode",
    )


def with_prior(annual: DataFrame, value: str = "avg_price_eur_per_kwh") -> DataFrame:
    """WIN-1: LAG by row over (code, type) ordered by year - a gap year takes
    the last available year, not NULL."""
    w = Window.partitionBy("country_code", "consumer_type").orderBy("year")
    return annual.withColumn("prior_year_avg_price", F.lag(value, 1).over(w))


def with_yoy(df: DataFrame, value: str = "avg_price_eur_per_kwh") -> DataFrame:
    """WIN-3: percent change vs prior, NULL/0 guarded, rounded to 2."""
    return df.withColumn("yoy_change_pct", pct_change(F.col(value), F.col("prior_year_avg_price"), 2))


def mart(
    stg: DataFrame, band: str | None = MART_BAND, priority: Sequence[str] = TIER_PRIORITY, labels: Sequence[str] | None = None
) -> DataFrame:
    """The annual mart (unordered; order at read with ``serving.prices``).

    ``labels`` is the dictionary of the tier column (see ``labels_of``, which finds it).
    Four plan steps: filter (band and non-NULL grain keys, as the original's
    inner join drops NULL keys), one aggregate, one window select, the YoY.
    """
    labels = labels or labels_of(stg, priority)
    if labels is None:
        return mart_two_step(stg, band, priority)
    year = year_of(F.col("period"))
    cond = F.col("country_code").isNotNull() & F.col("consumer_type").isNotNull() & year.isNotNull()
    if band is not None:
        cond = (F.col("nrg_cons") == band) & cond
    agg = (
        stg.where(cond)
        .groupBy("country_code", "country_name", year.alias("year"), "consumer_type")
        .agg(*_stats(), *_tier_count_cols(labels))
    )
    avg = _avg()
    w = Window.partitionBy("country_code", "consumer_type").orderBy("year")
    annual = agg.select(
        "country_code",
        "country_name",
        "year",
        "consumer_type",
        avg.alias("avg_price_eur_per_kwh"),
        "min_price",
        "max_price",
        _mode(labels).alias("price_category_mode"),
        F.lag(avg, 1).over(w).alias("prior_year_avg_price"),
    )
    return annual.select(
        *MART_COLUMNS[:-1],
        pct_change(F.col("avg_price_eur_per_kwh"), F.col("prior_year_avg_price"), 2).alias("yoy_change_pct"),
    )


def mart_two_step(
    stg: DataFrame, band: str | None = MART_BAND, priority: Sequence[str] = TIER_PRIORITY
) -> DataFrame:
    """The mart exactly as the original SQL composes it (general form)."""
    return with_yoy(with_prior(annual_with_mode(stg, band, priority))).select(*MART_COLUMNS)
