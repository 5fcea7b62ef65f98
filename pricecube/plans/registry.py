"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key, and
the DuckDB SQL that must return the same rows.

Every query reads the driver's tables (through the fixture views) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecube.operators import annual, serving
from pricecube.operators.staging import staging
from pricecube.plans import fixtures as fx
from pricecube.plans.oracle_sql import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


# --- shared inputs ----------------------------------------------------------


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(fx.raw(spark, sf_dir))


def stg_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(fx.raw_half(spark, sf_dir))


def stg_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(fx.raw_dirty(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annual.mart(stg(spark, sf_dir))


MART_COLS = ", ".join(annual.MART_COLUMNS)

# --- staging and mart -------------------------------------------------------


@register("stg_prices", with_ctes("stg") + "select * from stg")
def q_stg_prices(spark, sf_dir):
    return stg(spark, sf_dir)


@register(
    "price_tier",
    with_ctes("stg_dirty")
    + """select price_category, count(*) as n,
       count(*) filter (where price_eur_per_kwh is null) as n_null_price
from stg_dirty group by price_category""",
)
def q_price_tier(spark, sf_dir):
    return stg_dirty(spark, sf_dir).groupBy("price_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("price_eur_per_kwh").isNull()).alias("n_null_price"),
    )


@register(
    "annual_prices",
    with_ctes("yearly")
    + "select country_code, country_name, year, consumer_type, mean as avg_price_eur_per_kwh,"
    " lowest as min_price, highest as max_price from yearly",
)
def q_annual_prices(spark, sf_dir):
    return annual.annual_prices(stg(spark, sf_dir))


_TIER_COUNTS_SQL = """select * from (
  select country_code, year, consumer_type, unnest(['High', 'Medium', 'Low']) as price_category,
         unnest([high, medium, low]) as n
  from {yearly})
where n > 0"""

_TIER_MODE_SQL = "select country_code, year, consumer_type, price_category_mode from {mart}"


@register("tier_counts", with_ctes("yearly") + _TIER_COUNTS_SQL.format(yearly="yearly"))
def q_tier_counts(spark, sf_dir):
    return annual.tier_counts(stg(spark, sf_dir))


@register("tier_mode", with_ctes("mart") + _TIER_MODE_SQL.format(mart="mart"))
def q_tier_mode(spark, sf_dir):
    return annual.tier_mode(stg(spark, sf_dir))


@register("tier_mode_general", with_ctes("mart_half") + _TIER_MODE_SQL.format(mart="mart_half"))
def q_tier_mode_general(spark, sf_dir):
    return annual.tier_mode_general(stg_half(spark, sf_dir))


@register(
    "annual_with_mode",
    with_ctes("mart_half")
    + "select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh, min_price, max_price,"
    " price_category_mode from mart_half",
)
def q_annual_with_mode(spark, sf_dir):
    return annual.annual_with_mode(stg_half(spark, sf_dir))


@register(
    "prior_year_price",
    with_ctes("mart")
    + "select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh,"
    " prior_year_avg_price from mart",
)
def q_prior_year_price(spark, sf_dir):
    return annual.with_prior(annual.annual_prices(stg(spark, sf_dir))).select(
        "country_code", "country_name", "year", "consumer_type", "avg_price_eur_per_kwh", "prior_year_avg_price"
    )


@register(
    "yoy_change",
    with_ctes("mart")
    + "select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh,"
    " prior_year_avg_price, yoy_change_pct from mart",
)
def q_yoy_change(spark, sf_dir):
    return annual.with_yoy(annual.with_prior(annual.annual_prices(stg(spark, sf_dir)))).select(
        "country_code", "country_name", "year", "consumer_type", "avg_price_eur_per_kwh",
        "prior_year_avg_price", "yoy_change_pct",
    )


@register("mart_prices", with_ctes("mart") + "select * from mart order by country_code, consumer_type, year")
def q_mart_prices(spark, sf_dir):
    return mart(spark, sf_dir).orderBy(*serving.MART_ORDER)


@register("mart_half", with_ctes("mart_half") + "select * from mart_half")
def q_mart_half(spark, sf_dir):
    return annual.mart(stg_half(spark, sf_dir))


@register("mart_two_step", with_ctes("mart_half") + "select * from mart_half")
def q_mart_two_step(spark, sf_dir):
    return annual.mart_two_step(stg_half(spark, sf_dir))


#: Tiers of which the priority list names only some.
MORE_TIERS = [(">", 0.4, "Peak"), (">", 0.25, "High"), (">=", 0.15, "Medium"), (">=", 0.05, "Dip")]


@register(
    "mart_any_tier",
    with_ctes("mart_half")
    + """, tiered as (
  select geo as country_code, consumer_type, time[1:4]::int as year,
         case when value_eur_per_kwh > 0.4 then 'Peak' when value_eur_per_kwh > 0.25 then 'High'
              when value_eur_per_kwh >= 0.15 then 'Medium' when value_eur_per_kwh >= 0.05 then 'Dip' else 'Idle' end as tier
  from raw_half
), modes as (
  select country_code, consumer_type, year, tier from tiered group by country_code, consumer_type, year, tier
  qualify row_number() over (partition by country_code, consumer_type, year
                             order by count(*) desc, coalesce(list_position(['High', 'Medium', 'Low'], tier), 4), tier) = 1
)
select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh, min_price, max_price,
       tier as price_category_mode, prior_year_avg_price, yoy_change_pct
from mart_half join modes using (country_code, consumer_type, year)""",
)
def q_mart_any_tier(spark, sf_dir):
    return annual.mart(staging(fx.raw_half(spark, sf_dir), rules=MORE_TIERS, default_tier="Idle"))


# the other query families register themselves on import
from pricecube.plans import ingest_queries, serving_queries  # noqa: E402,F401
