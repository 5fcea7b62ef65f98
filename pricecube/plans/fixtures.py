"""Observation views derived from the driver's tables.

``obs`` maps every line item to one price observation (FIXTURES.md §2).  The
join is written orders -> customer -> nation -> lineitem so that Catalyst's
greedy join ordering keeps it: the order-sized side is shuffled on custkey
once, and the lineitem-sized side is shuffled exactly once (on orderkey),
instead of shuffling the lineitem-sized join result a second time on custkey.
Only the columns the views use are read (pruned at the parquet scan); filters
on the derived dimension columns are pushed to the lineitem scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecube.session import read_table

AS_OF = "2025-01-01 00:00:00"

def as_of_literal(ts: str = AS_OF) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


#: The columns that are used of the input tables.  A given schema saves a job for each read.
INPUTS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double",
}


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, lineitem = (read_table(spark, sf_dir, name, schema) for name, schema in INPUTS.items())
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(lineitem, orders.o_orderkey == lineitem.l_orderkey)
    )
    return joined.selectExpr(
        "case when c_mktsegment = 'HOUSEHOLD' then 'household' else 'industry' end as consumer_type",
        "concat('N', lpad(cast(n_nationkey as string), 2, '0')) as geo",
        "n_name as country_name",
        "concat(cast(year(o_orderdate) as string), case when month(o_orderdate) <= 6 then '-S1' else '-S2' end) as time",
        "'S' as freq",
        "'Half-yearly' as freq_label",
        "'E7000' as siec",
        "'Electricity' as siec_label",
        "case l_returnflag when 'A' then 'TOT_KWH' when 'N' then 'KWH1000-2499' else 'KWH2500-4999' end as nrg_cons",
        "case l_returnflag when 'A' then 'All bands' when 'N' then 'Small' else 'Medium' end as nrg_cons_label",
        "'KWH' as unit",
        "'Kilowatt-hour' as unit_label",
        "case when l_linestatus = 'F' then 'I_TAX' else 'X_TAX' end as tax",
        "case when l_linestatus = 'F' then 'Taxes included' else 'Taxes excluded' end as tax_label",
        "case when l_linenumber <= 5 then 'EUR' when l_linenumber = 6 then 'NAC' else 'PPS' end as currency",
        "case when l_linenumber <= 5 then 'Euro' when l_linenumber = 6 then 'National' else 'Parity' end as currency_label",
        "n_name as geo_label",
        "concat(cast(year(o_orderdate) as string), case when month(o_orderdate) <= 6 then ' first half' else ' second half' end) as time_label",
        "cast(floor(o_totalprice / 100) as double) / 10000 as value_eur_per_kwh",
        "l_orderkey * 10 + l_linenumber as obs_id",
        "l_quantity as qty",
    )


RAW_COLUMNS = [
    "consumer_type", "geo", "country_name", "time",
    "freq", "freq_label", "siec", "siec_label", "nrg_cons", "nrg_cons_label",
    "unit", "unit_label", "tax", "tax_label", "currency", "currency_label",
    "geo_label", "time_label", "value_eur_per_kwh",
]


def raw(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """``obs`` as the loaded raw table: the 19 raw columns plus a batch timestamp."""
    return obs(spark, sf_dir).select(*RAW_COLUMNS, as_of_literal(as_of).alias("loaded_at"))


def obs_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per (geo, type, half-year): the source's real grain."""
    o = obs(spark, sf_dir)
    return (
        o.where((F.col("currency") == "EUR") & (F.col("tax") == "I_TAX") & (F.col("nrg_cons") == "TOT_KWH"))
        .groupBy("geo", "country_name", "consumer_type", "time")
        .agg(F.min_by("value_eur_per_kwh", "obs_id").alias("value_eur_per_kwh"))
    )


def raw_half(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """``obs_half`` shaped as raw rows in EUR, taxes included, all bands."""
    h = obs_half(spark, sf_dir)
    return h.select(
        "consumer_type", "geo", "country_name", "time",
        F.lit("TOT_KWH").alias("nrg_cons"), F.lit("All bands").alias("nrg_cons_label"),
        F.lit("I_TAX").alias("tax"), F.lit("Taxes included").alias("tax_label"),
        F.lit("EUR").alias("currency"),
        "value_eur_per_kwh",
        as_of_literal(as_of).alias("loaded_at"),
    )


def raw_dirty(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Raw rows with a bad consumer type, missing names and missing values."""
    o = obs(spark, sf_dir)
    return o.select(
        F.when(F.col("qty") == 49, "other").otherwise(F.col("consumer_type")).alias("consumer_type"),
        "geo",
        F.when(F.col("geo") < "N06", F.col("country_name")).alias("country_name"),
        "time", "nrg_cons", "nrg_cons_label", "tax", "tax_label", "currency",
        F.when(F.col("qty") == 50, F.lit(None).cast("double"))
        .otherwise(F.col("value_eur_per_kwh"))
        .alias("value_eur_per_kwh"),
        as_of_literal(as_of).alias("loaded_at"),
    )


# Country dictionary for lookups: N00..N05 only, so the other codes miss.
COUNTRY_DICT = {
    "N00": "ALGERIA",
    "N01": "ARGENTINA",
    "N02": "BRAZIL",
    "N03": "CANADA",
    "N04": "EGYPT",
    "N05": "ETHIOPIA",
}


def countries(spark: SparkSession) -> DataFrame:
    """The dictionary as a DataFrame (fixed size, safe to broadcast)."""
    return spark.createDataFrame(list(COUNTRY_DICT.items()), "geo string, name string")
