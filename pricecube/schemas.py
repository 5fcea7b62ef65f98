"""Fixed StructTypes at every boundary of the pipeline."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S = StringType()

# One hypercube document: ordered dimension ids, their sizes, per-dimension
# category index/label maps, and the sparse value map keyed by the flat
# row-major index written as text.
CATEGORY = StructType(
    [
        StructField("index", MapType(S, IntegerType())),
        StructField("label", MapType(S, S)),
    ]
)
CUBE = StructType(
    [
        StructField("id", ArrayType(S)),
        StructField("size", ArrayType(IntegerType())),
        StructField("dimension", MapType(S, StructType([StructField("category", CATEGORY)]))),
        StructField("value", MapType(S, DoubleType())),
    ]
)

RAW_DIMENSIONS = ["freq", "siec", "nrg_cons", "unit", "tax", "currency"]

# Raw observations after tidying (20 columns with the load timestamp).
RAW = StructType(
    [
        StructField("consumer_type", S),
        StructField("geo", S),
        StructField("country_name", S),
        StructField("time", S),
        *[f for d in RAW_DIMENSIONS for f in (StructField(d, S), StructField(f"{d}_label", S))],
        StructField("geo_label", S),
        StructField("time_label", S),
        StructField("value_eur_per_kwh", DoubleType()),
    ]
)
RAW_LOADED = StructType(RAW.fields + [StructField("loaded_at", TimestampNTZType())])

PRICE = DecimalType(10, 4)

STG = StructType(
    [
        StructField("consumer_type", S),
        StructField("country_code", S),
        StructField("country_name", S),
        StructField("period", S),
        StructField("nrg_cons", S),
        StructField("nrg_cons_label", S),
        StructField("tax_label", S),
        StructField("price_eur_per_kwh", PRICE),
        StructField("price_category", S),
        StructField("loaded_at", TimestampNTZType()),
    ]
)

MART = StructType(
    [
        StructField("country_code", S),
        StructField("country_name", S),
        StructField("year", IntegerType()),
        StructField("consumer_type", S),
        StructField("avg_price_eur_per_kwh", DoubleType()),
        StructField("min_price", PRICE),
        StructField("max_price", PRICE),
        StructField("price_category_mode", S),
        StructField("prior_year_avg_price", DoubleType()),
        StructField("yoy_change_pct", DoubleType()),
    ]
)

DQ_RESULT = StructType(
    [
        StructField("table_name", S),
        StructField("test", S),
        StructField("column_name", S),
        StructField("failures", LongType()),
        StructField("status", S),
    ]
)

REPORT_ROW = StructType(
    [
        StructField("section", IntegerType()),
        StructField("item", S),
        StructField("value", S),
        StructField("status", S),
    ]
)
