"""Domain defaults.

Every operator takes these as parameters; the values below are only the
defaults a user of the original pipeline gets without passing anything.
"""

from __future__ import annotations

# --- fixed values (must equal the original pipeline's defaults) -------------
# Dataset code -> consumer type label.
DATASETS: dict[str, str] = {
    "nrg_pc_204": "household",
    "nrg_pc_205": "industry",
}
# Country code -> country name.
COUNTRIES: dict[str, str] = {
    "DE": "Germany",
    "FR": "France",
    "NL": "Netherlands",
    "ES": "Spain",
    "PL": "Poland",
    "IT": "Italy",
}
# Inclusive year range kept after decoding.
START_YEAR = 2015
END_YEAR = 2024
# Staging filter: one currency, taxes included.
STG_CURRENCY = "EUR"
STG_TAX = "I_TAX"
# Mart filter: the all-bands consumption aggregate.
MART_BAND = "TOT_KWH"
# Price tiers, tested in order on the raw double: > 0.25 High, >= 0.15 Medium, else Low.
TIER_RULES: list[tuple[str, float, str]] = [(">", 0.25, "High"), (">=", 0.15, "Medium")]
TIER_DEFAULT = "Low"
# Tie-break priority for the modal tier (first wins).
TIER_PRIORITY: list[str] = ["High", "Medium", "Low"]
# Accepted consumer types.
CONSUMER_TYPES: list[str] = ["household", "industry"]
# Report anomaly band on the annual average (strictly outside is an anomaly).
PRICE_MIN = 0.05
PRICE_MAX = 1.00
# Decimal type of the staged price.
PRICE_PRECISION = 10
PRICE_SCALE = 4
# Export batch size for JDBC sinks.
EXPORT_BATCH_ROWS = 1000
# Top-k size of the report's YoY highlights.
YOY_HIGHLIGHTS = 3
# Rows shown by the post-load sample.
SAMPLE_ROWS = 5
# Raw column order after tidying: these first, the rest in their order.
RAW_PRIORITY = ["consumer_type", "geo", "country_name", "time"]
# Raw sort order after tidying.
RAW_SORT = ["consumer_type", "geo", "time", "nrg_cons", "tax", "currency"]
# Table names as the original's reports and rules show them.
RAW_TABLE = "raw_electricity_prices"
STG_TABLE = "stg_electricity_prices"
MART_TABLE = "mart_energy_prices"
# --- end of fixed values ------------------------------------------------------
