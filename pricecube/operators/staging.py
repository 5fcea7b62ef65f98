"""Staging view: filter, rename, cast the price to DECIMAL, tier it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecube.constants import (
    PRICE_PRECISION,
    PRICE_SCALE,
    STG_CURRENCY,
    STG_TAX,
    TIER_DEFAULT,
    TIER_RULES,
)
from pricecube.functions import bucketize, to_decimal
from pricecube.functions.tiers import noted


def price_tier(value_col: str = "value_eur_per_kwh", rules=TIER_RULES, default: str = TIER_DEFAULT):
    """Tier from the *uncast* double; NULL falls to the default tier."""
    return bucketize(F.col(value_col), rules, default)


def staging(
    raw: DataFrame,
    currency: str = STG_CURRENCY,
    tax: str = STG_TAX,
    rules: Sequence[tuple[str, float, str]] = TIER_RULES,
    default_tier: str = TIER_DEFAULT,
) -> DataFrame:
    """Staging rows: 10 columns, filtered before projection.

    The two equality filters reach the scan of whatever produced ``raw``
    (Catalyst pushes them through projections and joins).
    """
    v = F.col("value_eur_per_kwh")
    return raw.where((F.col("currency") == currency) & (F.col("tax") == tax)).select(
        "consumer_type",
        F.col("geo").alias("country_code"),
        "country_name",
        F.col("time").alias("period"),
        "nrg_cons",
        "nrg_cons_label",
        "tax_label",
        to_decimal(v, PRICE_PRECISION, PRICE_SCALE).alias("price_eur_per_kwh"),
        noted(bucketize(v, rules, default_tier), "price_category", rules, default_tier),
        "loaded_at",
    )
