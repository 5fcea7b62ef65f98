from pricecube.functions.numeric import decimal_mean, pct_change, round_half_away, to_decimal
from pricecube.functions.periods import in_year_range, year_of
from pricecube.functions.tiers import bucketize, tier_rank

__all__ = [
    "bucketize",
    "decimal_mean",
    "in_year_range",
    "pct_change",
    "round_half_away",
    "tier_rank",
    "to_decimal",
    "year_of",
]
