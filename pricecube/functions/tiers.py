"""Threshold tiers and tier ranks as CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricecube.constants import TIER_DEFAULT, TIER_PRIORITY, TIER_RULES

#: Under this name a column's metadata notes the labels that it can hold.
LABELS = "labels"
_OPS = {
    ">": lambda c, t: c > t,
    ">=": lambda c, t: c >= t,
    "<": lambda c, t: c < t,
    "<=": lambda c, t: c <= t,
}


def bucketize(
    c: Column,
    rules: Sequence[tuple[str, float, str]] = TIER_RULES,
    default: str = TIER_DEFAULT,
) -> Column:
    """First matching (op, threshold, label) wins; NULL input falls to ``default``."""
    expr = None
    for op, threshold, label in rules:
        cond = _OPS[op](c, F.lit(threshold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def noted(c: Column, name: str, rules: Sequence[tuple[str, float, str]], default: str) -> Column:
    """``c``, a ``bucketize`` of these rules, named and with its labels noted."""
    labels = sorted({label for _, _, label in rules} | {default})
    return c.alias(name, metadata={LABELS: labels})


def tier_rank(c: Column, priority: Sequence[str] = TIER_PRIORITY) -> Column:
    """1 for the first label in ``priority``; anything unlisted ranks last."""
    expr = None
    for i, label in enumerate(priority[:-1], start=1):
        expr = F.when(c == label, F.lit(i)) if expr is None else expr.when(c == label, F.lit(i))
    last = F.lit(len(priority))
    return last if expr is None else expr.otherwise(last)
