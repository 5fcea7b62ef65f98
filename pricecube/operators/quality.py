"""Declarative data-quality rules, the test suite, the report and the gate.

Rules of one table compile into ONE aggregate (one scan, partial aggregation
map-side): every ``not_null`` / ``accepted_values`` rule is a ``count_if``
column of that aggregate, and the row of counts is turned into rule rows
with ``inline`` - the number of output rows is the number of rules, however
large the table.  ``unique`` needs a grouping on its column, so it is a
separate aggregate whose output is only the duplicated keys counted again.
On a column of about as many values as rows that grouping shuffles them all;
``unique(column, many=True)`` shuffles small keys instead, and values only
where a key says that one may repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecube.constants import (
    CONSUMER_TYPES,
    MART_TABLE,
    PRICE_MAX,
    PRICE_MIN,
    STG_TABLE,
    TIER_PRIORITY,
    YOY_HIGHLIGHTS,
)
from pricecube.operators import serving


@dataclass(frozen=True)
class Rule:
    test: str  # "not_null" | "accepted_values" | "unique"
    column: str
    values: tuple[str, ...] = field(default=())
    many: bool = False  # unique: about as many values as rows

    def failing(self) -> Column:
        c = F.col(self.column)
        if self.test == "not_null":
            return c.isNull()
        if self.test == "accepted_values":
            # NULL passes accepted_values (only not_null catches it)
            return c.isNotNull() & ~c.isin(list(self.values))
        raise ValueError(f"rule {self.test} is not a row predicate")


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def accepted_values(column: str, values: Sequence[str]) -> Rule:
    return Rule("accepted_values", column, tuple(values))


def unique(column: str, many: bool = False) -> Rule:
    """No value occurs twice; ``many`` picks how that is found out, not what."""
    return Rule("unique", column, many=many)


# The declared suite: 7 staging rules and 8 mart rules.
STG_RULES: list[Rule] = [
    not_null("country_code"),
    not_null("period"),
    not_null("consumer_type"),
    accepted_values("consumer_type", CONSUMER_TYPES),
    not_null("price_eur_per_kwh"),
    not_null("price_category"),
    accepted_values("price_category", TIER_PRIORITY),
]
MART_RULES: list[Rule] = [
    not_null("country_code"),
    not_null("year"),
    not_null("country_name"),
    not_null("consumer_type"),
    accepted_values("consumer_type", CONSUMER_TYPES),
    not_null("avg_price_eur_per_kwh"),
    not_null("price_category_mode"),
    accepted_values("price_category_mode", TIER_PRIORITY),
]


def _status(failures: Column, bad: str = "FAIL", good: str = "PASS") -> Column:
    return F.when(failures > 0, F.lit(bad)).otherwise(F.lit(good))


def _row_rules(table_name: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    rules = [r for r in rules if r.test != "unique"]
    if not rules:
        return None
    counts = df.agg(*[F.count_if(r.failing()).alias(f"_r{i}") for i, r in enumerate(rules)])
    structs = [
        F.struct(
            F.lit(r.test).alias("test"),
            F.lit(r.column).alias("column_name"),
            F.col(f"_r{i}").alias("failures"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*structs))).select(
        F.lit(table_name).alias("table_name"), "test", "column_name", "failures"
    )


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def possible_repeats(df: DataFrame, column: str) -> DataFrame:
    """The non-NULL values of ``column`` that may occur more than once, as often as they
    do: a column named ``column``.  Every repeated value is among them.

    Integers are gathered into bitmaps, a 64-bit word for 64 neighbouring values: a word
    with fewer bits than rows holds a repeat.  Where neighbours are read by one task a
    row of 32 bytes stands for up to 64 values in the shuffle, and at worst for one.
    Other types are counted by a 64-bit hash, whatever their width.  The keys so found
    are joined back (Spark broadcasts them if they are few), so ``df`` is read twice.
    """
    values = df.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull())
    if isinstance(df.schema[column].dataType, _INTEGERS):
        v = F.col("_v").cast("bigint")
        keyed = values.withColumn("_key", F.shiftright(v, 6))
        bit = F.expr("shiftleft(1L, cast(cast(_v as bigint) & 63 as int))")
        seen = F.bit_count(F.bit_or(bit))
    else:
        keyed, seen = values.withColumn("_key", F.xxhash64("_v")), F.lit(1)
    suspects = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), seen.alias("_seen")).where(F.col("_n") > F.col("_seen"))
    return keyed.join(suspects.select("_key"), "_key", "left_semi").select(F.col("_v").alias(column))


def _unique_rule(table_name: str, df: DataFrame, rule: Rule) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    values = possible_repeats(df, rule.column) if rule.many else df
    dup = (
        values.where(F.col(rule.column).isNotNull())
        .groupBy(rule.column)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
    )
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table_name).alias("table_name"),
        F.lit("unique").alias("test"),
        F.lit(rule.column).alias("column_name"),
        "failures",
    )


def run_rules(table_name: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    parts = []
    row = _row_rules(table_name, df, rules)
    if row is not None:
        parts.append(row)
    parts += [_unique_rule(table_name, df, r) for r in rules if r.test == "unique"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("failures")))


def suite(tables: Sequence[tuple[str, DataFrame, Sequence[Rule]]]) -> DataFrame:
    """All rules of all tables as (table_name, test, column_name, failures, status)."""
    out = None
    for name, df, rules in tables:
        part = run_rules(name, df, rules)
        out = part if out is None else out.unionByName(part)
    return out


def default_suite(stg: DataFrame, mart: DataFrame) -> DataFrame:
    return suite([(STG_TABLE, stg, STG_RULES), (MART_TABLE, mart, MART_RULES)])


def passed(results: DataFrame) -> bool:
    """True when no rule failed.  Only the (bounded) failing rule rows reach
    the driver, never table data."""
    return results.where(F.col("status") == "FAIL").limit(1).count() == 0


# --- report checks (status never gates) --------------------------------------


def row_counts(stg: DataFrame, mart: DataFrame) -> DataFrame:
    s = stg.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(STG_TABLE).alias("table_name"), "rows")
    m = mart.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(MART_TABLE).alias("table_name"), "rows")
    return s.unionByName(m).withColumn("status", F.when(F.col("rows") == 0, "WARN").otherwise("OK"))


NULL_CHECKS = [
    ("stg", "country_code"),
    ("stg", "period"),
    ("stg", "price_eur_per_kwh"),
    ("mart", "country_code"),
    ("mart", "year"),
    ("mart", "avg_price_eur_per_kwh"),
]


def null_counts(stg: DataFrame, mart: DataFrame, checks=NULL_CHECKS) -> DataFrame:
    """NULL counts of key columns: one aggregate per table."""
    parts = []
    for alias, name, df in (("stg", STG_TABLE, stg), ("mart", MART_TABLE, mart)):
        cols = [c for t, c in checks if t == alias]
        if not cols:
            continue
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
        rows = agg.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls"))
                        for i, c in enumerate(cols)
                    ]
                )
            )
        ).select(F.lit(name).alias("table_name"), "column_name", "nulls")
        parts.append(rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("nulls"), "FAIL", "OK"))


def price_anomalies(mart: DataFrame, low: float = PRICE_MIN, high: float = PRICE_MAX) -> DataFrame:
    a = F.col("avg_price_eur_per_kwh")
    return (
        mart.where((a < low) | (a > high))
        .select("country_code", "consumer_type", "year", "avg_price_eur_per_kwh")
        .orderBy("country_code", "consumer_type", "year")
    )


def _pct(c: Column) -> Column:
    return F.concat(F.format_string("%.2f", c), F.lit("%"))


def _profile(df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """One aggregate over ``df``: row count, NULL count per column, extras."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
        *extra,
    )


def report(
    stg: DataFrame,
    mart: DataFrame,
    low: float = PRICE_MIN,
    high: float = PRICE_MAX,
    k: int = YOY_HIGHLIGHTS,
    checks=NULL_CHECKS,
) -> DataFrame:
    """The six report sections as (section, item, value, status) text rows.

    Rows come in the order of the sections, and within them as the checks are
    listed or by key.  All scalar checks of a table come from ONE aggregate (row
    count, latest period, NULL counts, anomaly count).  Several sections read the
    tables, so pass stored ones.
    """
    stg_cols = [c for t, c in checks if t == "stg"]
    mart_cols = [c for t, c in checks if t == "mart"]
    a = F.col("avg_price_eur_per_kwh")
    anomalous = (a < low) | (a > high)
    sp = _profile(stg, stg_cols, [F.max("period").alias("latest_period")])
    mp = _profile(mart, mart_cols, [F.count_if(anomalous).alias("anomalies")])

    none = F.lit(None).cast("double")

    def rows(df: DataFrame, section: int, item: Column, value: Column, status, part: int = 0, key=F.lit(""), rank: Column = none) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), item.alias("item"), value.alias("value"), status.alias("status"),
            F.lit(part).alias("_part"), rank.alias("_rank"), key.alias("_key"),
        )

    def warn_if(cond: Column) -> Column:
        return F.when(cond, "WARN").otherwise("OK")

    n = F.col("rows")
    per_country = mart.groupBy("country_code", "country_name").agg(F.count(F.lit(1)).alias("rows"))
    grain = F.concat_ws(" ", "country_code", "consumer_type", F.col("year").cast("string"))
    out = [
        rows(sp, 1, F.lit(STG_TABLE), F.format_number("rows", 0), warn_if(n == 0), 0),
        rows(mp, 1, F.lit(MART_TABLE), F.format_number("rows", 0), warn_if(n == 0), 1),
        rows(sp, 2, F.lit("latest_period"), F.coalesce("latest_period", F.lit("no data found")), warn_if(F.col("latest_period").isNull())),
        rows(per_country, 3, F.concat_ws(" ", "country_code", "country_name"), F.format_number("rows", 0), F.lit("OK"), key=F.col("country_code")),
        rows(mp.where(n == 0), 3, F.lit("rows"), F.lit("0"), F.lit("WARN")),
        rows(mp, 5, F.lit("anomalies"), F.col("anomalies").cast("string"), warn_if(F.col("anomalies") > 0)),
        rows(mart.where(anomalous), 5, grain, F.format_string("%.4f", "avg_price_eur_per_kwh"), F.lit("WARN"), 1, grain),
    ]
    nulls = [(sp, STG_TABLE, c) for c in stg_cols] + [(mp, MART_TABLE, c) for c in mart_cols]
    for prof, names in ((sp, stg_cols), (mp, mart_cols)):
        listed = F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(f"{t}.{c}").alias("name"), F.col(f"_null_{c}").alias("nulls"))
            for i, (p, t, c) in enumerate(nulls) if p is prof
        ])
        if names:
            each = prof.select(F.inline(listed))
            out.append(rows(each, 4, F.col("name"), F.col("nulls").cast("string"), _status(F.col("nulls"), "FAIL", "OK"), rank=F.col("i").cast("double")))
    for part, (tag, sign) in enumerate((("increase", "+"), ("decrease", ""))):
        change = F.col("yoy_change_pct")
        top = serving.yoy_extremes(mart, k, increases=part == 0)
        item = F.concat_ws(" ", F.lit(tag), grain)
        out.append(rows(top, 6, item, F.concat(F.lit(sign), _pct(change)), F.lit(""), part, grain, change if part else -change))
    report_rows = out[0]
    for part in out[1:]:
        report_rows = report_rows.unionByName(part)
    return report_rows.orderBy("section", "_part", "_rank", "_key").drop("_part", "_rank", "_key")
