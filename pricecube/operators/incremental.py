"""Keeping the mart and its checks up to date by what is new.

Each load of raw rows is read once.  What is kept of it merges with what is kept of the
others:

* the mart's groups as partial aggregates (exact sum, count, extremes, a count for each
  tier label).  A load's partials are merged into the groups that it touches; the mart's
  rows are made anew for those groups and, as the year-over-year change looks back, for
  the next year of their series.  All other rows are taken over as they are;
* for each rule the failing rows of the load, which add up; a ``unique`` rule keeps how
  often each value occurred.

Both live under a root of ``versions``, so a load takes effect in all tables at one
instant or not at all, and a load that was applied before is not applied again.  Loads
only add rows, as the raw table's do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricecube.constants import MART_BAND, TIER_PRIORITY
from pricecube.functions import decimal_mean, pct_change, round_half_away, year_of
from pricecube.operators import annual, quality, versions

GROUP = ["country_code", "country_name", "year", "consumer_type"]
PARTIALS, MART, LOADS, METRICS, VALUES = "partials", "mart", "loads", "metrics", "values"
_COUNTS = "map<string,bigint>"


def partials(stg: DataFrame, band: str | None = MART_BAND, labels: Sequence[str] | None = None) -> DataFrame:
    """One row a group: ``total``, ``n``, ``min_price``, ``max_price``, ``tiers`` (label ->
    rows) and ``no_tier`` (rows without a label).  One hash aggregate for up to
    ``annual.MAX_LABELS`` labels, two for more."""
    labels = labels or annual.labels_of(stg)
    year = year_of(F.col("period"))
    wanted = F.col("country_code").isNotNull() & F.col("consumer_type").isNotNull() & year.isNotNull()
    rows = stg.where(wanted if band is None else (F.col("nrg_cons") == band) & wanted).withColumn("year", year)
    p, tier = F.col("price_eur_per_kwh"), F.col("price_category")
    stats = [F.sum(p).cast("decimal(38,4)").alias("total"), F.count(p).alias("n"), F.min(p).alias("min_price"), F.max(p).alias("max_price")]
    no_tier = F.count_if(tier.isNull()).alias("no_tier")
    if labels is not None:
        other = F.count_if(~(tier.isNull() | tier.isin(list(labels)))).alias("_tx")
        held = rows.groupBy(*GROUP).agg(*stats, no_tier, other, *[F.count_if(tier == t).alias(f"_t{i}") for i, t in enumerate(labels)])
        counts = F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*[F.col(f"_t{i}") for i in range(len(labels))]))
        fails = F.raise_error(F.lit(f"tier labels other than {', '.join(labels)}")).cast(_COUNTS)
        tiers = F.when(F.col("_tx") > 0, fails).otherwise(F.map_filter(counts, lambda _, n: n > 0))
        return held.select(*GROUP, "total", "n", "min_price", "max_price", tiers.alias("tiers"), "no_tier")
    by_label = rows.groupBy(*GROUP, tier.alias("_tier")).agg(*stats, F.count(F.lit(1)).alias("_rows"))
    entries = F.collect_list(F.when(F.col("_tier").isNotNull(), F.struct("_tier", "_rows")))
    return by_label.groupBy(*GROUP).agg(
        F.sum("total").cast("decimal(38,4)").alias("total"), F.sum("n").alias("n"), F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
        F.map_from_entries(entries).alias("tiers"), F.coalesce(F.sum(F.when(F.col("_tier").isNull(), F.col("_rows"))), F.lit(0)).alias("no_tier"),
    )


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equal groups; a missing country name equals another."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """The groups of ``new`` with what ``old`` has of them: a row for each row of ``new``."""

    def both(column: str, f) -> Column:
        return f(F.col(f"o.{column}"), F.col(f"n.{column}")).alias(column)

    def added(a: Column, b: Column) -> Column:
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)

    empty = F.create_map().cast(_COUNTS)
    counts = F.map_zip_with(F.coalesce("o.tiers", empty), F.coalesce("n.tiers", empty), lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    return new.alias("n").join(old.alias("o"), _same("n", "o", GROUP), "left").select(
        *[F.col(f"n.{k}").alias(k) for k in GROUP],
        both("total", lambda a, b: added(a, b).cast("decimal(38,4)")), both("n", added),
        both("min_price", F.least), both("max_price", F.greatest), counts.alias("tiers"), both("no_tier", added),
    )


def _mode(priority: Sequence[str]) -> Column:
    """The label with the most rows; of equal ones the first of the list, then by name,
    no label last."""
    ranks = F.create_map(*[x for i, t in enumerate(priority) for x in (F.lit(t), F.lit(i))])
    entry = F.transform(
        F.map_entries("tiers"),
        lambda e: F.struct((-e["value"]).alias("down"), F.coalesce(F.try_element_at(ranks, e["key"]), F.lit(len(priority))).alias("rank"), e["key"].alias("label")),
    )
    best = F.get(F.array_sort(entry), F.lit(0))
    return F.when(best.isNull() | (F.col("no_tier") > -best["down"]), F.lit(None).cast("string")).otherwise(best["label"])


def mart_rows(groups: DataFrame, priority: Sequence[str] = TIER_PRIORITY, more: Sequence[str] = ()) -> DataFrame:
    """The mart's rows of partial aggregates, which must hold whole series; ``more`` are
    columns to carry, and the row before's of them as ``prior_<name>``."""
    avg = round_half_away(decimal_mean(F.col("total"), F.col("n")), 4)
    w = Window.partitionBy("country_code", "consumer_type").orderBy("year")
    rows = groups.select(
        *GROUP, avg.alias("avg_price_eur_per_kwh"), "min_price", "max_price", _mode(priority).alias("price_category_mode"),
        F.lag(avg, 1).over(w).alias("prior_year_avg_price"), *more, *[F.lag(c, 1).over(w).alias(f"prior_{c}") for c in more],
    )
    return rows.withColumn("yoy_change_pct", pct_change(F.col("avg_price_eur_per_kwh"), F.col("prior_year_avg_price"), 2))


def changed_rows(state: DataFrame, delta: DataFrame, priority: Sequence[str] = TIER_PRIORITY) -> DataFrame:
    """The mart's rows that a load changes: those of the groups in ``delta``, and the row
    after each in its series.  Only series with such a group are looked at."""
    touched = delta.select(*GROUP, F.lit(True).alias("touched"))
    series = delta.select("country_code", "consumer_type").distinct()
    groups = state.join(series, ["country_code", "consumer_type"], "left_semi")
    marked = groups.alias("g").join(touched.alias("t"), _same("g", "t", GROUP), "left").select("g.*", F.coalesce("t.touched", F.lit(False)).alias("touched"))
    rows = mart_rows(marked, priority, ["touched"])
    return rows.where(F.col("touched") | F.coalesce("prior_touched", F.lit(False))).select(*annual.MART_COLUMNS)


def _without(old: DataFrame, gone: DataFrame) -> DataFrame:
    return old.alias("o").join(gone.select(*GROUP).alias("g"), _same("o", "g", GROUP), "left_anti")


def refresh_mart(spark: SparkSession, root: str, load: str, stg: DataFrame, band: str | None = MART_BAND, priority: Sequence[str] = TIER_PRIORITY) -> versions.Snapshot:
    """Applies the staging rows of one load to the mart under ``root`` and returns the
    tables then current (``mart``, ``partials``, ``loads``).  ``stg`` is all that is read
    besides those tables.  A load applied before changes nothing."""
    base = versions.latest(spark, root)
    before = versions.Snapshot(spark, root, base) if base else None
    applied = before.table(LOADS) if before else spark.createDataFrame([], "load string")
    if not applied.where(F.col("load") == load).isEmpty():
        return before
    delta, held = partials(stg, band), None
    if before is None:
        state, mart = delta, mart_rows(delta, priority).select(*annual.MART_COLUMNS)
    else:
        # The load's partials are used several times; they are a row a group.
        held = versions.stage(spark, root, {"delta": delta})
        delta = held.tables["delta"]
        state, mart = before.table(PARTIALS), before.table(MART)
        state = _without(state, delta).unionByName(merged(state, delta))
        changed = changed_rows(state, delta, priority)
        mart = _without(mart, changed).unionByName(changed)
    loads = applied.unionByName(spark.createDataFrame([(load,)], "load string"))
    try:
        versions.publish(spark, root, {PARTIALS: state, MART: mart, LOADS: loads}, number=base + 1)
    finally:
        if held:
            versions.discard(spark, held)
    return versions.Snapshot(spark, root, base + 1)


# --- checks on increments ---------------------------------------------------------


def metrics(load: str, table_name: str, new: DataFrame, rules: Sequence[quality.Rule]) -> DataFrame:
    """(load, table_name, test, column_name, failures) of the new rows for rules that look
    at single rows: one aggregate."""
    row_rules = [r for r in rules if r.test != "unique"]
    return quality.run_rules(table_name, new, row_rules).select(F.lit(load).alias("load"), "table_name", "test", "column_name", "failures")


def value_counts(load: str, table_name: str, new: DataFrame, rules: Sequence[quality.Rule]) -> DataFrame | None:
    """(load, table_name, column_name, value, n) for each ``unique`` rule's column."""
    parts = [
        new.where(F.col(r.column).isNotNull()).groupBy(F.col(r.column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(load).alias("load"), F.lit(table_name).alias("table_name"), F.lit(r.column).alias("column_name"), "value", "n")
        for r in rules if r.test == "unique"
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def check_load(spark: SparkSession, root: str, load: str, tables: Sequence[tuple[str, DataFrame, Sequence[quality.Rule]]]) -> DataFrame:
    """Adds the metrics of a load's new rows to those kept under ``root`` and returns the
    suite of all loads.  Only the new rows are read besides what is kept."""
    base = versions.latest(spark, root)
    before = versions.Snapshot(spark, root, base) if base else None
    new = reduce(DataFrame.unionByName, [metrics(load, n, df, rules) for n, df, rules in tables])
    values = [v for n, df, rules in tables if (v := value_counts(load, n, df, rules)) is not None]
    none = spark.createDataFrame([], "load string, table_name string, column_name string, value string, n bigint")
    new_values = reduce(DataFrame.unionByName, values, none)
    if before:
        if not before.table(METRICS).where(F.col("load") == load).isEmpty():
            return suite(before)
        new, new_values = before.table(METRICS).unionByName(new), before.table(VALUES).unionByName(new_values)
    versions.publish(spark, root, {METRICS: new, VALUES: new_values}, number=base + 1)
    return suite(versions.Snapshot(spark, root, base + 1))


def suite(snapshot: versions.Snapshot) -> DataFrame:
    """(table_name, test, column_name, failures, status) over all loads checked."""
    added = snapshot.table(METRICS).groupBy("table_name", "test", "column_name").agg(F.sum("failures").alias("failures"))
    each = snapshot.table(VALUES).groupBy("table_name", "column_name", "value").agg(F.sum("n").alias("n"))
    repeated = each.groupBy("table_name", "column_name").agg(F.count_if(F.col("n") > 1).alias("failures"))
    found = added.unionByName(repeated.select("table_name", F.lit("unique").alias("test"), "column_name", "failures"))
    return found.withColumn("status", F.when(F.col("failures") > 0, "FAIL").otherwise("PASS"))
