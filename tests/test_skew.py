"""A hot key holding a third of all rows: same results as DuckDB, and the
aggregation is partial (map-side) so the hot key never crosses the shuffle
as raw rows."""

from __future__ import annotations

import datetime
import decimal
import random
import re

import duckdb
from pyspark.sql import functions as F

from pricecube.operators import annual
from pricecube.schemas import STG
from pricecube.sources import datasets

TS = datetime.datetime(2025, 1, 1)


def skewed_rows(n=30_000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        code = "DE" if hot else f"C{rnd.randrange(20):02d}"
        year = 2020 if hot else rnd.randrange(2015, 2025)
        half = "S1" if rnd.random() < 0.5 else "S2"
        v = rnd.randrange(0, 4000) / 10000
        tier = "High" if v > 0.25 else "Medium" if v >= 0.15 else "Low"
        rows.append(("household", code, f"name-{code}", f"{year}-{half}", "TOT_KWH", "All", "Taxes included",
                     decimal.Decimal(v).quantize(decimal.Decimal("0.0001")), tier, TS))
    return rows


def test_hot_key_matches_duckdb_and_aggregates_partially(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, STG).repartition(8)
    m = annual.mart(df)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"partial_sum", plan) and re.search(r"partial_count", plan)
    got = {(r.country_code, r.year): (r.avg_price_eur_per_kwh, r.min_price, r.max_price, r.price_category_mode,
                                      r.yoy_change_pct) for r in m.collect()}
    con = duckdb.connect()
    con.execute("create table stg (consumer_type varchar, country_code varchar, country_name varchar, period varchar,"
                " nrg_cons varchar, nrg_cons_label varchar, tax_label varchar, price_eur_per_kwh decimal(10,4),"
                " price_category varchar, loaded_at timestamp)")
    con.executemany("insert into stg values (?,?,?,?,?,?,?,?,?,?)", rows)
    want_sql = """
    with yearly as (
      select country_code, period[1:4]::int as year, round(avg(price_eur_per_kwh), 4) as mean,
             min(price_eur_per_kwh) as low, max(price_eur_per_kwh) as high,
             count(*) filter (where price_category = 'High') as h,
             count(*) filter (where price_category = 'Medium') as m,
             count(*) filter (where price_category = 'Low') as l
      from stg group by all)
    select country_code, year, mean, low, high,
           if(h >= greatest(m, l), 'High', if(m >= l, 'Medium', 'Low')),
           round((mean - lag(mean) over series) / nullif(lag(mean) over series, 0) * 100, 2)
    from yearly window series as (partition by country_code order by year)"""
    want = {(r[0], r[1]): tuple(r[2:]) for r in con.sql(want_sql).fetchall()}
    assert got == want
    assert len(want) > 100


def test_a_hot_sort_key_is_split(spark):
    rows = spark.range(60_000).selectExpr(
        "'household' as consumer_type", "if(id % 3 = 0, 'DE', concat('C', id % 500)) as geo", "'2020-S1' as time",
        "'a' as nrg_cons", "'b' as tax", "'c' as currency", "cast(id as double) as value_eur_per_kwh")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tidied = datasets.tidy([rows.repartition(8)], names={"DE": "Germany"})
        sizes = tidied.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 60_000 and len(sizes) > 2 and max(sizes) < 60_000 / 3
