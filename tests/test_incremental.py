"""The mart and its checks by increments equal those of all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_annual import any_labels, stg_rows

from pricecube.operators import annual, incremental, quality, versions
from pricecube.operators.staging import staging
from pricecube.plans import fixtures as fx
from pricecube.plans.serving_queries import landed_loads


def bag(df):
    return sorted(map(str, df.collect()))


def loads(spark, seed=1, n=4):
    """Staging rows in several loads: new groups, more rows of old ones, missing values."""
    draw = random.Random(seed)
    rows = []
    for _ in range(260):
        code = draw.choice(["DE", "FR", "NL", None])
        price = draw.choice([None, f"{draw.randrange(1, 9999) / 10000:.4f}"])
        rows.append((draw.choice(["household", "industry"]), code, None if code == "NL" else code, f"{draw.randrange(1990, 2004)}-S1", draw.choice(["TOT_KWH", "TOT_KWH", "KWH1000-2499"]), price, draw.choice(["High", "Medium", "Low", "Odd", None])))
    return [stg_rows(spark, rows[k::n]) for k in range(n)], stg_rows(spark, rows)


@pytest.mark.parametrize("most", [annual.MAX_LABELS, 2])
def test_loads_give_the_mart_of_all_rows(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(annual, "MAX_LABELS", most)
    parts, everything = loads(spark)
    seen = None
    for k, part in enumerate(parts):
        seen = incremental.refresh_mart(spark, tmp_dir, f"l{k}", part)
    assert bag(seen.table("mart")) == bag(annual.mart_two_step(everything))
    again = incremental.refresh_mart(spark, tmp_dir, "l1", parts[1])
    assert again.number == seen.number == len(parts)  # applied once


def test_many_labels(spark, tmp_dir):
    df = any_labels(spark, 200)
    for k in range(2):
        seen = incremental.refresh_mart(spark, tmp_dir, str(k), df.where(F.expr(f"cast(substr(period, 4, 1) as int) % 2 = {k}")))
    assert bag(seen.table("mart")) == bag(annual.mart_two_step(df))


def test_only_touched_groups_and_their_successors_are_made_anew(spark):
    rows = [("household", c, c, f"{y}-S1", "TOT_KWH", "0.2000", "Medium") for c in ("DE", "FR") for y in (2000, 2001, 2003, 2004)]
    state = incremental.partials(stg_rows(spark, rows))
    delta = incremental.partials(stg_rows(spark, [("household", "DE", "DE", "2001-S2", "TOT_KWH", "0.4000", "High"), ("household", "DE", "DE", "2004-S2", "TOT_KWH", "0.4000", "High")]))
    state = incremental._without(state, delta).unionByName(incremental.merged(state, delta))
    got = {(r.country_code, r.year): (r.avg_price_eur_per_kwh, r.prior_year_avg_price) for r in incremental.changed_rows(state, delta).collect()}
    assert got == {("DE", 2001): (0.3, 0.2), ("DE", 2003): (0.2, 0.3), ("DE", 2004): (0.3, 0.2)}


def test_old_raw_files_are_not_read(spark, sf_dir, tmp_dir):
    raw = fx.raw(spark, sf_dir).withColumn("load", F.when(F.col("time") < "1996", 1).otherwise(2))
    raw.write.partitionBy("load").parquet(f"{tmp_dir}/raw")

    def new(k):
        return staging(spark.read.parquet(f"{tmp_dir}/raw/load={k}"))

    incremental.refresh_mart(spark, f"{tmp_dir}/mart", "1", new(1))
    incremental.check_load(spark, f"{tmp_dir}/dq", "1", [("stg", new(1), quality.STG_RULES)])
    second = new(2)
    assert all("load=2" in f for f in second.inputFiles())
    seen = incremental.refresh_mart(spark, f"{tmp_dir}/mart", "2", second)
    assert bag(seen.table("mart")) == bag(annual.mart(staging(fx.raw(spark, sf_dir))))
    files = {f for t in seen.tables().values() for f in t.inputFiles()}
    assert files and not any("/raw/" in f for f in files)


def test_suite_of_all_loads(spark, tmp_dir):
    parts, everything = loads(spark)
    rules = [*quality.STG_RULES, quality.unique("period"), quality.unique("price_eur_per_kwh")]
    for k, part in enumerate([*parts, parts[0]]):
        got = incremental.check_load(spark, tmp_dir, f"l{k % len(parts)}", [("stg", part, rules), ("other", part.limit(0), [quality.not_null("period")])])
    want = quality.suite([("stg", everything, rules), ("other", everything.limit(0), [quality.not_null("period")])])
    assert bag(got) == bag(want)
    assert versions.latest(spark, tmp_dir) == len(parts)


def test_loads_land_in_tasks_of_one_size(spark, sf_dir):
    """However many rows a partition has, a task that writes (and sorts) them gets a bounded share."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        new = landed_loads(spark, sf_dir, lambda *a: fx.raw(*a).crossJoin(spark.range(10)).drop("id").repartition(8))
        assert len(new(1).inputFiles()) > 8
        assert sum(new(k).count() for k in (1, 2, 3)) == 10 * staging(fx.raw(spark, sf_dir)).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
