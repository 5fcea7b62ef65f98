"""Mart semantics on hand-made staging rows (traps T6, T7, T11, T12)."""

from __future__ import annotations

import datetime
import decimal
import random

import pytest

from pricecube.operators import annual, quality
from pricecube.operators.staging import staging
from pricecube.plans import fixtures as fx
from pricecube.schemas import STG

TS = datetime.datetime(2025, 1, 1)


def stg_rows(spark, rows):
    full = [
        (t, code, name, period, band, "lbl", "Taxes included",
         None if p is None else decimal.Decimal(p), tier, TS)
        for (t, code, name, period, band, p, tier) in rows
    ]
    return spark.createDataFrame(full, STG)


def by_key(df):
    return {(r.country_code, r.consumer_type, r.year): r for r in df.collect()}


def test_mode_tie_goes_to_higher_tier(spark):
    rows = [
        ("household", "DE", "Germany", "2020-S1", "TOT_KWH", "0.3000", "High"),
        ("household", "DE", "Germany", "2020-S2", "TOT_KWH", "0.2000", "Medium"),
        ("household", "FR", "France", "2020-S1", "TOT_KWH", "0.1000", "Low"),
        ("household", "FR", "France", "2020-S2", "TOT_KWH", "0.2000", "Medium"),
        ("household", "FR", "France", "2021-S1", "TOT_KWH", "0.1000", "Low"),
        ("household", "FR", "France", "2021-S2", "TOT_KWH", "0.1000", "Low"),
    ]
    df = stg_rows(spark, rows)
    for out in (annual.mart(df), annual.mart_two_step(df)):
        m = by_key(out)
        assert m[("DE", "household", 2020)].price_category_mode == "High"
        assert m[("FR", "household", 2020)].price_category_mode == "Medium"
        assert m[("FR", "household", 2021)].price_category_mode == "Low"
    gen = {(r.country_code, r.year): r.price_category_mode for r in annual.tier_mode_general(df).collect()}
    one = {(r.country_code, r.year): r.price_category_mode for r in annual.tier_mode(df).collect()}
    assert gen == one


def test_lag_is_by_row_not_calendar(spark):
    rows = [
        ("industry", "PL", "Poland", "2015-S1", "TOT_KWH", "0.1000", "Low"),
        ("industry", "PL", "Poland", "2017-S1", "TOT_KWH", "0.1500", "Medium"),
    ]
    m = by_key(annual.mart(stg_rows(spark, rows)))
    first, after_gap = m[("PL", "industry", 2015)], m[("PL", "industry", 2017)]
    assert first.prior_year_avg_price is None and first.yoy_change_pct is None
    assert after_gap.prior_year_avg_price == 0.1  # the gap year takes the last available year
    assert after_gap.yoy_change_pct == 50.0


def test_single_half_and_band_filter(spark):
    rows = [
        ("household", "NL", "Netherlands", "2019-S2", "TOT_KWH", "0.2222", "Medium"),
        ("household", "NL", "Netherlands", "2019-S1", "KWH1000-2499", "0.9999", "High"),
    ]
    r = by_key(annual.mart(stg_rows(spark, rows)))[("NL", "household", 2019)]
    assert r.avg_price_eur_per_kwh == 0.2222
    assert r.min_price == r.max_price == decimal.Decimal("0.2222")
    assert r.price_category_mode == "Medium"


def test_null_price_counts_for_tier_not_for_average(spark):
    rows = [
        ("household", "ES", "Spain", "2018-S1", "TOT_KWH", None, "Low"),
        ("household", "ES", "Spain", "2018-S2", "TOT_KWH", None, "Low"),
        ("household", "IT", "Italy", "2018-S1", "TOT_KWH", None, "Low"),
        ("household", "IT", "Italy", "2018-S2", "TOT_KWH", "0.3000", "High"),
    ]
    m = by_key(annual.mart(stg_rows(spark, rows)))
    assert m[("ES", "household", 2018)].avg_price_eur_per_kwh is None
    it = m[("IT", "household", 2018)]
    assert it.avg_price_eur_per_kwh == 0.3
    assert it.price_category_mode == "High"  # one Low (NULL price), one High: tie -> High


def test_null_keys_dropped_like_inner_join(spark):
    rows = [
        ("household", None, "Nowhere", "2018-S1", "TOT_KWH", "0.1000", "Low"),
        ("household", "DE", "Germany", "2018-S1", "TOT_KWH", "0.1000", "Low"),
    ]
    df = stg_rows(spark, rows)
    assert annual.mart(df).count() == 1
    assert annual.mart_two_step(df).count() == 1


def test_mart_schema(spark):
    rows = [("household", "DE", "Germany", "2020-S1", "TOT_KWH", "0.3000", "High")]
    out = annual.mart(stg_rows(spark, rows))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [
        ("country_code", "string"), ("country_name", "string"), ("year", "int"), ("consumer_type", "string"),
        ("avg_price_eur_per_kwh", "double"), ("min_price", "decimal(10,4)"), ("max_price", "decimal(10,4)"),
        ("price_category_mode", "string"), ("prior_year_avg_price", "double"), ("yoy_change_pct", "double"),
    ]


def test_an_unlisted_tier_label_is_not_masked(spark):
    rows = [("household", "DE", "Germany", f"2020-S{i}", "TOT_KWH", "0.3000", tier) for i, tier in ((1, "Odd"), (2, "Odd"), (2, "Low"))]
    rows += [("household", "FR", "France", "2020-S1", "TOT_KWH", "0.3000", "Odd"), ("household", "FR", "France", "2020-S2", "TOT_KWH", "0.3000", "Low")]
    df = stg_rows(spark, rows)
    for out in (annual.mart(df), annual.mart_two_step(df)):
        assert by_key(out)[("DE", "household", 2020)].price_category_mode == "Odd"
    assert not quality.passed(quality.run_rules("mart", annual.mart(df), quality.MART_RULES))
    assert by_key(annual.mart(df))[("FR", "household", 2020)].price_category_mode == "Low"


def any_labels(spark, n):
    """Ties of listed, unlisted and missing labels, more than one for each group."""
    draw = random.Random(6)
    names = [f"T{i:02d}" for i in range(n)] + ["High", "Medium", "Low", None]
    rows = [("household", c, c, f"{y}-S{h}", "TOT_KWH", "0.3000", draw.choice(names)) for c in ("DE", "FR", "NL") for y in range(1990, 2010) for h in (1, 2, 2, 1)]
    return stg_rows(spark, rows)


@pytest.mark.parametrize("n", [0, 3, 12, 200])
def test_the_mode_of_any_label_in_one_aggregate(spark, n):
    df = any_labels(spark, n)
    want = sorted(map(str, annual.mart_two_step(df).collect()))
    assert sorted(map(str, annual.mart(df).collect())) == want
    one, general = (sorted(map(str, f(df).collect())) for f in (annual.tier_mode, annual.tier_mode_general))
    assert one == general
    labels = annual.labels_of(df)
    assert (labels is None) == (n == 200)
    if labels:
        assert labels[:3] == ["High", "Medium", "Low"] and labels[3:] == sorted(labels[3:])
        assert sorted(map(str, annual.mart(df, labels=labels).collect())) == want


def test_a_wrong_dictionary_fails(spark):
    with pytest.raises(Exception, match="tier labels other than High, Medium, Low"):
        annual.mart(any_labels(spark, 3), labels=["High", "Medium", "Low"]).collect()


def test_staging_notes_the_labels(spark, sf_dir, tmp_dir):
    """No job is needed to learn them, also from a stored table."""
    rules = [(">", 0.4, "Peak"), (">", 0.25, "High"), (">=", 0.15, "Medium")]
    stg = staging(fx.raw(spark, sf_dir), rules=rules, default_tier="Idle")
    stg.write.parquet(f"{tmp_dir}/stg")
    tracker, group = spark.sparkContext.statusTracker(), "labels"
    stored = spark.read.parquet(f"{tmp_dir}/stg")
    spark.sparkContext.setJobGroup(group, group)
    assert annual.labels_of(stg) == annual.labels_of(stored) == ["High", "Medium", "Low", "Idle", "Peak"]
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
