"""Serving queries, quality rules, the gate, and dataset helpers."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricecube.operators import annual, publish, quality, serving
from pricecube.operators.staging import staging
from pricecube.plans import fixtures as fx
from pricecube.sources import catalog, datasets


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    s = staging(fx.raw(spark, sf_dir))
    return s, annual.mart(s)


def test_prices_filters_and_order(spark, tables):
    _, m = tables
    all_rows = serving.prices(m).collect()
    keys = [(r.country_code, r.consumer_type, r.year) for r in all_rows]
    assert keys == sorted(keys)
    assert serving.prices(m, country="", year=0).count() == len(all_rows)  # falsy = absent
    lower = serving.prices(m, country="n03").collect()
    assert lower and all(r.country_code == "N03" for r in lower)


def test_invalid_consumer_type_rejected_before_any_job(tables):
    _, m = tables
    with pytest.raises(ValueError):
        serving.prices(m, consumer_type="Household")


def test_summary_is_latest_year(tables):
    _, m = tables
    latest = m.agg(F.max("year")).first()[0]
    rows = serving.prices_summary(m).collect()
    assert rows and {r.year for r in rows} == {latest}


def test_topk_and_order(tables):
    _, m = tables
    top = serving.yoy_extremes(m, 3, True).collect()
    bottom = serving.yoy_extremes(m, 3, False).collect()
    all_yoy = sorted(r.yoy_change_pct for r in m.where("yoy_change_pct is not null").collect())
    assert [r.yoy_change_pct for r in top] == all_yoy[::-1][:3]
    assert [r.yoy_change_pct for r in bottom] == all_yoy[:3]
    ranked = [r.yoy_change_pct for r in serving.prices_yoy(m).collect()]
    assert ranked == sorted(ranked, reverse=True)


def test_clean_suite_passes_dirty_fails_every_rule(spark, sf_dir, tables):
    s, m = tables
    assert quality.passed(quality.default_suite(s, m))
    ds = staging(fx.raw_dirty(spark, sf_dir))
    res = {(r.table_name, r.test, r.column_name): r.failures for r in quality.default_suite(ds, annual.mart(ds)).collect()}
    assert res[("stg_electricity_prices", "not_null", "price_eur_per_kwh")] > 0
    assert res[("stg_electricity_prices", "accepted_values", "consumer_type")] > 0
    assert res[("mart_energy_prices", "not_null", "country_name")] > 0
    assert res[("mart_energy_prices", "accepted_values", "consumer_type")] > 0
    assert len(res) == 15


def test_accepted_values_lets_null_pass(spark):
    df = spark.createDataFrame([("household",), (None,), ("x",)], "consumer_type string")
    r = quality.run_rules("t", df, [quality.accepted_values("consumer_type", ["household"]),
                                    quality.not_null("consumer_type"), quality.unique("consumer_type")])
    got = {row.test: row.failures for row in r.collect()}
    assert got == {"accepted_values": 1, "not_null": 1, "unique": 0}


def test_gate_blocks_and_publishes(spark, sf_dir, tmp_dir, tables):
    ds = staging(fx.raw_dirty(spark, sf_dir))
    many = [quality.not_null("price_eur_per_kwh")] * 25
    with pytest.raises(publish.QualityGateError) as error:
        publish.gated_publish(spark, [("stg", ds, many, "pc_gate.stg")], f"{tmp_dir}/staging")
    assert str(error.value).count("stg.price_eur_per_kwh") == 25  # every failing rule is named
    assert not catalog.table_exists(spark, "pc_gate.stg")
    s, _ = tables
    publish.gated_publish(spark, [("stg", s, quality.STG_RULES, "pc_gate.stg")], f"{tmp_dir}/staging")
    assert spark.table("pc_gate.stg").count() == s.count()


def test_all_targets_change_or_none(spark, tmp_dir, monkeypatch):
    one, two = spark.range(1), spark.range(2)
    publish.gated_publish(spark, [("a", one, [quality.not_null("id")], "pc_two.a"), ("b", one, [quality.not_null("id")], "pc_two.b")], tmp_dir)
    point = publish.point_table_at

    def failing(spark, table, location, fmt="parquet"):
        if table == "pc_two.new" or (table == "pc_two.b" and "published" not in location):
            raise RuntimeError("lost")
        point(spark, table, location, fmt)

    monkeypatch.setattr(publish, "point_table_at", failing)
    for last in ("pc_two.b", "pc_two.new"):
        targets = [("a", two, [quality.not_null("id")], "pc_two.a"), ("b", two, [quality.not_null("id")], last)]
        with pytest.raises(RuntimeError):
            publish.gated_publish(spark, targets, tmp_dir)
    assert spark.table("pc_two.a").count() == 1 and spark.table("pc_two.b").count() == 1
    with pytest.raises(RuntimeError):
        publish.gated_publish(spark, [("a", two, [quality.not_null("id")], "pc_two.fresh"), ("b", two, [quality.not_null("id")], "pc_two.new")], tmp_dir)
    assert not catalog.table_exists(spark, "pc_two.fresh")


def test_report_sections(tables):
    s, m = tables
    rep = quality.report(s, m, 0.20, 0.30).collect()
    assert {r.section for r in rep} == {1, 2, 3, 4, 5, 6}
    assert sum(1 for r in rep if r.section == 6) == 6
    assert [r.section for r in rep] == sorted(r.section for r in rep)
    countries = [r.item for r in rep if r.section == 3]
    assert countries == sorted(countries)
    count, *listed = [r for r in rep if r.section == 5]
    assert (count.item, count.value, count.status) == ("anomalies", str(len(listed)), "WARN") and listed
    assert [r.item for r in listed] == sorted(r.item for r in listed)
    changes = [float(r.value.strip("%")) for r in rep if r.section == 6]
    assert changes[:3] == sorted(changes[:3], reverse=True) and changes[3:] == sorted(changes[3:])
    calm = [r for r in quality.report(s, m, -1, 1000).collect() if r.section == 5]
    assert [(r.item, r.value, r.status) for r in calm] == [("anomalies", "0", "OK")]


def test_counts_of_summary_and_yoy(tables):
    _, m = tables
    summary = serving.prices_summary(m).collect()
    assert tuple(serving.prices_summary_count(m).first()) == (summary[0].year, len(summary))
    assert serving.prices_yoy_count(m).first()[0] == serving.prices_yoy(m).count()
    assert tuple(serving.prices_summary_count(m.limit(0)).first()) == (None, 0)


def test_union_and_empty_datasets(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("y",)], "k string")
    empty = spark.createDataFrame([], "k string, v int")
    u = datasets.union_datasets([a, empty, b])
    assert sorted(tuple(r) for r in u.collect()) == [("x", 1), ("y", None)]
    assert datasets.require_rows(u) is u
    with pytest.raises(datasets.NoDataError):
        datasets.require_rows(datasets.union_datasets([empty]))
    with pytest.raises(datasets.NoDataError):
        datasets.union_datasets([])


def test_lookup_keeps_the_row_count(spark):
    df = spark.createDataFrame([("DE",), ("XX",)], "geo string")
    names = spark.createDataFrame([("DE", "Germany"), ("DE", "Deutschland")], "geo string, name string")
    assert sorted(tuple(r) for r in datasets.lookup_country(df, names).collect()) == [("DE", "Deutschland"), ("XX", None)]


def test_year_filter(spark):
    df = spark.createDataFrame([("2014-S2",), ("2015-S1",), ("2024-S2",), ("2025-S1",)], "time string")
    assert [r.time for r in datasets.filter_year_range(df, 2015, 2024).collect()] == ["2015-S1", "2024-S2"]
    no_time = spark.createDataFrame([(1,)], "x int")
    assert datasets.filter_year_range(no_time).count() == 1
    bad = spark.createDataFrame([("20x5-S1",)], "time string")
    with pytest.raises(PySparkException):
        datasets.filter_year_range(bad).collect()  # ANSI cast fails like the original


def test_lookup_and_tidy(spark):
    df = spark.createDataFrame([("b", "DE", "2020-S1"), ("a", "XX", "2020-S1"), ("a", "FR", None)],
                               "consumer_type string, geo string, time string")
    looked = datasets.lookup_country(df).collect()
    assert {r.geo: r.country_name for r in looked} == {"DE": "Germany", "XX": None, "FR": "France"}
    t = datasets.tidy([df], sort=["consumer_type", "time"])
    assert t.columns[:4] == ["consumer_type", "geo", "country_name", "time"]
    assert [(r.consumer_type, r.time) for r in t.collect()] == [("a", "2020-S1"), ("a", None), ("b", "2020-S1")]


def test_gate_publishes_tables_without_copy(spark, tmp_dir, tables):
    s, m = tables
    places = []
    for _ in range(2):
        publish.gated_publish(spark, [("mart", m, quality.MART_RULES, "pc_serving.mart_energy_prices")], tmp_dir)
        assert spark.table("pc_serving.mart_energy_prices").count() == m.count()
        places.append(publish.table_location(spark, "pc_serving.mart_energy_prices"))
    assert len(set(places)) == 2 and all(p.rstrip("/").endswith("/mart") for p in places)


def test_tidy_sorts_a_bounded_number_of_rows_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(datasets, "SORT_ROWS", 1_000)
    df = spark.range(20_000).selectExpr("'household' as consumer_type", "concat('N', id % 3) as geo", "cast((id * 7919) % 20011 as string) as time", "id as v")
    t = datasets.tidy([df], names={"N1": "ONE"}, sort=["consumer_type", "geo", "time"], stored=True)
    sizes = [r.n for r in t.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    rows = [(r.geo, r.time, r.v) for r in t.collect()]
    assert len(sizes) > 10 and max(sizes) < 3_000 and rows == sorted(rows) and len(rows) == 20_000
