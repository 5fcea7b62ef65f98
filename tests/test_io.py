"""CSV landing, load-once, export."""

from __future__ import annotations

import os

from pricecube.operators import publish
from pricecube.sources import catalog, files


def test_csv_empty_is_null(spark, tmp_dir):
    df = spark.createDataFrame([("a", ""), ("b", "x")], "k string, v string")
    files.write_csv(df, f"{tmp_dir}/c")
    back = {r.k: r.v for r in files.read_csv(spark, f"{tmp_dir}/c", df.schema).collect()}
    assert back == {"a": None, "b": "x"}


def test_load_once_keeps_first_batch(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    path = f"{tmp_dir}/raw"
    loaded, t = publish.load_once(spark, df, path, as_of="2025-01-01 00:00:00")
    assert loaded and t.count() == 2
    assert t.select("loaded_at").distinct().count() == 1
    loaded2, t2 = publish.load_once(spark, df.limit(1), path, as_of="2026-01-01 00:00:00")
    assert not loaded2 and t2.count() == 2
    assert catalog.schema_frame(spark, t2.schema).collect()[-1].data_type == "TIMESTAMP_NTZ"


def test_current_timestamp_is_one_per_batch(spark, tmp_dir):
    df = spark.range(1000).repartition(4)
    loaded = publish.with_load_timestamp(df)
    assert loaded.select("loaded_at").distinct().count() == 1
    assert dict(loaded.dtypes)["loaded_at"] == "timestamp_ntz"


def test_csv_returns_texts_as_they_were(spark, tmp_dir):
    texts = [" lead trail ", "x\ny", 'a "quote"', '"', "back\\", 'back\\"', "a,b", "\t", " ", "'", "a\r\nb"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string")
    files.write_csv(df, f"{tmp_dir}/c")
    assert sorted(tuple(r) for r in files.read_csv(spark, f"{tmp_dir}/c", df.schema).collect()) == list(enumerate(texts))


def test_load_once_in_other_formats_and_with_refresh(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    for fmt in ("json", "orc"):
        path = f"{tmp_dir}/{fmt}"
        assert publish.load_once(spark, df, path, fmt=fmt)[0]
        wrote, t = publish.load_once(spark, df.limit(1), path, fmt=fmt)
        assert not wrote and t.count() == 2 and t.columns == ["x", "y", "loaded_at"]
        wrote, t = publish.load_once(spark, df.limit(1), path, fmt=fmt, refresh=True)
        assert wrote and t.count() == 1


def test_load_after_a_crashed_load(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    os.makedirs(f"{path}/_temporary/0")
    df = spark.createDataFrame([(1,)], "x int")
    wrote, t = publish.load_once(spark, df, path)
    assert wrote and t.count() == 1 and catalog.path_complete(spark, path)


def test_stored_table_through_the_catalog(spark):
    df = spark.range(5)
    assert not catalog.table_exists(spark, "pc_store.t")
    assert publish.materialize_table(spark, df, "pc_store.t").count() == 5
    assert catalog.table_exists(spark, "pc_store.t")
    assert publish.materialize_table(spark, df.limit(2), "pc_store.t").count() == 2


def test_export_narrows_decimals_and_summary(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1)], "k string, v int").selectExpr("k", "cast(0.1234 as decimal(10,4)) as p")
    publish.export_table(df, f"{tmp_dir}/exp")
    assert dict(spark.read.parquet(f"{tmp_dir}/exp").dtypes)["p"] == "double"
    s = {r.table_name: r.rows for r in publish.export_all(spark, [("t1", df), ("t2", df.union(df))], f"{tmp_dir}/all").collect()}
    assert s == {"t1": 1, "t2": 2, "TOTAL": 3}
    assert spark.read.parquet(f"{tmp_dir}/all/t2").count() == 2


def test_csv_files_are_bounded(spark, tmp_dir, monkeypatch):
    """A task reads a whole file, so files do not grow with the writer's partitions."""
    monkeypatch.setattr(files, "ROWS_PER_FILE", 10)
    rows = spark.range(95).selectExpr("id", "concat(id, '\n\"') as text").coalesce(1)
    files.write_csv(rows, f"{tmp_dir}/csv")
    back = files.read_csv(spark, f"{tmp_dir}/csv", rows.schema)
    assert len(back.inputFiles()) == 10 and sorted(back.collect()) == sorted(rows.collect())
