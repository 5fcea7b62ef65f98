"""Incremental landing: each run loads only new documents, once."""

from __future__ import annotations

import time

import pytest

from pricecube.sources import cube
from pricecube.streaming.landing import LANDED, decoded_stream, load_landed


def land(spark, path, rows, dataset):
    df = spark.createDataFrame(rows, "geo string, time string, v double")
    docs = cube.encode(df, ["geo"], ["geo", "time"], "v")
    docs.select("doc.*").write.mode("append").json(f"{path}/dataset={dataset}")


def test_incremental_runs_load_new_documents_once(spark, tmp_dir):
    landing, target = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    ckpt = f"{tmp_dir}/ckpt"
    land(spark, landing, [("DE", "2016-S1", 0.3), ("DE", "2030-S1", 0.4)], "nrg_pc_204")
    first = load_landed(spark, landing, target, ckpt, dims=["geo", "time"])
    rows = first.collect()
    assert [(r.consumer_type, r.geo, r.country_name, r.time) for r in rows] == [
        ("household", "DE", "Germany", "2016-S1")
    ]  # 2030 is outside the default year range
    time.sleep(1.1)
    land(spark, landing, [("FR", "2017-S2", 0.2)], "nrg_pc_205")
    second = load_landed(spark, landing, target, ckpt, dims=["geo", "time"]).collect()
    assert sorted((r.consumer_type, r.geo) for r in second) == [("household", "DE"), ("industry", "FR")]
    assert len({r.loaded_at for r in second}) == 2  # one timestamp per batch
    again = load_landed(spark, landing, target, ckpt, dims=["geo", "time"]).count()
    assert again == 2  # nothing new landed: nothing loaded twice


def land_with(spark, path, dim, rows):
    df = spark.createDataFrame(rows, f"geo string, time string, {dim} string, v double")
    docs = cube.encode(df, ["geo"], ["geo", "time", dim], "v")
    docs.select("doc.*").write.mode("append").json(f"{path}/dataset=nrg_pc_204")


def test_dimensions_outside_the_known_ones_are_loaded(spark, tmp_dir):
    landing, target, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/ckpt"
    land_with(spark, landing, "band", [("DE", "2016-S1", "b1", 0.3), ("DE", "2016-S1", "b2", 0.4)])
    first = load_landed(spark, landing, target, ckpt)
    assert set(cube.CUBE_DIMS) < set(first.columns)
    assert sorted((r.geo, r.band, r.value_eur_per_kwh) for r in first.collect()) == [("DE", "b1", 0.3), ("DE", "b2", 0.4)]
    # A later run finds one more; what is loaded stays.
    land_with(spark, landing, "nace", [("FR", "2016-S1", "n1", 0.5), ("FR", "2016-S1", "n2", 0.6)])
    second = load_landed(spark, landing, target, ckpt).collect()
    assert sorted((r.geo, r.band or "", r.nace or "", r.value_eur_per_kwh) for r in second) == [
        ("DE", "b1", "", 0.3), ("DE", "b2", "", 0.4), ("FR", "", "n1", 0.5), ("FR", "", "n2", 0.6)
    ]


def test_a_dimension_that_is_not_decoded_fails_the_stream(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    land_with(spark, landing, "tax", [("DE", "2016-S1", "t1", 0.3)])
    docs = spark.readStream.schema(LANDED).json(landing).selectExpr("struct(id, size, dimension, value) as doc")
    streams = [decoded_stream(spark, landing), cube.decode(docs)]
    land_with(spark, landing, "band", [("FR", "2016-S1", "b1", 0.3)])
    for k, stream in enumerate(streams):
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ckpt{k}").trigger(availableNow=True).start(f"{tmp_dir}/out{k}")
        with pytest.raises(Exception, match="band"):
            query.awaitTermination()
