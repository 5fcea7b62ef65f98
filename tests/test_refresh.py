"""End-to-end refresh over landed documents derived from the driver tables."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from pricecube.plans import fixtures as fx
from pricecube.plans.ingest_queries import cube_docs
from pricecube.plans.refresh import refresh
from pricecube.schemas import MART, RAW_LOADED, STG
from pricecube.sources import datasets
from pricecube.sources.catalog import table_exists


def test_refresh_end_to_end(spark, sf_dir, tmp_dir):
    landing = f"{tmp_dir}/landing"
    cube_docs(spark, sf_dir).select("doc.*", "dataset").write.partitionBy("dataset").json(landing)
    # the documents' country codes are N00..N24; name them so the mart's not_null(country_name) passes
    names = {f"N{i:02d}": f"NATION_{i}" for i in range(25)}
    out = refresh(spark, landing, f"{tmp_dir}/wh", start=1990, end=2030, names=names, as_of=fx.AS_OF)
    assert out["suite"].where(F.col("status") == "FAIL").count() == 0
    assert out["raw"].select("loaded_at").distinct().count() == 1
    assert len(out["raw"].columns) == 20 and set(out["raw"].columns) == {f.name for f in RAW_LOADED.fields}
    assert out["stg"].schema.simpleString() == STG.simpleString()
    mart = out["mart"]
    assert mart.schema.simpleString() == MART.simpleString()
    assert mart.count() > 0
    assert dict(mart.dtypes)["min_price"] == "decimal(10,4)"
    assert {r.section for r in out["report"].collect()} >= {1, 2, 3, 4, 5}


def land(spark, path, value):
    doc = {"id": ["currency", "tax", "nrg_cons", "geo", "time"], "size": [1, 1, 1, 1, 1],
           "dimension": {d: {"category": {"index": {c: 0}, "label": {c: c}}} for d, c in
                         (("currency", "EUR"), ("tax", "I_TAX"), ("nrg_cons", "TOT_KWH"), ("geo", "DE"), ("time", "2020-S1"))},
           "value": value}
    os.makedirs(f"{path}/dataset=nrg_pc_204")
    with open(f"{path}/dataset=nrg_pc_204/d.json", "w") as f:
        json.dump(doc, f)


def test_no_data_stores_nothing(spark, tmp_dir):
    land(spark, f"{tmp_dir}/none", {})
    with pytest.raises(datasets.NoDataError):
        refresh(spark, f"{tmp_dir}/none", f"{tmp_dir}/wh", database="pc_none")
    assert not os.path.exists(f"{tmp_dir}/wh") and not table_exists(spark, "pc_none.mart_energy_prices")
    land(spark, f"{tmp_dir}/some", {"0": 0.2})
    out = refresh(spark, f"{tmp_dir}/some", f"{tmp_dir}/wh", database="pc_none")
    assert (out["raw"].count(), out["mart"].count()) == (1, 1)
    land(spark, f"{tmp_dir}/other", {"0": 0.3})
    again = refresh(spark, f"{tmp_dir}/other", f"{tmp_dir}/wh", database="pc_none")
    assert again["mart"].first().avg_price_eur_per_kwh == 0.2  # loaded once
    new = refresh(spark, f"{tmp_dir}/other", f"{tmp_dir}/wh", database="pc_none", reload=True)
    assert new["mart"].first().avg_price_eur_per_kwh == 0.3
