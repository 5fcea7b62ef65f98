"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from pricecube.operators import annual, serving
from pricecube.operators.staging import staging
from pricecube.plans import fixtures as fx
from pricecube.plans.registry import QUERIES
from pricecube.sources import cube, datasets


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


WRITING = {"gated_publish", "raw_load", "load_once", "load_batches", "table_schema", "csv_roundtrip", "export_staging",
           "export_mart", "cube_decode", "mart_table"}
QUERY_KEYS = sorted(set(QUERIES) - WRITING)


@pytest.mark.parametrize("key", QUERY_KEYS)
def test_no_python_in_query_plans(spark, sf_dir, key):
    text = formatted(E.queries()[key](spark, sf_dir))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in text, f"{key} runs Python: {op}"


def test_filters_and_pruning_reach_a_parquet_raw_table(spark, sf_dir, tmp_dir):
    path = f"{tmp_dir}/raw"
    fx.raw(spark, sf_dir).write.parquet(path)
    m = annual.mart(staging(spark.read.parquet(path)))
    text = formatted(m)
    assert "EqualTo(currency,EUR)" in text and "EqualTo(tax,I_TAX)" in text
    assert "EqualTo(nrg_cons,TOT_KWH)" in text
    # only the columns the mart needs are read
    scan = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "freq_label" not in scan and "unit" not in scan and "value_eur_per_kwh" in scan


def test_mart_is_one_aggregate_and_one_window(spark, sf_dir):
    m = annual.mart(staging(fx.raw(spark, sf_dir)))
    nodes = re.findall(r"^\(\d+\) (\w+)", formatted(m), re.M)
    assert nodes.count("HashAggregate") == 2  # partial + final: one aggregation
    assert nodes.count("Window") == 1
    after_agg = nodes[nodes.index("HashAggregate") + 1 :]
    assert not any("Join" in n for n in after_agg)  # no join after the aggregate


def test_general_mode_uses_group_limit(spark, sf_dir):
    df = annual.tier_mode_general(staging(fx.raw(spark, sf_dir)))
    assert "WindowGroupLimit" in formatted(df)


def test_topk_is_take_ordered(spark, sf_dir):
    m = annual.mart(staging(fx.raw(spark, sf_dir)))
    assert "TakeOrderedAndProject" in formatted(serving.yoy_extremes(m, 3))


def test_cube_maps_are_inverted_below_the_explode(spark, sf_dir):
    """Nothing above the Generate touches the documents' maps."""
    from pricecube.plans.ingest_queries import landed_docs

    text = cube.decode(landed_docs(spark, sf_dir), cube.CUBE_DIMS, carry=["dataset"])._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("Generate explode", 1)
    for costly in ("map_entries", "array_sort", "lambdafunction"):
        assert costly not in above and costly in below


def test_union_and_tidy_run_no_job_while_planning(spark, sf_dir):
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    o = fx.obs(spark, sf_dir)  # reads the files' footers
    spark.sparkContext.setJobGroup(group, group)
    datasets.tidy([o.where("consumer_type = 'household'"), o.where("consumer_type = 'industry'")], names=fx.COUNTRY_DICT)
    datasets.union_datasets([o, o])
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
