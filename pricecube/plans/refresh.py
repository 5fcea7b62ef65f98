"""The full refresh as one composition of the library's operators.

landed cube documents -> decode + year filter + names -> tidy CSV -> raw (load
once, batch timestamp) -> staging view -> annual mart -> quality gate ->
published tables -> report.  Jobs run only to learn the documents' dimensions,
at the sinks (the rows to tidy, CSV, raw load, the gate's writes) and when the caller
reads the report.  Every later step reads files, never the whole upstream plan again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from pricecube.constants import COUNTRIES, DATASETS, END_YEAR, MART_TABLE, RAW_TABLE, START_YEAR, STG_TABLE
from pricecube.operators import annual, publish, quality
from pricecube.operators.staging import staging
from pricecube.sources import cube, datasets, files
from pricecube.sources.catalog import path_complete


def refresh(
    spark: SparkSession,
    landing_path: str,
    warehouse: str,
    dims: Sequence[str] | None = None,
    start: int = START_YEAR,
    end: int = END_YEAR,
    names: Mapping[str, str] = COUNTRIES,
    labels: Mapping[str, str] = DATASETS,
    as_of: str | None = None,
    low: float = quality.PRICE_MIN,
    high: float = quality.PRICE_MAX,
    database: str = "pricecube",
    reload: bool = False,
) -> dict[str, DataFrame]:
    """Runs the chain; raises ``NoDataError`` before anything is stored when the
    documents hold no observation, and ``QualityGateError`` before anything is
    published when a rule fails.  ``reload`` replaces an earlier raw load."""
    root = warehouse.rstrip("/")
    raw_path = f"{root}/{RAW_TABLE}"
    if reload or not path_complete(spark, raw_path):
        docs = cube.read_cube_json(spark, landing_path)
        rows = cube.decode(docs, dims, carry=["dataset"], value_col="value_eur_per_kwh")
        rows = rows.withColumn("consumer_type", cube.dataset_label(rows["dataset"], labels)).drop("dataset")
        rows = datasets.require_rows(datasets.filter_year_range(rows, start, end))
        tidied = datasets.tidy([rows], names, stored=True)
        landed = files.write_csv(tidied, f"{root}/_csv/{uuid.uuid4().hex}")
        source = files.read_csv(spark, landed, tidied.schema)
        _, raw = publish.load_once(spark, source, raw_path, as_of=as_of, refresh=reload)
    else:
        raw = spark.read.parquet(raw_path)
    stg = publish.materialize_view(staging(raw), STG_TABLE)
    mart = annual.mart(stg)
    tables = {name: f"{database}.{name}" for name in (STG_TABLE, MART_TABLE)}
    suite = publish.gated_publish(
        spark,
        [
            (STG_TABLE, stg, quality.STG_RULES, tables[STG_TABLE]),
            (MART_TABLE, mart, quality.MART_RULES, tables[MART_TABLE]),
        ],
        staging_root=f"{root}/published",
    )
    pub_stg, pub_mart = spark.table(tables[STG_TABLE]), spark.table(tables[MART_TABLE])
    return {
        "raw": raw,
        "stg": pub_stg,
        "mart": pub_mart,
        "suite": suite,
        "report": quality.report(pub_stg, pub_mart, low, high),
    }
