"""Loading and publishing: batch timestamp, load-once, export, gated publish.

Loads and exports go to paths on the shared file system (or JDBC URLs for the
serving database); published tables are catalog entries over such files.  Every write is a distributed write by the executors; nothing is
pulled to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from pricecube.constants import EXPORT_BATCH_ROWS
from pricecube.operators import quality
from pricecube.sources.catalog import path_complete, table_exists


class QualityGateError(RuntimeError):
    """Raised when a rule fails; the publish target is left untouched."""


def load_timestamp(as_of: str | None = None) -> Column:
    """One timestamp for the whole batch, without zone.

    ``current_timestamp()`` is fixed once per query by Catalyst, so every row
    of a load shares it; ``as_of`` pins it (tests, replays).
    """
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz")
    return F.current_timestamp().cast("timestamp_ntz")


def with_load_timestamp(df: DataFrame, as_of: str | None = None, column: str = "loaded_at") -> DataFrame:
    """``SELECT *, <batch timestamp> AS loaded_at``."""
    return df.select("*", load_timestamp(as_of).alias(column))


def load_once(
    spark: SparkSession, df: DataFrame, path: str, as_of: str | None = None, fmt: str = "parquet", refresh: bool = False
) -> tuple[bool, DataFrame]:
    """Load ``df`` with a batch timestamp unless ``path`` already holds a finished
    load.  Returns (whether this call wrote, stored table).

    Reruns keep the first load (the original behaviour); ``refresh`` replaces it.
    What a crashed load left behind is overwritten.
    """
    wrote = refresh or not path_complete(spark, path)
    if wrote:
        with_load_timestamp(df, as_of).write.mode("overwrite").format(fmt).save(path)
    reader = spark.read.format(fmt)
    if fmt not in ("parquet", "orc"):  # other formats do not keep the schema
        reader = reader.schema(with_load_timestamp(df).schema)
    return wrote, reader.load(path)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A lazily evaluated view (the staging model): nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def materialize_table(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Rebuild a managed table (``db.table`` creates ``db`` when absent).

    The written table also cuts the lineage: later reads start from files.
    """
    if "." in name:
        ensure_database(spark, name.split(".", 1)[0])
    df.write.mode("overwrite").format(fmt).saveAsTable(name)
    return spark.table(name)


def decimals_as_double(df: DataFrame) -> DataFrame:
    """The serving copy narrows DECIMAL columns to DOUBLE."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def export_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    jdbc_properties: dict[str, str] | None = None,
    batch_rows: int = EXPORT_BATCH_ROWS,
) -> None:
    """Replace ``target`` with ``df`` (decimals as DOUBLE).

    ``fmt='jdbc'`` writes to a database table named ``target`` in batches of
    ``batch_rows`` (the JDBC driver must be on the classpath); the target's
    schema is created by the database on first write.
    """
    out = decimals_as_double(df)
    if fmt == "jdbc":
        props = dict(jdbc_properties or {})
        url = props.pop("url")
        (
            out.write.mode("overwrite")
            .option("batchsize", batch_rows)
            .option("truncate", "false")
            .jdbc(url, target, properties=props)
        )
        return
    out.write.mode("overwrite").format(fmt).save(target)


def export_all(spark: SparkSession, tables: Sequence[tuple[str, DataFrame]], root: str) -> DataFrame:
    """Export every table under ``root``, then report (table_name, rows) of what
    the exported copies hold, and a TOTAL row."""
    stored = []
    for name, df in tables:
        target = f"{root.rstrip('/')}/{name}"
        export_table(df, target)
        stored.append((name, spark.read.parquet(target)))
    return export_summary(stored)


def export_summary(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows per stored table plus a total row: one count aggregate per table."""
    parts = None
    for name, df in tables:
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        parts = c if parts is None else parts.unionByName(c)
    rolled = parts.rollup("table_name").agg(F.sum("rows").cast("bigint").alias("rows"))
    return rolled.select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "rows")


def table_location(spark: SparkSession, table: str) -> str | None:
    """Where a catalog table's files are; None when there is no such table."""
    if not table_exists(spark, table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first().data_type


def point_table_at(spark: SparkSession, table: str, location: str, fmt: str = "parquet") -> None:
    """Publish by metadata: (re)point a catalog table at validated files.

    No data is copied; readers switch to the new files when the catalog entry
    changes.
    """
    if "." in table:
        ensure_database(spark, table.split(".", 1)[0])
    if table_exists(spark, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{location}'")


def gated_publish(
    spark: SparkSession,
    candidates: Sequence[tuple[str, DataFrame, Sequence[quality.Rule], str]],
    staging_root: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Write every candidate once, run the rule suite on the written files, and
    only when every rule passes point the target tables at them.

    ``candidates``: (table_name, df, rules, target table).  On a failing rule
    ``QualityGateError`` is raised and no target is touched.  When a target
    cannot be pointed at its files, those already done are pointed back (or
    dropped, if new) before the error goes on, so either all targets change or
    none.  Every run writes under a fresh folder of ``staging_root``; files that
    an earlier run published stay for their readers.  Returns the suite results.
    """
    run = f"{staging_root.rstrip('/')}/{uuid.uuid4().hex}"
    staged = []
    for name, df, rules, target in candidates:
        df.write.format(fmt).save(f"{run}/{name}")
        staged.append((name, spark.read.format(fmt).load(f"{run}/{name}"), rules, target))
    results = quality.suite([(n, d, r) for n, d, r, _ in staged])
    failing = results.where(F.col("status") == "FAIL").select("table_name", "test", "column_name", "failures")
    bad = failing.collect()  # a row for each failing rule of the caller's rules
    if bad:
        detail = ", ".join(f"{r.table_name}.{r.column_name} {r.test}={r.failures}" for r in bad)
        raise QualityGateError(f"quality gate failed: {detail}")
    before = [(target, table_location(spark, target)) for _, _, _, target in staged]
    done: list[tuple[str, str | None]] = []
    try:
        for (name, _, _, target), old in zip(staged, before):
            point_table_at(spark, target, f"{run}/{name}", fmt)
            done.append(old)
    except Exception:
        for target, location in reversed(done):
            if location is None:
                spark.sql(f"DROP TABLE IF EXISTS {target}")
            else:
                point_table_at(spark, target, location, fmt)
        raise
    return results
