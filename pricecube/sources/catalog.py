"""Catalog helpers: existence and column listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, on any file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def path_complete(spark: SparkSession, path: str) -> bool:
    """True when a write to ``path`` has finished, on any file system and in any
    format: Spark's commit leaves the marker, a crashed write does not."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def schema_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """(ordinal_position, column_name, data_type) in ordinal order; built from
    the schema (metadata), not from the data."""
    rows = [(i + 1, f.name, f.dataType.simpleString().upper()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "ordinal_position int, column_name string, data_type string")


def column_listing(df: DataFrame) -> DataFrame:
    """(ordinal_position, column_name, data_type, rows, nulls) in ordinal order, counted in
    the table: one aggregate."""
    names = [f"`{f.name.replace('`', '``')}`" for f in df.schema.fields]
    held = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(n)).alias(f"_n{i}") for i, n in enumerate(names)])
    rows = [
        F.struct(F.lit(i + 1).alias("ordinal_position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString().upper()).alias("data_type"), "rows", (F.col("rows") - F.col(f"_n{i}")).alias("nulls"))
        for i, f in enumerate(df.schema.fields)
    ]
    return held.select(F.inline(F.array(*rows)))
