"""Landed documents, with a dead-letter route for broken ones.

Every landed text comes out once: as a document, or with the reason why it is
none, the path it landed at and the text itself.  Both kinds leave one pass over
the files (``store_documents`` writes them as one table, partitioned by kind), so
nothing is read again to find out what was lost.

A file holds one document however it is laid out (also pretty-printed), or one
document a line; it holds lines when any of them is a document by itself.  Files
with documents on lines that are too long for a task are read with
``layout="lines"``, which splits them.

What counts as broken is what a strict reader fails on: text that is not exactly
one JSON object (cut off, or followed by more), no ids, no sizes or unequal
numbers of them, a size below one, a listed dimension without categories, and
cells whose index or value is not a number.  A document without any cell is whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from pricecube.schemas import CUBE

LAYOUTS = ("auto", "lines", "whole")
#: What a row of ``documents`` has besides the landed folders' columns.
DOCUMENT = StructType(
    [
        StructField("doc", CUBE),
        StructField("path", StringType()),
        StructField("number", IntegerType()),
        StructField("reason", StringType()),
        StructField("text", StringType()),
    ]
)
#: Broken documents named in an error.
NAMED = 20


class BrokenDocumentsError(RuntimeError):
    """Raised when broken documents landed and the caller wants none."""


def _objects(text: Column) -> Column:
    """The JSON objects in a text; NULL unless it is a list of values without its
    brackets.  (A JSON reader by itself ignores what follows the first object.)"""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), ArrayType(CUBE))


def _reason(objects: Column, text: Column) -> Column:
    """Why a text is no document; NULL when it is one."""
    doc = F.get(objects, F.lit(0))
    ids, sizes, cells = doc["id"], doc["size"], doc["value"]

    def without_categories(d: Column) -> Column:
        return d.isNull() | F.try_element_at(doc["dimension"], d)["category"]["index"].isNull()

    cases = [
        (F.coalesce(F.size(objects) != 1, F.lit(True)) | doc.isNull(), "not one JSON object"),
        (ids.isNull(), "no dimension ids"),
        (sizes.isNull(), "no sizes"),
        (F.size(ids) != F.size(sizes), "as many sizes as ids are needed"),
        (F.exists(sizes, lambda n: n.isNull() | (n < 1)), "a size below one"),
        (doc["dimension"].isNull() | F.exists(ids, without_categories), "a dimension without categories"),
        (cells.isNull() & F.get_json_object(text, "$.value").isNotNull(), "cells that are not numbers"),
        (F.exists(F.map_keys(cells), lambda k: k.try_cast("bigint").isNull()), "a cell whose index is not a number"),
    ]
    reason = F.lit(None).cast("string")
    for broken, words in reversed(cases):
        reason = F.when(broken, F.lit(words)).otherwise(reason)
    return reason


def documents(texts: DataFrame, layout: str = "auto") -> DataFrame:
    """(doc, path, number, reason, text, ...) of (value, path, ...) rows: one row a
    document, in a batch or a stream.  ``number`` counts a file's documents from 1
    (always 1 in layout "lines"); whole documents have no ``reason`` and ``text``,
    broken ones no ``doc``."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    carry = [c for c in texts.columns if c not in ("value", "path")]
    value = F.col("value")

    def entry(text: Column, number: Column) -> Column:
        return F.struct(text.alias("text"), _objects(text).alias("objects"), number.cast("int").alias("number"))

    whole = F.array(entry(value, F.lit(1)))
    found = whole
    if layout == "auto":
        lines = F.filter(F.split(value, "\r?\n"), lambda line: line.rlike(r"\S"))

        def alone(line: Column) -> Column:
            # A document on a line names its ids; only such lines are parsed to find out.
            return line.rlike(r'^\s*\{.*"id"') & F.coalesce(F.get(_objects(line), F.lit(0))["id"].isNotNull(), F.lit(False))

        found = F.when(F.exists(lines, alone), F.transform(lines, lambda line, i: entry(line, i + 1))).otherwise(whole)
    rows = texts.where(value.rlike(r"\S")) if layout == "lines" else texts
    rows = rows.select("path", *carry, F.explode(found).alias("_e"))
    rows = rows.select("path", *carry, "_e", _reason(F.col("_e.objects"), F.col("_e.text")).alias("reason"))
    broken = F.col("reason").isNotNull()
    return rows.select(
        F.when(~broken, F.get("_e.objects", F.lit(0))).alias("doc"),
        "path",
        F.col("_e.number").alias("number"),
        "reason",
        F.when(broken, F.col("_e.text")).alias("text"),
        *carry,
    )


def landed_texts(reader, path: str, layout: str = "auto") -> DataFrame:
    """(value, path, and a column for each ``name=value`` folder) of ``spark.read`` or
    ``spark.readStream``: a row a file, or a row a line in layout "lines"."""
    texts = reader.text(path, wholetext=layout != "lines")
    return texts.select("*", F.col("_metadata.file_path").alias("path"))


def read_documents(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    return documents(landed_texts(spark.read, path, layout), layout)


def whole_only(found: DataFrame) -> DataFrame:
    """The whole documents; reading a broken one fails with its path and reason."""
    fails = F.raise_error(F.concat(F.lit("broken document in "), F.col("path"), F.lit(": "), F.col("reason")))
    return found.where(F.when(F.col("reason").isNotNull(), fails.cast("boolean")).otherwise(F.lit(True))).drop("reason", "text")


def store_documents(found: DataFrame, store: str, partitions: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Writes whole and broken documents in one pass, as one table partitioned by
    ``broken``; returns (whole ones, the quarantine)."""
    found.withColumn("broken", F.col("reason").isNotNull()).write.mode("overwrite").partitionBy(*partitions, "broken").parquet(store)
    return stored_documents(found.sparkSession, store, found.schema)


def stored_documents(spark: SparkSession, store: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The whole documents of a store, and its quarantine (path, number, reason, text
    and the landed folders' columns)."""
    table = spark.read.schema(StructType([*schema.fields, StructField("broken", StringType())])).parquet(store)
    whole = table.where(F.col("broken") == "false").drop("broken", "reason", "text")
    return whole, table.where(F.col("broken") == "true").drop("broken", "doc")


def fail_on(quarantine: DataFrame) -> None:
    """Raises when there is a broken document, naming some of them."""
    some = quarantine.select("path", "number", "reason").orderBy("path", "number").limit(NAMED).collect()
    if some:
        told = "; ".join(f"{r.path} ({r.number}): {r.reason}" for r in some)
        raise BrokenDocumentsError(f"broken documents landed, among them {told}")
