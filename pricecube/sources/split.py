"""Decoding one large document in many tasks.

A document is one JSON object, so a reader that takes it as a row parses and explodes
it in one task, and cannot take it at all beyond the size of a row.  Here a file is
read at its commas: Spark's text reader splits it into ranges, wherever they fall,
and each task gets the pieces of its range, nearly all of them single cells.

* The piece that opens the cells (``"value": {`` with a cell or nothing in it) and the
  first closing brace after it bound a document's cells.  Cells hold no braces and no
  commas, so these bounds are exact however the rest of the document looks.
* What lies outside the bounds (ids, sizes, categories) is put together again and
  parsed: the document's head, as small as its dimensions.
* Heads and bounds go to the ranges that they concern, a row for each range of a
  file, and meet the cells there.  A document is never one join key, so its cells stay
  in as many tasks as it has ranges.

A file holds one document, or with ``parts`` a folder's files do, in the order of their
names: a document that many tasks wrote, each from after a comma between cells (or the
beginning) on.  Files of many documents have ranges and tasks enough and are read by
``documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecube.session import scratch_path
from pricecube.sources import cube, documents

#: A piece that opens the cells: what ends with the brace, and what follows it.
OPENS = r'(?s)^(.*"value"\s*:\s*\{)(\s*(?:"\s*[+-]?\d+\s*"\s*:.*|\}.*)?)$'
CELL = r'^\s*"\s*([+-]?\d+)\s*"\s*:\s*(null|-?\d[0-9.eE+-]*)\s*$'
#: Stand for the cells in a head while it is put together (JSON texts hold neither).
GONE, DONE = "\x01", "\x02"


def pieces(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(path, _file, block, seq, text, opens, closes, and the landed folders' columns): the
    texts between the commas of all documents, in the order of (_file, block, seq).
    ``path`` is the document's, a file or with ``parts`` a folder; ``_file`` is the file's
    name and ``block`` where the range that the piece was read in begins."""
    read = spark.read.text(path, lineSep=",")
    folders = [c for c in read.columns if c != "value"]
    file = F.col("_metadata.file_path")
    document = F.regexp_replace(file, "/[^/]*$", "") if parts else file
    place = [document.alias("path"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("block")]
    found = read.select("value", *folders, *place).withColumn("seq", F.monotonically_increasing_id())
    opens = F.col("value").rlike(OPENS)
    after = F.when(opens, F.regexp_extract("value", OPENS, 2)).otherwise(F.col("value"))
    out = found.select("path", "_file", "block", "seq", F.col("value").alias("text"), opens.alias("opens"), F.contains(after, F.lit("}")).alias("closes"), *folders)
    target = scratch_path(spark, "pieces")  # numbered once: all later steps see the same order
    out.write.parquet(target)
    return spark.read.schema(out.schema).parquet(target)


#: A range of a document's file.
RANGE = ["path", "_file", "block"]


def _at() -> Column:
    return F.struct("_file", "block", "seq")


def bounds(found: DataFrame) -> DataFrame:
    """(path, _file, block, first, last): for each range of a file, where its document's cells
    begin and end (NULL where it has none, or is cut off within them)."""
    ranges = found.groupBy(*RANGE).agg(F.max("closes").alias("closes"))
    first = found.where("opens").groupBy("path").agg(F.min(_at()).alias("first"), F.count(F.lit(1)).alias("n"))
    several = F.raise_error(F.concat(F.col("path"), F.lit(" holds the cells of more than one document")))
    first = first.where(F.when(F.col("n") > 1, several.cast("boolean")).otherwise(F.lit(True))).drop("n")
    opened = ranges.drop("closes").join(first, "path", "left")
    closing = found.where("closes").select(*RANGE, "seq").join(opened.where("first is not null"), RANGE)
    last = closing.where(_at() >= F.col("first")).groupBy("path").agg(F.min(_at()).alias("last"))
    return opened.join(last, "path", "left")


def heads(found: DataFrame, ranges: DataFrame, folders: Sequence[str]) -> DataFrame:
    """(doc, path, reason, folders): each document without its cells."""
    joined = found.join(ranges, RANGE)
    opening, closing = F.coalesce(_at() == F.col("first"), F.lit(False)), F.coalesce(_at() == F.col("last"), F.lit(False))
    outside = joined.where(F.col("first").isNull() | (_at() <= F.col("first")) | F.coalesce(_at() >= F.col("last"), F.lit(False)))
    before, tail = F.regexp_extract("text", OPENS, 1), F.regexp_extract("text", r"(?s)(\}.*)$", 1)
    rest = F.regexp_extract(F.regexp_extract("text", OPENS, 2), r"(?s)(\}.*)$", 1)
    part = (
        F.when(opening & closing, F.concat(before, rest))
        .when(opening, F.concat(before, F.lit(GONE)))
        .when(closing, F.concat(F.lit(DONE), tail))
        .otherwise(F.col("text"))
    )
    held = outside.groupBy("path", *folders).agg(F.array_sort(F.collect_list(F.struct("_file", "block", "seq", part.alias("piece")))).alias("pieces"))

    def joint(p: Column, i: Column) -> Column:
        """The comma before a piece; files are cut after one that their last piece follows."""
        before = F.get("pieces", i - 1)
        cut = before.isNull() | (before["_file"] != p["_file"]) | F.startswith(p["piece"], F.lit(DONE))
        return F.concat(F.when(cut, F.lit("")).otherwise(F.lit(",")), p["piece"])

    text = F.replace(F.array_join(F.transform("pieces", joint), ""), F.lit(f"{GONE}{DONE}"), F.lit(""))
    return documents.documents(held.select("path", *folders, text.alias("value")), "whole")


def split_decode(spark: SparkSession, path: str, dims: Sequence[str] | None = None, value_col: str = "value", parts: bool = False) -> DataFrame:
    """The rows that ``cube.decode`` gives of the documents under ``path``, with a column
    for each landed folder, each range of a file decoded in its own task.  Without ``dims``
    all dimensions that the documents list are decoded.  A broken document fails the
    read with its path, as does a cell that is not a number."""
    found = pieces(spark, path, parts)
    folders = found.columns[7:]
    target = scratch_path(spark, "ranges")
    bounds(found).write.parquet(target)
    ranges = spark.read.parquet(target)
    headed = heads(found, ranges, folders)
    target = scratch_path(spark, "heads")
    headed.write.parquet(target)
    headed = documents.whole_only(spark.read.schema(headed.schema).parquet(target))
    if dims is None:
        dims = cube.document_dims(headed)
    looked_up = cube.lookups(headed, dims, ["path"])
    within = found.select(*RANGE, "seq", "text", *folders).join(ranges, RANGE)
    # Up to the last closing brace of a whole document; a document cut off in its cells has none and fails as a head.
    within = within.where((_at() >= F.col("first")) & (_at() <= F.col("last")))
    own = F.when(_at() == F.col("first"), F.regexp_extract("text", OPENS, 2)).otherwise(F.col("text"))
    own = F.substring_index(own, "}", 1)
    cells = within.select(*RANGE, *folders, own.alias("own")).where(F.col("own").rlike(r"\S"))
    index, value = F.regexp_extract("own", CELL, 1), F.regexp_extract("own", CELL, 2)
    wrong = F.raise_error(F.concat(F.lit("broken document in "), F.col("path"), F.lit(": a cell that is not a number: "), F.left("own", F.lit(80))))
    number = F.when(index == "", wrong.cast("bigint")).otherwise(index.cast("bigint"))
    cells = cells.select(*RANGE, *folders, number.alias("_key"), F.when(value != "null", value.cast("double")).alias(value_col))
    spread, target = ranges.select(*RANGE).join(looked_up, "path"), scratch_path(spark, "spread")  # a head for each range
    spread.write.parquet(target)  # of a known size: if small, cells stay in their tasks
    return cube.positioned(cells.join(spark.read.schema(spread.schema).parquet(target), RANGE), dims, folders, value_col)
