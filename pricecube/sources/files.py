"""CSV landing: write with a header, read back with a fixed schema.

An empty field reads as NULL (``nullValue=''``), the same as the original
loader; the schema is given, so there is no inference pass over the data.
Texts come back as they were: spaces at their ends, quotes, backslashes and line
breaks included.  A file that may hold line breaks within a field cannot be
split, so its size should suit one task: ``write_csv`` begins a new file after
``ROWS_PER_FILE`` rows, however large the partitions are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: The same on both sides: a quote within a field is doubled, no other escapes.
FAITHFUL = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}

#: Rows of a written file at most: some 25 to 60 MB of the raw table's columns.
ROWS_PER_FILE = 200_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**FAITHFUL).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.options(**FAITHFUL).option("nullValue", "").option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    else:  # fallback only: costs an extra pass over the files
        reader = reader.option("inferSchema", True)
    return reader.csv(path)
