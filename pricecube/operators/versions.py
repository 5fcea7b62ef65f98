"""Publishing all tables at one instant, and loading with one winner.

Under a root folder every table has a folder for each version, and a log has one
small file for each committed version::

    root/<table>/version=<id>/part-...
    root/_versions/<number>.json

A publish writes all its tables first and then creates the next log file, by a rename
that fails when the number is taken.  That is the only step readers can see, so they
have either all tables of a version or none, and of two writers that want the same
number one wins.  (It is the rename that Spark's streaming logs rely on; on stores
without one that refuses to overwrite, let one writer at a time commit.)

Readers take the version from the log by a scalar subquery, which prunes the tables'
partitions when the query runs.  A ``Snapshot`` picks one log entry when it is made, so
all its tables keep showing the same version, whatever is committed later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pricecube.operators import quality
from pricecube.operators.publish import QualityGateError, with_load_timestamp
from pricecube.sources.catalog import path_exists

LOG = "_versions"
ENTRY = "number bigint, version string, tables map<string,string>"
VERSION = StructField("version", StringType())


class LostRaceError(RuntimeError):
    """Raised when another writer has committed the wanted number."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file with all its text at once; False if there is one already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = _path(spark, path)
    fs = target.getFileSystem(conf)
    part = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    modes = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(modes, 1)
    never[0] = modes.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(part), fs.makeQualified(target), never)
        return True
    except Py4JJavaError as e:
        fs.delete(part, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def log(spark: SparkSession, root: str) -> DataFrame:
    """(number, version, tables) of the versions committed by now; a table's entry is
    its schema."""
    folder = f"{root.rstrip('/')}/{LOG}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("mode", "FAILFAST").json(folder)


def latest(spark: SparkSession, root: str) -> int:
    """The number of the last committed version; 0 before the first."""
    return log(spark, root).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]


@dataclass(frozen=True)
class Staged:
    """Tables that are written and not yet committed."""

    root: str
    version: str
    tables: dict[str, DataFrame]


def stage(spark: SparkSession, root: str, tables: Mapping[str, DataFrame]) -> Staged:
    """Writes all tables as a version that no reader sees."""
    root, version, stored = root.rstrip("/"), uuid.uuid4().hex, {}
    for name, df in tables.items():
        if name.startswith("_") or "version" in (c.lower() for c in df.columns):
            raise ValueError(f"{name}: a table's name may not begin with _, nor a column be named version")
        target = f"{root}/{name}/version={version}"
        df.write.parquet(target)
        stored[name] = spark.read.schema(df.schema).parquet(target)
    return Staged(root, version, stored)


def commit(spark: SparkSession, staged: Staged, number: int | None = None) -> int:
    """Makes a staged version the current one under ``number``; raises
    ``LostRaceError`` if that is taken.  Without a number the next free one is taken."""
    wanted = number
    while True:
        if wanted is None:
            wanted = latest(spark, staged.root) + 1
        entry = {"number": wanted, "version": staged.version, "tables": {n: df.schema.json() for n, df in staged.tables.items()}}
        if create_new(spark, f"{staged.root}/{LOG}/{wanted:012d}.json", json.dumps(entry)):
            return wanted
        if number is not None:
            raise LostRaceError(f"version {number} of {staged.root} is committed already")
        wanted = None


def discard(spark: SparkSession, staged: Staged) -> None:
    """Deletes the files of a staged version that was not committed."""
    if log(spark, staged.root).where(F.col("version") == staged.version).isEmpty():
        _delete(spark, staged.root, staged.tables, [staged.version])


def _delete(spark: SparkSession, root: str, names: Sequence[str], versions: Sequence[str]) -> None:
    conf = spark._jsc.hadoopConfiguration()
    for name in names:
        for version in versions:
            path = _path(spark, f"{root}/{name}/version={version}")
            path.getFileSystem(conf).delete(path, True)


class Snapshot:
    """The tables of the version that is current when it is made, or of an older one."""

    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        entries = log(spark, root)
        if number is not None:
            entries = entries.where(F.col("number") == number)
        head = entries.agg(F.max("number").alias("number"), F.max_by("version", "number").alias("version"), F.max_by("tables", "number").alias("tables"))
        row = head.first()  # one small row: the number and the tables' schemas
        if row.number is None:
            raise ValueError(f"no version {'' if number is None else f'{number} '}of {root} is committed")
        self.spark, self.root, self.number = spark, root.rstrip("/"), row.number
        self.schemas = {name: StructType.fromJson(json.loads(text)) for name, text in row.tables.items()}
        self._version = spark.read.schema(ENTRY).json(f"{self.root}/{LOG}/{row.number:012d}.json").select("version")

    def table(self, name: str) -> DataFrame:
        schema = StructType([*self.schemas[name].fields, VERSION])
        stored = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return stored.where(F.col("version") == self._version.scalar()).drop("version")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.schemas}


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[quality.Rule]] | None = None, number: int | None = None) -> int:
    """Writes all tables, checks the rules on the written files and commits; returns
    the version's number.  When a rule fails or the number is lost, the error goes on,
    readers keep what they have and the written files are deleted."""
    staged = stage(spark, root, tables)
    try:
        checks = [(n, staged.tables[n], r) for n, r in (rules or {}).items() if r]
        if checks:
            bad = quality.suite(checks).where(F.col("status") == "FAIL").collect()  # a row a failing rule
            if bad:
                raise QualityGateError("quality gate failed: " + ", ".join(f"{r.table_name}.{r.column_name} {r.test}={r.failures}" for r in bad))
        return commit(spark, staged, number)
    except Exception:
        discard(spark, staged)
        raise


def load_first(spark: SparkSession, root: str, name: str, df: DataFrame, as_of: str | None = None) -> tuple[bool, DataFrame]:
    """Loads ``df`` with a batch timestamp unless something is loaded under ``root``.
    Returns (whether this call's rows are the stored ones, stored table).  Of loaders that
    run at the same time one wins, and the others return its rows."""
    won = latest(spark, root) == 0
    if won:
        try:
            publish(spark, root, {name: with_load_timestamp(df, as_of)}, number=1)
        except LostRaceError:
            won = False
    return won, Snapshot(spark, root, 1).table(name)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Deletes the files of all but the last ``keep`` versions, for when no reader has
    them any more; returns their numbers.  Their log entries go first."""
    entries = sorted(log(spark, root).collect(), key=lambda r: r.number)  # a small row a version
    conf, gone = spark._jsc.hadoopConfiguration(), entries[: max(0, len(entries) - max(1, keep))]
    for r in gone:
        path = _path(spark, f"{root.rstrip('/')}/{LOG}/{r.number:012d}.json")
        path.getFileSystem(conf).delete(path, False)
        _delete(spark, root.rstrip("/"), list(r.tables), [r.version])
    return [r.number for r in gone]
