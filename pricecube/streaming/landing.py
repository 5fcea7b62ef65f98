"""Incremental loading of landed cube documents with Structured Streaming.

The batch pipeline decodes documents, keeps a year range, looks up country
names and loads the rows with one batch timestamp.  Here the same steps run as two
file streams with exactly-once sinks:

1. *Documents.*  Every file landed under ``landing_path`` (``dataset=<code>/``
   folders) is parsed once.  Whole and broken documents go to one table in the same
   pass, partitioned by run and by kind; the broken ones are the quarantine.
2. *Rows.*  Whole documents not decoded yet are decoded and appended to the target;
   each micro-batch gets a single ``loaded_at`` (``current_timestamp`` is fixed per
   batch).

Between the two, the dimensions that the run's own documents list are noted in a
small table beside the checkpoints, so a run never looks at what earlier runs
landed.  A run that fails has noted nothing, and the next one goes on under its
number.  Progress lives on the shared file system, so a restarted job (or a lost
executor) resumes without duplicates.

Everything is stateless per row (explode + expressions), so no state store
is needed; ``trigger(availableNow=True)`` processes what has landed and stops,
which is how a scheduled refresh runs it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from pricecube.constants import COUNTRIES, DATASETS, END_YEAR, START_YEAR
from pricecube.operators.publish import with_load_timestamp
from pricecube.schemas import CUBE
from pricecube.session import checkpoint_root
from pricecube.sources import cube, datasets, documents
from pricecube.sources.catalog import path_exists

LANDED = StructType(CUBE.fields + [StructField("dataset", StringType())])
TEXTS = StructType([StructField("value", StringType()), StructField("dataset", StringType())])
STORED = StructType([*documents.DOCUMENT.fields, StructField("dataset", StringType()), StructField("run", IntegerType()), StructField("broken", BooleanType())])
RUNS = "run int, dims array<string>"


def decoded_stream(
    spark: SparkSession,
    landing_path: str,
    dims: Sequence[str] | None = None,
    start: int = START_YEAR,
    end: int = END_YEAR,
    names: Mapping[str, str] = COUNTRIES,
    labels: Mapping[str, str] = DATASETS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The rows of landed documents as a stream.  Without ``dims`` the known
    dimensions are decoded; a document that lists another one fails the stream, and
    so does a broken document."""
    reader = spark.readStream.schema(TEXTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    found = documents.documents(documents.landed_texts(reader, landing_path))
    docs = documents.whole_only(found).select("doc", "dataset")
    return observations(cube.decode(docs, dims, carry=["dataset"], value_col="value_eur_per_kwh"), start, end, names, labels)


def observations(rows: DataFrame, start: int, end: int, names: Mapping[str, str], labels: Mapping[str, str]) -> DataFrame:
    """Decoded cells as raw rows: consumer type, years, country names, column order."""
    rows = rows.withColumn("consumer_type", cube.dataset_label(F.col("dataset"), labels)).drop("dataset")
    rows = datasets.filter_year_range(rows, start, end)
    return datasets.reorder(datasets.lookup_country(rows, names))


def appended(stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()) -> None:
    """Appends all that a stream has now to ``path``."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer.partitionBy(*partitions).trigger(availableNow=True).start(path).awaitTermination()


def quarantine(spark: SparkSession, documents_path: str) -> DataFrame:
    """All broken documents that have landed: (path, number, reason, text, dataset, run)."""
    if not path_exists(spark, documents_path):
        return spark.createDataFrame([], STORED).drop("doc", "broken")
    stored = spark.read.schema(STORED).parquet(documents_path)
    return stored.where("broken").drop("doc", "broken")


def load_landed(
    spark: SparkSession,
    landing_path: str,
    target_path: str,
    checkpoint_path: str | None = None,
    dims: Sequence[str] | None = None,
    start: int = START_YEAR,
    end: int = END_YEAR,
    names: Mapping[str, str] = COUNTRIES,
    labels: Mapping[str, str] = DATASETS,
    max_files_per_trigger: int | None = None,
    documents_path: str | None = None,
    on_broken: str = "quarantine",
) -> DataFrame:
    """Run the incremental load until everything landed so far is loaded;
    return the target table.  Rows of runs before a dimension was first listed
    have NULL there.

    Documents go to ``documents_path`` (by default beside the target), of which
    ``quarantine`` shows the broken ones.  ``on_broken="fail"`` raises
    ``BrokenDocumentsError`` before any row of the run is loaded; its documents are
    loaded by a later call that accepts the quarantine.  Without ``dims`` the known
    dimensions and all that documents list are decoded.
    """
    if on_broken not in ("quarantine", "fail"):
        raise ValueError(f"on_broken must be 'quarantine' or 'fail', got {on_broken!r}")
    if checkpoint_path is None:  # stable per target, so a rerun resumes
        tag = hashlib.sha1(target_path.encode()).hexdigest()[:16]
        checkpoint_path = f"{checkpoint_root(spark).rstrip('/')}/pricecube-streams/{tag}"
    root, store = checkpoint_path.rstrip("/"), documents_path or target_path.rstrip("/") + "_documents"
    noted = spark.read.schema(RUNS).parquet(f"{root}/runs/*").collect() if path_exists(spark, f"{root}/runs") else []
    run = max((r.run for r in noted), default=0) + 1

    reader = spark.readStream.schema(TEXTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    found = documents.documents(documents.landed_texts(reader, landing_path))
    found = found.withColumns({"run": F.lit(run), "broken": F.col("reason").isNotNull()})
    appended(found, store, f"{root}/documents", ["run", "broken"])

    if path_exists(spark, store):
        new = spark.read.schema(STORED).parquet(store).where(F.col("run") == run)
        if on_broken == "fail":
            documents.fail_on(new.where("broken"))
        listed = cube.document_dims(new.where("not broken"))
        spark.createDataFrame([(run, listed)], RUNS).write.mode("overwrite").parquet(f"{root}/runs/run-{run}")
        if dims is None:
            others = {d for r in noted for d in r.dims}.union(listed).difference(cube.CUBE_DIMS)
            dims = [*cube.CUBE_DIMS, *sorted(others)]
        docs = spark.readStream.schema(STORED).parquet(store).where("not broken").select("doc", "dataset")
        rows = cube.decode(docs, dims, carry=["dataset"], value_col="value_eur_per_kwh")
        appended(with_load_timestamp(observations(rows, start, end, names, labels)), target_path, f"{root}/rows")
    return spark.read.option("mergeSchema", True).parquet(target_path)
