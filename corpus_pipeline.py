"""The corpus pipeline: five stages over ``documents``, each by one operator of
``pricecube.llm``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns the columns of ``docs`` (the last one: token digests).  Between
stages the documents are a Parquet table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecube.llm.common import columns, drop, fresh, stored, table, written
from pricecube.llm.decontamination import contaminated
from pricecube.llm.line_dedup import line_dedup
from pricecube.llm.near_dedup import near_duplicates
from pricecube.llm.quality import fold, quality_scores
from pricecube.llm.sentencepiece_bpe import default_model, tokenize


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key made of id and text, as ids may be null or repeated: 128 bits of
    a digest that also tells null from empty."""
    key = fresh(docs, "_key")
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("doc_id", "text")]
    return docs.withColumn(key, F.unhex(F.substring(F.sha2(F.concat_ws(" ", *parts), 256), 1, 32))), key


def _without(keyed: DataFrame, gone: DataFrame, key: str, docs: DataFrame, share: bool = False) -> DataFrame:
    """The rows of ``docs`` whose key is not in ``gone``.  Where a ``share`` of the corpus
    goes, the keys outgrow any broadcast: the texts are dealt by key at every size, and
    met by hash, so they are not sorted."""
    gone = written(gone.select(key).distinct(), "gone")
    if share:
        gone = gone.hint("shuffle_hash")
    return keyed.join(gone, key, "left_anti").select(*columns(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality ranking rejects.  It learns from the
    labels outside the held-out fold.  Texts without a word are rejected if the
    features of no words are.  Rows are judged where they are read, without a
    shuffle of texts."""
    names = fresh(docs, "_score"), fresh(docs, "_predicted")
    scored = quality_scores(docs, table(spark, sf_dir, "labels"), lambda i: fold(i, 5) != 0, carry=docs.columns, names=names)
    return scored.where(F.col(names[1]) == 1).select(*columns(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines of each source; no document goes."""
    return line_dedup(docs, counts=False)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near duplicates.
    Rows of one id and one text stay or go together."""
    keyed, key = _keyed(docs)
    found = near_duplicates(keyed, carry={key: F.col(key)})
    return _without(keyed, found.where(~F.col("kept")), key, docs, share=True)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    keyed, key = _keyed(docs)
    found = contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
    return _without(keyed, found, key, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return tokenize(docs, default_model())


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicate),
    ("decontamination", benchmark),
    ("sentencepiece", tokens),
]

#: SQL can express neither the ranking nor the MinHash search nor the tokenizer;
#: tests/llm/test_pipeline.py holds run() against a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table.  Each stage's scratch tables go once its own table is
    written, and that one once the next stage's is, so two copies of the documents and
    one stage's scratch are the most that is held."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        given = docs
        docs, path = stored(lambda: stage(spark, given, sf_dir), spark, f"pipeline-{name}")  # noqa: B023 - called at once
        drop(spark, before)
        before = [path]
    return docs
