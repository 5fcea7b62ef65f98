"""``unique`` on columns of about as many values as rows: small keys shuffle, and of the
values only what may repeat."""

from __future__ import annotations

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from pricecube.operators import quality


def failures(df, column, many):
    return quality.run_rules("t", df, [quality.unique(column, many=many)]).collect()[0].failures


def shuffled(df):
    """(rows, bytes) that the exchanges of a plan wrote, once it has run."""
    df.collect()
    total, todo = [0, 0], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        elif name != "ReusedExchange":
            if name == "Exchange":
                metrics = node.metrics()
                total[0] += metrics.apply("shuffleRecordsWritten").value()
                total[1] += metrics.apply("shuffleBytesWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


LOW, HIGH = -(1 << 63), (1 << 63) - 1
CASES = {
    "bigint": [0, 1, -1, 63, 64, -64, -65, LOW, HIGH, LOW + 63, None, None],
    "int": [0, -1, 1, 63, 64, -(1 << 31), (1 << 31) - 1, None],
    "tinyint": [0, -1, 127, -128, None],
    "string": ["", " ", "a", "A", "a ", "\u00e9", "e\u0301", "x" * 100_000, None],
    "double": [0.0, 1.5, float("inf"), float("nan"), None],
    "boolean": [True, False, None],
    "date": [datetime.date(2020, 1, 1), datetime.date(1960, 1, 1), None],
    "decimal(20,4)": [decimal.Decimal("1.0000"), decimal.Decimal("-1.0000"), None],
    "binary": [bytearray(b""), bytearray(b"\0"), None],
}


@pytest.mark.parametrize("kind", CASES)
def test_same_as_the_plain_grouping(spark, kind):
    held = [v for v in CASES[kind] if v is not None]
    for rows, want in ((CASES[kind], 0), (CASES[kind] + held[:1], 1), (CASES[kind] + held * 2, len(held)), ([None, None], 0), ([], 0)):
        df = spark.createDataFrame([(v,) for v in rows], f"`a b` {kind}").withColumnRenamed("a b", "v").repartition(3)
        assert failures(df, "v", True) == failures(df, "v", False) == want, (kind, rows)


def test_zeros_of_both_signs_are_one_value(spark):
    df = spark.sql("select * from values (0.0D), (-0.0D), (1.0D) as t(v)")
    assert failures(df, "v", True) == failures(df, "v", False) == 1


def test_neighbouring_integers_shuffle_as_words(spark, tmp_dir):
    n = 400_000
    spark.range(0, n, 1, 4).selectExpr("id * 10 + id % 7 as id").write.parquet(f"{tmp_dir}/ids")
    df = spark.read.parquet(f"{tmp_dir}/ids")
    rule = quality.run_rules("t", df, [quality.unique("id", many=True)])
    plain = quality.run_rules("t", df, [quality.unique("id")])
    few, many = shuffled(rule), shuffled(plain)
    assert rule.collect()[0].failures == plain.collect()[0].failures == 0
    assert many[0] >= n and few[0] < n / 5 and few[1] < many[1] / 3


def test_of_wide_values_only_possible_repeats_shuffle(spark, tmp_dir):
    n = 60_000
    wide = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 384))
    spark.range(0, n, 1, 4).union(spark.range(5)).select(wide.alias("key")).write.parquet(f"{tmp_dir}/keys")
    df = spark.read.parquet(f"{tmp_dir}/keys")
    rule = quality.run_rules("t", df, [quality.unique("key", many=True)])
    plain = quality.run_rules("t", df, [quality.unique("key")])
    few, many = shuffled(rule), shuffled(plain)
    assert rule.collect()[0].failures == plain.collect()[0].failures == 5
    assert few[1] < many[1] / 4


def test_a_hot_value_of_a_third_of_the_rows(spark):
    df = spark.range(0, 90_000, 1, 8).selectExpr("if(id % 3 = 0, -7, id) as v", "if(id % 3 = 0, 'hot', cast(id as string)) as s")
    for column in ("v", "s"):
        assert failures(df, column, True) == failures(df, column, False) == 1
