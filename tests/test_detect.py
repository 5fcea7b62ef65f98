"""Detected types equal those of a reader that looks at all rows, without a second read."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from pricecube.sources import detect

COLUMNS = {
    "bool": ["true", "FALSE"], "tf": ["t", "f"], "yn": ["yes", "no"], "zero_one": ["0", "1"], "int": ["1", "-2"], "plus": ["+1", "2"], "lead0": ["007", "1"],
    "space": [" 1", "2 "], "big": ["9223372036854775807", "1"], "huge": ["9223372036854775808", "1"], "dec": ["1.5", "2"], "dot": [".5", "1."],
    "exp": ["1E-4", "2.5e3"], "nan": ["nan", "1.0"], "under": ["1_000", "2"], "thou": ['"1,000"', "2"], "date": ["2020-01-01", "2021-12-31"],
    "dates": ["2020/01/01", "2021/12/31"], "dmy": ["31/12/2020", "01/02/2020"], "mdy": ["12/31/2020", "01/02/2020"], "short": ["2020-1-1", "2021-12-31"],
    "baddate": ["2020-02-30", "2021-12-31"], "ts": ["2020-01-01 10:00:00", "2021-01-01 00:00:00.5"], "tsT": ["2020-01-01T10:00:00", "2021-01-01T00:00:00"],
    "tsZ": ["2020-01-01T10:00:00Z", "2021-01-01T00:00:00Z"], "tsmin": ["2020-01-01 10:00", "2021-01-01 00:00"], "date_ts": ["2020-01-01", "2021-01-01 10:00:00"],
    "half": ["2020-S1", "2020-S2"], "year": ["2020", "2021"], "empty": ["", ""], "int_empty": ["1", ""], "bool_int": ["true", "1"], "date_int": ["2020-01-01", "5"],
    "pct": ["5%", "6%"], "minus": ["-", "1"], "neg0": ["-0", "0"], "null": ["null", "1"], "quoted": ['"a ""b"""', '"x,y"'],
}


def write(path, columns, rows=2):
    os.makedirs(path)
    with open(f"{path}/t.csv", "w") as f:
        f.write(",".join(["id", *columns]) + "\n")
        for i in range(rows):
            f.write(",".join([f"a{i}", *[v[i % len(v)] for v in columns.values()]]) + "\n")


def test_types_equal_those_of_a_whole_read(spark, tmp_dir):
    write(f"{tmp_dir}/in", COLUMNS)
    sql = f"describe select * from read_csv('{tmp_dir}/in/t.csv', header=true, nullstr='', auto_detect=true, sample_size=-1)"
    want = {}
    for name in COLUMNS:  # one column at a time, so that the other reader's dialect search is not misled
        write(f"{tmp_dir}/{name}", {name: COLUMNS[name]})
        want |= {r[0]: r[1] for r in duckdb.sql(sql.replace("/in/", f"/{name}/")).fetchall()}
    got = {r.column_name: r.data_type for r in detect.detect_types(detect.read_texts(spark, f"{tmp_dir}/in")).collect()}
    assert got == want


def test_one_odd_value_among_many_decides(spark, tmp_dir):
    write(f"{tmp_dir}/in", {"n": [str(i) for i in range(29_999)] + ["x"], "d": ["1"] * 29_999 + ["1.5"]}, 30_000)
    texts = detect.read_texts(spark, f"{tmp_dir}/in").repartition(4)
    assert [r.data_type for r in detect.detect_types(texts).collect()] == ["VARCHAR", "VARCHAR", "DOUBLE"]
    plan = detect.detect_types(texts)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "partial_bit_or" in plan and "SortAggregate" not in plan


def test_load_reads_the_files_once(spark, tmp_dir):
    write(f"{tmp_dir}/in", COLUMNS)
    table = detect.load_detected(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    os.rename(f"{tmp_dir}/in/t.csv", f"{tmp_dir}/in/_t.csv")  # neither types nor rows need it now
    kinds = dict(table.dtypes)
    assert (kinds["int_empty"], kinds["huge"], kinds["exp"], kinds["dmy"], kinds["ts"], kinds["tsZ"], kinds["yn"], kinds["empty"]) == (
        "bigint", "decimal(38,0)", "double", "date", "timestamp_ntz", "timestamp", "boolean", "string")
    first = table.where("id = 'a0'").first()
    assert (first.space, str(first.dmy), first.exp, first.yn, first.empty, first.quoted) == (1, "2020-12-31", 1e-4, True, None, 'a "b"')


@pytest.mark.parametrize("rows", [0, 1])
def test_small_tables(spark, tmp_dir, rows):
    write(f"{tmp_dir}/in", {"n": ["1"], "a.b": ["2020-01-01"]}, rows)
    got = [(r.ordinal_position, r.column_name, r.data_type) for r in detect.detect_types(detect.read_texts(spark, f"{tmp_dir}/in")).collect()]
    assert got == [(1, "id", "VARCHAR"), (2, "n", "BIGINT" if rows else "VARCHAR"), (3, "a.b", "DATE" if rows else "VARCHAR")]
    assert detect.load_detected(spark, f"{tmp_dir}/in", f"{tmp_dir}/out").count() == rows


def test_one_expression_for_all_columns(spark, tmp_dir):
    """The code that tries the types does not grow with the columns, and gives what trying each type gives."""
    write(f"{tmp_dir}/in", COLUMNS | {"odd": ["1e-5", "1:2"], "sign": ["-2020-01-01", "/"], "mixed": ["nan", "2020-1-1"], "line": ['"1\n"', "é"]})
    texts = detect.read_texts(spark, f"{tmp_dir}/in")
    plans = [detect.detect_types(texts.select(*texts.columns[:n]))._jdf.queryExecution().executedPlan().toString() for n in (2, len(texts.columns))]
    assert plans[0].count("RLIKE") == plans[1].count("RLIKE") > 0
    tried = F.transform(F.array(*map(detect._value, texts.columns)), lambda v: F.when(v.isNotNull(), sum(F.when(f(v).isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, _, f) in enumerate(detect.TYPES)).cast("bigint")))
    want = texts.select(tried.alias("e")).agg(*detect.misfits(texts.columns, "e")).first()
    got = texts.select(detect._each(texts.columns).alias("e")).agg(*detect.misfits(texts.columns, "e")).first()
    assert tuple(got) == tuple(want)
