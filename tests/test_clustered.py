"""The clustered layout keeps all rows, and filters on any column skip files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pricecube.sources import clustered


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def raw(spark):
    draw = random.Random(1)
    geos = ["N00"] * 20 + [f"N{i:02d}" for i in range(25)]  # one country holds almost half
    rows = [(draw.choice(geos), f"{draw.randrange(1990, 2010)}-S{draw.randrange(1, 3)}", draw.choice(["a", "b", "c", None]), i) for i in range(20_000)]
    return spark.createDataFrame(rows, "geo string, time string, nrg_cons string, v int").repartition(4)


@pytest.fixture(scope="module")
def root(spark, raw):
    import tempfile

    path = tempfile.mkdtemp(prefix="pricecube-test-")
    clustered.write(raw, path, files=32)
    return path


WANTED = [
    {"geo": ["N03"]}, {"geo": ["N00", "N24"]}, {"time": ("1995-S1", "1996-S2")}, {"nrg_cons": ["b"]}, {"time": (None, "1990-S2")}, {"time": ("2009-S2", None)},
    {"geo": ["N07"], "time": ("2000-S1", "2001-S1")}, {"geo": ["N00"], "nrg_cons": ["a"], "time": ("1999-S1", "1999-S2")}, {"geo": ["nowhere"]}, {"geo": []}, {},
]


def plain(raw, wanted):
    for c, w in wanted.items():
        cond = F.col(c).isin(list(w)) if isinstance(w, list) else (F.coalesce(F.col(c) >= w[0], F.lit(True)) & F.coalesce(F.col(c) <= w[1], F.lit(True)))
        raw = raw.where(cond)
    return raw


@pytest.mark.parametrize("wanted", WANTED, ids=str)
def test_reads_all_wanted_rows(spark, raw, root, wanted):
    assert bag(clustered.read(spark, root, wanted)) == bag(plain(raw, wanted))


def test_files_read(spark, root):
    """Each single column leaves out files, which no sort by one column does for the others."""
    every = len(spark.read.parquet(f"{root}/rows").inputFiles())
    assert every >= 24
    read = {c: len(clustered.read(spark, root, {c: w}).inputFiles()) for c, w in (("geo", ["N03"]), ("time", ("1995-S1", "1995-S2")), ("nrg_cons", ["b"]))}
    assert read["geo"] <= every / 3 and read["time"] <= every * 0.6 and read["nrg_cons"] <= every * 0.7, read
    both = clustered.read(spark, root, {"geo": ["N03"], "time": ("1995-S1", "1995-S2")})
    assert len(both.inputFiles()) <= every / 4
    assert "EqualTo(geo,N03)" in both._jdf.queryExecution().executedPlan().toString()
    assert clustered.files_for(spark, root, {"geo": ["nowhere"]}) == []


def test_a_hot_value_is_split_over_files(spark, root):
    sizes = [r.n for r in spark.read.parquet(f"{root}/rows").groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 3 * 20_000 / 32


def test_keys_in_spark(spark):
    rows = [(a, b) for a in range(4) for b in range(4)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").select("a", "b", clustered.interleaved([F.col("a"), F.col("b")], 2).alias("k"))
    assert {(r.a, r.b): r.k for r in df.collect()} == {(a, b): (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | b & 1 for a, b in rows}
    with pytest.raises(ValueError):
        clustered.keyed(df, ["a", "b", "k"], bits=30)
