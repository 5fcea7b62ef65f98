"""A large document is decoded in many tasks, with the rows of a plain decode."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from test_documents import DOC, LINE, PRETTY, WHOLE, land

from pricecube.sources import cube, split


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("split_bytes", ["64", "1000000"])
def test_equals_a_plain_decode(spark, tmp_dir, split_bytes):
    awkward = DOC | {
        "id": ["value", "time"],
        "size": [3, 2],
        "label": 'commas, {braces} and a "value": {"0": 1}',
        "status": {"0": "p", "5": "e"},
        "dimension": {"value": {"category": {"index": {"2015": 0, "a,b": 1, "{": 2}, "label": {"2015": "}, {", "a,b": '"value":{', "{": "x"}}}, "time": DOC["dimension"]["time"]},
        "value": {"0": 1, "3": -2.5e-3, "5": None},
    }
    last = {k: v for k, v in awkward.items() if k != "value"} | {"value": {str(i): i / 8 for i in range(6)}}
    land(tmp_dir, **{k: t for k, t in WHOLE.items() if k != "two_lines"}, awkward=json.dumps(awkward), tight=json.dumps(awkward, separators=(",", ":")), deep=json.dumps(awkward, indent=1), last=json.dumps(last), none=json.dumps(DOC | {"value": {}}), one=json.dumps(DOC | {"value": {"1": 3}}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        # "value" is also the name of a dimension here
        got, want = split.split_decode(spark, tmp_dir, value_col="cell"), cube.decode(cube.read_cube_json(spark, tmp_dir), value_col="cell")
        assert got.columns == want.columns and bag(got) == bag(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", [LINE[:-30], LINE[: LINE.index('"value"') + 16], PRETTY[:90], LINE + "}", json.dumps(DOC | {"value": {"0": "n/a"}}), LINE + "\n" + LINE])
def test_broken_documents_fail_with_their_path(spark, tmp_dir, text):
    land(tmp_dir, good=LINE, broken=text)
    with pytest.raises(Exception, match="broken.json"):
        split.split_decode(spark, tmp_dir).collect()


def test_a_million_cells_in_many_tasks(spark, tmp_dir):
    n = 1000
    index = {f"c{i}": i for i in range(n)}
    head = {"id": ["a", "b"], "size": [n, n], "dimension": {d: {"category": {"index": index, "label": index}} for d in "ab"}}
    os.makedirs(f"{tmp_dir}/dataset=x")
    with open(f"{tmp_dir}/dataset=x/d.json", "w") as f:
        f.write(json.dumps(head | {"value": {str(i): i for i in range(n * n)}}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = split.split_decode(spark, tmp_dir).withColumn("task", F.spark_partition_id())
        right = (F.col("a") == F.concat(F.lit("c"), (F.col("value") / n).cast("int"))) & (F.col("b") == F.concat(F.lit("c"), (F.col("value") % n).cast("int")))
        got = rows.agg(F.count(F.lit(1)), F.count_distinct("value"), F.count_if(right), F.count_distinct("task")).first()
        assert tuple(got)[:3] == (n * n, n * n, n * n) and got[3] > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split_bytes", ["64", "1000000"])
def test_a_document_in_parts(spark, tmp_dir, split_bytes):
    """Files cut after the commas between cells, as many tasks write them, are one document."""
    head = {"id": ["a"], "size": [40], "label": 'a, "b": {', "dimension": {"a": {"category": {"index": {f"c{i}": i for i in range(40)}}}}}
    for k, n in (("x", 40), ("y", 7)):
        lines = json.dumps(head | {"value": {str(i): i / 8 for i in range(n)}, "note": "x, y"}).replace('"value": {', '"value": {\n').replace(', "', ',\n"').split("\n")
        at = [i for i, line in enumerate(lines) if line.endswith('"value": {')][0]
        cuts = [0, at + 2, at + 3, at + n - 1, len(lines)]
        os.makedirs(f"{tmp_dir}/dataset={k}")
        for j, (i, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
            with open(f"{tmp_dir}/dataset={k}/part-{j:05d}.txt", "w") as f:
                f.write("".join(line + "\n" for line in lines[i:z]))
        with open(f"{tmp_dir}/dataset={k}/part-00001b.txt", "w") as f:
            f.write("\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = split.split_decode(spark, tmp_dir, parts=True).select("dataset", "a", "value").collect()
        assert sorted(map(tuple, got)) == sorted((k, f"c{i}", i / 8) for k, n in (("x", 40), ("y", 7)) for i in range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
