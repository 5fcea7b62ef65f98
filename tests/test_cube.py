"""Hypercube decoding: the unit fixture, its variants, and encode/decode identity."""

from __future__ import annotations

import json
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricecube.sources import cube


def doc_frame(spark, doc: dict):
    text = spark.createDataFrame([(json.dumps(doc),)], "t string")
    return text.select(cube.parse_cube(F.col("t")).alias("doc"))


UNIT = {
    "id": ["a", "b"],
    "size": [2, 3],
    "dimension": {
        "a": {"category": {"index": {"p": 0, "q": 1}, "label": {"p": "P", "q": "Q"}}},
        "b": {"category": {"index": {"x": 0, "y": 1, "z": 2}, "label": {"x": "X", "y": "Y", "z": "Z"}}},
    },
    "value": {"0": 1.5, "4": 2.5},
}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_unit_fixture(spark):
    docs = doc_frame(spark, UNIT)
    out = cube.decode(docs, ["a", "b"], value_col="v")
    assert rows(out) == [("p", "P", "x", "X", 1.5), ("q", "Q", "y", "Y", 2.5)]
    st_ = cube.stride_table(docs).collect()
    assert [(r.dimension, r.size, r.stride) for r in st_] == [("a", 2, 3), ("b", 3, 1)]


def test_variants(spark):
    doc = json.loads(json.dumps(UNIT))
    del doc["dimension"]["b"]["category"]["label"]["y"]  # category without label -> ''
    del doc["dimension"]["b"]["category"]["index"]["z"]  # position 2 without code -> pos2
    doc["value"] = {"4": 2.5, "5": None, "6": 7.0}  # null value kept; 6 wraps to (0, 0)
    out = rows(cube.decode(doc_frame(spark, doc), ["a", "b"], value_col="v"))
    assert ("q", "Q", "y", "", 2.5) in out
    assert ("q", "Q", "pos2", "", None) in out
    assert ("p", "P", "x", "X", 7.0) in out
    assert len(out) == 3


def test_empty_value_and_missing_dimension(spark):
    doc = dict(UNIT, value={})
    assert cube.decode(doc_frame(spark, doc), ["a", "b"]).count() == 0
    out = cube.decode(doc_frame(spark, UNIT), ["a", "b", "c"], value_col="v").select("c", "c_label").collect()
    assert all(r.c is None and r.c_label is None for r in out)


def test_dimensions_table(spark):
    d = cube.dimensions(doc_frame(spark, UNIT)).collect()
    got = sorted((r.dimension, r.position, r.code, r.label) for r in d)
    assert got == [("a", 0, "p", "P"), ("a", 1, "q", "Q"), ("b", 0, "x", "X"), ("b", 1, "y", "Y"), ("b", 2, "z", "Z")]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["g1", "g2"]), st.sampled_from(["A", "B", "C"]), st.integers(0, 5),
                  st.floats(0, 1, allow_nan=False)),
        min_size=1, max_size=25, unique_by=lambda t: t[:3],
    )
)
def test_encode_decode_identity(spark, cells):
    df = spark.createDataFrame([(g, a, f"t{t}", v) for g, a, t, v in cells], "g string, a string, t string, v double")
    docs = cube.encode(df, ["g"], ["a", "t"], "v")
    back = cube.decode(docs, ["a", "t"], carry=["g"], value_col="v").select("g", "a", "t", "v")
    assert rows(back) == rows(df)


def test_all_listed_dimensions_are_decoded(spark):
    out = cube.decode(doc_frame(spark, UNIT), value_col="v")
    assert out.columns == ["a", "a_label", "b", "b_label", "v"]
    assert rows(out) == [("p", "P", "x", "X", 1.5), ("q", "Q", "y", "Y", 2.5)]


def test_later_code_wins_on_a_shared_position(spark):
    doc = json.loads(json.dumps(UNIT))
    doc["dimension"]["a"]["category"] = {"index": {"p": 0, "z": 0, "q": 1, "far": 99, "neg": -1}, "label": {"z": "Z", "q": "Q", "other": "O"}}
    assert rows(cube.decode(doc_frame(spark, doc), value_col="v")) == [("q", "Q", "y", "Y", 2.5), ("z", "Z", "x", "X", 1.5)]


def test_four_thousand_categories_in_seconds(spark):
    n = 4000
    doc = {"id": ["a"], "size": [n], "dimension": {"a": {"category": {"index": {f"c{i}": i for i in range(n)}, "label": {f"c{i}": f"L{i}" for i in range(n)}}}}, "value": {str(i): float(i) for i in range(n)}}
    docs = doc_frame(spark, doc)
    began = time.perf_counter()
    got = cube.decode(docs, value_col="v").collect()
    assert time.perf_counter() - began < 20
    assert len(got) == n and all((r.a, r.a_label) == (f"c{int(r.v)}", f"L{int(r.v)}") for r in got)
