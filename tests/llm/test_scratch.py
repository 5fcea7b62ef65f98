"""Scratch tables go when what they were made for is done."""

from __future__ import annotations

import os

import pytest

from pricecube.llm.common import scratch, stored, written


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://").removeprefix("file:"))


def test_scratch_tables_are_deleted(spark):
    with scratch(spark):
        outer = folder(written(spark.range(3), "outer"))
        with scratch(spark):
            inner = folder(written(spark.range(3), "inner"))
        assert os.path.isdir(outer) and not os.path.exists(inner)
    assert not os.path.exists(outer)
    assert os.path.isdir(folder(written(spark.range(3), "kept")))


def test_also_when_the_work_fails(spark):
    with pytest.raises(ZeroDivisionError), scratch(spark):
        made = folder(written(spark.range(3), "outer"))
        1 / 0
    assert not os.path.exists(made)


def test_a_stored_result_outlasts_what_it_was_made_of(spark):
    made = []

    def work():
        step = written(spark.range(5), "step")
        made.append(folder(step))
        return step.where("id > 2")

    out, path = stored(work, spark, "result")
    assert [r.id for r in out.orderBy("id").collect()] == [3, 4] and not os.path.exists(made[0])
    assert folder(out) == path.removeprefix("file:")
