from __future__ import annotations

from llm_cases import awkward, by_name, empty, oracle, spark_by_name

from pricecube.llm.exact_dedup import OP2_SQL, exact_dedup
from pricecube.llm.queries import QUERIES


def test_query_equals_sql(spark, sf_dir):
    assert spark_by_name(QUERIES["op2_exact_dedup"](spark, sf_dir)) == by_name(oracle(OP2_SQL, sf_dir))


def test_awkward_rows_and_a_hot_text(spark, sf_dir):
    docs = awkward(spark, [(100 + i, "a hot TEXT" if i % 2 else f"text {i % 7}", "en", "s") for i in range(400)])
    want = by_name(oracle(OP2_SQL, sf_dir, documents=docs.toArrow()))
    assert spark_by_name(exact_dedup(docs)) == want
    # A single counter and winner: all but the hot text takes the shuffle.
    assert spark_by_name(exact_dedup(docs, winners=1, counters=8)) == want
    assert exact_dedup(empty(spark)).collect() == []


def test_runs_no_python(spark, sf_dir):
    plan = QUERIES["op2_exact_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
