from __future__ import annotations

from llm_cases import awkward, by_name, empty, oracle, spark_by_name

from pricecube.llm.line_dedup import OP9_SQL, line_dedup
from pricecube.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_lines", "n_dropped", "text"]


def test_query_equals_sql(spark, sf_dir):
    assert spark_by_name(QUERIES["op9_line_dedup"](spark, sf_dir)) == by_name(oracle(OP9_SQL, sf_dir))


def test_awkward_rows(spark, sf_dir):
    pages = [(200 + i, f"Menu\n own line {i}\n\n  Menu \nhalf {i % 2}" if i % 3 else "Menu", "en", "x" if i % 5 else None) for i in range(90)]
    docs = awkward(spark, pages)
    assert spark_by_name(line_dedup(docs).select(*COLUMNS)) == by_name(oracle(OP9_SQL, sf_dir, documents=docs.toArrow()))
    texts = {r.doc_id: r.text for r in line_dedup(docs).collect()}
    assert texts[201] == " own line 1\n" and texts[203] == "" and texts[1] is None


def test_columns_stay_and_clashes_do_not_matter(spark):
    docs = awkward(spark).withColumnRenamed("kept", "n_lines").withColumnRenamed("key", "_drop").withColumnRenamed("n", "_site")
    assert line_dedup(docs, counts=False).columns == docs.columns
    assert line_dedup(docs).columns == [*docs.columns, "n_dropped"]
    assert line_dedup(empty(spark)).collect() == []
