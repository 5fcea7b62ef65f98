from __future__ import annotations

from llm_cases import awkward, by_name, empty, oracle, shingles, spark_by_name

from pricecube.llm.decontamination import OP3_SQL, contaminated
from pricecube.llm.queries import QUERIES

ITEMS = "item_id bigint, text string, key string, item bigint"


def test_query_equals_sql(spark, sf_dir):
    got = QUERIES["op3_decontamination"](spark, sf_dir)
    assert spark_by_name(got) == by_name(oracle(OP3_SQL, sf_dir))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_share_around_the_threshold(spark):
    """Documents that hold the first k words of an item, for each k."""
    items = [(j, " ".join(f"w{j}x{i}" for i in range(n)), "k", 0) for j, n in enumerate((5, 6, 9, 20, 33, 64, 65, 130))]
    items += [(90, None, "k", 0), (91, " ", "k", 0), (92, "too short", "k", 0), (93, "w0x0 " * 40, "k", 0), (94, items[3][1], "k", 0), (None, items[4][1], "k", 0)]
    docs = [(1000 * j + k, "Some words BEFORE " + " ".join(t.upper().split()[:k]) + " and after", "en", "s") for j, t, *_ in items[:8] for k in range(1, len(t.split()) + 1)]
    docs += [(50_000, "Too  SHORT", "en", "s"), (50_001, "not too short", "en", "s"), (50_000, "Too  SHORT", "en", "s")]
    table = awkward(spark, docs)
    got = {(r.doc_id, r.item_id): (r.n_item_shingles, r.n_shared) for r in contaminated(table, spark.createDataFrame(items, ITEMS)).collect()}
    want = {}
    for r in table.collect():
        for i, t, *_ in items:
            a, b = shingles(t), shingles(r.text)
            if a and 4 * len(a & b) >= 3 * len(a):
                want[r.doc_id, i] = (len(a), len(a & b))
    assert got == want and len(got) > 50


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two three four five six", "k", 0)], ITEMS)
    assert contaminated(empty(spark), items).collect() == []
    assert contaminated(awkward(spark), items.limit(0)).collect() == []
