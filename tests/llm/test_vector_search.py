from __future__ import annotations

import math
import random

import numpy as np
import pytest
from llm_cases import by_name, oracle, spark_by_name
from pyspark.sql import functions as F

from pricecube.llm import vectors as V
from pricecube.llm.hard_negatives import OP11_SQL, hard_negatives
from pricecube.llm.queries import QUERIES
from pricecube.llm.topk_search import OP12_SQL, exact_top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, score bigint, query bigint, `a.b` string"


def table(spark, given):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in given], SCHEMA)


def awkward():
    draw = random.Random(4)
    out = [(i, [draw.choice([-1.0, -0.3, 0.2, 0.7]) for _ in range(6)], draw.randrange(3)) for i in range(160)]
    out += [(1000 + i, [0.7] * 6, 1) for i in range(150)]  # a hot vector of a hot label
    out += [(20, [0.2] * 6, 2), (20, [0.2] * 6, 2), (40, [0.1, 0.9], 0), (60, [], 0), (None, [0.7] * 6, 0), (None, [0.7] * 6, 1)]
    out += [(2000, None, 1), (2020, [0.5, None, 0.5], 1), (2040, [float("nan")] * 6, 1), (2060, [float("inf")] + [0.0] * 5, 1), (2080, [0.5] * 6, None), (2100, [0.0] * 6, 2)]
    return out


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def score(a, b, scale):
    return sum(math.floor(scale * float(np.float32(x))) * math.floor(scale * float(np.float32(y))) for x, y in zip(a, b, strict=False))


def ranked(rows):
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))


def plain_top(given, k, scale, every):
    good = [r for r in given if usable(r[1])]
    out = []
    for i, v, _ in good:
        if i is not None and i % every == 0:
            best = ranked((score(v, w, scale), j) for j, w, _ in good if j != i)[:k]
            out += [(i, n, j, s) for n, (s, j) in enumerate(best, 1)]
    return sorted(map(str, out))


def plain_negatives(given, k, positives, share, scale, every):
    good = [r for r in given if usable(r[1]) and r[2] is not None]
    out = []
    for i, v, label in good:
        if i is None or i % every:
            continue
        scored = [(score(v, w, scale), j, y) for j, w, y in good]
        own = ranked((s, j) for s, j, y in scored if y == label and j != i)[:positives]
        for p, j in own:
            window = ranked((s, n) for s, n, y in scored if y != label and share * p <= 100 * s <= 100 * p)[:k]
            out += [(i, j, rank, n, p, s) for rank, (s, n) in enumerate(window, 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("name, sql", [("op11_hard_negatives", OP11_SQL), ("op12_topk_search", OP12_SQL)])
def test_queries_equal_sql(spark, sf_dir, name, sql):
    assert spark_by_name(QUERIES[name](spark, sf_dir)) == by_name(oracle(sql, sf_dir))


def test_top_k_of_awkward_rows(spark, monkeypatch):
    given = awkward()
    rows = table(spark, given).repartition(3)
    monkeypatch.setattr(V, "PIECE", 64)
    for k, lists, block in ((1, 1, 4096), (7, 3, 5), (500, 2, 4096)):
        got = exact_top_k(rows, F.col("vec_id") % 20 == 0, k=k, scale=10, lists=lists, block=block)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(str(tuple(r)) for r in got.collect()) == plain_top(given, k, 10, 20)
    assert exact_top_k(table(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert exact_top_k(table(spark, [(20, [1.0], 1)]), F.col("vec_id") % 20 == 0).collect() == []


def test_negatives_of_awkward_rows(spark):
    given = awkward()
    rows = table(spark, given).repartition(3)
    for k, positives, share, block in ((5, 5, 80, 4096), (2, 40, 10, 7), (3, 1, 100, 4096), (50, 4, 0, 4096)):
        got = hard_negatives(rows, F.col("vec_id") % 20 == 0, k, positives, share, 10, block=block)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(str(tuple(r)) for r in got.collect()) == plain_negatives(given, k, positives, share, 10, 20)
    assert hard_negatives(table(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_sums_stay_exact(spark):
    """Scores beyond float32 and float64, and what does not fit 64 bits."""
    draw = random.Random(8)
    for size in (2.0**10, 2.0**24, 2.0**27):
        given = [(i, [float(np.float32(draw.uniform(-size, size))) for _ in range(9)], i % 2) for i in range(60)]
        rows = table(spark, given)
        assert sorted(str(tuple(r)) for r in exact_top_k(rows, F.col("vec_id") % 20 == 0, k=4, scale=3).collect()) == plain_top(given, 4, 3, 20)
        got = hard_negatives(rows, F.col("vec_id") % 20 == 0, 3, 4, 10, 3)
        assert sorted(str(tuple(r)) for r in got.collect()) == plain_negatives(given, 3, 4, 10, 3, 20)
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(table(spark, [(0, [1e18, 1e18], 1), (1, [1e18, 1e18], 1)]), F.col("vec_id") % 20 == 0).collect()
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(table(spark, [(0, [1e30], 1), (1, [1e30], 1)]), F.col("vec_id") % 20 == 0).collect()


def test_the_cutoff_spares_most_rows(spark, sf_dir):
    """Few rows reach the uniform threshold, and about k a query leave the tasks."""
    import pyarrow as pa

    from pricecube.llm.topk_search import _gathered, _resolved, cutoffs

    rows = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/embeddings.parquet").select("vec_id", "embedding")
    batch = rows.toArrow().combine_chunks().to_batches()[0]
    held = V.decoded(batch.column(0), batch.column(1), None, 64).part(0, 100)

    class Held:
        value = held

    first = pa.Table.from_batches(list(_gathered(Held, 20, 64, 2)(iter([batch]))))
    least = cutoffs(spark.createDataFrame(first), 20, 100)

    class Cut:
        value = least

    sent = sum(b.num_rows for b in _resolved(Held, Cut, 20, 64, 2)(iter([batch])))
    assert sent == 20 * 100
    (_, local), *_ = V.pieces(held, iter([batch]), 64, 2)
    reached = (np.maximum(*local) * 2 >= least[:, None]).mean()
    assert reached < 0.25
