from __future__ import annotations

import random

import numpy as np
from llm_cases import awkward, by_name, empty, near_groups, oracle, spark_by_name, twins

from pricecube.llm import near_dedup
from pricecube.llm.components import components
from pricecube.llm.near_dedup import near_duplicates
from pricecube.llm.queries import QUERIES


def check(docs, out):
    want = near_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    texts = sorted(str((i, *v)) for (i, t), v in want.items())
    assert sorted({str(tuple(r)) for r in out.collect()}) == sorted(set(texts))


def test_query_equals_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.01"
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), QUERIES["op8_near_dedup"](spark, sf_dir))


def test_edited_copies_chains_and_awkward_rows(spark):
    draw = random.Random(11)
    base = [draw.choice("abcdefghij") + str(draw.randrange(300)) for _ in range(140)]
    rows = []
    for i in range(150):  # every share of edits around the threshold
        words = list(base)
        for j in draw.sample(range(140), draw.randrange(9)):
            words[j] = f"new{draw.randrange(10**9)}"
        rows.append((1000 + i, " ".join(words), "en", "s"))
    chain = [f"c{i}" for i in range(100)]  # neighbours are linked, the ends are not
    for i in range(40):
        rows.append((2000 - i, " ".join(chain[i : i + 60]), "en", "s"))
    docs = awkward(spark, rows)
    check(docs, near_duplicates(docs))


def test_repeated_rows_are_all_returned(spark):
    docs = awkward(spark)
    assert near_duplicates(docs).count() == docs.count()
    assert near_duplicates(empty(spark)).collect() == []


def test_odd_sketches_estimate_the_difference():
    draw = np.random.default_rng(1)
    k, n = near_dedup.BANDS * near_dedup.ROWS, 300
    a = draw.integers(0, 1 << 63, (n, k), dtype=np.uint64)
    b = a.copy()
    changed = draw.random((n, k)) < 0.25
    b[changed] = draw.integers(0, 1 << 63, int(changed.sum()), dtype=np.uint64)
    flips = np.bitwise_count(near_dedup.odd_sketches(a) ^ near_dedup.odd_sketches(b)).sum(1)
    estimate = 1 + near_dedup.BITS / (4 * k) * np.log(1 - 2 * flips / near_dedup.BITS)
    assert abs(estimate.mean() - 0.75) < 0.02 and flips.max() <= near_dedup.most_flips()


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(140)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 50)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


def test_words_of_one_polynomial_hash_are_different_words(spark):
    a, b = twins()
    docs = [(1, f"{a} and some more words to fill it"), (2, f"{b} and some more words to fill it"), (3, a), (4, b), (5, a)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    want = near_groups(docs)
    assert got == {i: want[i, t][1] for i, t in docs} and got[4] == 4


def test_query_equals_sql(spark, sf_dir):
    assert spark_by_name(QUERIES["op8_near_dedup"](spark, sf_dir)) == by_name(oracle(near_dedup.OP8_SQL, sf_dir))


def test_sql_on_chains_short_and_blank_texts(spark, sf_dir):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, 10, 3)]  # each near the next only
    texts += ["a b", "A  b\t", "a b c d e", "a b c d e a b c d e", "", " \n", None, "\u00c4 b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = by_name(oracle(near_dedup.OP8_SQL, sf_dir, documents=docs.toArrow()))
    assert spark_by_name(near_duplicates(docs)) == want
