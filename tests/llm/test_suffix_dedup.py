from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward, by_name, empty, oracle, spark_by_name, twins

from pricecube.llm import suffix_dedup
from pricecube.llm.common import prefix_hashes
from pricecube.llm.queries import QUERIES
from pricecube.llm.suffix_dedup import Suffixes, remove_repeats


def plain(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(hash(b[p : p + length]) for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[hash(b[p : p + length])] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, out):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(str((r.doc_id, *w)) for r, w in zip(rows, plain([r.text for r in rows]), strict=True))
    assert sorted(str(tuple(r)[:5]) for r in out.collect()) == want


def test_query_equals_counting_all_windows(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), QUERIES["op4_suffix_dedup"](spark, sf_dir))


@pytest.fixture(scope="module")
def passages(spark):
    """Passages of 190 to 260 bytes in texts of their own, repeats within a text,
    runs of one character, and a passage in very many texts."""
    draw = random.Random(4)

    def noise(n):
        return "".join(draw.choice("abcdefgh ü") for _ in range(n))

    known = [noise(n) for n in (150, 160, 170, 180, 190, 240)]
    rows = [(1000 + i, noise(draw.randrange(80)) + draw.choice(known) + noise(draw.randrange(300)) + draw.choice(known) + noise(draw.randrange(60)), "en", "s") for i in range(120)]
    rows += [(2000, "x" * 450, "en", "s"), (2001, "x" * 199, "en", "s"), (2002, "ab" * 150, "en", "s"), (2003, noise(200) * 3, "en", "s"), (2004, noise(199), "en", "s")]
    return awkward(spark, rows)


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 3])
def test_passages_and_awkward_rows(passages, group):
    check(passages, remove_repeats(passages, group=group))


def test_kept_bytes_and_pieces_of_long_texts(passages, monkeypatch):
    out = remove_repeats(passages, with_kept=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in out)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1000)
    data = np.frombuffer(random.Random(1).randbytes(7777), np.uint8)
    windows = []
    for part, at, base in suffix_dedup._pieces(data, np.array([0, len(data)]), 200):
        _, _, _, _, a, b = suffix_dedup.anchors(part, at, 200)
        windows += [base + p for x, y in zip(a, b, strict=True) for p in range(x, y + 1)]
    assert windows == list(range(len(data) - 199))


def test_empty_table(spark):
    assert remove_repeats(empty(spark)).collect() == []


@pytest.mark.parametrize("collide", [False, True])
def test_suffix_sort(collide, monkeypatch):
    if collide:  # as if two hashes had collided
        monkeypatch.setattr(Suffixes, "verified", lambda *a: False)
    draw = random.Random(9)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randrange(12))) for _ in range(400)]
    group = np.sort(np.array([draw.randrange(40) for _ in texts]))
    size = np.array([len(t) for t in texts])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    order, shared = Suffixes(data, np.cumsum(size) - size, size).sorted(group)
    for g in set(group.tolist()):
        at = np.flatnonzero(group == g)
        got = [texts[i] for i in order[at]]
        assert sorted(order[at]) == list(at) and got == sorted(got)
        assert shared[at[0]] == -1
        for x, y, n in zip(got, got[1:], shared[at[1:]], strict=False):
            assert x[:n] == y[:n] and (n in (len(x), len(y)) or x[n] != y[n])


def test_verification_sees_a_collision():
    data = np.frombuffer(b"abcdabce", np.uint8)
    s = Suffixes(data, np.array([0, 4]), np.array([4, 4]))
    order, shared = s.sorted(np.zeros(2, int))
    assert list(order) == [0, 1] and list(shared) == [-1, 3]
    assert not s.verified(order, np.array([-1, 4]), np.array([1]))


def test_a_large_group_takes_little_memory():
    """20,000 contexts of an anchor (7 MB), as at the edge of a passage in very many texts."""
    draw, n = np.random.default_rng(3), 20_000
    passage = draw.integers(97, 123, 240, np.uint8).tobytes()
    contexts = [draw.integers(97, 123, 120, np.uint8).tobytes() + passage for _ in range(n)]
    one, hi = np.ones(n, np.int64), np.full(n, 160)
    tracemalloc.start()
    try:
        found = suffix_dedup.repeated_windows(np.zeros(n, np.int64), one, one * 0, hi, contexts, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == n and (found[:, 1] == 0).all() and (found[:, 2] >= 40).all()  # the rest agrees by chance
    assert peak < 20 * n * 360


def test_texts_of_one_polynomial_hash_are_different_texts(spark):
    a, b = twins()
    assert prefix_hashes(np.frombuffer(a.encode(), np.uint8))[-1] == prefix_hashes(np.frombuffer(b.encode(), np.uint8))[-1]
    docs = spark.createDataFrame([(3, a), (4, b), (5, "x" * 50 + a[:400])], "doc_id bigint, text string")
    check(docs, remove_repeats(docs))
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()} == {3: 400, 4: 0, 5: 400}


def test_query_equals_sql(spark, sf_dir):
    assert spark_by_name(QUERIES["op4_suffix_dedup"](spark, sf_dir)) == by_name(oracle(suffix_dedup.OP4_SQL, sf_dir))


def test_sql_on_spans_that_touch_overlap_and_are_of_many_bytes(spark, sf_dir):
    draw = random.Random(4)
    a, b, c = ("".join(draw.choice("ab\u00e9\u6f22 ") for _ in range(260)) for _ in range(3))
    texts = [a, b, a + b, "x" + a + "y" + b, "z" * 199, "z" * 200, "q" * 201, "q" * 500, c[:150], c, c[40:], None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = by_name(oracle(suffix_dedup.OP4_SQL, sf_dir, documents=docs.toArrow()))
    assert spark_by_name(remove_repeats(docs)) == want
