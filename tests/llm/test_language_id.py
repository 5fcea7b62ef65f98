from __future__ import annotations

import numpy as np
from llm_cases import awkward, empty
from pyspark.sql import functions as F

from pricecube.llm.language_id import ORDER, build, gram_counts, identify, learn
from pricecube.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = [r for r in QUERIES["op6_language_id"](spark, sf_dir).collect() if r.held_out and langs[r.doc_id]]
    assert len(out) > 150 and np.mean([r.lang_pred == langs[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_code_lengths_are_those_of_the_tree():
    texts, other = [b"the cat sat on the mat", b"a cat that ate"], [b"der kater satt"]
    counted = []
    for lang, group in (("en", texts), ("de", other)):
        for t in group:
            padded = b" " * ORDER + t
            counted += [(lang, int.from_bytes(padded[i - ORDER : i + 1], "big"), 1) for i in range(ORDER, len(padded))]
    model = build(*[np.array(c, t) for c, t in zip(zip(*counted, strict=True), (object, np.int64, float), strict=True)])
    text = b"the mat ate a cat"
    got = model.code_lengths(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    want = plain_bits(set(b"".join(texts + other)), texts, text)
    assert abs(got[model.langs.index("en")] - want) < 1e-3


def plain_bits(symbols, texts, text):
    """Code length by walking the contexts of each byte, longest first, with exclusion."""
    seen: dict[bytes, dict[int, int]] = {}
    for t in texts:
        padded = b" " * ORDER + t
        for i in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                row = seen.setdefault(padded[i - k : i], {})
                row[padded[i]] = row.get(padded[i], 0) + 1

    def p(context, b):
        lower = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / (len(symbols) + 1))
        row = seen.get(context)
        if not row:
            return lower(b)
        n, d = sum(row.values()), len(row)
        return row[b] / (n + d) if b in row else d / (n + d) * lower(b) / (1 - sum(map(lower, row)))

    padded = b" " * ORDER + text
    return -sum(np.log2(p(padded[i - ORDER : i], padded[i])) for i in range(ORDER, len(padded)))


def test_awkward_rows(spark):
    docs = awkward(spark, [(300 + i, "123 456 !?" if i % 2 else "und der die das " * 9, "de", "s") for i in range(12)])
    got = sorted((r.doc_id or -1, r.lang_pred, r.score) for r in identify(docs, lambda i: F.lit(True)).collect())
    assert len(got) == docs.count()
    told = {i: (lang, score) for i, lang, score in got}
    assert told[1] == told[2] == told[3] == told[301] == ("und", 0.0)
    assert told[300][0] == "de" and told[6][0] == "en" and told[5][0] in ("en", "de")
    nothing = identify(docs, lambda i: F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert identify(empty(spark), lambda i: F.lit(True)).collect() == []


def learnt(spark, texts, **kwargs):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id int, text string, lang string")
    return learn(gram_counts(docs, "text", "lang"), **kwargs)


def test_all_counts_are_used(spark):
    """Grams seen once or twice count too, and more different bytes than 160."""
    wide = "".join(chr(i) for i in range(0x20, 0x800, 7)) + "".join(chr(i) for i in range(0x800, 0xD000, 997)) + "😀"
    texts = [("en", "the cat sat on the mat and the cat ate " * 50), ("en", wide), ("xx", "zu qo vil"), ("xx", "qo zu wam")]
    symbols = set("".join(t for _, t in texts).translate({c: c + 32 for c in range(65, 91)}).encode()) | {0x20}
    model = learnt(spark, texts)
    assert model.langs == ["en", "xx"]
    text = b"zu vil the \xe4\x84 cat"
    got = model.code_lengths(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    for k, lang in enumerate(model.langs):
        taught = [t.translate({c: c + 32 for c in range(65, 91)}).encode() for name, t in texts if name == lang]
        assert abs(got[k] - plain_bits(symbols, taught, text)) < 1e-3
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate([*texts, (None, "qo vil")])], "doc_id int, text string, lang string")
    told = {r.doc_id: r.lang_pred for r in identify(docs, lambda i: F.lit(True)).collect()}
    assert told[2] == told[3] == told[4] == "xx" and told[0] == "en"


def test_a_small_budget_only_backs_off(spark):
    texts = [("en", "the cat sat on the mat and the cat ate them " * 30), ("xx", "zu qo vil"), ("yy", "zim qolo vat")]
    whole = learnt(spark, texts)
    for budget in (0, 3, 30, 60):
        model = learnt(spark, texts, budget=budget)
        assert model.langs == ["en", "xx", "yy"]
        assert sum(len(t.orders[0][0]) for t in model.trees) <= budget
        for kept, tree in zip(model.trees, whole.trees, strict=True):
            for a, b in zip(kept.orders[1:], tree.orders[1:], strict=True):
                assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))
            seen = np.unique(np.concatenate([t.orders[-1][0] for t in whole.trees]))
            for context in (b"the", b"e c", b"qo ", b"zzz", b"zim"):
                after = np.array([int.from_bytes(context, "big") << 8 | int(b) for b in [*seen, 0xFF]], np.uint32)
                assert abs(np.exp2(-kept.bits(after)).sum() - 1) < 1e-4
    # The share that small languages leave is the large one's.
    assert [len(t.orders[0][0]) for t in model.trees[1:]] == [len(t.orders[0][0]) for t in whole.trees[1:]]
