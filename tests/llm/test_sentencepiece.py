from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from llm_cases import awkward, empty

from pricecube.llm import sentencepiece_bpe as bpe
from pricecube.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=bpe.default_model())


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(bpe.Vocabulary.load(bpe.default_model()))


def test_equals_the_library_on_random_texts(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 100)  # so that generations turn over
    monkeypatch.setattr(bpe, "PAIRS", 1000)
    draw, pieces = random.Random(3), list(own.v.pieces)
    for i in range(4000):
        if i % 3 == 0:
            text = "".join(draw.choice(pieces) for _ in range(draw.randrange(9)))
            text = text.replace(bpe.SPACE, " ") if draw.random() < 0.5 else text
        elif i % 3 == 1:
            text = "".join(draw.choice(" ab\n\t▁\x00é😀<s>́aaa  thein") for _ in range(draw.randrange(30)))
        else:
            text = "".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(160, 0xD7FF), draw.randrange(0x10000, 0x1FFFF)])) for _ in range(9))
        ids = library.encode(text)
        assert own.encode(text) == ids, text
        assert own.decode(ids) == own.by_runs(text)[2] == library.decode(ids), text


def test_decodes_ids_that_no_text_gives(library, own):
    draw = random.Random(5)
    for _ in range(500):
        ids = [draw.randrange(3, 32000) if draw.random() < 0.5 else draw.randrange(3, 259) for _ in range(12)]
        assert own.decode(ids) == library.decode(ids)


def expected(library, text):
    ids = library.encode(text or "")
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
    return (len(ids), *digest)


def test_query_equals_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:4]) for r in QUERIES["op1_sentencepiece"](spark, sf_dir).collect()}
    assert got == {i: expected(library, t) for i, t in texts.items()}


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    got = bpe.tokenize(docs, bpe.default_model(), with_ids=True, with_decoded=True).collect()
    want = sorted(str((r.doc_id, *expected(library, r.text))) for r in docs.collect())
    assert sorted(str(tuple(r[:4])) for r in got) == want
    assert all(len(r.ids) == r.n_tokens and r.decoded == library.decode(r.ids) for r in got)
    assert bpe.tokenize(empty(spark), bpe.default_model()).collect() == []
