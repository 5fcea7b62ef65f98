from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from llm_cases import awkward, empty
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pricecube.llm import token_alignment as al
from pricecube.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    """Groups and links of whole texts by the libraries, byte for byte."""
    path_a, path_b = al.default_models()
    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    letters = al.byte_alphabet()
    piece = {i: bytes(letters[c] for c in p) for p, i in a.get_vocab(with_added_tokens=False).items()}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def run(text):
        if not text:
            return [], [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        if b"".join(map(piece.get, ids_a)) != whole or b"".join(map(of_b, ids_b)) != whole:
            return [], [], [], []
        ends = []
        for ids, told in ((ids_a, piece.get), (ids_b, of_b)):
            at, own = 0, {}
            for n, i in enumerate(ids):
                at += len(told(i))
                own[at] = n
            ends.append(own)
        both = sorted(ends[0].keys() & ends[1].keys())
        groups, i, j = [], 0, 0
        for e in both:
            groups.append((ids_a[i : ends[0][e] + 1], ids_b[j : ends[1][e] + 1]))
            i, j = ends[0][e] + 1, ends[1][e] + 1
        return ids_a, ids_b, groups, [(ids_a[ends[0][e]], ids_b[ends[1][e]]) for e in both]

    return run


def expected(plain, texts):
    found = [plain(t) for t in texts]
    links, docs = Counter(x for f in found for x in f[3]), Counter(x for f in found for x in set(f[3]))
    most = {}
    for (_, b), n in links.items():
        most[b] = max(n, most.get(b, 0))
    rows = []
    for ids_a, ids_b, groups, own in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        rows.append((len(ids_a), len(ids_b), len(groups), len(own), sum(links[x] == most[x[1]] for x in own), sum(links[x] for x in own), sha))
    return rows, {(*p, docs[p], n, n == most[p[1]]) for p, n in links.items()}


def test_query_equals_plain(spark, sf_dir, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows, _ = expected(plain, [t for _, t in docs])
    got = QUERIES["op13_token_alignment"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted((i, *r) for (i, _), r in zip(docs, rows, strict=True))


def odd_texts():
    draw = random.Random(11)
    signs = " ab\n\t▁\x00é😀<s>́aaa  thein漢字　 \x85 'll 12 <|endoftext|> ½²𝟘"
    out = ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(1500)]
    out += [" ", "  ", "a ", " a", "a  b", "a \n b", "a\n  b", "x▁ y", "▁", "<|endoftext|>", "a<|endoftext|> b", "<0x41> <s>", "é " * 300]
    return out + ["the cat " * 70_000, "long" * 20_000]


def test_odd_texts_in_small_chunks(spark, plain, monkeypatch):
    texts = odd_texts()
    rows, pairs = expected(plain, texts)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, place string, n bigint").repartition(3)
    for postings in (500, al.POSTINGS):  # workers are forked anew for each query
        monkeypatch.setattr(al, "POSTINGS", postings)
        got, counted = al.alignment(docs, *al.default_models(), with_groups=True)
        got = {r.doc_id: tuple(r)[1:] for r in got.collect()}
        for i, r in enumerate(rows):
            assert got[i][:7] == r, texts[i][:80]
            assert (hashlib.sha256(got[i][7].encode()).hexdigest() if got[i][7] else "") == r[6]
        assert {tuple(r) for r in counted.collect()} == pairs


def test_a_is_the_library_on_all_pieces_and_signs():
    path_a, path_b = al.default_models()
    library = Tokenizer.from_file(path_a)
    library.encode_special_tokens = True
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        own = al.Aligner(f.read(), g.read())
    texts = [b.decode(errors="ignore") for b in own.bytes_a.values()]
    signs = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x30000, 3)]]
    texts += [f" a{c}b {c}1{c}{c} 'll{c}  {c}" for c in signs]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.a(text) == found.ids, text


def test_planes_and_compression():
    import numpy as np

    draw = random.Random(2)
    chunk, want = al.Chunk(), Counter()
    for _ in range(4):
        place = np.arange(chunk.places, chunk.places + 500)
        links = [(draw.choice([1, 2, 3, 70_000 * 32_000]), int(draw.choice(place))) for _ in range(4000)]
        want.update(links)
        chunk.merge(np.array([x[0] for x in links]), np.array([x[1] for x in links]))
        chunk.places += 500
    got, kinds = Counter(), set()
    for batch in chunk.bitmaps():
        for r in batch.to_pylist():
            kinds.add(r["plain"])
            places = np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8))) if r["plain"] else np.frombuffer(r["bits"], "<u2")
            assert len(places) == r["n"]
            for p in places:
                got[r["pair"], int(p)] += 1 if r["plane"] == 0 else 1 << r["plane"] - 1
    assert got == want and kinds == {True, False}


def test_awkward_rows(spark, plain):
    docs = awkward(spark)
    given = docs.collect()
    rows, pairs = expected(plain, [r.text for r in given])
    got, counted = al.alignment(docs, *al.default_models())
    want = sorted(str((r.doc_id, *x)) for r, x in zip(given, rows, strict=True))
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert {tuple(r) for r in counted.collect()} == pairs
    nothing = al.alignment(empty(spark), *al.default_models())
    assert nothing[0].collect() == nothing[1].collect() == []
