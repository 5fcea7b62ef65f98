"""Alignment of two tokenizers' tokens, with corpus-wide counts by inverted pair bitmaps.

Tokenizer A is a byte-level BPE, B a SentencePiece model.  Both encode a text with
a space before it.  Where a token of A and one of B end at the same byte, the two
are linked; these places cut both sequences into groups.

1. *Encode and invert.*  A task encodes its texts and deals them into chunks of at
   most 65,536.  For each pair of ids that a chunk links it makes a bitmap of the
   chunk's texts (plane 0: texts that link the pair) and planes of multiplicity
   (plane p > 0: texts whose number of links, less one, has bit p - 1).  A bitmap
   is compressed: 16-bit places where texts are few, plain bits otherwise.  Batches
   of texts are ORed into their chunk's bitmaps before anything leaves the task.
2. *Count.*  A pair's population counts, plane p > 0 weighing 2 ** (p - 1), add up
   to the links that hold it, those of plane 0 alone to its texts; Spark sums them
   by pair (combined in the tasks), and takes the highest count of each id of B.
3. *Return.*  The bitmaps are the pairs' postings: joined with the counts and
   dealt by chunk, each sends its pair's count to the places of its texts, where
   they are added up.

A pair of very common ids has one bitmap a chunk and plane, never a row for each
text, and no task gathers all texts of a pair.  A chunk ends with the text that
takes it to ``POSTINGS`` (pair, text) entries, which bounds what a task holds.

Texts are encoded in pieces, cut before spaces that stand after a letter, digit or
ASCII sign and before further text.  A's pattern always cuts there, and no piece of
B goes on with a space, so both encode the pieces one by one as they do the whole.
Short pieces are remembered.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship, table, text_chunks, written

SPACE = "▁"
#: How byte-level tokenizers cut texts (a fixed value of their format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Remembered pieces (at most twice as many, in two generations), and their length.
MEMORY, MEMORY_CHARS = 200_000, 32
#: Texts in a chunk at most, and (pair, text) entries that end one.
PLACES, POSTINGS = 1 << 16, 3_000_000
#: Bytes of text encoded at a time.
BATCH_BYTES = 1 << 20
#: Bitmaps in an Arrow batch.
OUT_ROWS = 50_000


def byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable
    ones for themselves, the rest from U+0100 up in their order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Encodes single texts with both tokenizers; one for each Python worker."""

    def __init__(self, json_a: str, model_b: bytes):
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        told = json.loads(json_a)
        cutter, model = told.get("pre_tokenizer") or {}, told["model"]
        plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
        if not plain or told.get("normalizer") or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("A is to be a byte-level tokenizer with the usual pattern and without normalisation")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][x + y] for x, y in merges]
        if order != sorted(order):
            raise ValueError("A's ids are to be in the order of its merges")
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in p): i for p, i in model["vocab"].items()}
        # Merges in the order of ids are merges by rank, which this encoder does fastest.
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = SentencePieceProcessor(model_proto=model_b)
        self.bytes_a = {i: p for p, i in ranks.items()}
        self.bytes_b: list[bytes] = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.size_b = len(self.bytes_b)
        inner = any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(self.size_b))
        if inner or not self.b.id_to_piece(self.b.encode("a")[0]).startswith(SPACE):
            raise ValueError("B is to add a space before texts, and to have spaces only where pieces begin")
        if (max(self.bytes_a) + 1) * self.size_b >= 1 << 47:
            raise ValueError("the vocabularies are too large for pairs of 47 bits")
        self.lengths_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.lengths_a[list(self.bytes_a)] = [len(p) for p in self.bytes_a.values()]
        self.lengths_b = np.array([len(p) for p in self.bytes_b])
        ids = range(max(len(self.lengths_a), self.size_b))
        self.names = np.array([[f"{mark}{i}" for i in ids] for mark in ("", ",", ";", "|")], object)
        self.cut = re.compile(r"(?<=[\w!-~])(?= +[^ ])").split
        # Texts without these are cut at every space.
        self.uneven = re.compile(r"[^\w!-~] | $").search
        self.memory: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def pieces(self, text: str) -> list[str]:
        """The pieces of a space and the text, without their first spaces."""
        if text[:1] == " " or self.uneven(text):
            return [p[1:] for p in self.cut(" " + text)]
        return text.split(" ")

    def entry(self, piece: str, a: list[int], b: list[int]) -> tuple[int, int, int, str, bytes] | None:
        """(tokens of A, of B, groups, groups as text, linked pairs) of a piece; None
        where the tokens' bytes are not those of a space and the piece."""
        whole = b" " + piece.encode()
        told_a, told_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        if b"".join(told_a) != whole or b"".join(told_b) != whole:
            return None
        groups, pairs = [], []
        j = first_a = first_b = at_a = at_b = 0
        for i, told in enumerate(told_a, 1):
            at_a += len(told)
            while at_b < at_a:
                at_b += len(told_b[j])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
                pairs.append(a[i - 1] * self.size_b + b[j - 1])
                first_a, first_b = i, j
        return len(a), len(b), len(groups), ";".join(groups), array("q", pairs).tobytes()

    def entries(self, pieces: list[str], a: list[list[int]], b: list[list[int]]) -> list[tuple[int, int, int, str, bytes] | None]:
        """``entry`` of many pieces at once."""
        whole = [b" " + p.encode() for p in pieces]
        ends, tokens, flat = np.cumsum([len(w) for w in whole]), [], []
        for ids, told in ((a, self.bytes_a), (b, self.bytes_b)):
            flat.append(np.fromiter(chain.from_iterable(ids), np.int64))
            tokens.append(np.cumsum([len(x) for x in ids]))
            if b"".join(map(told.__getitem__, flat[-1].tolist())) != b"".join(whole):
                return [self.entry(*one) for one in zip(pieces, a, b, strict=True)]
        (flat_a, flat_b), (past_a, past_b) = flat, tokens
        end_a, end_b = np.cumsum(self.lengths_a[flat_a]), np.cumsum(self.lengths_b[flat_b])
        if (end_a[past_a - 1] != ends).any() or (end_b[past_b - 1] != ends).any():
            return [self.entry(*one) for one in zip(pieces, a, b, strict=True)]
        common_a, common_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        group_a, group_b = np.cumsum(common_a) - common_a, np.cumsum(common_b) - common_b
        after_a, after_b = np.flatnonzero(common_a) + 1, np.flatnonzero(common_b) + 1  # tokens up to the end of each group
        first_a, first_b = np.append(0, after_a[:-1]), np.append(0, after_b[:-1])
        # What stands before each id: "" first of a piece, ";" of another group, "|" first of B in a group, "," else.
        mark_a, mark_b = np.full(len(flat_a), 1), np.full(len(flat_b), 1)
        mark_a[first_a], mark_b[first_b] = 2, 3
        mark_a[np.append(0, past_a[:-1])] = 0
        told = np.empty(len(flat_a) + len(flat_b), object)
        told[np.arange(len(flat_a)) + first_b[group_a]] = self.names[mark_a, flat_a]
        told[np.arange(len(flat_b)) + after_a[group_b]] = self.names[mark_b, flat_b]
        told, past = told.tolist(), (past_a + past_b).tolist()
        pairs = (flat_a[after_a - 1] * self.size_b + flat_b[after_b - 1]).tobytes()
        groups = np.cumsum(common_a)[past_a - 1].tolist()
        n_a, n_b = np.diff(past_a, prepend=0).tolist(), np.diff(past_b, prepend=0).tolist()
        out, i, g = [], 0, 0
        for x, y, j, h in zip(n_a, n_b, past, groups, strict=True):
            out.append((x, y, h - g, "".join(told[i:j]), pairs[8 * g : 8 * h]))
            i, g = j, h
        return out

    def aligned(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """(tokens of A, of B, groups, groups as text, linked pairs) of each text."""
        pieces = [self.pieces(t) if t else [] for t in texts]
        if len(self.memory) > MEMORY:
            self.older, self.memory = self.memory, {}
        memory, older = self.memory, self.older
        unknown = []
        distinct = set().union(*pieces)
        for p in distinct.difference(memory):
            found = older.get(p, unknown)
            if found is unknown:
                unknown.append(p)
            else:
                memory[p] = found
        if unknown:
            a, b = [self.a(" " + p) for p in unknown], self.b.encode(unknown, num_threads=1)
            memory.update(zip(unknown, self.entries(unknown, a, b), strict=True))
        odd = {p for p in distinct if memory[p] is None}
        out = []
        for text, one in zip(texts, pieces, strict=True):
            entries = [memory[p] for p in one]
            if not odd.isdisjoint(one):  # the whole decides
                entries = [self.entry(text, self.a(" " + text), self.b.encode(text))]
            if entries and entries[0]:
                n_a, n_b, n, groups, pairs = zip(*entries)
                out.append((sum(n_a), sum(n_b), sum(n), ";".join(groups), b"".join(pairs)))
            else:
                out.append(NOTHING)
        for p in unknown:
            if len(p) > MEMORY_CHARS:
                del memory[p]
        return out


#: A text without tokens.
NOTHING = (0, 0, 0, "", b"")


class Chunk:
    """The bitmaps of the texts of one chunk, as sorted (pair, place) keys."""

    def __init__(self):
        self.places = self.size = 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def merge(self, pairs: np.ndarray, place: np.ndarray) -> None:
        """ORs a batch of links in; a text's links all come in one batch."""
        keys, times = np.unique(pairs << 16 | place, return_counts=True)
        self.keys.append(keys)
        self.times.append(times.astype(np.uint32))
        self.size += len(keys)

    def bitmaps(self) -> Iterator[pa.RecordBatch]:
        """(pair, plane, n, plain, bits): all planes of all pairs."""
        if not self.size:
            return
        keys, extra = np.concatenate(self.keys), np.concatenate(self.times) - np.uint32(1)
        order = np.argsort(keys)
        keys, extra, plane = keys[order], extra[order], 0
        yield from compressed(keys, plane, self.places)
        keys, extra = keys[extra > 0], extra[extra > 0]
        while len(keys):
            plane += 1
            yield from compressed(keys[(extra & np.uint32(1)) > 0], plane, self.places)
            keys, extra = keys[extra > 1], extra[extra > 1] >> np.uint32(1)


def compressed(keys: np.ndarray, plane: int, places: int) -> Iterator[pa.RecordBatch]:
    """The bitmap of each pair's places in sorted ``pair << 16 | place`` keys: the
    places as 16-bit numbers, or as plain bits where that is shorter."""
    if not len(keys):
        return
    pair, place = keys >> 16, keys & 0xFFFF
    start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    n = np.diff(np.append(start, len(keys)))
    width = -(-places // 8)
    plain = 2 * n > width
    offsets = np.concatenate(([0], np.cumsum(np.where(plain, width, 2 * n))))
    data = np.zeros(offsets[-1], np.uint8)
    few = np.repeat(~plain, n)
    at = (np.repeat(offsets[:-1] - 2 * start, n) + 2 * np.arange(len(keys)))[few]
    data[at], data[at + 1] = place[few] & 255, place[few] >> 8
    for i in np.flatnonzero(plain):
        bits = np.zeros(8 * width, np.uint8)
        bits[place[start[i] : start[i] + n[i]]] = 1
        data[offsets[i] : offsets[i + 1]] = np.packbits(bits)
    ends = offsets.astype(np.int32)
    bits = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    for i in range(0, len(n), OUT_ROWS):
        some = slice(i, i + OUT_ROWS)
        yield pa.RecordBatch.from_pydict({
            "pair": pa.array(pair[start][some]), "plane": pa.array(np.full(len(n[some]), plane, np.int32)),
            "n": pa.array(n[some].astype(np.int64)), "plain": pa.array(plain[some]), "bits": bits[some],
        })


#: One aligner a worker and pair of tokenizers, kept from task to task.
_aligners: dict[str, Aligner] = {}


def encoded(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, with_groups: bool) -> tuple[DataFrame, int]:
    """Rows of texts (``plane`` is null) and of bitmaps, in one table, and the
    size of B's vocabulary."""
    sc = docs.sparkSession.sparkContext
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        models = (a.read(), b.read())
    shared, tag = sc.broadcast(models), uuid.uuid4().hex
    id_type = docs.schema[id_col].dataType.simpleString()
    text_row = "chunk bigint, place int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string" + ", groups string" * with_groups
    bitmap_row = "pair bigint, plane int, n bigint, plain boolean, bits binary"
    schema = f"id {id_type}, {text_row}, {bitmap_row}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tag not in _aligners:
            _aligners.clear()
            _aligners[tag] = Aligner(*shared.value)
        aligner, number, chunk = _aligners[tag], TaskContext.get().partitionId() << 32, Chunk()
        types = None

        def filled(found: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([found[n] if n in found else pa.nulls(rows, t) for n, t in types], [n for n, _ in types])

        def ended() -> Iterator[pa.RecordBatch]:
            for one in chunk.bitmaps():
                found = dict(zip(one.schema.names, one.columns, strict=True))
                yield filled(found | {"chunk": pa.array(np.full(one.num_rows, number, np.int64))}, one.num_rows)

        for batch in batches:
            types = types or arrow_types(batch.schema.field(0).type, with_groups)
            for row, end, _, _ in text_chunks(batch.column(1), BATCH_BYTES):
                if chunk.size >= POSTINGS or chunk.places + end - row > PLACES:
                    yield from ended()
                    number, chunk = number + 1, Chunk()
                told = aligner.aligned([t or "" for t in batch.column(1).slice(row, end - row).to_pylist()])
                n_a, n_b, n_groups, groups, pairs = zip(*told, strict=True)
                linked = np.frombuffer(b"".join(pairs), np.int64)
                n_links = np.array([len(x) for x in pairs], np.int64) // 8
                first = chunk.places
                chunk.merge(linked, np.repeat(np.arange(first, first + len(told)), n_links))
                chunk.places += len(told)
                found = {
                    "id": batch.column(0).slice(row, end - row),
                    "chunk": pa.array(np.full(len(told), number, np.int64)),
                    "place": pa.array(np.arange(first, first + len(told), dtype=np.int32)),
                    "n_a": pa.array(n_a, pa.int64()),
                    "n_b": pa.array(n_b, pa.int64()),
                    "n_groups": pa.array(n_groups, pa.int64()),
                    "n_links": pa.array(n_links),
                    "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string()),
                }
                yield filled(found | ({"groups": pa.array(groups, pa.string())} if with_groups else {}), len(told))
        if types:
            yield from ended()

    out = map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)
    return out, Aligner(*models).size_b


def arrow_types(id_type: pa.DataType, with_groups: bool) -> list[tuple[str, pa.DataType]]:
    long, text = pa.int64(), pa.string()
    counts = [(n, long) for n in ("n_a", "n_b", "n_groups", "n_links")]
    own = [("id", id_type), ("chunk", long), ("place", pa.int32()), *counts, ("groups_sha256", text)]
    own += [("groups", text)] if with_groups else []
    return [*own, ("pair", long), ("plane", pa.int32()), ("n", long), ("plain", pa.bool_()), ("bits", pa.binary())]


def pair_counts(bitmaps: DataFrame, size_b: int) -> DataFrame:
    """(pair, texts, links, highest): population counts over all chunks, and
    whether no other pair of the same id of B has more links."""
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counted = written(
        bitmaps.groupBy("pair").agg(F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("texts"), F.sum(F.col("n") * weight).alias("links")).withColumn("b", F.col("pair") % size_b),
        "pairs",
    )
    most = counted.groupBy("b").agg(F.max("links").alias("most"))  # at most a row for each id of B
    return counted.join(F.broadcast(most), "b").select("pair", "texts", "links", (F.col("links") == F.col("most")).alias("highest"))


def returned(bitmaps: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, place, n_best, count_sum) of the texts in the pairs' bitmaps."""

    def added(rows: pa.Table) -> pa.Table:
        total, best, hit = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64), np.zeros(PLACES, bool)
        plane = np.asarray(rows["plane"].combine_chunks())
        weight = np.where(plane == 0, 1, np.int64(1) << np.maximum(plane - 1, 0).astype(np.int64))
        links, highest = np.asarray(rows["links"].combine_chunks()) * weight, np.asarray(rows["highest"].combine_chunks()) * weight
        plain = np.asarray(rows["plain"].combine_chunks())
        few = rows["bits"].filter(pa.array(~plain)).combine_chunks()
        lengths = np.asarray(pa.compute.binary_length(few)) // 2
        place = np.frombuffer(b"".join(few.to_pylist()), "<u2").astype(np.int64)
        np.add.at(total, place, np.repeat(links[~plain], lengths))
        np.add.at(best, place, np.repeat(highest[~plain], lengths))
        hit[place] = True
        for i in np.flatnonzero(plain):
            bits = np.unpackbits(np.frombuffer(rows["bits"][int(i)].as_py(), np.uint8)).astype(bool)
            at = np.flatnonzero(bits)
            total[at] += links[i]
            best[at] += highest[i]
            hit[at] = True
        at = np.flatnonzero(hit)
        return pa.table({"chunk": pa.array(np.full(len(at), rows["chunk"][0].as_py(), np.int64)), "place": pa.array(at.astype(np.int32)), "n_best": pa.array(best[at]), "count_sum": pa.array(total[at])})

    ship(bitmaps.sparkSession)
    postings = bitmaps.join(counts, "pair").select("chunk", "plane", "plain", "bits", "links", "highest")
    return postings.groupBy("chunk").applyInArrow(added, "chunk bigint, place int, n_best bigint, count_sum bigint")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """A row for each text, (<id>, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256[, groups]), and one for each pair of ids that is linked anywhere,
    (a, b, texts, links, highest).

    ``groups`` is `a1,a2|b1;a3|b2,b3`: the ids of each group in order.  A pair's
    count is the number of links that hold it in all texts; ``n_best`` are the links
    whose count no other pair with their id of B exceeds, ``count_sum`` adds the
    counts of all links.  Strings of special tokens in a text are plain text.

    Texts that are null or empty, or whose tokens' bytes are not those of a space
    and the text, have no tokens: zeros and empty strings.  Null or repeated ids do
    not matter (each row is a text of its own), nor do other columns of ``docs``.
    An empty table gives two empty results.
    """
    found, size_b = encoded(docs, path_a, path_b, id_col, text_col, with_groups)
    found = written(found, "alignment")
    bitmaps = found.where(F.col("plane").isNotNull()).select("chunk", "pair", "plane", "n", "plain", "bits")
    counts = written(pair_counts(bitmaps, size_b), "pair-counts")
    texts = found.where(F.col("plane").isNull()).join(returned(bitmaps, counts), ["chunk", "place"], "left")
    none = F.lit(0).cast("bigint")
    texts = texts.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256", *["groups"] * with_groups,
    )
    a, b = F.floor(F.col("pair") / size_b).cast("int").alias("a"), (F.col("pair") % size_b).cast("int").alias("b")
    return texts, counts.select(a, b, "texts", "links", "highest")


def default_models() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), *default_models())[0]
