"""SentencePiece (BPE) encoding by the prefix table, and decoding.

In a merge-type (BPE) vocabulary the encoding of a text, cut after any of its
tokens, is the encoding of the text up to there: no merge has crossed that
place.  So every prefix of a text has exactly one last token, and a token ``t``
that ends at a place is that last token if and only if the last token ``u`` of
the text before it stands next to ``t`` in the encoding of ``u + t``.  Encoding
fills a table of those last tokens from left to right: an Aho-Corasick
automaton lists the pieces that end at each place, the pair test picks the one
that fits, and the ids are then read off backwards.

No merge crosses two characters that no piece holds side by side.  Texts are
therefore cut at such places (before a space after other characters, around
characters that no longer piece has), and the short runs between them are
remembered, which the few million words of a language make worthwhile.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, table

SPACE = "▁"
#: Remembered runs (at most twice as many, in two generations), and their length.
MEMORY, MEMORY_CHARS = 250_000, 48
#: Remembered pair tests.
PAIRS = 500_000
NEVER = float("-inf")
MODEL = "piece_bpe_32k.model"


# The library gives one replacement character for each byte that is no UTF-8.
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: its size bounds what is sent to the executors."""

    pieces: dict[str, tuple[int, float]]
    bytes_: tuple[int, ...]
    unknown: int
    size: int
    control: frozenset[int]
    dummy_prefix: bool

    @staticmethod
    def load(path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        norm, kind = m.normalizer_spec, pb.ModelProto.SentencePiece
        plain = not norm.precompiled_charsmap and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        odd = {p.type for p in m.pieces} & {kind.USER_DEFINED, kind.UNUSED}
        if m.trainer_spec.model_type != pb.TrainerSpec.BPE or not plain or odd or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: only BPE models without text normalisation or user-defined pieces are supported")
        ids = {t: [i for i, p in enumerate(m.pieces) if p.type == t] for t in (kind.BYTE, kind.UNKNOWN, kind.CONTROL)}
        in_order = sorted(ids[kind.BYTE], key=lambda i: int(m.pieces[i].piece[1:-1], 16))
        return Vocabulary(
            {p.piece: (i, p.score) for i, p in enumerate(m.pieces) if p.type == kind.NORMAL},
            tuple(in_order) if m.trainer_spec.byte_fallback else (),
            ids[kind.UNKNOWN][0],
            len(m.pieces),
            frozenset(ids[kind.CONTROL]),
            norm.add_dummy_prefix,
        )


class Tokenizer:
    """Encodes and decodes single texts; one for each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        long = [p for p in vocabulary.pieces if len(p) > 1]
        joining = set("".join(long))
        for piece in joining.union(vocabulary.pieces):  # also characters that are no piece
            self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        # A run may be cut before a space only if no piece has one after another character.
        leading = not any(SPACE in p.lstrip(SPACE) for p in long)
        inner = "".join(map(re.escape, sorted(joining - {SPACE} if leading else joining))) or SPACE
        self.runs = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|." if leading else f"[{inner}]+|.", re.DOTALL).findall
        self.by_id = {i: p for p, (i, _) in vocabulary.pieces.items()}
        self.byte_of = {i: b for b, i in enumerate(vocabulary.bytes_)}
        self.scores = {p: score for p, (_, score) in vocabulary.pieces.items()}
        self.built: dict[str, tuple[list[float], list[str], list[str]]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.names = list(map(str, range(vocabulary.size)))
        # Runs met since the memory was last full, and those met before that.
        self.memory: dict[str, tuple[str, int, str]] = {}
        self.older: dict[str, tuple[str, int, str]] = {}

    def next_merge(self, parts: list[str]) -> tuple[float, int]:
        """BPE's next merge by its definition: the best score, the leftmost of equals."""
        best, at = NEVER, -1
        for i in range(len(parts) - 1):
            score = self.scores.get(parts[i] + parts[i + 1], NEVER)
            if score > best:
                best, at = score, i
        return best, at

    def steps(self, piece: str) -> tuple[list[float], list[str], list[str]]:
        """How BPE builds a piece: the score of each merge, and the part at the
        left and at the right end before it."""
        known = self.built.get(piece)
        if known is None:
            parts, scores, left, right = list(piece), [], [piece[0]], [piece[-1]]
            while (found := self.next_merge(parts))[0] > NEVER:
                scores.append(found[0])
                parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
                left.append(parts[0])
                right.append(parts[-1])
            known = self.built[piece] = ([*scores, NEVER], left, right)
        return known

    def fits(self, before: str, piece: str) -> bool:
        """Whether ``piece`` stays next to ``before`` in the encoding of both:
        their own merges run in order of score (the left one first of equals),
        and no merge across their border may come before those are done."""
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, _, edge = self.steps(before)
            b, other, _ = self.steps(piece)
            i = j = 0
            while known is None:
                across = self.scores.get(edge[i] + other[j], NEVER)
                if across > a[i] and across >= b[j]:
                    known = False
                elif a[i] >= b[j]:
                    if a[i] == NEVER:
                        known = True
                    i += 1
                else:
                    j += 1
            self.pairs[key] = known
        return known

    def begins(self, piece: str) -> bool:
        """Whether BPE joins the whole piece from its characters."""
        return self.steps(piece)[1][-1] == piece

    def last_tokens(self, run: str) -> list[str]:
        """The prefix table: entry i is the last token of ``run[: i + 1]``.  The
        automaton lists what ends at a place from the longest to one character."""
        last, known = [""] * len(run), self.pairs.get
        for end, (piece, length) in self.automaton.iter(run):
            if last[end]:
                continue
            if length > end:
                fit = self.begins(piece)
            else:
                fit = known((last[end - length], piece))
                if fit is None:
                    fit = self.fits(last[end - length], piece)
            if fit:
                last[end] = piece
        return last

    def run_ids(self, run: str) -> list[int]:
        last = self.last_tokens(run) if len(run) > 1 else [run]
        tokens, end = [], len(run)
        while end:  # backwards from the whole run
            tokens.append(last[end - 1])
            end -= len(tokens[-1])
        ids: list[int] = []
        for t in reversed(tokens):
            known = self.v.pieces.get(t)
            if known is not None:
                ids.append(known[0])
            elif self.v.bytes_:
                ids.extend(self.v.bytes_[b] for b in t.encode("utf-8", "replace"))
            else:
                ids.append(self.v.unknown)
        return ids

    def normalized(self, text: str) -> str:
        out = text.replace(" ", SPACE)
        return SPACE + out if out and self.v.dummy_prefix else out

    def raw_decode(self, ids: list[int]) -> str:
        try:
            return "".join([self.by_id[i] for i in ids]).replace(SPACE, " ")
        except KeyError:
            out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            out.append(pending.decode("utf-8", "each_byte"))
            pending.clear()
            if i not in self.v.control:
                out.append(self.by_id.get(i, " ⁇ "))
        out.append(pending.decode("utf-8", "each_byte"))
        return "".join(out).replace(SPACE, " ")

    def known_run(self, run: str) -> tuple[str, int, str]:
        """(ids as text, their number, decoded text) of a run not in ``memory``."""
        out = self.older.get(run)
        if out is None:
            ids = self.run_ids(run)
            out = (",".join([self.names[i] for i in ids]), len(ids), self.raw_decode(ids))
        if len(run) <= MEMORY_CHARS:
            if len(self.memory) >= MEMORY:
                self.older, self.memory = self.memory, {}
            self.memory[run] = out
        return out

    def by_runs(self, text: str) -> tuple[str, int, str]:
        """(ids joined by commas, their number, the decoded text) of a text."""
        make = self.known_run
        found = [self.memory.get(r) or make(r) for r in self.runs(self.normalized(text))]
        decoded = "".join([f[2] for f in found])
        if self.v.dummy_prefix:
            decoded = decoded.removeprefix(" ")
        return ",".join([f[0] for f in found]), sum([f[1] for f in found]), decoded

    def encode(self, text: str) -> list[int]:
        joined = self.by_runs(text)[0]
        return [int(i) for i in joined.split(",")] if joined else []

    def decode(self, ids: list[int]) -> str:
        out = self.raw_decode(ids)
        prefixed = self.v.dummy_prefix and ids and self.by_id.get(ids[0], "").startswith(SPACE)
        return out.removeprefix(" ") if prefixed else out


#: One tokenizer a worker and model, kept from task to task.
_tokenizers: dict[str, Tokenizer] = {}


def tokenize(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids][, decoded]), a row per input row.

    Ids are those of the whole text without begin and end marks; the decoded
    text is what those ids give back.  Null and empty texts have no ids.  Null
    or repeated ids and other columns of ``docs`` do not matter: rows are
    independent.  A task holds one batch of texts and a bounded memory of runs.
    """
    v = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    tag = uuid.uuid4().hex
    kept = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kept}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tag not in _tokenizers:
            _tokenizers.clear()
            _tokenizers[tag] = Tokenizer(v.value)
        tok = _tokenizers[tag]
        for batch in batches:
            n, ids_sha, text_sha, all_ids, all_decoded = [], [], [], [], []
            for value in batch.column(1):
                joined, count, decoded = tok.by_runs(value.as_py() or "")
                n.append(count)
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
                if with_ids:
                    all_ids.append([int(i) for i in joined.split(",")] if joined else [])
                if with_decoded:
                    all_decoded.append(decoded)
            columns = {id_col: batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if with_ids:
                columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            if with_decoded:
                columns["decoded"] = pa.array(all_decoded, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return map_batches(docs.select(F.col(id_col), F.col(text_col).alias("_text")), run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents"), default_model())
