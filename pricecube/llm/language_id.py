"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts of up to three bytes is counted on the
training texts.  A byte's probability after a context is its count there (PPM
method C: a context of n occurrences and d different successors gives them
count / (n + d)); the rest, d / (n + d), is the escape to the next shorter
context, from which the bytes already predicted are excluded, down to equal
chances.  The statistics are frozen after training, so the bits of every byte seen
after a context and of every context's escape are worked out once, and a text's
exact code length under a language is a sum of table entries.  The language of
the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, table, text_chunks, written
from .quality import fold

#: Four-byte sequences that the model holds, dealt evenly among the languages (what
#: one does not need goes to the others).  Shorter ones are all held.
GRAMS = 1 << 21
ORDER = 3
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
PAD = 0x20


def shifted(data: np.ndarray, offsets: np.ndarray, by: int) -> np.ndarray:
    """The byte ``by`` places earlier in the same text, ``PAD`` before its start."""
    out = np.full(len(data), PAD, np.uint8)
    out[by:] = data[: max(len(data) - by, 0)]
    for j in range(by):
        at = offsets[:-1] + j
        out[at[at < offsets[1:]]] = PAD
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the number made of the three bytes before it and itself."""
    data = _FOLD[data]
    out = data.astype(np.uint32)
    for by in range(1, ORDER + 1):
        out |= shifted(data, offsets, by).astype(np.uint32) << np.uint32(8 * by)
    return out


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n): a task sums up what it reads; distinct grams bound its memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for row, end, data, offsets in text_chunks(batch.column(0)):
                found, here = grams(data, offsets), np.repeat(langs[row:end], np.diff(offsets))
                for lang in set(langs[row:end]):
                    seen, n = np.unique(found[here == lang], return_counts=True)
                    if lang in total:
                        old, m = total[lang]
                        seen, back = np.unique(np.concatenate((old, seen)), return_inverse=True)
                        n = np.bincount(back, weights=np.concatenate((m, n))).astype(np.int64)
                    total[lang] = (seen, n)
        for lang, (seen, n) in total.items():
            for i in range(0, len(seen), 50_000):
                part = slice(i, i + 50_000)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(seen[part]), pa.string()), "gram": pa.array(seen[part].astype(np.int64)), "n": pa.array(n[part].astype(np.int64))}
                )

    counted = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = counted.where("lang is not null and text is not null")
    return map_batches(counted, run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def mask(order: int) -> np.uint32:
    """Of the last byte and ``order`` bytes before it."""
    return np.uint32((1 << 8 * (order + 1)) - 1)


def summed(gram: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of the order, sorted, and their counts."""
    keys, back = np.unique(gram & mask(order), return_inverse=True)
    return keys, np.bincount(back, weights=n, minlength=len(keys))


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are in the sorted ``keys``, and where those are."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return hit, at[hit]


@dataclass(frozen=True)
class Tree:
    """A language's frozen tree: for each order, the longest first, (sorted grams,
    bits of their last bytes, sorted contexts, bits of their escapes)."""

    orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    floor: float

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte after the bytes before it."""
        out, left = np.zeros(len(gram)), np.arange(len(gram))
        for order, (keys, bits, contexts, escapes) in zip(range(ORDER, -1, -1), self.orders, strict=True):
            key = gram[left] & mask(order)
            hit, at = found(keys, key)
            out[left[hit]] += bits[at]
            left, key = left[~hit], key[~hit]
            hit, at = found(contexts, key >> np.uint32(8))
            out[left[hit]] += escapes[at]
        out[left] += self.floor
        return out


@dataclass(frozen=True)
class Model:
    langs: list[str]
    trees: list[Tree]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text of a chunk under each language."""
        gram, back = np.unique(grams(data, offsets), return_inverse=True)
        out, total = np.empty((len(offsets) - 1, len(self.langs))), np.zeros(len(data) + 1)
        for k, tree in enumerate(self.trees):
            np.cumsum(tree.bits(gram)[back], out=total[1:])
            out[:, k] = total[offsets[1:]] - total[offsets[:-1]]
        return out


def frozen(keys: np.ndarray, counts: np.ndarray, lower: np.ndarray, n: np.ndarray | None = None, d: np.ndarray | None = None):
    """(probabilities, contexts, probabilities of their escapes) from an order's
    grams and the probabilities of their last bytes in the order below.

    ``n`` and ``d`` are those of each gram's context where ``keys`` are not all of
    its grams; what the others have goes to the escape.
    """
    contexts, first, own = np.unique(keys >> np.uint32(8), return_index=True, return_inverse=True)
    kept = np.bincount(own, weights=counts, minlength=len(contexts))
    n = kept if n is None else n[first]
    d = np.bincount(own, minlength=len(contexts)) if d is None else d[first]
    rest = np.maximum(1 - np.bincount(own, weights=lower, minlength=len(contexts)), 1e-9)
    return counts / (n + d)[own], contexts, (n + d - kept) / (n + d) / rest


def build(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, deep: pa.Table | None = None) -> Model:
    """Freezes the counts into trees; without any language every text is ``und``.

    ``deep`` are the four-byte grams to hold: (lang, gram, n, context_n, context_d).
    Without it those of the counts are held, and else only the shorter ones are
    taken from the counts.
    """
    gram = gram.astype(np.uint32)
    # All bytes that no training text has share one symbol.
    size = len({PAD, *np.unique(gram & mask(0)).tolist()}) + 1
    langs, trees = sorted(set(lang)), []
    for name in langs:
        own = np.flatnonzero(lang == name)
        orders, below, p = [], np.zeros(1, np.uint32), np.full(1, 1 / size)
        for order in range(ORDER + 1):
            if order == ORDER and deep is not None:
                rows = deep.filter(pc.equal(deep["lang"], name)).sort_by("gram")
                keys = rows["gram"].to_numpy().astype(np.uint32)
                counts, *context = (rows[c].to_numpy().astype(float) for c in ("n", "context_n", "context_d"))
            else:
                (keys, counts), context = summed(gram[own], n[own], order), []
            lower = p[np.searchsorted(below, keys & mask(order - 1))]
            below = keys
            p, contexts, escapes = frozen(keys, counts, lower, *context)
            orders.insert(0, (keys, -np.log2(p).astype(np.float32), contexts, -np.log2(escapes).astype(np.float32)))
        trees.append(Tree(orders, float(np.log2(size))))
    return Model(langs, trees)


def least_levels(tally: list[tuple[str, int, int]], budget: int) -> dict[str, int]:
    """Of (lang, level, grams) rows, the lowest level that a language's share of the
    budget holds, for the languages that have more grams than that."""
    need: dict[str, int] = {}
    for lang, _, grams_there in tally:
        need[lang] = need.get(lang, 0) + grams_there
    out = {}
    for i, lang in enumerate(sorted(need, key=lambda x: (need[x], x))):
        share = min(need[lang], budget // (len(need) - i))
        budget -= share
        if share < need[lang]:
            levels = sorted((level, grams_there) for name, level, grams_there in tally if name == lang)
            out[lang] = levels[-1][0] + 1
            while levels and levels[-1][1] <= share:
                out[lang], taken = levels.pop()
                share -= taken
    return out


def learn(counted: DataFrame, budget: int = GRAMS) -> Model:
    """The model of (lang, gram, n) rows.  Grams of one to three bytes are counted
    over all rows and all go to the driver (at most 2**24 a language whatever the
    corpus).  Of the four-byte ones, each language sends its most frequent within
    its share of ``budget``, with the whole count and the number of successors of
    their contexts; a gram left out is coded by the escape to its last three bytes."""
    short = counted.groupBy("lang", F.col("gram").bitwiseAND(F.lit(int(mask(ORDER - 1)))).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    level = F.floor(F.lit(8) * F.log2("n"))
    tally = counted.groupBy("lang", level.alias("level")).agg(F.count(F.lit(1)).alias("grams")).collect()
    same = Window.partitionBy("lang", F.shiftright("gram", 8))
    deep = counted.withColumns({"context_n": F.sum("n").over(same), "context_d": F.count(F.lit(1)).over(same)})
    least = least_levels([tuple(r) for r in tally], budget)
    if least:
        lowest = F.try_element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col("lang"))
        deep = deep.where(level >= F.coalesce(lowest, F.lit(0)))
    return build(short["lang"].to_numpy().astype(object), short["gram"].to_numpy(), short["n"].to_numpy().astype(float), deep.toArrow())


def identify(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang_pred, score), a row per input row; ``train`` says of an id column
    which rows may be learnt from (those with text and language are).

    Null texts and texts without a letter get ``und`` and score 0.  Otherwise the
    score is the winner's share of the likelihoods; of equal code lengths the
    first language in order wins.  Without training rows every text is ``und``.
    Repeated rows count again in training; other columns are ignored.
    """
    model = learn(written(gram_counts(docs.where(train(F.col(id_col))), text_col, lang_col), "grams"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = pa.array([*m.langs, "und"], pa.string())
        for batch in batches:
            letters = pc.fill_null(pc.match_substring_regex(batch.column(1), r"\p{L}"), False).to_numpy(zero_copy_only=False)
            for row, end, data, offsets in text_chunks(batch.column(1)):
                told = letters[row:end] & bool(m.langs)
                best, score = np.full(end - row, len(m.langs)), np.zeros(end - row)
                if m.langs:
                    cost = m.code_lengths(data, offsets)
                    cost -= cost.min(1, keepdims=True)
                    best = np.where(told, cost.argmin(1), best)
                    score = np.where(told, 1 / np.exp2(-np.minimum(cost, 1000)).sum(1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), names.take(pa.array(best)), pa.array(score)], [id_col, "lang_pred", "score"])

    return map_batches(docs.select(F.col(id_col), F.col(text_col).alias("_text")), run, f"`{id_col}` {kept}, lang_pred string, score double")


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    out = identify(table(spark, sf_dir, "documents"), lambda i: fold(i, 4) != 2)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
