"""Removal of long repeated strings by hash-compared suffix sorting.

Sorting every suffix of a corpus is out of reach, so each window of ``length``
bytes names an anchor: the place in it whose ``GRAM`` bytes have the smallest
hash, the leftmost of equals.  Equal windows name the same place, so windows
need only be compared around anchors of equal bytes.  Neighbouring windows share
an anchor; the bytes that they cover are its context.

1. Anchors whose bytes occur once are dropped, by a map-side combined count.
   Where all contexts of an anchor are the same, all their windows repeat.
2. For the other anchors the distinct contexts are sorted as suffixes from the
   anchor rightwards, and from the anchor leftwards: a mergesort whose
   comparisons find the common extension of two suffixes by binary search over
   prefix polynomial hashes.  All neighbours' extensions are then verified byte
   by byte.  Two windows are equal if their suffixes agree far enough on both
   sides, so sorted neighbours tell every repeated window.
3. Groups of more than ``GROUP`` different contexts, such as those at the edge
   of a passage that a third of all texts hold, are not gathered in a task:
   their windows are counted as rows, with map-side combining.

Texts travel between stages compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix, powers, prefix_hashes, range_hashes, table, text_chunks, written

LENGTH, GRAM = 200, 40
#: Bytes that a task looks at together: numpy's arrays of them take some hundred bytes for each.
CHUNK_BYTES = 1 << 20
#: Bytes or pairs that the steps over a whole group hold in wide arrays at once.
SLICE = 1 << 18
#: Different contexts of an anchor that one task sorts at most: of at most 360
#: bytes each, so up to 18 MB, their hashes (8 bytes for each byte) and some seconds.
GROUP = 50_000


# --- anchors -------------------------------------------------------------------


def smallest_in(x: np.ndarray, m: int) -> np.ndarray:
    """The least of each ``m`` neighbours."""
    y, span = x, 1
    while span * 2 <= m:
        y = np.minimum(y[:-span], y[span:])
        span *= 2
    return np.minimum(y[: len(x) - m + 1], y[m - span :]) if span < m else y


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, text, anchor, first window, last window) of a chunk."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = mix(range_hashes(prefix, at, at + GRAM))
    low = np.uint64(0xFFFFFFFF)
    place = (smallest_in((gram & ~low) | at.astype(np.uint64), length - GRAM + 1) & low).astype(np.int64)
    window = np.arange(len(place))
    text = np.searchsorted(offsets, window, "right") - 1
    inside = np.flatnonzero(window + length <= offsets[text + 1])  # matches never cross texts
    if not len(inside):
        return none
    window, place, text = window[inside], place[inside], text[inside]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    last = np.append(first[1:], len(window)) - 1
    a, b = window[first], window[last]
    context = mix(range_hashes(prefix, a, b + length) + (b - a).astype(np.uint64))
    return gram[place[first]], context, text[first], place[first], a, b


def text_names(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128-bit BLAKE2 digests that name whole texts, as rows of two 64-bit numbers."""
    each = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.frombuffer(b"".join(each), np.int64).reshape(-1, 2)


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """(first text, bytes, offsets, place of the bytes in their text): one longer
    text is cut into overlapping pieces that hold each of its windows once."""
    if len(offsets) > 2 or len(data) <= CHUNK_BYTES + length:
        yield data, offsets, 0
        return
    for i in range(0, len(data) - length + 1, CHUNK_BYTES):
        part = data[i : i + CHUNK_BYTES + length - 1]
        yield part, np.array([0, len(part)]), i


#: The columns that name a whole text.
TEXT = ["text", "text_"]


#: An anchor's place, and how far before it its last and its first window begin, in one number.
def _pack(q, lo, hi):
    return (q << 20) | (lo << 10) | hi


def found_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(gram, context, text, text_, at) of a ``_text`` column; the two text columns name
    the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), CHUNK_BYTES):
                names = text_names(data, offsets)
                for part, at, base in _pieces(data, offsets, length):
                    gram, context, text, q, a, b = anchors(part, at, length)
                    where = _pack(q - at[text] + base, q - b, q - a)
                    columns = [gram.view(np.int64), context.view(np.int64), names[text, 0], names[text, 1], where]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "context", *TEXT, "at"])

    return map_batches(docs.select("_text"), run, "gram long, context long, text long, text_ long, at long")


# --- suffix sorting --------------------------------------------------------------


def suffix_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``prefix_hashes`` whose powers begin anew at each of ``start``, so equal pieces of two
    suffixes, as far from their starts, have equal differences.  Made in slices: besides
    the result nothing wide grows with the data."""
    order, n = np.sort(start), len(data)
    weights = powers(int(np.diff(np.append(order, n)).max(initial=0)) + 1)[0]
    out = np.zeros(n + 1, np.uint64)
    for i in range(0, n, SLICE):
        at = np.arange(i, min(i + SLICE, n))
        begin = order[np.maximum(np.searchsorted(order, at, "right") - 1, 0)]
        out[at + 1] = np.cumsum((data[at].astype(np.uint64) + np.uint64(1)) * weights[np.maximum(at - begin, 0)]) + out[i]
    return out


class Suffixes:
    """Suffixes of a byte array, each with an end and none in another, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = np.append(data, np.uint8(0)), start, size
        self.prefix = suffix_hashes(data, start)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of common extensions, by binary search over their bits."""
        p, q, limit = self.start[x], self.start[y], np.minimum(self.size[x], self.size[y])
        out = np.zeros(len(x), np.int64)
        for bit in reversed(range(int(limit.max(initial=0)).bit_length())):
            step = out + (1 << bit)
            fits = step <= limit
            step = np.where(fits, step, out)
            a, b, c, d = p + out, p + step, q + out, q + step
            same = self.prefix[b] - self.prefix[a] == self.prefix[d] - self.prefix[c]  # as far from their starts
            out = np.where(fits & same, step, out)
        return out

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as x sorts before, with or after y; a prefix sorts first."""
        n = self.common(x, y)
        ends = (n == self.size[x]) | (n == self.size[y])
        byte = np.sign(self.data[self.start[x] + n].astype(np.int16) - self.data[self.start[y] + n])
        return np.where(ends, np.sign(self.size[x] - self.size[y]), byte)

    def sorted(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mergesort within each group (numbers in order): the order, and the
        common extension of each with the one before it, -1 for a group's first.
        Runs of all groups are merged at once; an element's place in a merged run
        is its place in its own run plus its rank in the other, found by binary
        search."""
        n = len(group)
        bounds = np.append(np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))), n)
        sizes = np.diff(bounds)
        begin, end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        order, run = np.arange(n), 1
        while run < sizes.max(initial=0):
            at = np.flatnonzero(end - begin > run)
            local = at - begin[at]
            block = local // run
            lo = np.minimum(begin[at] + (block ^ 1) * run, end[at])
            other, hi = lo.copy(), np.minimum(lo + run, end[at])
            while len(open_ := np.flatnonzero(lo < hi)):
                mid = (lo[open_] + hi[open_]) // 2
                sign = self.before(order[mid], order[at[open_]])
                right = (sign < 0) | ((sign == 0) & (block[open_] & 1 == 1))
                lo[open_] = np.where(right, mid + 1, lo[open_])
                hi[open_] = np.where(right, hi[open_], mid)
            place = begin[at] + (block & ~1) * run + (local - block * run) + (lo - other)
            merged = order.copy()
            merged[place] = order[at]
            order, run = merged, run * 2
        shared = np.full(n, -1, np.int64)
        later = np.flatnonzero(begin != np.arange(n))
        shared[later] = self.common(order[later - 1], order[later])
        if not self.verified(order, shared, later):
            return self.sorted_by_bytes(bounds)
        return order, shared

    def verified(self, order: np.ndarray, shared: np.ndarray, later: np.ndarray) -> bool:
        """Whether neighbours do agree in the bytes that their hashes say, and
        are in order by the first byte after those."""
        pairs = SLICE // max(1, int(shared.max(initial=1))) + 1
        for i in range(0, len(later), pairs):
            at = later[i : i + pairs]
            x, y, n = order[at - 1], order[at], shared[at]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            same = self.data[np.repeat(self.start[x], n) + step] == self.data[np.repeat(self.start[y], n) + step]
            short = n == self.size[x]
            rising = self.data[self.start[x] + n] < self.data[self.start[y] + n]
            if not (same.all() and (short | ((n < self.size[y]) & rising)).all()):
                return False
        return True

    def sorted_by_bytes(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same without hashes, for batches in which two hashes collided."""
        raw = [self.data[s : s + k].tobytes() for s, k in zip(self.start, self.size, strict=True)]
        order = np.concatenate([np.array(sorted(range(a, b), key=raw.__getitem__)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        shared = np.full(len(raw), -1, np.int64)
        for i in sorted(set(range(len(raw))) - set(bounds.tolist())):
            x, y = raw[order[i - 1]], raw[order[i]]
            shared[i] = next((j for j in range(min(len(x), len(y))) if x[j] != y[j]), min(len(x), len(y)))
        return order, shared


def repeated_windows(group: np.ndarray, copies: np.ndarray, lo: np.ndarray, hi: np.ndarray, contexts: list[bytes], length: int) -> np.ndarray:
    """(context number, least, largest distance before the anchor) of all runs of
    windows that another context of the group holds too, or a copy of their own."""
    size = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    start = np.cumsum(size) - size
    anchor = start + hi
    right, agree_right = Suffixes(data, anchor, size - hi).sorted(group)
    left, agree_left = Suffixes(data[::-1], len(data) - anchor, hi).sorted(group)
    n = len(size)
    known = (copies > 1)[:, None] & np.ones((1, length - GRAM + 1), bool)
    class_right, class_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(lo.min(initial=0)), int(hi.max(initial=-1)) + 1):
        # Windows that begin o bytes before the anchor agree if o bytes do on its left and the rest on its right.
        class_right[right] = np.cumsum(agree_right < length - o)
        class_left[left] = np.cumsum(agree_left < o)
        valid = np.flatnonzero((lo <= o) & (o <= hi))
        _, back, count = np.unique(class_right[valid] * (n + 1) + class_left[valid], return_inverse=True, return_counts=True)
        known[valid[count[back] > 1], o] = True
    o = np.arange(known.shape[1])
    known &= (lo[:, None] <= o) & (o <= hi[:, None])
    edge = np.diff(np.pad(known, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (which, first), (_, last) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    return np.stack([which, first, last - 1], 1)


# --- Spark jobs --------------------------------------------------------------------


def packed(docs: DataFrame, id_type: str | None) -> DataFrame:
    """([id, ]text, text_, zipped): the compressed bytes of ``_text`` and their name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("_text"), CHUNK_BYTES):
                each = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                names = text_names(data, offsets)
                columns = [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([zip_.compress(x.tobytes()) for x in each], pa.binary())]
                if id_type:
                    columns.insert(0, batch.column("_id").slice(row, end - row))
                yield pa.RecordBatch.from_arrays(columns, ["_id"] * bool(id_type) + [*TEXT, "zipped"])

    return map_batches(docs, run, f"_id {id_type}, " * bool(id_type) + "text long, text_ long, zipped binary")


def _unzip(value: pa.Scalar, unzip: zstandard.ZstdDecompressor) -> bytes:
    return unzip.decompress(value.as_py())


def contexts_of(texts: DataFrame, length: int) -> DataFrame:
    """(gram, context, copies, lo, hi, bytes) of (zipped, wanted): the bytes of each wanted context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for zipped, wanted in zip(batch.column(0), batch.column(1), strict=True):
                text, w = _unzip(zipped, unzip), wanted.values
                at = w.field("at").to_numpy()
                q, lo, hi = at >> 20, (at >> 10) & 1023, at & 1023
                cut = [text[a - h : a - low + length] for a, low, h in zip(q.tolist(), lo.tolist(), hi.tolist(), strict=True)]
                columns = [w.field("gram"), w.field("context"), w.field("copies"), pa.array(lo), pa.array(hi), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "context", "copies", "lo", "hi", "bytes"])

    return map_batches(texts.select("zipped", "wanted"), run, "gram long, context long, copies long, lo long, hi long, bytes binary")


def sorted_groups(contexts: DataFrame, length: int) -> DataFrame:
    """(gram, context, least, most): a task sorts whole groups, some at a time."""

    def result(rows: pa.Table) -> pa.RecordBatch:
        c = {n: rows[n].to_numpy() for n in ("gram", "context", "copies", "lo", "hi")}
        found = repeated_windows(c["gram"], c["copies"], c["lo"], c["hi"], rows["bytes"].to_pylist(), length)
        which = found[:, 0]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (c["gram"][which], c["context"][which], found[:, 1], found[:, 2])], ["gram", "context", "least", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while held.nbytes > CHUNK_BYTES:  # the last group may go on in the next batch
                gram = held["gram"].to_numpy()
                ends = np.flatnonzero(gram[1:] != gram[:-1]) + 1
                if not len(ends):
                    break
                per_row = held.nbytes // held.num_rows + 1
                cut = int(ends[max(np.searchsorted(ends, CHUNK_BYTES // per_row, "right") - 1, 0)])
                yield result(held.slice(0, cut).combine_chunks())
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield result(held)

    return map_batches(contexts.repartition("gram").sortWithinPartitions("gram"), run, "gram long, context long, least long, most long")


def counted_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size: each window is a row with a 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, context, copies, lo, hi, raw in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                n = hi - lo + 1
                digests = [hashlib.blake2b(raw[hi - o : hi - o + length], digest_size=16).digest() for o in range(lo, hi + 1)]
                columns = [pa.array([x] * n, pa.int64()) for x in (gram, context, copies)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(range(lo, hi + 1), pa.int64()), pa.array(digests, pa.binary())], ["gram", "context", "copies", "o", "window"])

    rows = map_batches(contexts, run, "gram long, context long, copies long, o long, window binary")
    often = rows.groupBy("window").agg(F.sum("copies").alias("all")).where(F.col("all") > 1)
    return rows.join(often, "window").select("gram", "context", F.col("o").alias("least"), F.col("o").alias("most"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept]), a row per input row.

    Every byte goes that is covered by a string of ``length`` bytes which also
    begins at another place of any row, the same row included.  Repeated rows
    are such places.  ``n_spans`` counts the maximal removed runs; ``kept`` are
    the remaining bytes (cuts may fall within a character).  Null text counts as
    empty, and texts shorter than ``length`` stay whole.  Null or repeated ids do
    not matter; other columns are ignored.
    """
    if not GRAM <= length < 1024:
        raise ValueError(f"length must be at least {GRAM} and below 1024")
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    seen = found_anchors(texts, length)
    grams = seen.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("a"), F.max("context").alias("b")).where("n > 1")
    grams = written(grams.select("gram", (F.col("a") != F.col("b")).alias("mixed")), "grams")
    repeated = written(seen.join(grams, "gram"), "anchors")
    place, lo, hi = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023), F.col("at").bitwiseAND(1023)
    whole = repeated.where(~F.col("mixed")).select(*TEXT, (place - hi).alias("start"), (place - lo + length).alias("end"))

    # One example of each different context, and the size of its group.
    mixed = repeated.where("mixed")
    example = mixed.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*TEXT, "at")).alias("e"))
    wanted = example.groupBy("e.text", "e.text_").agg(F.collect_list(F.struct("gram", "context", "copies", F.col("e.at").alias("at"))).alias("wanted"))
    # Copies of one text have one name; the first of them serves.
    source = packed(texts.select("_text"), None).join(wanted, TEXT).groupBy(*TEXT).agg(F.first("zipped").alias("zipped"), F.first("wanted").alias("wanted"))
    contexts = written(contexts_of(source, length), "contexts")
    sizes = written(contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("different")).where(F.col("different") > group).select("gram"), "large")
    ranges = sorted_groups(contexts.join(sizes, "gram", "left_anti"), length).unionByName(counted_windows(contexts.join(sizes, "gram", "left_semi"), length))
    ranges = written(ranges, "ranges")
    partly = mixed.join(ranges, ["gram", "context"]).select(*TEXT, (place - F.col("most")).alias("start"), (place - F.col("least") + length).alias("end"))
    spans = whole.unionByName(partly).distinct().groupBy(*TEXT).agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for zipped, each in zip(batch.column(1), batch.column(2), strict=True):
                text = _unzip(zipped, unzip)
                kept, at, removed, n = [], 0, 0, 0
                if each.is_valid:
                    pairs = sorted(zip(each.values.field("start").to_pylist(), each.values.field("end").to_pylist(), strict=True))
                    for a, b in pairs:
                        if not n or a > at:
                            kept.append(text[at:a])
                            n += 1
                            removed += b - a
                            at = b
                        elif b > at:
                            removed += b - at
                            at = b
                kept.append(text[at:])
                left = b"".join(kept)
                out.append((len(text), removed, n, hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_kept]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept])

    schema = f"`{id_col}` {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    told = packed(texts, id_type).join(written(spans, "spans"), TEXT, "left")
    return map_batches(told.select("_id", "zipped", "spans"), run, schema)


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


#: All windows, those that occur twice, their overlaps as spans, and what lies between.
OP4_SQL = f"""
with b as (select doc_id, encode(coalesce(text, '')) as b from documents),
w as (select doc_id, i, b[i + 1 : i + {LENGTH}] as w
      from (select doc_id, b, unnest(range(0, octet_length(b) - {LENGTH - 1})) as i from b)),
dup as (select doc_id, i from (select doc_id, i, count(*) over (partition by w) as n from w) where n > 1),
stepped as (select doc_id, i, i > lag(i, 1, -{LENGTH + 1}) over (partition by doc_id order by i) + {LENGTH} as first from dup),
numbered as (select doc_id, i, sum(first::int) over (partition by doc_id order by i) as span from stepped),
spans as (select doc_id, span, min(i) as a, max(i) + {LENGTH} as z from numbered group by all),
gaps as (select doc_id, a, z, lag(z, 1, 0) over (partition by doc_id order by a) as after from spans),
cut as (select doc_id, count(*) as n_spans, sum(z - a) as n_removed, max(z) as tail,
               string_agg(hex(b[after + 1 : a]), '' order by a) as kept
        from gaps join b using (doc_id) group by doc_id)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, '') || hex(b[coalesce(tail, 0) + 1 : octet_length(b)]))) as kept_sha256
from b left join cut using (doc_id)
"""
