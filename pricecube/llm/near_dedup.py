"""Near-duplicate groups of documents by MinHash, odd sketches and exact sets.

1. Each text's shingle set is hashed to a MinHash sample.  Rows of the sample
   make the keys of bands; the whole sample, folded into a bitmap by the parity
   of how often each bit is hit, is its odd sketch.  Texts of equal sets form
   one class at once.
2. Classes that share a band are candidates.  The symmetric difference of two
   samples is read off the population count of the XOR of their odd sketches;
   only pairs that may reach the similarity go on.  Candidates also have the
   parity bitmap of their whole set: its XOR never has more bits than the sets
   have differing shingles, so it rules out pairs without any error.
3. A bucket's members are first compared with its most central member only (a
   star).  What is then still in different components of one bucket is compared
   pair by pair, so no link is lost to the star, and no pair within a component
   is ever made.

A class whose own shingles (those that no other candidate has) leave too few to
reach the similarity with any set as large as the smallest of its buckets is
set aside before any pair is made.  That bound is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, UPPER, distinct_per_text, map_batches, mix, shingle_hashes, table, text_chunks, word_hashes, written
from .components import components

THRESHOLD = 0.75
#: Bands and rows of a band: a pair at the threshold is missed with probability
#: (1 - 0.75**4)**32, about 5e-6.
BANDS, ROWS = 32, 4
#: Bits of an odd sketch, and standard errors that its estimate is given.
BITS, ERRORS = 512, 6.0
#: Bits of the parity bitmap of a candidate's whole set.
SET_BITS = 2048
_draw = np.random.default_rng(2017)
_MUL = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def most_flips(threshold: float = THRESHOLD, samples: int = BANDS * ROWS, bits: int = BITS) -> int:
    """Differing bits that a pair at the threshold practically never exceeds."""
    differing = 2 * samples * (1 - threshold)
    mean = bits / 2 * (1 - math.exp(-2 * differing / bits))
    share = mean / bits
    spread = bits * share * (1 - share) + (2 * (1 - 2 * share)) ** 2 * samples * threshold * (1 - threshold)
    return math.ceil(mean + ERRORS * math.sqrt(spread))


def sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, first of each text, texts that have any, 16-byte keys of the sets)."""
    n = len(offsets) - 1
    _, _, hashed, doc = word_hashes(data, offsets)
    values, owner = distinct_per_text(*shingle_hashes(hashed, doc, n))
    has = np.flatnonzero(np.bincount(owner, minlength=n))
    first = np.searchsorted(owner, has)
    if not len(has):
        return values, first, has, np.zeros((0, 2), np.uint64)
    keys = [np.add.reduceat(mix(values ^ np.uint64(salt)), first) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return values, first, has, np.ascontiguousarray(np.stack(keys, 1))


def sample(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.stack([np.minimum.reduceat(values * m + a, first) for m, a in zip(_MUL, _ADD, strict=True)], 1)


def band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(len(minima), BANDS, ROWS)
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(minima), 1))
    for r in range(ROWS):
        out = mix(out ^ rows[:, :, r]) * np.uint64(0x9FB21C651E98DF25)
    return out


def parities(values: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """For each run of values, which begin at ``first``, the parity of how often
    each bit is hit, as 64-bit words."""
    bit = (mix(values ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    ends = np.append(first, len(values))
    out = np.zeros((len(first), bits // 64), np.uint64)
    for i in range(0, len(first), 1024):  # bounds the counters held at once
        at = ends[i : i + 1025]
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        hits = np.bincount(row * bits + bit[at[0] : at[-1]], minlength=(len(at) - 1) * bits)
        out[i : i + 1024] = np.packbits((hits & 1).astype(np.uint8).reshape(-1, bits), axis=1).view(np.uint64)
    return out


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Odd sketches of MinHash samples: a value counts with its place in the sample."""
    n, k = minima.shape
    return parities((minima ^ mix(np.arange(1, k + 1, dtype=np.uint64))).ravel(), np.arange(n) * k, BITS)


def _lists(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(matrix).view(np.int64).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, matrix.shape[1]).cast(pa.list_(pa.int64()))


def _binary(keys: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in keys], pa.binary())


def signatures(docs: DataFrame) -> DataFrame:
    """(id, ..., n, key, bands, sketch) of (id, ..., _text); null key without words."""
    fields = docs.drop("_text").schema.fields
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("_text")):
                values, first, has, keys = sets(data, offsets)
                size = np.zeros(end - row, np.int64)
                size[has] = np.diff(np.append(first, len(values)))
                at = np.full(end - row, -1)
                at[has] = np.arange(len(has))
                place = pa.array(at, mask=at < 0)  # take() gives null there
                minima = sample(values, first) if len(has) else np.zeros((0, BANDS * ROWS), np.uint64)
                out = [batch.column(f.name).slice(row, end - row) for f in fields]
                out += [pa.array(size)] + [c.take(place) for c in (_binary(keys), _lists(band_keys(minima)), _lists(odd_sketches(minima)))]
                yield pa.RecordBatch.from_arrays(out, [*[f.name for f in fields], "n", "key", "bands", "sketch"])

    return map_batches(docs, run, schema + "n long, key binary, bands array<long>, sketch array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(key, shingles, parity) of a ``_text`` column; texts without words give no
    row.  ``parity`` is the parity bitmap of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                values, first, _, keys = sets(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(values)), pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([_binary(keys), lists, _lists(parities(values, first, SET_BITS))], ["key", "shingles", "parity"])

    return map_batches(texts.select("_text"), run, "key binary, shingles array<long>, parity array<long>")


def may_link(n_a: Column, n_b: Column, shared: Column, threshold: float) -> Column:
    """Whether sets of these sizes with at most ``shared`` in common can be that
    similar: J = i / (n_a + n_b - i), so i >= t / (1 + t) * (n_a + n_b)."""
    return shared * F.lit(1 + threshold) >= F.lit(threshold) * (n_a + n_b)


def verified(pairs: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    a = found.select(F.col("key").alias("u"), F.col("shingles").alias("a"))
    b = found.select(F.col("key").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(a, "u").join(b, "v").where(F.lit(100) * both >= F.lit(round(100 * threshold)) * (F.size("a") + F.size("b") - both)).select("u", "v")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, ..., n_shingles, component_id, kept), a row per input row.

    Texts are linked if their sets of distinct five-word shingles have a Jaccard
    similarity of ``threshold`` or more; fewer words than five make one shingle.
    ``component_id`` is the smallest id that links reach, and that row is kept.
    Null and blank texts have no shingles, are linked with nothing and are kept.
    A null id is no smallest id unless the whole component has none (then null,
    and all its rows are kept); rows that share the smallest id are all kept if
    they are in that component.  ``carry`` adds columns made from ``docs`` that
    go through as they are; other columns are ignored.
    """
    carry = carry or {}
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[c.alias(n) for n, c in carry.items()])
    rows = written(signatures(texts), "signatures")
    classes = written(
        rows.where("key is not null").groupBy("key").agg(F.min("_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "classes",
    )
    banded = classes.select("key", "n", F.explode("bands").alias("band"))
    buckets = written(banded.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("least")).where("members > 1").drop("members"), "buckets")
    places = written(banded.join(buckets, "band"), "places")
    candidates = places.groupBy("key").agg(F.min("least").alias("least"))

    # The candidates' whole sets, one text for each class.
    wanted = written(candidates.join(classes.select("key", "id", "n"), "key"), "candidates")
    ids = wanted.select("id").distinct()
    found = written(
        shingle_sets(texts.join(ids, texts["_id"].eqNullSafe(ids["id"]), "left_semi"))
        .join(wanted.select("key"), "key", "left_semi")
        .dropDuplicates(["key"]),
        "sets",
    )
    # Shingles that no other candidate has.
    alone = (
        found.select(F.xxhash64("key").alias("short"), F.explode("shingles").alias("s"))
        .groupBy("s")
        .agg(F.count(F.lit(1)).alias("df"), F.min("short").alias("short"))
        .where("df = 1")
        .groupBy("short")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    facts = ["n", "common", "sketch", "parity"]
    smallest = F.greatest("least", F.lit(threshold) * F.col("n"))
    linkable = written(
        wanted.withColumn("short", F.xxhash64("key"))
        .join(alone, "short", "left")
        .withColumn("common", F.col("n") - F.coalesce("own", F.lit(0)))
        .where(may_link(F.col("n"), smallest, F.col("common"), threshold))
        .join(classes.select("key", "sketch"), "key")
        .join(found.select("key", "parity"), "key")
        .select("key", *facts),
        "linkable",
    )
    members = written(places.select("band", "key").join(linkable, "key"), "members")

    def differing(name: str) -> Column:
        words = F.zip_with(name, f"_{name}", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        return F.aggregate(words, F.lit(0), lambda total, x: total + x)

    both = F.col("n") + F.col("_n")
    alike = (
        may_link(F.col("n"), F.col("_n"), F.least(F.col("common"), F.col("_common")), threshold)
        & (F.least(F.col("n"), F.col("_n")) >= F.lit(threshold) * F.greatest(F.col("n"), F.col("_n")))
        & (differing("sketch") <= most_flips(threshold))
        & (differing("parity") * F.lit(1 + threshold) <= F.lit(1 - threshold) * both)
    )
    apart = (F.lit(1) - F.col("common") / F.col("n")).alias("apart")
    star = members.groupBy("band").agg(F.min(F.struct(apart, "key", *facts)).alias("h"), F.count(F.lit(1)).alias("m"))
    star = written(star.where("m > 1").select("band", *[F.col(f"h.{c}").alias(f"_{c}") for c in ("key", *facts)]), "stars")
    pairs = members.join(star, "band").where((F.col("key") != F.col("_key")) & alike).select(F.col("key").alias("u"), F.col("_key").alias("v")).distinct()
    links = written(verified(pairs, found, threshold), "links")
    first = written(components(links), "components")

    # What is left in several components of one bucket, pair by pair.
    labelled = members.join(first, members["key"] == first["node"], "left").withColumn("component", F.coalesce("component", "key")).drop("node")
    labelled = written(labelled, "labelled")
    central = labelled.select(F.col("key").alias("_key"), F.col("band"), F.col("component").alias("of")).join(star.select("band", "_key"), ["band", "_key"]).drop("_key")
    outside = labelled.join(central, "band").where("component <> of").drop("of")
    other = labelled.select("band", *[F.col(c).alias(f"_{c}") for c in ("key", *facts, "component")])
    rest = (
        outside.join(other, "band")
        .where((F.col("component") != F.col("_component")) & alike)
        .select(F.least("key", "_key").alias("u"), F.greatest("key", "_key").alias("v"))
        .distinct()
        .join(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), ["u", "v"], "left_anti")
    )
    more = written(verified(rest, found, threshold), "links")
    whole = written(components(links.unionByName(more)), "components")

    named = classes.select("key", "id").join(whole.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    smallest_id = named.groupBy("component").agg(F.min("id").alias("component_id"))
    told = written(named.join(smallest_id, "component").select("key", "component_id"), "told")
    out = rows.select("_id", *carry, "n", "key").join(told, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("_id").alias(id_col),
        *carry,
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Classes of equal sets, their shared shingles counted pair by pair, and all that links reach.
OP8_SQL = f"""
with recursive t as (
  select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACES}') if x <> ''] as w from documents
),
s as (
  select doc_id, case when len(w) >= 5 then list_sort(list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from t
),
classes as (select min(doc_id) as k, s, len(s) as n from s where len(s) > 0 group by s),
members as (select doc_id, k, len(s.s) as n_shingles from s left join classes c on s.s = c.s),
shingles as (select k, n, unnest(s) as x from classes),
links as (
  select a.k as u, b.k as v from shingles a join shingles b on a.x = b.x and a.k < b.k and 100 * a.n >= 75 * b.n and 100 * b.n >= 75 * a.n
  group by a.k, b.k, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
edges as (select u, v from links union all select v, u from links),
reach(k, r) as (select k, k from classes union select reach.k, edges.v from reach join edges on reach.r = edges.u),
least as (select k, min(r) as component_id from reach group by k)
select doc_id, n_shingles, coalesce(component_id, doc_id) as component_id, doc_id = coalesce(component_id, doc_id) as kept
from members left join least using (k)
"""
