"""Document quality by Bradley-Terry pairwise ranking.

Each text is described by a few shares and lengths.  From a bounded sample of
labelled rows, pairs (a document of label 1, one of label 0) are drawn, and
weights are learnt by logistic loss on the differences of their features: under
the Bradley-Terry model the better one of a pair wins with probability
sigmoid(score difference).  The cut between good and bad is a quantile of the
sample's scores, that of the share of label 0; scores are shifted so that the
cut lies at the wanted probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_per_text, map_batches, quoted, table, text_chunks, word_hashes, written

#: Labelled rows to fit on at most (those of the smallest hash of their id),
#: pairs drawn for each row of label 0, weight of the penalty, and score of the cut.
SAMPLE, PAIRS, RIDGE, CUT = 20_000, 20, 1e-3, 0.3

_KIND = np.full(256, 4, np.uint8)  # 0 letter, 1 capital, 2 digit, 3 space, 4 sign
_KIND[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 3
_COMMON_SIGN = np.zeros(256, bool)
_COMMON_SIGN[np.frombuffer(b".,", np.uint8)] = True


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers for each text of a chunk; zeros for a text without words."""
    n = len(offsets) - 1
    start, end, hashed, doc = word_hashes(data, offsets)
    words = np.bincount(doc, minlength=n).astype(float)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    per_word = np.maximum(words, 1)
    text = np.repeat(np.arange(n), np.diff(offsets))
    kind = np.bincount(text * 5 + _KIND[data], minlength=5 * n).reshape(n, 5)
    length = (end - start).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=mask, minlength=n) / per_word

    again = np.zeros(len(start), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (doc[1:] == doc[:-1])
    sign_end = (_KIND[data[end - 1]] == 4) & ~_COMMON_SIGN[data[end - 1]] if len(end) else again
    bare = (length == 1) & (_KIND[data[start]] == 4) if len(end) else again
    capital = _KIND[data[start]] == 1 if len(end) else again
    kinds = np.bincount(distinct_per_text(hashed, doc)[1], minlength=n)
    lines = np.bincount(text, weights=data == 0x0A, minlength=n)
    stops = np.bincount(text, weights=_COMMON_SIGN[data], minlength=n)
    shares = [
        share(again),
        share(sign_end),
        share(bare),
        share(capital),
        share(length <= 2),
        share(length > 14),
        kind[:, 1] / size,
        kind[:, 2] / size,
        kind[:, 4] / size,
        stops / size,
        lines / per_word,
    ]
    columns = [
        *shares,
        *[np.sqrt(x) for x in shares],
        share(length) / 10,
        kinds / np.sqrt(per_word) / 10,
        np.log1p(words) / 10,
        np.log1p(kinds) / 10,
    ]
    return np.where(words[:, None] > 0, np.stack(columns, 1), 0.0)


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.shift, -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, cut: float = CUT) -> Ranking:
    """Newton's method on the mean logistic loss of the pairs' differences."""
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (0.0, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):  # nothing to rank: every text gets the middle
        return Ranking(mean, scale, w, 0.0)
    draw = np.random.default_rng(7)
    worse = np.repeat(bad, pairs)
    diff = z[draw.choice(good, len(worse))] - z[worse]
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))  # of the worse one winning
        grad = -(diff * p[:, None]).mean(0) + ridge * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = np.sort(z @ w)
    at = min(max(len(bad), 1), len(scores) - 1)
    edge = (scores[at - 1] + scores[at]) / 2
    return Ranking(mean, scale, w, float(np.log(cut / (1 - cut)) - edge))


def with_features(docs: DataFrame, kept: list[str], text_col: str, outputs: dict[str, str], make) -> DataFrame:
    """The columns ``kept`` of ``docs``, and ``outputs`` (name: type), which
    ``make`` gives as arrays for the features of a chunk of texts."""
    # Plain names on the way: mapInArrow takes no names with dots.
    plain = [f"c{i}" for i in range(len(kept))]
    schema = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(plain, kept, strict=True)], *[f"o{i} {t}" for i, t in enumerate(outputs.values())]])
    names = [*plain, *[f"o{i}" for i in range(len(outputs))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("text")):
                out = [batch.column(c).slice(row, end - row) for c in plain]
                yield pa.RecordBatch.from_arrays([*out, *make(features(data, offsets))], names)

    taken = [F.col(quoted(c)).alias(n) for n, c in zip(plain, kept, strict=True)]
    return map_batches(docs.select(*taken, F.col(text_col).alias("text")), run, schema).toDF(*kept, *outputs)


def rank(docs: DataFrame, labels: DataFrame, train, cut: float = CUT, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranking:
    """Fits on at most ``sample`` labelled rows, those of the smallest hash of
    their id.  Labels are cut down by that hash before anything is joined, so
    that about as many rows, and not as many from each task, reach the driver."""
    taught = labels.where(train(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    share = 1.2 * sample / max(taught.count(), 1) + 1e-6
    at = F.xxhash64(id_col) / F.lit(2.0**64) + F.lit(0.5)
    taught = written(taught.where(at < share).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")), "taught")
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(taught, "id")
    described = with_features(
        known, ["id", "label"], "text", {"x": "array<double>"}, lambda x: [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))]
    )
    chosen = described.orderBy(F.xxhash64("id"), "id").limit(sample).select("x", "label").toPandas()
    n = features(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape[1]
    return fit(np.array(chosen["x"].tolist(), float).reshape(len(chosen), n), chosen["label"].to_numpy(int), cut=cut)


def quality_scores(docs: DataFrame, labels: DataFrame, train, cut: float = CUT, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: list[str] | None = None, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """(id or the columns ``carry``, score, predicted), a row per input row;
    ``train`` says of an id column which labelled rows may be learnt from.

    Null and blank texts have the features zero and so all get one and the same
    score.  Rows with a null id or a null label teach nothing; repeated rows teach
    once each.  Without rows of both labels every score is 0.5.  Other columns
    are ignored; ``names`` are those of the two results.
    """
    model = rank(docs, labels, train, cut, sample, id_col, text_col, label_col)

    def told(x: np.ndarray) -> list[pa.Array]:
        score = model.score(x)
        return [pa.array(score), pa.array((score >= cut).astype(np.int32))]

    return with_features(docs, carry or [id_col], text_col, dict(zip(names, ("double", "int"), strict=True)), told)


def fold(id_col, parts: int):
    """crc32 of the id as text, modulo ``parts``; null ids count as 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % parts, F.lit(0))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda i: fold(i, 5) != 0)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
