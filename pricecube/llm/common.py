"""Small helpers that several corpus operators share."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pricecube
from pricecube.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Java regex of the characters between words.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Words in a shingle.
SHINGLE = 5
#: Bytes of text that a task holds as numpy arrays at once (more for one longer text).
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_made: ContextVar[list[str] | None] = ContextVar("scratch tables", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts the lineage, is
    computed once, and has a size that Spark knows when it picks a join."""
    path = scratch_path(df.sparkSession, name)
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that ``written`` made within it.  What is to
    outlast it must be a table of its own that was begun outside, or collected."""
    before = _made.set(made := [])
    try:
        yield
    finally:
        _made.reset(before)
        drop(spark, made)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders by Spark's own file systems."""
    sc = spark.sparkContext
    for name in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: Callable[[], DataFrame], spark: SparkSession, name: str) -> tuple[DataFrame, str]:
    """What ``df()`` gives as a table in the shared scratch folder, and its path; the
    tables that were made on the way are gone."""
    path = scratch_path(spark, name)
    with scratch(spark):
        result = df()
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path), path


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of the shared folder and the path in it."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once an application:
    they need not have the driver's Python path."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        packed, root = io.BytesIO(), Path(pricecube.__file__).parent
        with zipfile.ZipFile(packed, "w") as z:
            for source in sorted(root.rglob("*.py")):
                z.write(source, source.relative_to(root.parent))
        name = f"{scratch_path(spark, 'package')}/pricecube.zip"
        path = sc._jvm.org.apache.hadoop.fs.Path(name)  # any scheme that Spark knows
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        out.write(packed.getvalue())
        out.close()
        sc.addPyFile(name)
        _shipped.add(sc.applicationId)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by their names, whatever characters those hold."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fold_ascii(text: Column) -> Column:
    """Null as empty, A-Z in lower case, all else as it is.  ``lower`` does just
    that to pure ASCII and is much faster than ``translate``."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def words(text: Column) -> Column:
    """The array of folded words; empty for null and for blank text."""
    return F.filter(F.split(fold_ascii(text), SPACES), lambda w: w != "")


# --- whole batches of texts as numpy arrays ---------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2**64, and their inverses."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = [
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))))
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``p`` with one more entry than ``data``: polynomial hashes of all prefixes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end), alike for equal bytes anywhere."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def text_chunks(column: pa.ChunkedArray | pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, UTF-8 bytes, offsets) of runs of whole texts of
    at most ``max_bytes``, or of one longer text.  Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, at, buf = column.buffers()
    offsets = np.frombuffer(at, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


#: Words of more bytes are digested: there are different texts of some hundred bytes and
#: more that have one polynomial hash modulo 2**64, whatever the base.
LONG_WORD = 64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, folded hashes and text numbers of all words in a chunk."""
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([True], space[:-1])) if len(data) else space
    start = np.flatnonzero(~space & (before | first[:-1]))
    after = np.concatenate((space[1:], [True])) if len(data) else space
    end = np.flatnonzero(~space & (after | first[1:])) + 1
    folded = _FOLD[data]
    hashed = mix(range_hashes(prefix_hashes(folded), start, end) + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > LONG_WORD):
        hashed[i] = int.from_bytes(hashlib.blake2b(folded[start[i] : end[i]], digest_size=8).digest(), "little")
    return start, end, hashed, np.searchsorted(offsets, start, "right") - 1


def shingle_hashes(hashed: np.ndarray, doc: np.ndarray, n_docs: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of a text, and their text numbers.  A
    text of fewer words gives its whole sequence; one without words, nothing."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    out, owner = [], []
    for k in range(1, size + 1):
        if k == size:
            at = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, int)
        else:
            at = first[count == k]
        if not len(at):
            continue
        h = np.full(len(at), k, np.uint64)
        for j in range(k):
            h = (h ^ hashed[at + j]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        out.append(mix(h))
        owner.append(doc[at])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def distinct_per_text(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, value) pairs, sorted."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], owner[keep]
