"""Sparse statistical hypercubes: decode documents into flat observations.

A document holds an ordered list of dimension ids, their sizes, per dimension
a ``category.index`` map (code -> position) and ``category.label`` map
(code -> label), and a sparse ``value`` map whose keys are flat row-major
indexes written as text.  Missing cells are absent.

Decoding is pure Catalyst (higher-order functions, no Python rows):

* once for each document, in a projection *below* the explode of its values:
  the strides ``stride[k] = product(size[k+1:])`` and, for each dimension, an
  array of (code, label) by position;
* for each cell only arithmetic and array access:
  ``pos[k] = (i div stride[k]) mod size[k]``, then the entry at that position
  (defaults: code ``pos{n}``, label ``''``).

A document is one row, so its explode runs in one task: land many documents
(per dataset and country) for parallelism, pass ``partitions`` to spread
the decoded rows before heavy downstream work, and read a document that is too
large for a task with ``split.split_decode``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecube.constants import DATASETS
from pricecube.schemas import CUBE
from pricecube.sources import documents

CUBE_DIMS = ["freq", "siec", "nrg_cons", "unit", "tax", "currency", "geo", "time"]


def read_cube_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed documents, one a file (however laid out) or one a line; reading a
    broken one fails with its path (``documents.store_documents`` sets it aside).

    Folders named ``dataset=<code>`` become a ``dataset`` column.  ``multi_line=True``
    takes each file for one document without looking for documents on lines.
    """
    found = documents.whole_only(documents.read_documents(spark, path, "whole" if multi_line else "auto"))
    return found.drop("path", "number")


def parse_cube(text: Column) -> Column:
    """JSON text -> cube struct (string keys stay text; cast when decoding)."""
    return F.from_json(text, CUBE)


def strides(size: Column) -> Column:
    """Row-major strides as ARRAY<BIGINT>: suffix products of ``size``."""
    n = F.size(size)
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda k: F.aggregate(
                F.slice(size, k + 1, n - k), F.lit(1).cast("bigint"), lambda acc, x: acc * x.cast("bigint")
            ),
        )
    )


# What is worked out for each document and dimension is SQL text: one expression to
# parse for a dimension, where columns built piece by piece make planning the dearest part.


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for the value, which is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _by_position(category: str, size: str) -> str:
    """ARRAY<STRUCT<code, label>> indexed by position, below ``size``.

    Of two codes on one position the later one counts.  Positions without a
    code are NULL, codes without a label have label ''.
    """
    index = f"coalesce(map_entries({category}.index), cast(array() as array<struct<key:string,value:int>>))"
    label = f"coalesce({category}.label, cast(map() as map<string,string>))"
    placed = f"filter(transform({index}, (e, i) -> named_struct('code', e.key, 'p', e.value, 'i', i)), e -> e.p >= 0 and e.p < {size})"
    # Maps are searched from their start, so where both maps have the same
    # codes they are sorted and zipped instead.
    zipped = "zip_with(codes, known, (e, k) -> named_struct('p', e.p, 'i', e.i, 'code', e.code, 'label', k.value))"
    searched = f"transform(codes, e -> named_struct('p', e.p, 'i', e.i, 'code', e.code, 'label', try_element_at({label}, e.code)))"
    labelled = f"case when transform(codes, e -> e.code) = transform(known, e -> e.key) then {zipped} else {searched} end"
    labelled = _let("codes", f"array_sort({placed})", _let("known", f"array_sort(map_entries({label}))", labelled))
    last = "filter(entries, (e, i) -> coalesce(get(entries, i + 1).p <> e.p, true))"
    out = "transform(found, e -> named_struct('code', e.code, 'label', coalesce(e.label, '')))"
    top, gaps = "element_at(found, -1).p", f"map_from_arrays(transform(found, e -> e.p), {out})"
    dense = f"case when size(found) = 0 or {top} = size(found) - 1 then {out} else transform(sequence(0, {top}), at -> try_element_at({gaps}, at)) end"
    return _let("entries", f"array_sort({labelled})", _let("found", last, dense))


def document_dims(docs: DataFrame, doc_col: str = "doc") -> list[str]:
    """All dimension ids that the documents list: the known ones first, then the
    others by name.  One job; its result has a row for each different id."""
    ids = docs.select(F.explode(F.col(doc_col)["id"]).alias("id")).distinct()
    found = {r.id for r in ids.collect() if r.id is not None}
    return [d for d in CUBE_DIMS if d in found] + sorted(found - set(CUBE_DIMS))


def listing_only(docs: DataFrame, dims: Sequence[str], doc_col: str = "doc") -> DataFrame:
    """``docs``, failing on a document that lists a dimension outside ``dims``: its
    cells would come as rows that differ in nothing but the value."""
    ids = F.col(doc_col)["id"]
    fails = F.raise_error(
        F.concat(F.lit(f"a document lists dimensions outside {', '.join(dims)}: "), F.array_join(F.array_except(ids, F.array(*[F.lit(d) for d in dims])), ", "))
    )
    other = F.coalesce(F.exists(ids, lambda d: ~d.isin(list(dims))), F.lit(False))
    return docs.where(F.when(other, fails.cast("boolean")).otherwise(F.lit(True)))


def decode(
    docs: DataFrame,
    dims: Sequence[str] | None = None,
    doc_col: str = "doc",
    value_col: str = "value",
    carry: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per observed cell: ``<dim>``, ``<dim>_label`` for each dimension
    (NULL when a document lacks it), the value, and the ``carry`` columns of the
    document row.  Without ``dims`` all dimensions that the documents list are
    decoded; a stream, which cannot look ahead, decodes ``CUBE_DIMS`` then and fails
    on a document that lists others.

    A flat index past the end wraps by modulo, as row-major unravelling does.
    """
    carry = [c for c in (carry if carry is not None else docs.columns) if c != doc_col]
    if dims is None:
        dims = CUBE_DIMS if docs.isStreaming else document_dims(docs, doc_col)
        docs = listing_only(docs, dims, doc_col) if docs.isStreaming else docs
    looked_up = lookups(docs, dims, carry, [F.col(doc_col)["value"].alias("_cells")], doc_col)
    exploded = looked_up.select(*[c for c in looked_up.columns if c != "_cells"], F.explode("_cells").alias("_key", value_col))
    out = positioned(exploded, dims, carry, value_col)
    if partitions:
        # hash on the full cell coordinates: even spread, deterministic on retry
        out = out.repartition(partitions, *carry, *dims)
    return out


def lookups(docs: DataFrame, dims: Sequence[str], carry: Sequence[str], more: Sequence[Column] = (), doc_col: str = "doc") -> DataFrame:
    """For each document ``carry``, its size, stride and (code, label) by position of each
    dimension, and ``more``."""
    per_doc: list[Column] = []
    for k, d in enumerate(dims):
        at = f"cast(array_position(`{doc_col}`.id, {_text(d)}) as int)"
        size = f"get(`{doc_col}`.size, {at} - 1)"
        stride = f"aggregate(slice(`{doc_col}`.size, {at} + 1, size(`{doc_col}`.size) - {at}), 1L, (product, n) -> product * n)"
        entries = _by_position(f"`{doc_col}`.dimension[{_text(d)}].category", size)
        for name, value in ((f"_size{k}", f"cast({size} as bigint)"), (f"_stride{k}", stride), (f"_at{k}", entries)):
            per_doc.append(F.expr(f"case when {at} > 0 then {value} end").alias(name))
    return docs.select(*carry, *per_doc, *more)


def positioned(cells: DataFrame, dims: Sequence[str], carry: Sequence[str], value_col: str) -> DataFrame:
    """Codes and labels of cells (``_key`` is the flat index) with their document's lookups."""
    out_cols: list[Column] = [F.col(c) for c in carry]
    for k, d in enumerate(dims):
        pos = f"pmod(cast(_key as bigint) div _stride{k}, _size{k})"
        entry = f"get(_at{k}, cast({pos} as int))"
        out_cols.append(F.expr(f"case when _size{k} is not null then coalesce({entry}.code, concat('pos', {pos})) end").alias(d))
        out_cols.append(F.expr(f"case when _size{k} is not null then coalesce({entry}.label, '') end").alias(f"{d}_label"))
    return cells.select(*out_cols, F.col(value_col))


def dimensions(docs: DataFrame, doc_col: str = "doc", carry: Sequence[str] | None = None) -> DataFrame:
    """(carry..., ordinal, dimension, position, code, label) for every category."""
    carry = [c for c in (carry if carry is not None else docs.columns) if c != doc_col]
    doc = F.col(doc_col)
    dims = docs.select(*carry, doc["dimension"].alias("_dim"), F.posexplode(doc["id"]).alias("_ord", "dimension"))
    cats = dims.select(
        *carry,
        (F.col("_ord") + 1).alias("ordinal"),
        "dimension",
        F.col("_dim")[F.col("dimension")]["category"].alias("_cat"),
    ).select(*carry, "ordinal", "dimension", "_cat", F.explode(F.col("_cat")["index"]).alias("code", "position"))
    return cats.select(
        *carry,
        "ordinal",
        "dimension",
        "position",
        "code",
        F.coalesce(F.try_element_at(F.col("_cat")["label"], F.col("code")), F.lit("")).alias("label"),
    )


def stride_table(docs: DataFrame, doc_col: str = "doc", carry: Sequence[str] | None = None) -> DataFrame:
    """(carry..., ordinal, dimension, size, stride) for every dimension."""
    carry = [c for c in (carry if carry is not None else docs.columns) if c != doc_col]
    doc = F.col(doc_col)
    z = docs.select(
        *carry,
        F.arrays_zip(doc["id"].alias("dimension"), doc["size"].alias("size"), strides(doc["size"]).alias("stride")).alias("_z"),
    )
    return z.select(*carry, F.posexplode("_z").alias("_ord", "_e")).select(
        *carry,
        (F.col("_ord") + 1).alias("ordinal"),
        F.col("_e")["dimension"].alias("dimension"),
        F.col("_e")["size"].alias("size"),
        F.col("_e")["stride"].alias("stride"),
    )


def encode(
    cells: DataFrame,
    doc_keys: Sequence[str],
    dims: Sequence[str],
    value: str,
    label_cols: Mapping[str, str] | None = None,
) -> DataFrame:
    """Build one cube document per ``doc_keys`` group from flat cells.

    One shuffle: a document's cells meet in its row, and its codes are sorted and
    numbered there, dimension by dimension.  A document holds only its own cells, so
    its size is bounded by its dimensions' extents.
    """
    label_cols = dict(label_cols or {})
    cell = [F.col(value).alias("v")]
    for k, d in enumerate(dims):
        label = F.col(label_cols[d]) if d in label_cols else F.lit("")
        cell.append(F.struct(F.col(d).alias("code"), label.alias("label")).alias(f"d{k}"))
    held = cells.groupBy(*doc_keys).agg(F.collect_list(F.struct(*cell)).alias("_cells"))
    numbers = range(len(dims))
    held = held.selectExpr("*", *[f"array_sort(array_distinct(transform(_cells, c -> c.d{k}))) as _codes{k}" for k in numbers])
    positions = [f"map_from_entries(transform(_codes{k}, (e, i) -> struct(e.code, i))) as _at{k}" for k in numbers]
    sizes = f"array({', '.join(f'size(_codes{k})' for k in numbers)}) as _size"
    held = held.selectExpr("*", *positions, sizes).withColumn("_stride", strides(F.col("_size")))
    flat = " + ".join(f"cast(try_element_at(_at{k}, c.d{k}.code) as bigint) * get(_stride, {k})" for k in numbers)
    labels = [f"map_from_entries(transform(_codes{k}, e -> struct(e.code, e.label)))" for k in numbers]
    categories = [f"{_text(d)}, named_struct('category', named_struct('index', _at{k}, 'label', {labels[k]}))" for k, d in enumerate(dims)]
    doc = ", ".join([
        f"'id', array({', '.join(map(_text, dims))})",
        "'size', _size",
        f"'dimension', map({', '.join(categories)})",
        f"'value', map_from_entries(transform(_cells, c -> struct(cast({flat} as string), c.v)))",
    ])
    return held.select(*doc_keys, F.expr(f"named_struct({doc})").alias("doc"))


def dataset_label(dataset: Column, mapping: Mapping[str, str] = DATASETS) -> Column:
    """Dataset code -> consumer type label (literal map, NULL on a miss)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(m, dataset)


def dataset_code(label: Column, mapping: Mapping[str, str] = DATASETS) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv[::-1]])
    return F.try_element_at(m, label)
