"""Types of text columns, from all their values in one pass.

Every type is a candidate until a value does not fit it.  A value's misfits are the bits
of a number, a column's are their bitwise OR: one aggregate with a fixed buffer of eight
bytes a column, combined in the tasks, the same in whatever order and however often rows
are counted.  So it can be gathered while the rows are written (``load_detected``), and
no row is left to a sample.

A column has the first type of ``TYPES`` that all its values fit, text if there is none
or no value at all.  Empty fields are NULL and fit everything.  Spaces around numbers and
dates do not count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricecube.sources.files import FAITHFUL

_WHOLE = r"^-?(0|[1-9]\d*)$"
_NUMBER = r"^-?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_CLOCK = r"\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"


def _dated(v: Column, pattern: str, year: int, month: int, day: int) -> Column:
    return F.when(v.rlike(pattern), F.regexp_replace(v, pattern, f"${year}-${month}-${day}").try_cast("date"))


def _ymd(v: Column) -> Column:
    return _dated(v, r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", 1, 2, 3)


def _dmy(v: Column) -> Column:
    return _dated(v, r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$", 3, 2, 1)


def _mdy(v: Column) -> Column:
    return _dated(v, r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$", 3, 1, 2)


def _boolean(v: Column) -> Column:
    word = F.lower(v)
    return F.when(word.isin("true", "t", "yes"), F.lit(True)).when(word.isin("false", "f", "no"), F.lit(False))


def _double(v: Column) -> Column:
    return F.when(v.rlike(_NUMBER) | (F.lower(v) == "nan"), v.try_cast("double"))


def _moment(zone: str, kind: str):
    return lambda v: F.when(v.rlike(rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[ T]{_CLOCK}{zone}$"), v.try_cast(kind))


#: (name, Spark's type, the value of a text, NULL where it does not fit), from the narrowest on.
TYPES = [
    ("BOOLEAN", "boolean", _boolean),
    ("BIGINT", "bigint", lambda v: F.when(v.rlike(_WHOLE), v.try_cast("bigint"))),
    ("HUGEINT", "decimal(38,0)", lambda v: F.when(v.rlike(_WHOLE), v.try_cast("decimal(38,0)"))),
    ("DOUBLE", "double", _double),
    ("DATE", "date", _ymd),
    ("DATE", "date", _dmy),
    ("DATE", "date", _mdy),
    ("TIMESTAMP", "timestamp_ntz", _moment("", "timestamp_ntz")),
    ("TIMESTAMP WITH TIME ZONE", "timestamp", _moment(r"(Z|[+-]\d{2}(:?\d{2})?)", "timestamp")),
]
TEXT = "VARCHAR"
_ALL = (1 << len(TYPES)) - 1
_BOOLEAN, _BIGINT, _HUGEINT, _DOUBLE, _YMD, _DMY, _MDY, _MOMENT, _ZONED = range(len(TYPES))


def _misfits(v: Column) -> Column:
    """The misfits of one value.  Its first character and signs say which few types it may
    fit, and only those are tried; a value of the group's narrowest type is not tried
    further, as it fits the wider ones and no other type."""

    def but(*fitted: int) -> int:
        return _ALL - sum(1 << k for k in fitted)

    def tried(first: int, wider: Sequence[int], *others: int) -> Column:
        bits = F.lit(but(first, *wider, *others)) + F.lit(1 << first)
        for k in (*wider, *others):
            bits = bits + F.when(TYPES[k][2](v).isNull(), F.lit(1 << k)).otherwise(F.lit(0))
        return F.when(TYPES[first][2](v).isNotNull(), F.lit(but(first, *wider))).otherwise(bits)

    numeric = F.substring(v, 1, 1).between("-", "9")  # a sign, a point or a digit
    separated = F.contains(v, F.lit("/")) | (F.locate("-", v, 2) > 0)  # of a date, or of an exponent
    return (
        F.when(~numeric, tried(_BOOLEAN, [], _DOUBLE))  # nan
        .when(F.contains(v, F.lit(":")), tried(_MOMENT, [], _ZONED))
        .when(separated, tried(_YMD, [], _DMY, _MDY, _DOUBLE))
        .otherwise(tried(_BIGINT, [_HUGEINT, _DOUBLE]))
        .cast("bigint")
    )


def _value(c: str) -> Column:
    v = F.col("`" + c.replace("`", "``") + "`")
    return F.when(v != "", F.trim(v))


def _each(columns: Sequence[str]) -> Column:
    """The misfits of a row's values, NULL for those that are missing.  One expression for all
    columns: code made for each of them would be too long for the JVM to compile."""
    values = F.array(*[_value(c) for c in columns]) if columns else F.array().cast("array<string>")
    return F.transform(values, lambda v: F.when(v.isNotNull(), _misfits(v)))


def misfits(columns: Sequence[str], each: str) -> list[Column]:
    """For each column the OR of its values' misfits, NULL when it has no value; ``each`` is
    the column of ``_each``."""
    return [F.bit_or(F.get(each, F.lit(i))).alias(f"_m{i}") for i in range(len(columns))]


def detect_types(texts: DataFrame) -> DataFrame:
    """(ordinal_position, column_name, data_type) of a table of texts: one aggregate."""
    found = texts.select(_each(texts.columns).alias("_each")).agg(*misfits(texts.columns, "_each"))
    rows = []
    for i, c in enumerate(texts.columns):
        kind, mask = F.lit(TEXT), F.col(f"_m{i}")
        for k, (name, _, _) in reversed(list(enumerate(TYPES))):
            kind = F.when(mask.bitwiseAND(F.lit(1 << k)) == 0, F.lit(name)).otherwise(kind)
        rows.append(F.struct(F.lit(i + 1).alias("ordinal_position"), F.lit(c).alias("column_name"), kind.alias("data_type")))
    return found.select(F.inline(F.array(*rows)))


def typed(texts: DataFrame, masks: Sequence[int | None]) -> DataFrame:
    """The columns of ``texts`` as the types that their misfits leave."""
    out = []
    for c, mask in zip(texts.columns, masks, strict=True):
        left = [k for k in range(len(TYPES)) if mask is not None and not mask >> k & 1]
        v = _value(c)
        if left:
            v = TYPES[left[0]][2](v).cast(TYPES[left[0]][1])
        else:
            v = F.when(F.col("`" + c.replace("`", "``") + "`") != "", F.col("`" + c.replace("`", "``") + "`"))
        out.append(v.alias(c))
    return texts.select(*out)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every field as its text."""
    return spark.read.options(**FAITHFUL).option("nullValue", "").option("multiLine", True).csv(path)


def load_detected(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Loads a CSV under ``target`` and returns it with the types that all its values
    fit.  The files are read once: what the values rule out is gathered while their
    texts are written, and the types are put on the stored table."""
    texts = read_texts(spark, path)
    seen = Observation("misfits")
    each = "_each"
    while each in (c.lower() for c in texts.columns):
        each += "_"
    watched = texts.withColumn(each, _each(texts.columns)).observe(seen, *misfits(texts.columns, each))
    watched.select(*[F.col("`" + c.replace("`", "``") + "`") for c in texts.columns]).write.mode("overwrite").parquet(target)
    stored = spark.read.schema(texts.schema).parquet(target)
    return typed(stored, [seen.get[f"_m{i}"] for i in range(len(texts.columns))])
