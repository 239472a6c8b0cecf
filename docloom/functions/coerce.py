"""Typed document columns: how a query column becomes an `id`, attribute or text field.

NULL becomes the zero value of the type, numbers wrap or truncate, and text that should hold a number must be
one, whatever the session's ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The document column types, and which of them can be updated in place.
COLUMN_TYPES = (
    "id",
    "attr_float",
    "attr_uint",
    "attr_bigint",
    "attr_multi",
    "attr_multi_64",
    "attr_string",
    "field",
)
IN_PLACE_TYPES = ("attr_float", "attr_uint", "attr_bigint", "attr_multi", "attr_multi_64")

UINT32_MAX = 4294967295
INT64_MIN = -9223372036854775808
INT64_MAX = 9223372036854775807


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.BinaryType))


def _as_text(c: Column, dtype: T.DataType) -> Column:
    # bytes and text compare and parse the same way
    return c.cast("string") if isinstance(dtype, T.BinaryType) else c


def _parsed(text: Column, pattern: str, low: int, high: int, what: str) -> Column:
    number = F.when(text.rlike(pattern), text.try_cast("decimal(38,0)"))
    bad = F.raise_error(F.concat(F.lit(f"not a valid {what}: "), text))
    return (
        F.when(text.isNull(), F.lit(0).cast("bigint"))
        .when(number.between(F.lit(low), F.lit(high)), number.cast("bigint"))
        .otherwise(bad.cast("bigint"))
    )


def to_uint32(c: Column, dtype: T.DataType) -> Column:
    """Unsigned 32-bit: numbers wrap, text must be a base-10 number in range, NULL is 0."""
    if _is_text(dtype):
        return _parsed(_as_text(c, dtype), r"\A[0-9]+\z", 0, UINT32_MAX, "unsigned 32-bit number")
    return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).bitwiseAND(F.lit(UINT32_MAX))


def to_int64(c: Column, dtype: T.DataType) -> Column:
    """Signed 64-bit: numbers truncate, text must be a base-10 number in range, NULL is 0."""
    if _is_text(dtype):
        return _parsed(_as_text(c, dtype), r"\A[+-]?[0-9]+\z", INT64_MIN, INT64_MAX, "64-bit number")
    return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))


def to_doc_id(c: Column, dtype: T.DataType) -> Column:
    """Document id as a non-negative bigint; NULL is 0.

    Ids from 2^63 up do not fit Spark's bigint and are refused, as are negative ones.
    """
    if _is_text(dtype):
        return _parsed(_as_text(c, dtype), r"\A[0-9]+\z", 0, INT64_MAX, "document id")
    number = F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    bad = F.raise_error(F.concat(F.lit("negative document id: "), number.cast("string")))
    return F.when(number >= 0, number).otherwise(bad.cast("bigint"))


def to_float(c: Column) -> Column:
    """Double rounded to the six decimals an attribute keeps; NULL is 0."""
    return F.round(F.coalesce(c.cast("double"), F.lit(0.0)), 6)


def strip_nul(c: Column) -> Column:
    """Text without NUL characters."""
    return F.replace(c, F.lit("\u0000"), F.lit(""))


def to_text(c: Column) -> Column:
    """Text without NUL characters; NULL is the empty string."""
    return strip_nul(F.coalesce(c.cast("string"), F.lit("")))


def to_multi(c: Column, dtype: T.DataType) -> Column:
    """Multi-value attribute: a sorted set of numbers from an array or a comma list; NULL is empty."""
    if isinstance(dtype, T.ArrayType):
        values = c.cast("array<bigint>")
    else:
        items = F.filter(F.split(_as_text(c, dtype).cast("string"), ","), lambda v: F.trim(v) != "")
        values = F.transform(
            items, lambda v: _parsed(F.trim(v), r"\A[+-]?[0-9]+\z", INT64_MIN, INT64_MAX, "64-bit number")
        )
    return F.coalesce(F.array_sort(F.array_distinct(values)), F.array().cast("array<bigint>"))


def typed(c: Column, dtype: T.DataType, doc_type: str) -> Column:
    """The column `c` of Spark type `dtype`, converted to the document type `doc_type`."""
    if doc_type == "id":
        return to_doc_id(c, dtype)
    if doc_type == "attr_uint":
        return to_uint32(c, dtype)
    if doc_type == "attr_bigint":
        return to_int64(c, dtype)
    if doc_type == "attr_float":
        return to_float(c)
    if doc_type in ("attr_string", "field"):
        return to_text(c)
    if doc_type in ("attr_multi", "attr_multi_64"):
        return to_multi(c, dtype)
    raise ValueError(f"unknown document column type {doc_type!r}")


def comparable(c: Column, dtype: T.DataType) -> Column:
    """Value as it is compared in row images and keys: bytes become text."""
    return _as_text(c, dtype)


def part_of(doc_id: Column, parts: int) -> Column:
    """Partition number of a document."""
    return F.pmod(doc_id, F.lit(parts).cast("bigint")).cast("int")
