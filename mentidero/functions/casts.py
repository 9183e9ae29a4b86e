"""Lenient casts: bad input becomes null, never an error and never a lost row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

from mentidero.functions.text import strip

# --- fixed values ---
TRUE_WORDS = ("true", "t", "yes", "y", "1", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "off")
# --- end of fixed values ---


def _number_text(value: Column) -> Column:
    # The JVM float parser also takes type suffixes ("12d", "1f"); those are not numbers here.
    text = strip(value.cast("string"))
    return F.when(~text.rlike(r"[0-9.][dDfF]$"), text)


def lenient_int(value: Column) -> Column:
    """Integer, trimmed integer text, or a fraction cut towards zero."""
    text = _number_text(value)
    # A failing text-to-integer cast is slow, so only whole numbers are tried.
    whole = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
    return F.coalesce(whole, text.try_cast("double").try_cast("bigint"))


def lenient_float(value: Column) -> Column:
    return _number_text(value).try_cast("double")


def lenient_bool(value: Column, dtype: DataType | None = None) -> Column:
    """Word lists for text; a number is true when it is not zero."""
    if isinstance(dtype, BooleanType):
        return value
    if isinstance(dtype, NumericType):
        return value != 0
    word = F.lower(strip(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def lenient(value: Column, target: str, dtype: DataType | None = None) -> Column:
    """Cast to one of the bronze types; a matching source type passes through untouched."""
    if dtype is not None and dtype.simpleString() == target:
        return value
    if target == "bigint":
        return value.try_cast("bigint") if _is_number(dtype) else lenient_int(value)
    if target == "double":
        return value.try_cast("double") if _is_number(dtype) else lenient_float(value)
    if target == "boolean":
        return lenient_bool(value, dtype)
    return scalar_text(value, dtype)


def scalar_text(value: Column, dtype: DataType | None = None) -> Column:
    """Scalars as text; arrays, maps and structs as JSON."""
    if dtype is not None and dtype.typeName() in ("array", "map", "struct"):
        return F.to_json(value)
    return value if isinstance(dtype, StringType) else value.cast("string")


def _is_number(dtype: DataType | None) -> bool:
    return isinstance(dtype, (NumericType, BooleanType))
