"""Scalar value rules: defaults, type conversion, SQL literals."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The type names a conversion accepts; "decimal" is a double.
TYPE_NAMES = {"int": "int", "long": "bigint", "float": "float", "double": "double", "decimal": "double", "string": "string"}


def convert(value: Column, to_type: str | None) -> Column:
    """Convert text to the named type; an unknown name keeps text and bad text gives null."""
    return value.try_cast(TYPE_NAMES.get(to_type or "string", "string"))


def convert_failed(value: Column, to_type: str | None) -> Column:
    """True where a value is present but is not of the named type."""
    return value.isNotNull() & convert(value, to_type).isNull()


def default_if_empty(value: Column, default: Any) -> Column:
    """The value, or the default where it is null or the empty string."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def text_or(value: Column, default: str = "") -> Column:
    """Text of any value, with a stand-in for null."""
    return F.coalesce(value.cast("string"), F.lit(default))


def sql_literal(value: Column) -> Column:
    """Quoted SQL literal with doubled quotes; null is the bare word."""
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(quoted, F.lit("null"))
