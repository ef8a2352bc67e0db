"""Column, table and attribute names: case folding, mapping, qualifiers, formats."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted case settings.
CASES = ("None", "Upper", "Lower")

# The accepted attribute-name formats of a wide-column scan.
NAME_FORMATS = ("tablename.family.qualifier", "tablename.qualifier", "family.qualifier", "qualifier")


def apply_case(name: Column, case: str = "None") -> Column:
    """Fold a name to upper or lower case, or leave it."""
    if case not in CASES:
        raise ValueError(f"case must be one of {CASES}, not {case!r}")
    return {"Upper": F.upper, "Lower": F.lower}.get(case, lambda c: c)(name)


def fold_names(name: str, case: str = "None") -> str:
    """``apply_case`` for a name known when the plan is built."""
    if case not in CASES:
        raise ValueError(f"case must be one of {CASES}, not {case!r}")
    return {"Upper": str.upper, "Lower": str.lower}.get(case, str)(name)


def literal_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def map_column(table: Column, column: Column, mapping: Mapping[str, str] | None, case: str = "None") -> Column:
    """Target name of ``<table>.<column>`` under ``mapping``; the source name where it has none."""
    if mapping:
        column = F.coalesce(F.element_at(literal_map(mapping), F.concat(table, F.lit("."), column)), column)
    return apply_case(column, case)


def table_without_schema(table: Column) -> Column:
    """Everything after the first dot; the whole name where there is none."""
    return F.substring(table, F.instr(table, ".") + 1, F.length(table))


def override_schema(table: Column, schema: str | None) -> Column:
    """Replace the part before the first dot; ``""`` removes it and ``None`` keeps it."""
    if schema is None:
        return table
    bare = table_without_schema(table)
    return F.concat(F.lit(f"{schema}."), bare) if schema else bare


def strip_qualifier(name: str) -> str:
    """Drop everything up to the last dot of a result label."""
    return re.sub(r"^.*[.]", "", name, count=1)


def attribute_name(table: Column, family: Column, qualifier: Column, name_format: str = "qualifier") -> Column:
    """Attribute name of one cell in the wanted format."""
    if name_format not in NAME_FORMATS:
        raise ValueError(f"name_format must be one of {NAME_FORMATS}, not {name_format!r}")
    parts = {"tablename": table, "family": family, "qualifier": qualifier}
    return F.concat_ws(".", *[parts[p] for p in name_format.split(".")])


def split_list(names: str | list[str] | tuple[str, ...] | None, delimiter: str = ",") -> list[str]:
    """A list given as delimited text or as a list; text is split literally and not trimmed."""
    if not names:
        return []
    return names.split(delimiter) if isinstance(names, str) else list(names)
