from .maps import build_map, last_wins, rename_map, sorted_json
from .names import (
    apply_case,
    attribute_name,
    fold_names,
    map_column,
    override_schema,
    split_list,
    strip_qualifier,
)
from .template import Template, template
from .values import convert, default_if_empty, sql_literal, text_or

__all__ = [
    "Template",
    "apply_case",
    "attribute_name",
    "build_map",
    "convert",
    "default_if_empty",
    "fold_names",
    "last_wins",
    "map_column",
    "override_schema",
    "rename_map",
    "sorted_json",
    "split_list",
    "sql_literal",
    "strip_qualifier",
    "template",
    "text_or",
]
