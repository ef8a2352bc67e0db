"""JSON documents to records, and JSON documents to delimited text."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maps import last_wins, rename_map
from ..functions.names import split_list
from ..functions.template import quoted
from ..routes import FAILURE, ORIGINAL, REASON, ROUTE, SUCCESS
from .sequence import fragment_id

# When records get fragment columns.
FRAGMENTS = ("Always", "Never", "JSON Arrays Only")

# Lenient parsing: unquoted names, single quotes and comments are accepted.
LENIENT = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "allowComments": "true"}

FRAGMENT_COLUMNS = ("frag_id", "frag_index", "frag_count", "frag_size")


def parse_lenient(text: Column) -> Column:
    """VARIANT of leniently read JSON, null where it cannot be read."""
    return F.from_json(text, "variant", LENIENT)


def as_map(value: Column) -> Column:
    """Fields of a VARIANT object, null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_array(value: Column) -> Column:
    """Elements of a VARIANT array, null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def is_nested(value: Column) -> Column:
    return F.substring(F.schema_of_variant(value), 1, 3).isin("OBJ", "ARR")


def attribute_pairs(
    pairs: Column, *, prefix: str, renames: tuple[list[str], list[str]], blanks: Sequence[str]
) -> Column:
    """Attributes of a record as (k, v) pairs: names renamed and prefixed, ``blanks`` first and empty."""
    rename = rename_map(*renames)
    named = F.transform(
        pairs, lambda e: F.struct((F.concat(F.lit(prefix), rename(e["k"])) if prefix else rename(e["k"])).alias("k"), e["v"].alias("v"))
    )
    if blanks:
        named = F.concat(F.array(*[F.struct(F.lit(b).alias("k"), F.lit("").alias("v")) for b in blanks]), named)
    return named


def explode_records(
    df: DataFrame, records: Column, document_id: Column, failed: Column, reason: Column, original: bool
) -> DataFrame:
    """One row per record of a document, one for a failed document, and one for the original if wanted.

    The records stay inside their document's row until the explode, so nothing is shuffled.
    """
    count = F.size(records)
    numbered = F.transform(
        records,
        lambda r, i: F.struct(r.alias("record"), (i + 1).cast("bigint").alias("index"), F.lit(SUCCESS).alias("route")),
    )

    def marker(route: str) -> Column:
        # same type as a record row: the first one with its fields emptied
        return F.array(F.struct(F.lit(None).alias("record"), F.lit(None).cast("bigint").alias("index"), F.lit(route).alias("route")))

    rows = F.when(failed, marker(FAILURE)).otherwise(F.concat(numbered, marker(ORIGINAL)) if original else numbered)
    return (
        df.withColumns({"__count": count.cast("bigint"), "__id": document_id, REASON: F.when(failed, reason)})
        .withColumn("__row", F.explode(rows))
        .withColumn(ROUTE, F.col("__row.route"))
    )


def json_to_rows(
    df: DataFrame,
    column: str = "content",
    *,
    prefix: str = "",
    null_fields: bool = True,
    fragments: str = "JSON Arrays Only",
    delimiter: str = ",",
    rename: str | Sequence[str] | None = None,
    new_names: str | Sequence[str] | None = None,
    always_add: bool = True,
    names: Sequence[str] | None = None,
    original: bool = False,
    id_columns: Sequence[str] = (),
) -> DataFrame:
    """One row per JSON object: the document itself, or each object in its array.

    Fields that are objects or arrays are left out. Fields are renamed by position of their name
    in ``rename`` and then prefixed. Nulls become ``""`` or, without ``null_fields``, are left
    out; ``always_add`` starts every record with the new names empty. The attributes are a map
    ``attrs``, or one column each for ``names``. Text that is not an object or an array goes to
    ``failure``. ``original`` adds a row per document with route ``original``. ``id_columns``
    name what tells documents of equal text apart; the fragment id is computed from them as well.
    """
    if fragments not in FRAGMENTS:
        raise ValueError(f"fragments must be one of {FRAGMENTS}, not {fragments!r}")
    old, new = split_list(rename, delimiter), split_list(new_names, delimiter)
    parsed = df.withColumn("__doc", parse_lenient(F.col(quoted(column))))
    document = F.col("__doc")
    parsed = parsed.withColumns({"__object": as_map(document), "__array": as_array(document)})
    records = F.when(F.col("__object").isNotNull(), F.array("__object")).otherwise(
        F.filter(F.transform("__array", as_map), lambda r: r.isNotNull())
    )
    # the array itself must not be copied to every one of its records
    parsed = parsed.withColumns({"__records": records, "__is_array": F.col("__array").isNotNull()})
    failed = F.col("__records").isNull()
    reason = F.when(document.isNull(), "content is not JSON").otherwise("the supplied JSON is not an array or an object")
    rows = explode_records(parsed, F.col("__records"), fragment_id(F.col(quoted(column)), *[F.col(quoted(c)) for c in id_columns]), failed, reason, original)
    tagged = (F.col(ROUTE) == SUCCESS) & {
        "Always": F.lit(True),
        "Never": F.lit(False),
        "JSON Arrays Only": F.col("__is_array"),
    }[fragments]

    record = F.col("__row.record")
    ok = F.col(ROUTE) == SUCCESS
    blanks = [f"{prefix}{n}" for n in new] if always_add and null_fields else []
    if names is not None:
        picked = {n: _named_field(record, n, prefix, (old, new), null_fields, n in blanks) for n in names}
        return _finish(rows, df.columns, tagged, {n: F.when(ok, v) for n, v in picked.items()})

    def pair(entry: Column) -> Column:
        value = entry["value"].cast("string")
        return F.struct(entry["key"].alias("k"), (F.coalesce(value, F.lit("")) if null_fields else value).alias("v"))

    pairs = F.transform(F.filter(F.map_entries(record), lambda e: ~is_nested(e["value"])), pair)
    if not null_fields:
        pairs = F.filter(pairs, lambda e: e["v"].isNotNull())
    pairs = attribute_pairs(pairs, prefix=prefix, renames=(old, new), blanks=blanks)
    return _finish(rows.withColumn("__pairs", F.when(ok, pairs)), df.columns, tagged, all_attributes())


def _named_field(
    record: Column, name: str, prefix: str, renames: tuple[list[str], list[str]], null_fields: bool, blank: bool
) -> Column:
    """One attribute straight from a record: the last field, by name, that ends up under it."""
    target = dict(zip(reversed(renames[0]), reversed([*renames[1], *renames[0][len(renames[1]):]][: len(renames[0])])))
    sources = {old for old, new in target.items() if prefix + new == name}
    if name.startswith(prefix) and name[len(prefix):] not in target:
        sources.add(name[len(prefix):])

    def text(field: str) -> Column:
        value = F.element_at(record, field)
        shown = value.cast("string")
        return F.when(value.isNotNull() & ~is_nested(value), F.coalesce(shown, F.lit("")) if null_fields else shown)

    found = [text(f) for f in sorted(sources, reverse=True)]
    return F.coalesce(*found, F.lit("" if blank else None).cast("string"))


def all_attributes() -> dict[str, Column]:
    """The map of all ``__pairs``."""
    pairs = F.col("__pairs")
    return {"attrs": F.when(pairs.isNotNull(), last_wins(pairs["k"], pairs["v"]))}


def chosen_attributes(names: Sequence[str]) -> dict[str, Column]:
    """One column per wanted name from ``__pairs``."""

    def last(name: str) -> Column:
        return F.try_element_at(F.filter(F.col("__pairs"), lambda e: e["k"] == name), F.lit(-1))["v"]

    return {n: last(n) for n in names}


def _finish(rows: DataFrame, keep: Sequence[str], tagged: Column, attributes: Mapping[str, Column]) -> DataFrame:
    """Result columns: those of the document, the attributes, fragment columns and routes."""
    fragment = {
        "frag_id": F.col("__id"),
        "frag_index": F.col("__row.index"),
        "frag_count": F.col("__count"),
        "frag_size": F.lit("0"),
    }
    return rows.select(
        *[F.col(quoted(c)) for c in keep if c not in attributes],
        *[v.alias(n) for n, v in attributes.items()],
        *[F.when(tagged, v).alias(k) for k, v in fragment.items()],
        ROUTE,
        REASON,
    )


def schema_fields(schema: str | Mapping[str, Any] | Sequence[str]) -> list[str]:
    """Field names of a record schema (JSON text or a mapping with ``fields[].name``) or a list."""
    if isinstance(schema, str):
        schema = json.loads(schema)
    return [f["name"] for f in schema["fields"]] if isinstance(schema, Mapping) else list(schema)


def json_to_csv(
    df: DataFrame,
    schema: str | Mapping[str, Any] | Sequence[str],
    column: str = "content",
    *,
    delimiter: str = ",",
    headers: bool = True,
    quoted_fields: bool = True,
    output: str = "csv",
) -> DataFrame:
    """Delimited text of each JSON document, columns in schema order.

    A document is an object or an array of objects or of strings that hold an object; any other
    element sends it to ``failure``. Missing and null fields are empty, an empty array is the
    empty text, and a scalar has no data lines. Lines are joined by ``\\n``.
    """
    names = schema_fields(schema)

    def cell(text: Column) -> Column:
        if not quoted_fields:
            return text
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    document = F.col("__doc")
    # an element that is text is read as JSON itself
    unwrapped = F.transform(
        as_array(document),
        lambda e: F.coalesce(as_map(e), F.when(F.schema_of_variant(e) == "STRING", as_map(parse_lenient(e.cast("string"))))),
    )
    rows = df.withColumn("__doc", parse_lenient(F.col(quoted(column))))
    rows = rows.withColumns({"__object": as_map(document), "__array": unwrapped})
    rows = rows.withColumn("__elements", F.when(F.col("__object").isNotNull(), F.array("__object")).otherwise(F.col("__array")))
    bad = F.exists(F.col("__elements"), lambda e: e.isNull())

    def line(fields: Column) -> Column:
        cells = [cell(F.coalesce(F.element_at(fields, n).cast("string"), F.lit(""))) for n in names]
        return F.concat_ws(delimiter, *cells)

    lines = F.coalesce(F.transform(F.col("__elements"), line), F.array().cast("array<string>"))
    if headers:
        title = delimiter.join(f'"{n}"' if quoted_fields else n for n in names)
        lines = F.concat(F.array(F.lit(title)), lines)
    failed = document.isNull() | F.coalesce(bad, F.lit(False))
    reason = F.when(document.isNull(), "content is not JSON").when(
        F.coalesce(bad, F.lit(False)), "array elements must be JSON objects or strings that hold JSON objects"
    )
    text = F.when(F.size("__elements") == 0, F.lit("")).otherwise(F.array_join(lines, "\n"))
    return rows.select(
        *[F.col(quoted(c)) for c in df.columns if c != output],
        F.when(~failed, text).alias(output),
        F.when(failed, FAILURE).otherwise(SUCCESS).alias(ROUTE),
        reason.alias(REASON),
    )
