"""Record columns: copy content, fill templates, collect columns into JSON."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maps import last_wins, materialise
from ..functions.names import split_list
from ..functions.template import expand_again, quoted, template
from ..routes import with_route


def content_to_column(df: DataFrame, name: str, expression: str | Column | None = None, *, content: str = "content") -> DataFrame:
    """Copy the content into a column, then optionally replace that column by a template.

    The template may refer to the new column. The content itself stays.
    """
    rows = df.withColumn(name, F.col(quoted(content)))
    if expression is None:
        return rows
    value = template(expression, rows.columns) if isinstance(expression, str) else expression
    return rows.withColumn(name, value)


def update_columns(
    df: DataFrame,
    set: Mapping[str, str] | None = None,
    *,
    new_content: str | None = None,
    evaluate_content: bool = False,
    evaluate_columns: bool = False,
    recursive: bool = False,
    content: str = "content",
) -> DataFrame:
    """Set the content and then the columns, one after another; each sees the ones before.

    Texts are templates where the matching ``evaluate`` option is on. ``recursive`` fills in
    names that the filled-in values bring along, again and again. A chain of names without a cycle
    is no longer than there are columns; a text that holds names after so many rounds sends the
    row to ``failure``.
    """
    rows, unfinished = df, []

    def assign(rows: DataFrame, name: str, text: str, evaluate: bool) -> DataFrame:
        # the content is not a name a template can use, nor are the flags of earlier steps
        names = [c for c in rows.columns if c != content and c not in dict(unfinished)]
        if not evaluate:
            return rows.withColumn(name, F.lit(text))
        value = template(text, names)
        if recursive:
            value, left = expand_again(value, {n: F.col(quoted(n)) for n in names}, len(names) + 1)
            flag = f"__left{len(unfinished)}"
            rows = materialise(rows, {"__text": value})
            # the flag is a test on the finished text
            rows = rows.withColumns({name: F.col("__text"), flag: left(F.col("__text"))}).drop("__text")
            unfinished.append((flag, name))
            return rows
        return rows.withColumn(name, value)

    if new_content:
        rows = assign(rows, content, new_content, evaluate_content)
    for name, text in (set or {}).items():
        rows = assign(rows, name, text, evaluate_columns)
    rows = with_route(rows, [(F.col(flag), f"{name}: names in the template form a cycle") for flag, name in unfinished])
    return rows.drop(*[flag for flag, _ in unfinished])


def columns_to_json(
    df: DataFrame,
    *,
    prefix: str | None = None,
    strip_prefix: bool = True,
    regex: str | None = None,
    names: str | Sequence[str] | None = None,
    delimiter: str = ",",
    constants: Mapping[str, str] | None = None,
    output: str = "content",
) -> DataFrame:
    """JSON object of text values, keys ascending, from chosen columns.

    Chosen by name prefix, by a regular expression that matches the whole name, by a list, and
    from constants (templates); a later choice of a name replaces an earlier one. A null column
    counts as absent for the prefix and regex choices and is written as null for listed names.
    The choice is made on the column names when the plan is built.
    """
    # name in the JSON -> candidates, first present one is used
    chosen: dict[str, list[tuple[Column, bool]]] = {}

    def choose(name: str, value: Column, always: bool) -> None:
        if always:
            chosen[name] = [(value, True)]
        else:
            chosen.setdefault(name, []).insert(0, (value, False))

    for column in df.columns:
        if prefix and column.startswith(prefix):
            choose(column[len(prefix):] if strip_prefix else column, F.col(quoted(column)).cast("string"), False)
    for column in df.columns:
        if regex and re.fullmatch(regex, column):
            choose(column, F.col(quoted(column)).cast("string"), False)
    for name in split_list(names, delimiter):
        choose(name, F.col(quoted(name)).cast("string") if name in df.columns else F.lit(None).cast("string"), True)
    for name, text in (constants or {}).items():
        choose(name, template(text, df.columns), True)

    entries = []
    for name in sorted(chosen):
        candidates = chosen[name]
        value = F.coalesce(*[v for v, _ in candidates])
        keep = F.lit(True) if any(always for _, always in candidates) else value.isNotNull()
        entries.append(F.struct(F.lit(name).alias("k"), value.alias("v"), keep.alias("keep")))
    if not entries:
        return df.withColumn(output, F.lit("{}"))
    if all(any(always for _, always in chosen[n]) for n in chosen):
        document = F.struct(*[F.coalesce(*[v for v, _ in chosen[n]]).alias(n) for n in sorted(chosen)])
    else:
        kept = F.filter(F.array(*entries), lambda e: e["keep"])
        document = F.map_from_arrays(F.transform(kept, lambda e: e["k"]), F.transform(kept, lambda e: e["v"]))
    return df.withColumn(output, F.to_json(document, {"ignoreNullFields": "false"}))


def map_to_json(
    attrs: Column,
    *,
    prefix: str | None = None,
    strip_prefix: bool = True,
    regex: str | None = None,
    names: Sequence[str] = (),
    constants: Mapping[str, str | Column] | None = None,
) -> Column:
    """:func:`columns_to_json` for attributes held in a map column."""
    keys, values = [], []

    def choose(part: Column, rename) -> None:
        keys.append(F.transform(F.map_keys(part), rename))
        values.append(F.map_values(part))

    if prefix:
        cut = (lambda k: F.substring(k, len(prefix) + 1, F.length(k))) if strip_prefix else (lambda k: k)
        choose(F.map_filter(attrs, lambda k, _: k.startswith(prefix)), cut)
    if regex:
        whole = f"^(?:{regex})$"
        choose(F.map_filter(attrs, lambda k, _: k.rlike(whole)), lambda k: k)
    if names:
        keys.append(F.array(*[F.lit(n) for n in names]))
        values.append(F.array(*[F.element_at(attrs, n) for n in names]))
    if constants:
        keys.append(F.array(*[F.lit(n) for n in constants]))
        values.append(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in constants.values()]))
    if not keys:
        return F.lit("{}")
    return F.to_json(last_wins(F.concat(*keys), F.concat(*values)), {"ignoreNullFields": "false"})
