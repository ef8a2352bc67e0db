"""Maps built from entries where a later entry replaces an earlier one.

The session's duplicate-key policy is never relied on: entries are reduced to one per key
before a map is made, so the operators behave the same under either policy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import literal_map


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def materialise(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns that later steps use several times or filter on.

    Spark copies an expression into every filter that is pushed below its projection; it does
    not push a filter below a generator, so the columns come out of a one-row one.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*[F.col("`" + c.replace("`", "``") + "`") for c in kept], F.inline(F.array(row)))


def last_wins(keys: Column, values: Column) -> Column:
    """Map from parallel arrays, keys ascending, the last value of a repeated key.

    Keys are sorted together with their positions (``n log n``, and values need not be
    orderable); an element survives if its right neighbour has another key.
    """
    ranked = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

    def pick(given: Column) -> Column:
        order = given["order"]
        kept = F.filter(order, lambda e, i: ~F.coalesce(F.get(order, i + 1)["k"] == e["k"], F.lit(False)))
        return let(
            kept,
            lambda k: F.map_from_arrays(F.transform(k, lambda e: e["k"]), F.transform(k, lambda e: F.get(given["values"], e["i"]))),
        )

    return let(F.struct(ranked.alias("order"), values.alias("values")), pick)


def sorted_json(keys: Column, values: Column) -> Column:
    """JSON object text with ascending keys; nulls are written."""
    return F.to_json(last_wins(keys, values), {"ignoreNullFields": "false"})


def build_map(pairs: Mapping[str, Column]) -> Column:
    """Map of named columns, keys ascending."""
    names = sorted(pairs)
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[pairs[n] for n in names]))


def rename_map(old_names: Sequence[str], new_names: Sequence[str]):
    """Function that renames a key by position; names beyond the new list keep theirs."""
    pairs: dict[str, str] = {}
    for old, new in zip(old_names, new_names):
        pairs.setdefault(old, new)
    # the first occurrence of an old name decides, also when it has no partner
    for old in old_names[len(new_names):]:
        pairs.setdefault(old, old)
    if not pairs:
        return lambda key: key
    return lambda key: F.coalesce(F.element_at(literal_map(pairs), key), key)
