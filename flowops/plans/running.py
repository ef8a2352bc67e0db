"""Running aggregates over ordered groups of any size.

A plain window sends one group to one task. Here a group with more than ``max_rows`` rows is
cut into consecutive parts by all of its order columns together: each part is aggregated on its own, the part
totals (a small table) are accumulated, and the accumulated value is combined with the running
value inside the part. Groups below the limit keep the plain window. The data is shuffled once
in both cases, and the result does not depend on where the cuts are.

Cuts are tuples of a sample of the large groups' rows, so equal values in the first order columns are
told apart by the next ones. There is no limit to the number of parts: cuts are a search tree of
tables (:mod:`flowops.plans.search`), which a row descends by one join per level, one in most cases.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import measured
from .search import SearchTree, place_among, search_tree

DEFAULT_MAX_ROWS = 5_000_000

KINDS = ("max", "min", "first", "last", "sum", "count")

# Rows sampled for every part that is wanted: parts then differ in size by about a tenth.
_SAMPLED_PER_PART = 64

PART = "__part"


@dataclass(frozen=True)
class Running:
    """One running aggregate; ``first`` and ``last`` skip nulls."""

    name: str
    kind: str
    value: Column = field(default_factory=lambda: F.lit(1))

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}, not {self.kind!r}")


@dataclass(frozen=True)
class Split:
    """Where large groups are cut: ascending tuples of their order, by key (``__k0``...)."""

    keys: tuple[str, ...]
    cuts: SearchTree


def _check_order(df: DataFrame, order_by: Sequence[str]) -> None:
    if not order_by:
        raise ValueError("order_by is required: Spark rows have no arrival order")
    for name in order_by:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType)):
            raise TypeError(f"order column {name!r} must have an order, and {kind.simpleString()} has none")


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)], F.lit(True))


def _tuple(order_by: Sequence[str]) -> Column:
    """The order columns as one value; a null comes first, as it does in a window's order."""
    return F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order_by)])


def plan_split(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], max_rows: int | None = DEFAULT_MAX_ROWS) -> Split | None:
    """Find the groups that are too large for one task and cut them at sampled tuples of the order.

    Counts rows per group over the key columns and, only if a group is too large, samples the
    order columns of such groups. ``max_rows=None`` skips both for keyed groups.
    """
    _check_order(df, order_by)
    names = [f"__k{i}" for i in range(len(keys))]
    if not keys:
        # one group: at least a part per core, as long as there are rows
        rows = df.count()
        cores = df.sparkSession.sparkContext.defaultParallelism
        part_rows = max(1, min(max_rows or DEFAULT_MAX_ROWS, -(-rows // cores)))
        return Split((), _cuts(df.select(_tuple(order_by).alias("__o")), [], part_rows))
    if max_rows is None:
        return None
    counted = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n"))
    large, small_side = measured(counted.where(F.col("__n") > max_rows).select(*[F.col(n).alias(f"{n}c") for n in names]), "large")
    if large.isEmpty():
        return None
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], _tuple(order_by).alias("__o"))
    same = same_keys([F.col(n) for n in names], [F.col(f"{n}c") for n in names])
    return Split(tuple(keys), _cuts(rows.join(small_side(large), same, "left_semi"), names, max_rows))


def _cuts(rows: DataFrame, names: Sequence[str], part_rows: int) -> SearchTree:
    """Ascending different tuples of ``__o`` to cut at, per group; where they lie decides balance only.

    Every row has the same chance to be sampled, so a group gets cuts in proportion to its rows.
    """
    rate = min(1.0, _SAMPLED_PER_PART / part_rows)
    stride = max(1, round(part_rows * rate))
    some = rows if rate == 1.0 else rows.sample(rate, 17)
    found = some.groupBy(*names).agg(F.sort_array(F.collect_list("__o")).alias("__all"))
    cuts = F.array_distinct(F.filter("__all", lambda _, i: i % stride == stride - 1))
    return search_tree(found.select(*names, F.posexplode(cuts).alias("__n", "__o")), names)


def with_part(df: DataFrame, order_by: Sequence[str], split: Split) -> DataFrame:
    """Add ``__part``, the number of the part a row is in: null in groups that are not cut."""
    placed = place_among(df, split.cuts, [F.col(k) for k in split.keys], _tuple(order_by), PART)
    return placed if split.keys else placed.withColumn(PART, F.coalesce(PART, F.lit(0)))


def join_parts(work: DataFrame, keys: Sequence[str], parts: DataFrame) -> DataFrame:
    """Join rows with a table that has one row per part: the keys as ``__c0``..., and ``__p``.

    The table has about ``rows / max_rows`` rows. It is computed first and broadcast if its
    values are small as well.
    """
    names = [f"__c{i}" for i in range(len(keys))]
    parts, small_side = measured(parts, "parts")
    on = same_keys([F.col(k) for k in keys] + [F.col(PART)], [F.col(n) for n in names] + [F.col("__p")])
    return work.join(small_side(parts), on, "left").drop(*names, "__p")


def part_groups(keys: Sequence[str]) -> list[Column]:
    """Grouping columns of a table for :func:`join_parts`."""
    return [*[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)], F.col(PART).alias("__p")]


def _over(spec: Running, window) -> Column:
    value = F.col(f"__v_{spec.name}")
    return {
        "max": F.max,
        "min": F.min,
        "sum": F.sum,
        "count": F.count,
        "first": lambda c: F.first(c, ignorenulls=True),
        "last": lambda c: F.last(c, ignorenulls=True),
    }[spec.kind](value).over(window)


def _total(spec: Running, order_by: Sequence[str], backwards: bool) -> Column:
    value = F.col(f"__v_{spec.name}")
    if spec.kind in ("first", "last"):
        place = F.when(value.isNotNull(), F.struct(*[F.col(o) for o in order_by]))
        return (F.min_by if (spec.kind == "first") != backwards else F.max_by)(value, place)
    return {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}[spec.kind](value)


def _merge(spec: Running, before: Column, here: Column) -> Column:
    """Combine what precedes a part with the running value inside it."""
    return {
        "max": lambda: F.greatest(before, here),
        "min": lambda: F.least(before, here),
        "first": lambda: F.coalesce(before, here),
        "last": lambda: F.coalesce(here, before),
        "sum": lambda: F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here),
        "count": lambda: F.coalesce(before, F.lit(0)) + here,
    }[spec.kind]()


def running(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    specs: Sequence[Running],
    *,
    inclusive: bool = False,
    backwards: bool = False,
    split: Split | None = None,
) -> DataFrame:
    """Add one column per spec, aggregated over the rows of the group before the current one.

    ``inclusive`` adds the current row; ``backwards`` looks at the rows after it. ``split``
    comes from :func:`plan_split` with the same keys and order.
    """
    _check_order(df, order_by)
    direction = [F.col(o).desc() if backwards else F.col(o).asc() for o in order_by]
    end = Window.currentRow if inclusive else -1
    values = {f"__v_{s.name}": s.value for s in specs}
    work = df.withColumns(values)

    if split is None:
        if not keys:
            raise ValueError("groups without keys need a split")
        frame = Window.partitionBy(*keys).orderBy(*direction).rowsBetween(Window.unboundedPreceding, end)
        return work.withColumns({s.name: _over(s, frame) for s in specs}).drop(*values)

    work = with_part(work, order_by, split)
    frame = Window.partitionBy(*keys, PART).orderBy(*direction).rowsBetween(Window.unboundedPreceding, end)
    here = {f"__h_{s.name}": _over(s, frame) for s in specs}

    # one row per part of a large group
    names = [f"__c{i}" for i in range(len(keys))]
    totals = (
        work.where(F.col(PART).isNotNull())
        .groupBy(*part_groups(keys))
        .agg(*[_total(s, order_by, backwards).alias(f"__v_{s.name}") for s in specs])
    )
    parts = (
        Window.partitionBy(*names)
        .orderBy(F.col("__p").desc() if backwards else F.col("__p").asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry_kind = {"count": "sum"}
    before = totals.select(
        *names, "__p", *[_over(Running(s.name, carry_kind.get(s.kind, s.kind)), parts).alias(f"__b_{s.name}") for s in specs]
    )
    merged = join_parts(work.withColumns(here), keys, before)
    result = merged.withColumns({s.name: _merge(s, F.col(f"__b_{s.name}"), F.col(f"__h_{s.name}")) for s in specs})
    return result.drop(*values, *here, PART, *[f"__b_{s.name}" for s in specs])
