"""Named sequences and fragment numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import DEFAULT_MAX_ROWS, Running, plan_split, running


def _order(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def assign_sequence(
    df: DataFrame,
    sequence: str | None,
    order_by: str | Sequence[str],
    *,
    state: DataFrame | None = None,
    start: int | Column = 1,
    increment: int | Column = 1,
    output: str = "sequence_value",
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Give every row the next number of its named sequence, in order.

    A sequence found in ``state`` (``seq``, ``value``) goes on from its value; any other one
    begins with ``start``. ``sequence=None`` numbers all rows as one sequence and then
    ``state`` is not used. ``start`` and ``increment`` may differ per row: the first row of a
    new sequence gives its start, and every later row adds its own increment.
    """
    order = _order(order_by)
    keys = [sequence] if sequence else []
    rows = df.withColumns({"__inc": _long(increment), "__start": _long(start)})
    specs = [
        Running("__sum", "sum", F.col("__inc")),
        Running("__inc1", "first", F.col("__inc")),
        Running("__start1", "first", F.col("__start")),
    ]
    rows = running(rows, keys, order, specs, inclusive=True, split=plan_split(rows, keys, order, max_rows))
    fresh = F.col("__start1") + F.col("__sum") - F.col("__inc1")
    if state is not None and sequence:
        rows = rows.join(_stored(state), F.col(sequence) == F.col("__seq"), "left")
        number = F.coalesce(F.col("__stored") + F.col("__sum"), fresh)
    else:
        number = fresh
    return rows.withColumn(output, number).select(*df.columns, output)


def sequence_after(
    df: DataFrame,
    sequence: str,
    order_by: str | Sequence[str],
    *,
    state: DataFrame | None = None,
    start: int | Column = 1,
    increment: int | Column = 1,
) -> DataFrame:
    """The (seq, value) table once all rows of ``df`` have their number."""
    place = F.struct(*[F.col(o) for o in _order(order_by)])
    used = (
        df.withColumns({"__inc": _long(increment), "__start": _long(start)})
        .groupBy(F.col(sequence).alias("seq"))
        .agg(
            F.sum("__inc").alias("__sum"),
            (F.min_by("__start", place) - F.min_by("__inc", place)).alias("__origin"),
        )
    )
    if state is None:
        return used.select("seq", (F.col("__origin") + F.col("__sum")).alias("value"))
    merged = used.join(_stored(state), F.col("seq") == F.col("__seq"), "full")
    value = F.coalesce(F.col("__stored"), F.col("__origin")) + F.coalesce(F.col("__sum"), F.lit(0))
    return merged.select(F.coalesce("seq", "__seq").alias("seq"), value.alias("value"))


def _long(value: int | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def _stored(state: DataFrame) -> DataFrame:
    return state.select(F.col("seq").alias("__seq"), F.col("value").cast("bigint").alias("__stored"))


def fragment_id(*parent: Column) -> Column:
    """Group identifier computed from the parent, so a retried task gives the same one."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parent]), 256)


def number_fragments(
    df: DataFrame, parent: Sequence[str], order_by: str | Sequence[str], *, name: str = "all", max_rows: int | None = DEFAULT_MAX_ROWS
) -> DataFrame:
    """Add ``frag_id``, ``frag_index`` (from 1) and ``frag_count`` per parent; no parent = one group, called ``name``.

    The count is a pre-aggregated total joined back, not a window over the whole group.
    """
    order = _order(order_by)
    rows = running(df, list(parent), order, [Running("frag_index", "count")], inclusive=True, split=plan_split(df, list(parent), order, max_rows))
    if not parent:
        total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        return rows.withColumns({"frag_id": fragment_id(F.lit(name)), "frag_count": total}).select(*df.columns, "frag_id", "frag_index", "frag_count")
    names = [f"__p{i}" for i in range(len(parent))]
    counts = df.groupBy(*[F.col(p).alias(n) for p, n in zip(parent, names)]).agg(F.count(F.lit(1)).alias("frag_count"))
    on = [F.col(p).eqNullSafe(F.col(n)) for p, n in zip(parent, names)]
    rows = rows.join(counts, on, "left").drop(*names)
    return rows.withColumn("frag_id", fragment_id(*[F.col(p) for p in parent])).select(*df.columns, "frag_id", "frag_index", "frag_count")
