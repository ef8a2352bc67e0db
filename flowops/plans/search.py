"""Search trees made of tables: the place of a value among sorted values, for any number of either.

The sorted values of a group lie in chunks of ``FANOUT``; the first values of the chunks lie in chunks
again, and so on up to one chunk. A search descends by one equi-join per level, on the group and the
chunk's number, so a row never meets more than one chunk a level. Every level is measured: while it has
few values it is broadcast and the rows stay where they are, else both sides are shuffled by chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import measured

#: Values of a chunk; a power of two.
FANOUT = 256

#: Values of a level that is broadcast, at most: a task holds them all, and files, in which alike values take little, do not tell how much that is.
MAX_BROADCAST_VALUES = 1 << 17

_CHUNK, _VALUES = "__tree_chunk", "__tree_values"


@dataclass(frozen=True)
class SearchTree:
    """``levels``, the leaves first; each has the group's columns ``names``, ``__tree_chunk`` and ``__tree_values``."""

    names: tuple[str, ...]
    levels: tuple[tuple[DataFrame, Callable[[DataFrame], DataFrame]], ...]


def search_tree(values: DataFrame, names: Sequence[str], payload: Sequence[str] = ()) -> SearchTree:
    """The tree of ``values``: group columns ``names``, ``__n`` (place in the group, from 0) and ``__o``, ascending and different.

    The leaves also keep the columns ``payload``, which must have an order (no maps).
    """
    levels = []
    entry = F.struct("__o", *payload)
    while True:
        chunk = F.floor(F.col("__n") / FANOUT).alias(_CHUNK)
        whole = values.groupBy(*names, chunk).agg(F.sort_array(F.collect_list(F.struct("__n", entry.alias("e")))).alias("all"))
        level = whole.select(*names, _CHUNK, F.transform("all", lambda x: x["e"]).alias(_VALUES))
        saved, small_side = measured(level, "search")
        size = saved.agg(F.max(_CHUNK).alias("top"), F.sum(F.size(_VALUES)).alias("values")).first()
        levels.append((saved, small_side if (size["values"] or 0) <= MAX_BROADCAST_VALUES else _shuffled))
        top = size["top"]
        if not top:  # one chunk in every group, or no value at all
            return SearchTree(tuple(names), tuple(levels))
        values = saved.select(*names, F.col(_CHUNK).alias("__n"), F.get(_VALUES, 0)["__o"].alias("__o"))
        entry = F.struct("__o")


def _shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that is too large for every task to hold, whatever its files or statistics say."""
    return side.hint("merge")


def place_among(df: DataFrame, tree: SearchTree, groups: Sequence[Column], value: Column, output: str, *, inclusive: bool = False, entry: str | None = None) -> DataFrame:
    """Add ``output``: how many values of the row's group are below ``value`` (``inclusive``: or equal to it).

    Null in groups the tree does not have. ``entry`` adds the last of those values with its payload,
    as a struct whose field ``__o`` is the value; null where there is none.
    """
    columns = df.columns
    own = [f"__tree_g{i}" for i in range(len(tree.names))]
    # without groups the one chunk at the top is still met by a key, which is 0 but no constant: an equi-join
    start = F.lit(0).cast("bigint") if tree.names else F.pmod(F.xxhash64(value), F.lit(1)).cast("bigint")
    rows = df.withColumns({**{n: g for n, g in zip(own, groups, strict=True)}, "__tree_value": value, "__tree_at": start})
    for depth in range(len(tree.levels) - 1, -1, -1):
        level, small_side = tree.levels[depth]
        level = level.select(*[F.col(n).alias(f"__tree_{n}") for n in tree.names], F.col(_CHUNK).alias("__tree_to"), _VALUES)
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__tree_{n}")) for g, n in zip(own, tree.names)], F.col("__tree_at") == F.col("__tree_to"))
        # a tree of one chunk without groups is one row
        alone = not tree.names and depth == len(tree.levels) - 1
        rows = rows.join(F.broadcast(level) if alone else small_side(level), same, "left")
        below = _below(F.col(_VALUES), F.col("__tree_value"), inclusive)
        if depth:
            rows = rows.withColumn("__tree_at", F.col("__tree_at") * FANOUT + F.greatest(below - 1, F.lit(0)))
        else:
            rows = rows.withColumn("__tree_below", below)
            if entry:
                rows = rows.withColumn(entry, F.when(F.col("__tree_below") > 0, F.get(_VALUES, F.col("__tree_below") - 1)))
            rows = rows.withColumn(output, (F.col("__tree_at") * FANOUT + F.col("__tree_below")).cast("bigint"))
        rows = rows.drop("__tree_to", _VALUES, *[f"__tree_{n}" for n in tree.names])
    return rows.select(*columns, output, *([entry] if entry else []))


def _below(values: Column, value: Column, inclusive: bool) -> Column:
    """Number of entries in a chunk below ``value``, by binary search; null without a chunk."""
    steps = F.array(*[F.lit(FANOUT >> k) for k in range(FANOUT.bit_length())])

    def closer(place: Column, step: Column) -> Column:
        there = F.get(values, place + step - 1)["__o"]
        return F.when((place + step <= F.size(values)) & ((there <= value) if inclusive else (there < value)), place + step).otherwise(place)

    return F.when(values.isNotNull(), F.aggregate(steps, F.lit(0), closer))
