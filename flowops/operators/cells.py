"""Wide-column tables in long form: ``(table, row_key, family, qualifier, value, ts)``.

Row filters are ordinary Column predicates (``row_key.startswith(p)``, ``row_key == k``), so
they reach the file scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import attribute_name, split_list
from ..functions.template import quoted
from ..plans import DEFAULT_MAX_ROWS, Running, place_among, plan_split, running, search_tree
from ..routes import EMPTY, FAILURE, REASON, ROUTE, SUCCESS
from ..session import measured, spread
from .sequence import number_fragments

CELL_COLUMNS = ("table", "row_key", "family", "qualifier", "value", "ts")


def to_cells(df: DataFrame, table: str, row_key: str, columns: Sequence[str], *, family: str = "f", ts: Column | None = None) -> DataFrame:
    """Unpivot columns into cells; a null has no cell."""
    stamp = F.lit(0).cast("bigint") if ts is None else ts
    cells = F.array(*[F.struct(F.lit(c).alias("qualifier"), F.col(quoted(c)).cast("string").alias("value")) for c in columns])
    rows = df.select(
        F.lit(table).alias("table"),
        F.col(quoted(row_key)).cast("string").alias("row_key"),
        F.lit(family).alias("family"),
        stamp.alias("ts"),
        F.inline(F.filter(cells, lambda c: c["value"].isNotNull())),
    )
    return rows.select(*CELL_COLUMNS)


def scan(cells: DataFrame, table: str, where: Column | None = None) -> DataFrame:
    """Cells of one table that satisfy a predicate."""
    rows = cells.where(F.col("table") == table)
    return rows if where is None else rows.where(where)


def scan_cells(
    cells: DataFrame,
    table: str,
    where: Column | None = None,
    *,
    name_format: str = "qualifier",
    row_key_name: str = "row_key",
    names: Sequence[str] | None = None,
    fragments: bool = False,
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """One record per row key with its cells as attributes.

    Attributes are named by ``name_format``; of cells that share a name the later one (family,
    qualifier) stays. With ``names`` each becomes a column, made by one pre-aggregated
    group-by. Without it the attributes are a map, whose size is the number of different names
    a row has: cells are reduced to one per name before they are gathered.
    ``fragments`` adds the fragment columns, numbered by row key.
    """
    rows = scan(cells, table, where)
    name = attribute_name(F.col("table"), F.col("family"), F.col("qualifier"), name_format)
    place = F.struct("family", "qualifier", "ts")
    if names is not None:
        picks = [F.max_by("value", F.when(name == n, place)).alias(n) for n in names]
        records = rows.groupBy(F.col("row_key").alias(row_key_name)).agg(*picks)
    else:
        single = rows.groupBy("row_key", name.alias("__name")).agg(F.max_by("value", place).alias("__value"))
        pairs = F.array_sort(F.collect_list(F.struct("__name", "__value")))
        records = single.groupBy(F.col("row_key").alias(row_key_name)).agg(F.map_from_entries(pairs).alias("attrs"))
    if not fragments:
        return records
    # number the bare keys, so that planning passes read one column
    keys = rows.select(F.col("row_key").alias("__key")).distinct()
    numbered = number_fragments(keys, [], "__key", max_rows=max_rows)
    return records.join(numbered, F.col(row_key_name) == F.col("__key")).drop("__key")


def _only_row(family: str | None, qualifier: str | None, output: str) -> list[Column]:
    """Aggregates that pick one cell and tell whether more than one row is in the group."""
    wanted = F.lit(True) if qualifier is None else (F.col("family") == family) & (F.col("qualifier") == qualifier)
    place = F.when(wanted, F.struct("family", "qualifier", "ts"))
    return [F.max_by("value", place).alias(output), (F.min("row_key") != F.max("row_key")).alias("__many")]


def _only_row_routes(rows: DataFrame, output: str) -> DataFrame:
    many = F.col("__many")
    route = F.when(many, FAILURE).when(many.isNull(), EMPTY).otherwise(SUCCESS)
    reason = F.when(many, F.lit("found multiple rows for the filter"))
    return rows.withColumns({ROUTE: route, REASON: reason, output: F.when(~many, F.col(output))}).drop("__many")


def cell_by_filter(cells: DataFrame, where: Column, family: str | None = None, qualifier: str | None = None, output: str = "value") -> DataFrame:
    """One row: a cell of the only row that satisfies ``where``.

    Without a family and qualifier it is the row's last cell. More than one matching row is a
    ``failure``, none is ``empty``.
    """
    return _only_row_routes(cells.where(where).agg(*_only_row(family, qualifier, output)), output)


def lookup_cells(
    df: DataFrame,
    cells: DataFrame,
    column: str,
    *,
    family: str | None = None,
    qualifier: str | None = None,
    prefix: bool = False,
    output: str = "value",
) -> DataFrame:
    """:func:`cell_by_filter` for every row of ``df``: row key equal to ``column``.

    With ``prefix`` the row key has to begin with it. The prefixes asked for are an index of intervals: of all
    that a key begins with, the last one not above the key tells the others (``_by_prefix``). A cell is copied
    once for every prefix it has, so not at all without a hit. The cells are reduced to one row per key or prefix
    before they meet the rows, so matches are never paired up. The keys asked for are measured first; while
    they are few, other cells are dropped at the scan.
    """
    wanted = F.col(quoted(column))
    if prefix:
        found = _by_prefix(cells, df.select(wanted.alias("__find")).where(wanted.isNotNull()).distinct()).groupBy("__find").agg(*_only_row(family, qualifier, output))
        found, found_side = measured(found, "cells")
        return _only_row_routes(df.join(found_side(found), wanted == F.col("__find"), "left").drop("__find"), output)
    cells = cells.withColumn("__find", F.col("row_key"))
    asked, small_side = measured(df.select(wanted.alias("__find")).where(wanted.isNotNull()).distinct(), "lookups")
    if small_side is F.broadcast:
        cells = cells.join(F.broadcast(asked), "__find", "left_semi")
    found = cells.groupBy("__find").agg(*_only_row(family, qualifier, output))
    if small_side is F.broadcast:
        # few rows now, but only their size tells whether they may be broadcast
        found, found_side = measured(found, "cells")
        found = found_side(found)
    return _only_row_routes(df.join(found, wanted == F.col("__find"), "left").drop("__find"), output)


def _by_prefix(cells: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The cells with every one of the ``prefixes`` (column ``__find``) that their row key begins with.

    Keys that begin with p are the interval from p to the next text that does not. Whatever prefixes a
    key has, they are prefixes of the last text in the list that is not above the key, or that text itself. So a
    key looks up that one, by a search tree, and tries those that it brings along: by their lengths, which
    is all the tree has to hold of them.
    """
    saved, small_side = measured(prefixes, "prefixes")
    lengths = sorted(r[0] for r in saved.select(F.length("__find")).distinct().collect())
    if not lengths:
        return cells.select("*", F.lit(None).cast("string").alias("__find")).where("false")
    # the shorter prefixes that each one begins with; only the list itself is copied for this
    heads = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.when(n < F.length("__find"), F.substring("__find", F.lit(1), n))), lambda h: h.isNotNull())
    shorter = saved.select("__find", F.explode(heads).alias("__head")).join(small_side(saved.select(F.col("__find").alias("__head"))), "__head", "left_semi")
    chains = saved.select("__find", F.col("__find").alias("__head")).unionByName(shorter).groupBy(F.col("__find").alias("__o")).agg(F.collect_list(F.length("__head")).alias("lengths"))
    chains, _ = measured(chains, "chains")
    numbered = running(chains, [], ["__o"], [Running("__n", "count")], split=plan_split(chains, [], ["__o"]))
    tree = search_tree(numbered.select("__n", "__o", "lengths"), [], ["lengths"])
    placed = place_among(spread(cells), tree, [], F.col("row_key"), "__place", inclusive=True, entry="__last")
    heads = F.transform(F.col("__last.lengths"), lambda n: F.substring(F.col("__last.__o"), F.lit(1), n))
    hits = F.filter(heads, lambda p: F.startswith(F.col("row_key"), p))
    return placed.select(*[F.col(quoted(c)) for c in cells.columns], F.explode(hits).alias("__find"))


def truncate_cells(cells: DataFrame, tables: str | Sequence[str]) -> DataFrame:
    """All cells but those of the named tables (a comma list is not trimmed)."""
    names = split_list(tables)
    return cells.where(~F.col("table").isin(*names)) if names else cells


def cell_value(attrs: Column, family: str, qualifier: str) -> Column:
    """One cell of a record scanned with ``name_format='family.qualifier'``, else null."""
    return F.element_at(attrs, f"{family}.{qualifier}")
