"""Change-data-capture trails: decode, render as statements, merge images, replay on a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.maps import last_wins, materialise, sorted_json
from ..functions.names import apply_case, map_column, override_schema, split_list, table_without_schema
from ..functions.template import quoted
from ..functions.values import sql_literal
from ..plans import DEFAULT_MAX_ROWS, Running, plan_split, running
from ..routes import REASON, ROUTE, SUCCESS, with_route
from ..session import measured

# The fields of a trail record and its operation codes.
TRAIL_SCHEMA = (
    "table string, op_type string, op_ts string, current_ts string, pos string, "
    "primary_keys array<string>, before map<string,variant>, after map<string,variant>"
)
OPERATIONS = ("I", "U", "D")

UNSUPPORTED = "unsupported"
NOOP = "noop"

_CORRUPT = "__corrupt"


def parse_trail(df: DataFrame, content: str = "content", output: str = "trail") -> DataFrame:
    """Decode one trail object per row into a struct column.

    Text that is not a trail object goes to ``failure``; the other rows to ``success``.
    """
    schema = f"{TRAIL_SCHEMA}, {_CORRUPT} string"
    parsed = F.from_json(F.col(content), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = materialise(df, {output: parsed})
    trail = F.col(output)
    rows = with_route(
        rows,
        [
            (F.col(content).isNull() | trail[_CORRUPT].isNotNull(), "content is not a trail object"),
            (trail["table"].isNull(), "table is missing"),
            (trail["op_type"].isNull(), "op_type is missing"),
        ],
    )
    return rows.withColumn(output, trail.dropFields(_CORRUPT))


def _text(value: Column) -> Column:
    # a null in the JSON and an absent key both read as null text
    return value.cast("string")


def _keys_of(trail: Column, key_columns: Sequence[str]) -> Column:
    if key_columns:
        return F.array(*[F.lit(k) for k in key_columns])
    return F.coalesce(trail["primary_keys"], F.array().cast("array<string>"))


def trail_statements(
    df: DataFrame,
    trail: str = "trail",
    *,
    case: str = "None",
    schema: str | None = None,
    semicolon: bool = False,
    key_columns: str | Sequence[str] | None = None,
    column_map: Mapping[str, str] | None = None,
    output: str = "statement",
) -> DataFrame:
    """INSERT, UPDATE or DELETE text of every change; values are quoted text.

    ``key_columns`` replaces the record's own keys, ``column_map`` renames
    ``<table>.<column>``. Rows without a statement keep a null and say why in ``route``:
    ``failure`` (not a trail object, no image to read from, no keys), ``unsupported`` operation, or ``noop`` for an
    update that changes nothing but keys. Takes the result of :func:`parse_trail`.
    """
    record = F.col(trail)
    bare = table_without_schema(record["table"])
    target = apply_case(override_schema(record["table"], schema), case)
    keys = _keys_of(record, split_list(key_columns))

    def name(column: Column) -> Column:
        return map_column(bare, column, column_map, case)

    after = F.map_entries(record["after"])
    columns = F.array_join(F.transform(after, lambda e: name(e["key"])), ", ")
    values = F.array_join(F.transform(after, lambda e: sql_literal(_text(e["value"]))), ", ")
    insert = F.concat(F.lit("INSERT INTO "), target, F.lit(" ("), columns, F.lit(") VALUES ("), values, F.lit(")"))

    changed = F.filter(after, lambda e: ~F.array_contains(keys, e["key"]))
    assign = F.array_join(
        F.transform(changed, lambda e: F.concat(name(e["key"]), F.lit(" = "), sql_literal(_text(e["value"])))), ", "
    )

    def condition(key: Column) -> Column:
        value = _text(F.element_at(record["before"], key))
        return F.concat(name(key), F.when(value.isNull(), F.lit(" IS null")).otherwise(F.concat(F.lit(" = "), sql_literal(value))))

    where = F.concat(F.lit(" WHERE "), F.array_join(F.transform(keys, condition), " AND "))
    update = F.concat(F.lit("UPDATE "), target, F.lit(" SET "), assign, where)
    delete = F.concat(F.lit("DELETE FROM "), target, where)

    op = record["op_type"]
    route = (
        F.when(F.col(ROUTE) != SUCCESS, F.col(ROUTE))
        .when(~op.isin(*OPERATIONS), UNSUPPORTED)
        .when((op == "I") & record["after"].isNull(), "failure")
        .when((op == "U") & record["after"].isNull(), "failure")
        .when(op.isin("U", "D") & record["before"].isNull(), "failure")
        .when(op.isin("U", "D") & (F.size(keys) == 0), "failure")
        .when((op == "U") & (F.size(changed) == 0), NOOP)
        .otherwise(SUCCESS)
    )
    reason = F.coalesce(
        F.col(REASON),
        F.when(~op.isin(*OPERATIONS), F.concat(F.lit("unsupported op_type "), op))
        .when(op.isin("I", "U") & record["after"].isNull(), F.lit("after image is missing"))
        .when(op.isin("U", "D") & record["before"].isNull(), F.lit("before image is missing"))
        .when(op.isin("U", "D") & (F.size(keys) == 0), F.lit("primary key column(s) are required for this operation")),
    )
    text = F.when(op == "I", insert).when(op == "U", update).when(op == "D", delete)
    if semicolon:
        text = F.concat(text, F.lit(";"))
    rows = df.withColumns({ROUTE: route, REASON: reason})
    return rows.withColumn(output, F.when(F.col(ROUTE) == SUCCESS, text))


def merge_views(
    df: DataFrame,
    trail: str = "trail",
    *,
    case: str = "None",
    schema: str | None = None,
    header_fields: str | Sequence[str] | None = None,
    trim: bool = False,
    constants: Mapping[str, str | Column] | None = None,
    content: str = "content",
    output: str = "merged",
) -> DataFrame:
    """One JSON object per change, keys ascending.

    From lowest to highest precedence: the chosen header fields, the before image, the after
    image, the constants (whose names are not folded). An operation other than I, U or D goes
    to ``unsupported``. ``header_fields`` as text is split at commas and not trimmed unless
    ``trim`` is set; any field of the record that is neither an object nor an array can be named,
    and keeps its type. Takes the result of :func:`parse_trail`, with the record's text in
    ``content``.
    """
    record = F.col(trail)
    wanted = [f.strip() if trim else f for f in split_list(header_fields)]
    chosen = list(dict.fromkeys(wanted))
    if set(chosen) - {"table"}:  # the text is read again only for fields that the struct does not hold as they are
        df = materialise(df, {"__header": F.from_json(F.col(content), "map<string,variant>")})

    def header(field: str) -> Column:
        if field == "table":
            return apply_case(override_schema(record["table"], schema), case).cast("variant")
        value = F.element_at(F.col("__header"), field)
        nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY|VOID)")
        return F.when(~nested, value)

    # each source is (names, values, present); a header field that is not in the record is left out
    present = F.filter(
        F.array(*[F.struct(apply_case(F.lit(f), case).alias("k"), header(f).alias("v")) for f in chosen]),
        lambda e: e["v"].isNotNull(),
    ) if chosen else None

    empty = F.create_map().cast("map<string,variant>")
    before = F.coalesce(record["before"], empty)
    after = F.coalesce(record["after"], empty)
    keys, values = [], []
    if present is not None:
        keys.append(F.transform(present, lambda e: e["k"]))
        values.append(F.transform(present, lambda e: e["v"]))
    for image in (before, after):
        keys.append(F.transform(F.map_keys(image), lambda k: apply_case(k, case)))
        values.append(F.map_values(image))
    if constants:
        keys.append(F.array(*[F.lit(k) for k in constants]))
        fixed = [v if isinstance(v, Column) else F.lit(v) for v in constants.values()]
        values.append(F.array(*[v.cast("string").cast("variant") for v in fixed]))

    op = record["op_type"]
    supported = op.isin(*OPERATIONS)
    rows = df.withColumn(ROUTE, F.when(F.col(ROUTE) != SUCCESS, F.col(ROUTE)).when(supported, SUCCESS).otherwise(UNSUPPORTED))
    return rows.withColumn(output, F.when(F.col(ROUTE) == SUCCESS, sorted_json(F.concat(*keys), F.concat(*values)))).drop("__header")


def image_as_map(image: Column, case: str = "None") -> Column:
    """An image with folded names; where two names fold to one, the later value stays."""
    return last_wins(F.transform(F.map_keys(image), lambda k: apply_case(k, case)), F.map_values(image))


def route_changes(
    base: DataFrame | T.StructType,
    trail: DataFrame,
    keys: Sequence[str],
    *,
    record: str = "trail",
    order_by: Column | None = None,
    case: str = "None",
) -> DataFrame:
    """The rows of ``trail`` with the route each takes when it is applied to ``base``, a table or its schema.

    ``failure``: a missing image or key, no usable place, or a value that does not convert to its
    column's type; :func:`apply_changes` leaves such changes out. An explicit null converts. Rows
    off the success route stay as they are.
    """
    fields = _fields(base)
    change = F.col(record)
    op = change["op_type"]
    place = change["pos"].try_cast("decimal(38,0)") if order_by is None else order_by
    rows = materialise(trail, {"__before": _folded(change["before"], case), "__after": _folded(change["after"], case)})
    key_map = F.when(op == "I", F.col("__after")).otherwise(F.col("__before"))

    def broken(image: Column, column: str) -> Column:
        value = F.element_at(image, column)
        return value.isNotNull() & ~F.is_variant_null(value) & _typed(value, fields[column]).isNull()

    problems = [
        (op.isin("I", "U") & F.col("__after").isNull(), "after image is missing"),
        (op.isin("U", "D") & F.col("__before").isNull(), "before image is missing"),
        (place.isNull(), "the change has no usable place"),
        *[(~F.map_contains_key(key_map, k), f"key {k} is missing") for k in keys],
        *[(broken(key_map, k), f"key {k} does not convert") for k in keys],
        *[(op.isin("I", "U") & broken(F.col("__after"), c), f"{c} does not convert") for c in fields if c not in keys],
    ]
    # the first that holds; a test on a missing image is null and so does not
    why = F.coalesce(*[F.when(test, F.lit(text)) for test, text in problems])
    taken = (F.col(ROUTE) == SUCCESS) & op.isin(*OPERATIONS)
    rows = materialise(rows, {"__why": F.when(taken, why)})
    rows = rows.withColumns({ROUTE: F.when(F.col("__why").isNotNull(), "failure").otherwise(F.col(ROUTE)), REASON: F.coalesce("__why", REASON)})
    return rows.drop("__before", "__after", "__why")


def _fields(table: DataFrame | T.StructType) -> dict[str, T.DataType]:
    schema = table if isinstance(table, T.StructType) else table.schema
    return {f.name: f.dataType for f in schema.fields}


def fold_changes(
    table: T.StructType,
    trail: DataFrame,
    keys: Sequence[str],
    *,
    record: str = "trail",
    order_by: Column | None = None,
    case: str = "None",
) -> DataFrame:
    """One row per changed key: what all its changes come to, whatever row they meet.

    ``__k<i>`` are the keys, ``__anchor`` and ``__anchor_op`` the place and operation of the last insert or
    delete, and for every other column ``__at<i>`` and ``__new<i>`` are the place and value of its last write.
    Folds of two sets of changes fold to that of both.
    """
    fields = _fields(table)
    others = [c for c in fields if c not in keys]
    change = F.col(record)
    trail = route_changes(table, trail, keys, record=record, order_by=order_by, case=case)
    rows = trail.where((F.col(ROUTE) == SUCCESS) & change["op_type"].isin(*OPERATIONS))
    place = change["pos"].try_cast("decimal(38,0)") if order_by is None else order_by
    rows = rows.select(
        change["op_type"].alias("__op"),
        place.alias("__pos"),
        _folded(change["before"], case).alias("__before"),
        _folded(change["after"], case).alias("__after"),
    )
    rows = rows if case == "None" else materialise(rows.select("__op", "__pos", "__before", "__after"), {n: F.col(n) for n in ("__before", "__after")})
    key_map = F.when(F.col("__op") == "I", F.col("__after")).otherwise(F.col("__before"))
    writes = F.col("__op").isin("I", "U")
    columns = {f"__k{i}": _typed(F.element_at(key_map, k), fields[k]) for i, k in enumerate(keys)}
    for i, c in enumerate(others):
        columns[f"__has{i}"] = writes & F.map_contains_key(F.col("__after"), c)
        columns[f"__v{i}"] = _typed(F.element_at(F.col("__after"), c), fields[c])
    flat = rows.select("__op", "__pos", *[v.alias(n) for n, v in columns.items()])

    # last insert or delete, and the last value of every column with its position
    anchors = F.when(F.col("__op").isin("I", "D"), F.col("__pos"))
    folds = [
        F.max(anchors).alias("__anchor"),
        F.max_by("__op", anchors).alias("__anchor_op"),
    ]
    for i in range(len(others)):
        at = F.when(F.col(f"__has{i}"), F.col("__pos"))
        folds += [F.max(at).alias(f"__at{i}"), F.max_by(f"__v{i}", at).alias(f"__new{i}")]
    return flat.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(*folds)


# ------------------------------------------------------------------ changes that come bit by bit

_PLACE = T.DecimalType(38, 0)


def changes_schema(table: T.StructType, keys: Sequence[str]) -> T.StructType:
    """Columns of the state of a changed table: keys, the row at the start (``__base``), and the fold of all changes."""
    fields = _fields(table)
    others = [c for c in fields if c not in keys]
    made = [T.StructField(f"__k{i}", fields[k]) for i, k in enumerate(keys)]
    made.append(T.StructField("__base", T.StructType([*[T.StructField(f"c{i}", fields[c]) for i, c in enumerate(others)], T.StructField("there", T.BooleanType())])))
    made += [T.StructField("__anchor", _PLACE), T.StructField("__anchor_op", T.StringType())]
    for i, c in enumerate(others):
        made += [T.StructField(f"__at{i}", _PLACE), T.StructField(f"__new{i}", fields[c])]
    return T.StructType(made)


def start_changes(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of a table that nothing has changed yet; the table has one row per key."""
    others = [c for c in base.columns if c not in keys]
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)], F.lit(True).alias("there"))
    start = base.select(*[F.col(quoted(k)).alias(f"__k{i}") for i, k in enumerate(keys)], row.alias("__base"))
    schema = changes_schema(base.schema, keys)
    return start.select(*[F.col(f.name) if f.name in start.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def change_keys(rows: DataFrame, table: T.StructType, keys: Sequence[str], *, content: str = "content", case: str = "None", **_: object) -> list[Column]:
    """The keys each trail text changes, as the table's types; null where it has none."""
    fields = _fields(table)
    record = F.from_json(F.col(content), TRAIL_SCHEMA)
    image = F.when(record["op_type"] == "I", _folded(record["after"], case)).otherwise(_folded(record["before"], case))
    return [_typed(F.element_at(image, k), fields[k]) for k in keys]


def fold_into(state: DataFrame, trail: DataFrame, table: T.StructType, keys: Sequence[str], *, record: str = "trail", order_by: Column | None = None, case: str = "None") -> DataFrame:
    """The state with more changes, wherever their places lie; ``order_by`` must give whole numbers here."""
    schema = changes_schema(table, keys)
    new = fold_changes(table, trail, keys, record=record, order_by=order_by, case=case)
    new = new.select(*[(F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    folds = [F.first("__base", ignorenulls=True).alias("__base"), F.max("__anchor").alias("__anchor"), F.max_by("__anchor_op", "__anchor").alias("__anchor_op")]
    for name in schema.names:
        if name.startswith("__at"):
            i = name[len("__at"):]
            folds += [F.max(name).alias(name), F.max_by(f"__new{i}", name).alias(f"__new{i}")]
    return state.unionByName(new).groupBy(*schema.names[: len(keys)]).agg(*folds).select(*schema.names)


def changed_table(state: DataFrame, table: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The table that a state stands for, as :func:`apply_changes` gives it for all changes at once."""
    fields = _fields(table)
    others = [c for c in fields if c not in keys]
    kept = F.col("__anchor").isNull() & F.col("__base").isNotNull()

    def value(c: str) -> Column:
        i = others.index(c)
        at, new = F.col(f"__at{i}"), F.col(f"__new{i}")
        before = F.when(at.isNotNull(), new).otherwise(F.col(f"__base.c{i}"))
        return F.when(F.col("__anchor").isNull(), before).otherwise(F.when(at >= F.col("__anchor"), new))

    rows = state.where(kept | (F.col("__anchor_op") == "I"))
    return rows.select(*[F.col(f"__k{list(keys).index(c)}").alias(c) if c in keys else value(c).alias(c) for c in fields])


def apply_changes(
    base: DataFrame,
    trail: DataFrame,
    keys: Sequence[str],
    *,
    record: str = "trail",
    order_by: Column | None = None,
    case: str = "None",
) -> DataFrame:
    """The table ``base`` after replaying all changes in order of ``pos``, a whole number, or ``order_by``.

    An insert (re)creates the row from its after image, a delete removes it, and an update
    sets just the columns its after image names, explicit nulls included; key columns never
    change and an update of a missing row does nothing. ``trail`` is the result of
    :func:`parse_trail`; rows not on the success route are ignored, and so are changes that
    :func:`route_changes` routes to failure. The keys of a change are
    read from ``before`` for updates and deletes and from ``after`` for inserts.

    The changes are reduced to one row per key by a single pre-aggregated group-by, so a key
    with very many changes costs its map tasks little more than any other. The reduced changes
    are saved and measured; while they are small the base is only scanned, else both are shuffled
    once by key.
    """
    fields = _fields(base)
    others = [c for c in fields if c not in keys]
    key_names = [f"__k{i}" for i in range(len(keys))]
    folded = fold_changes(base.schema, trail, keys, record=record, order_by=order_by, case=case)
    last, small_side = measured(folded, "changes")

    def since_anchor(i: int) -> Column:
        return F.col(f"__at{i}") >= F.col("__anchor")

    on = [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(keys, key_names)]
    kept = base.join(small_side(last), on, "left").where(F.col("__anchor").isNull())
    kept = kept.select(
        *[
            F.col(quoted(c)) if c in keys
            else F.when(F.col(f"__at{others.index(c)}").isNotNull(), F.col(f"__new{others.index(c)}")).otherwise(F.col(quoted(c))).alias(c)
            for c in fields
        ]
    )
    created = last.where(F.col("__anchor_op") == "I").select(
        *[
            F.col(key_names[list(keys).index(c)]).alias(c) if c in keys
            else F.when(since_anchor(others.index(c)), F.col(f"__new{others.index(c)}")).alias(c)
            for c in fields
        ]
    )
    return kept.unionByName(created)


def count_replaced(
    base: DataFrame,
    trail: DataFrame,
    keys: Sequence[str],
    *,
    record: str = "trail",
    order_by: Column | None = None,
    case: str = "None",
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """One row: how many inserts replace a row, one of ``base`` or one that an earlier insert made.

    Takes the same changes as :func:`apply_changes`.
    """
    change = F.col(record)
    rows = route_changes(base, trail, keys, record=record, order_by=order_by, case=case)
    rows = rows.where((F.col(ROUTE) == SUCCESS) & change["op_type"].isin("I", "D"))
    place = change["pos"].try_cast("decimal(38,0)") if order_by is None else order_by
    image = F.when(change["op_type"] == "I", _folded(change["after"], case)).otherwise(_folded(change["before"], case))
    names = [f"__k{i}" for i in range(len(keys))]
    rows = rows.select(change["op_type"].alias("__op"), place.alias("__pos"), *[_typed(F.element_at(image, k), base.schema[k].dataType).alias(n) for k, n in zip(keys, names)])
    rows = running(rows, names, ["__pos"], [Running("__previous", "last", F.col("__op"))], split=plan_split(rows, names, ["__pos"], max_rows))
    inserts = rows.where(F.col("__op") == "I")
    again = inserts.where(F.col("__previous") == "I").select(F.lit(1).alias("one"))
    on = [F.col(n).eqNullSafe(F.col(quoted(k))) for k, n in zip(keys, names)]
    first = inserts.where(F.col("__previous").isNull()).join(base.select(*keys), on, "left_semi").select(F.lit(1).alias("one"))
    return again.unionByName(first).agg(F.count(F.lit(1)).alias("replaced"))


def _folded(image: Column, case: str) -> Column:
    return image if case == "None" else image_as_map(image, case)


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.cast("string").try_cast(kind)
    return F.try_variant_get(value, "$", kind.simpleString())
