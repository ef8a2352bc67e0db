"""Keyed state: compare a value with the stored one, and hold or release a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import DEFAULT_MAX_ROWS, PART, Running, Split, join_parts, part_groups, plan_split, running, with_part
from ..routes import EMPTY, FAILURE, REASON, ROUTE, SUCCESS

# The accepted replace settings.
REPLACE_WHEN = ("Less Than", "Greater Than", "Equal To", "Not Equal To", "Never")

# Fixed value: what a lock holds when the caller gave no value of its own.
HOLDING = "!--holding--!"

_RUNNING_KIND = {"Greater Than": "max", "Less Than": "min", "Equal To": "first", "Never": "first", "Not Equal To": "last"}


def _order(order_by: str | Sequence[str]) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


def _stored_then_seen(kind: str, stored: Column, seen: Column) -> Column:
    """State after both the stored value and the values seen since."""
    return {
        "max": F.greatest(stored, seen),
        "min": F.least(stored, seen),
        "first": F.coalesce(stored, seen),
        "last": F.coalesce(seen, stored),
    }[kind]


def _comparable(df: DataFrame, value: str | None, content: str | None) -> Column:
    candidates = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in (value, content) if c]
    return F.coalesce(*candidates)


def check_state(
    df: DataFrame,
    key: str,
    value: str,
    order_by: str | Sequence[str],
    *,
    replace_when: str = "Greater Than",
    content: str | None = None,
    previous: str = "previous_state",
    state: DataFrame | None = None,
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Route every row by comparing its value, as text, with the state of its key.

    ``content`` is the column used where ``value`` is empty; a row with neither goes to
    ``empty`` and leaves the state alone. ``state`` is a (key, value) table to start from.
    Adds ``previous`` and ``route`` (less, greater, equal, initial, empty).
    """
    kind = _kind(replace_when)
    order = _order(order_by)
    rows = df.withColumn("__value", _comparable(df, value, content))
    split = plan_split(rows, [key], order, max_rows)
    rows = running(rows, [key], order, [Running("__seen", kind, F.col("__value"))], split=split)
    before = F.col("__seen")
    if state is not None:
        rows = rows.join(_stored(state), F.col(key).eqNullSafe(F.col("__state_key")), "left")
        before = _stored_then_seen(kind, F.col("__stored"), F.col("__seen"))
    rows = rows.withColumn("__before", F.when(F.col("__value").isNotNull(), before))
    route = (
        F.when(F.col("__value").isNull(), EMPTY)
        .when(F.col("__before").isNull(), "initial")
        .when(F.col("__value") < F.col("__before"), "less")
        .when(F.col("__value") > F.col("__before"), "greater")
        .otherwise("equal")
    )
    return rows.withColumns({previous: F.col("__before"), ROUTE: route}).select(*df.columns, previous, ROUTE)


def check_state_after(
    df: DataFrame,
    key: str,
    value: str,
    order_by: str | Sequence[str],
    *,
    replace_when: str = "Greater Than",
    content: str | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """The (key, value) state table once all rows of ``df`` have been compared."""
    kind = _kind(replace_when)
    order = F.struct(*[F.col(o) for o in _order(order_by)])
    rows = df.withColumn("__value", _comparable(df, value, content)).where(F.col("__value").isNotNull())
    seen = {
        "max": F.max("__value"),
        "min": F.min("__value"),
        "first": F.min_by("__value", order),
        "last": F.max_by("__value", order),
    }[kind]
    after = rows.groupBy(F.col(key).alias("key")).agg(seen.alias("__seen"))
    if state is None:
        return after.select("key", F.col("__seen").alias("value"))
    merged = after.join(_stored(state), F.col("key").eqNullSafe(F.col("__state_key")), "full")
    return merged.select(
        F.when(F.col("__seen").isNotNull(), F.col("key")).otherwise(F.col("__state_key")).alias("key"),
        _stored_then_seen(kind, F.col("__stored"), F.col("__seen")).alias("value"),
    )


def _kind(replace_when: str) -> str:
    if replace_when not in REPLACE_WHEN:
        raise ValueError(f"replace_when must be one of {REPLACE_WHEN}, not {replace_when!r}")
    return _RUNNING_KIND[replace_when]


def _stored(state: DataFrame) -> DataFrame:
    # an empty stored value counts as no state
    return state.select(F.col("key").alias("__state_key"), F.nullif(F.col("value"), F.lit("")).alias("__stored"))


def lock_name(topic: Column, key: Column) -> Column:
    return F.concat(topic.cast("string"), F.lit("."), key.cast("string"))


def hold_release(
    df: DataFrame,
    topic: str,
    key: str,
    action: str,
    order_by: str | Sequence[str],
    *,
    duplicate: str | None = None,
    held: DataFrame | None = None,
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Route ``hold`` and ``release`` requests on the lock ``topic.key`` in order.

    A hold is ``success`` on a free lock, ``duplicate`` if its ``duplicate`` value is the
    holder's, else ``busy``; a release is ``success`` on a held lock, else ``missing``. Any
    other action is a ``failure`` and changes nothing. ``held`` is a (key, value) table of
    locks held at the start. Adds ``lock``, ``holder`` (before the request) and ``route``.
    """
    order = _order(order_by)
    rows = _lock_rows(df, topic, key, action, duplicate)
    split = plan_split(rows, ["lock"], order, max_rows)
    rows = _with_holder(rows, order, held, split)
    is_held = F.col("holder").isNotNull()
    route = (
        F.when(F.col("lock").isNull() | F.col("__action").isNull(), FAILURE)
        .when(F.col("__action") == "release", F.when(is_held, SUCCESS).otherwise("missing"))
        .when(~is_held, SUCCESS)
        .when(F.col("__dup") == F.col("holder"), "duplicate")
        .otherwise("busy")
    )
    reason = F.when(F.col("lock").isNull(), "topic or key is missing").when(F.col("__action").isNull(), "action is neither hold nor release")
    return rows.withColumns({ROUTE: route, REASON: reason}).select(*df.columns, "lock", "holder", ROUTE, REASON)


def hold_release_after(
    df: DataFrame,
    topic: str,
    key: str,
    action: str,
    order_by: str | Sequence[str],
    *,
    duplicate: str | None = None,
    held: DataFrame | None = None,
    max_rows: int | None = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """The (key, value) table of locks still held once all requests are done."""
    order = _order(order_by)
    rows = _lock_rows(df, topic, key, action, duplicate).where(F.col("lock").isNotNull() & F.col("__action").isNotNull())
    rows = _with_holder(rows, order, held, plan_split(rows, ["lock"], order, max_rows))
    taken = F.coalesce(F.col("holder"), F.col("__offer"))
    last = rows.groupBy(F.col("lock").alias("key")).agg(
        F.max_by(F.when(F.col("__action") == "hold", taken), F.struct(*[F.col(o) for o in order])).alias("value")
    )
    if held is not None:
        untouched = held.select("key", "value").join(last.select("key"), "key", "left_anti")
        return untouched.unionByName(last.where(F.col("value").isNotNull()))
    return last.where(F.col("value").isNotNull())


def _lock_rows(df: DataFrame, topic: str, key: str, action: str, duplicate: str | None) -> DataFrame:
    dup = F.nullif(F.col(duplicate).cast("string"), F.lit("")) if duplicate else F.lit(None).cast("string")
    return df.withColumns(
        {
            "lock": lock_name(F.col(topic), F.col(key)),
            "__action": F.when(F.col(action).isin("hold", "release"), F.col(action)),
            "__dup": dup,
            "__offer": F.coalesce(dup, F.lit(HOLDING)),
        }
    )


def _with_holder(rows: DataFrame, order: list[str], held: DataFrame | None, split: Split | None) -> DataFrame:
    """Add ``holder``: the value the lock holds before each request, null on a free lock.

    After any hold the lock is held and after any release it is free, so the last action alone
    tells whether it is held; the holder is the last value offered to a free lock. Both windows
    use the same grouping and order, so the data is shuffled and sorted once.
    """
    if split is None:
        group = ["lock"]
        rows = rows.withColumns({"__entry": F.lit(None).cast("string"), "__released": F.lit(0).cast("long")})
    else:
        group = ["lock", PART]
        rows = with_part(rows, order, split)
        rows = join_parts(rows, ["lock"], _holders_at_entry(rows, order))
        rows = rows.withColumn("__entry", F.col("__before"))
    past = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__last", F.last("__action", ignorenulls=True).over(past))
    rows = rows.withColumn("__held", F.coalesce(F.col("__last") == "hold", F.col("__entry").isNotNull()))
    takes = F.when((F.col("__action") == "hold") & ~F.col("__held"), F.col("__offer"))
    freed = F.max(F.col("__action") == "release").over(past)
    rows = rows.withColumn("__takes", takes).withColumns({"__taken": F.last("__takes", ignorenulls=True).over(past), "__freed": freed})
    holder = F.when(F.col("__held"), F.coalesce("__taken", "__entry"))
    if held is None:
        return rows.withColumn("holder", holder)
    # a lock held from the start stays so until its first release, and what was held matters no more
    # behind it; joined here, a lock with many rows is not brought back to one task before the windows
    rows = rows.withColumn("holder", holder)
    stored = held.select(F.col("key").alias("__state_key"), F.col("value").alias("__stored"))
    rows = rows.join(stored, F.col("lock") == F.col("__state_key"), "left")
    still = (F.coalesce("__released", F.lit(0)) == 0) & ~F.coalesce("__freed", F.lit(False))
    return rows.withColumn("holder", F.when(still & F.col("__stored").isNotNull(), F.col("__stored")).otherwise(F.col("holder")))


def _holders_at_entry(rows: DataFrame, order: list[str]) -> DataFrame:
    """For every part of a large lock: its holder before the part, and how many parts had a release.

    From the rows two pre-aggregated totals per part are enough, the last release and the first
    hold after it. A part with a release forgets what was before; the holder after a part is the
    first hold since.
    """
    place = F.struct(*[F.col(o) for o in order])
    cut = rows.where(F.col(PART).isNotNull()).withColumn("__place", place)
    releases = cut.groupBy(*part_groups(["lock"])).agg(F.max(F.when(F.col("__action") == "release", F.col("__place"))).alias("__free"))
    holds = (F.col("__action") == "hold") & (F.col("__free").isNull() | (F.col("__place") > F.col("__free")))
    ends = join_parts(cut, ["lock"], releases).groupBy(*part_groups(["lock"])).agg(
        F.min_by("__offer", F.when(holds, F.col("__place"))).alias("__end"),
        F.max(F.col("__free").isNotNull().cast("int")).alias("__frees"),
    )
    parts = Window.partitionBy("__c0").orderBy("__p")
    ends = ends.withColumn("__since", F.sum("__frees").over(parts))
    since = Window.partitionBy("__c0", "__since").orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("__after", F.first("__end", ignorenulls=True).over(since))
    return ends.select(
        "__c0", "__p", F.lag("__after").over(parts).alias("__before"), F.lag("__since").over(parts).alias("__released")
    )
