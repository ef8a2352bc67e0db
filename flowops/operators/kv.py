"""Key/value tables ``(key, value)``: read, write, conditional write, remove.

Requests are DataFrames as well. Writes return a new table; nothing is changed in place. When
several requests name one key they are taken in the order of ``order_by``, and they are reduced
per key by pre-aggregated group-bys before they meet the table. The reduced requests are saved
and measured: while they are small the table is only scanned, else both sides are shuffled. The
table has one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import DEFAULT_MAX_ROWS, Running, follow_chain, next_match, plan_split, running
from ..routes import with_route
from ..session import cut_lineage, measured


def _first(requests: DataFrame, order_by: str) -> DataFrame:
    return requests.groupBy("key").agg(F.min_by("value", order_by).alias("value"), F.min(order_by).alias("__first"))


def _hits(table: DataFrame, keys: DataFrame, small_side) -> DataFrame:
    """Rows of the table with one of the keys, found without a shuffle of the table if they are few."""
    return table.select("key", "value").join(small_side(keys.select("key")), "key", "left_semi")


def kv_put(table: DataFrame, updates: DataFrame, order_by: str) -> DataFrame:
    """Upsert; the last value of a key in ``updates`` stays."""
    last, small_side = measured(updates.groupBy("key").agg(F.max_by("value", order_by).alias("value")), "puts")
    kept = table.select("key", "value").join(small_side(last.select("key")), "key", "left_anti")
    return kept.unionByName(last)


def kv_put_if_absent(table: DataFrame, updates: DataFrame, order_by: str) -> DataFrame:
    """Insert only keys that are absent; the first value of a key in ``updates`` stays."""
    first, small_side = measured(_first(updates, order_by).select("key", "value"), "puts")
    present = _hits(table, first, small_side).select("key")
    fresh = first.join(small_side(present), "key", "left_anti")
    return table.select("key", "value").unionByName(fresh)


def kv_put_if_absent_results(table: DataFrame, updates: DataFrame, order_by: str) -> DataFrame:
    """Each request with ``ok``: whether it was the one that inserted its key."""
    return kv_get_and_put_if_absent(table, updates, order_by).withColumn("ok", F.col("__inserted")).select(*updates.columns, "ok")


def kv_get_and_put_if_absent(table: DataFrame, updates: DataFrame, order_by: str) -> DataFrame:
    """Each request with ``previous``: the value it found, null for the one that inserted.

    The new table is :func:`kv_put_if_absent`.
    """
    first, small_side = measured(_first(updates, order_by), "gets")
    present = _hits(table, first, small_side).select("key", F.col("value").alias("__old"), F.lit(True).alias("__hit"))
    found = first.join(present, "key", "left")
    found = found.select("key", F.col("value").alias("__new"), "__first", "__old", F.coalesce("__hit", F.lit(False)).alias("__hit"))
    found, found_side = measured(found, "gets")
    rows = updates.join(found_side(found), "key", "left")
    inserted = ~F.col("__hit") & (F.col(order_by) == F.col("__first"))
    previous = F.when(F.col("__hit"), F.col("__old")).when(~inserted, F.col("__new"))
    return rows.withColumns({"previous": previous, "__inserted": inserted}).select(*updates.columns, "previous", "__inserted")


def kv_check_and_put(
    table: DataFrame, requests: DataFrame, order_by: str, *, fold_rows: int = 1000, max_rows: int | None = DEFAULT_MAX_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Write ``value`` where the current value equals ``expected`` (null = key absent).

    Returns the new table and the requests (key, expected, value, order) with ``ok``. Requests of
    equal order are taken by ``expected``, null first, and then by ``value``. The
    requests of a key with at most ``fold_rows`` of them are folded in its one row. Keys with more
    are solved as chains: the first request that expects the stored value succeeds, the next to
    succeed is the first later one that expects what it wrote, and so on; the links come from
    a running aggregate and are followed by pointer doubling, so a key may have any number.
    """
    asked = requests.select("key", "expected", "value", order_by)
    counts, small_side = measured(asked.groupBy("key").agg(F.count(F.lit(1)).alias("__n")), "requests")
    current = _hits(table, counts, small_side).select("key", F.col("value").alias("__cur"))
    busy, busy_side = measured(counts.where(F.col("__n") > fold_rows).select("key"), "busy")
    busy = busy_side(busy)
    if busy.isEmpty():
        writes, results = _fold(asked, current, order_by)
    else:
        writes, results = _fold(asked.join(busy, "key", "left_anti"), current, order_by)
        more_writes, more_results = _chain(asked.join(busy, "key", "left_semi"), current, order_by, max_rows)
        writes, results = writes.unionByName(more_writes), results.unionByName(more_results)
    kept = table.select("key", "value").join(small_side(writes.select("key")), "key", "left_anti")
    return kept.unionByName(writes), results


def _fold(asked: DataFrame, current: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(key, value) written last, and the requests with ``ok``, for keys with few requests."""
    in_order = F.sort_array(F.collect_list(F.struct(order, "expected", "value")))
    rows = asked.groupBy("key").agg(in_order.alias("__asked")).join(current, "key", "left")

    def step(done: Column, request: Column) -> Column:
        ok = done["value"].eqNullSafe(request["expected"])
        return F.struct(
            F.when(ok, request["value"]).otherwise(done["value"]).alias("value"),
            F.concat(done["oks"], F.array(ok)).alias("oks"),
        )

    start = F.struct(F.col("__cur").alias("value"), F.array().cast("array<boolean>").alias("oks"))
    rows = rows.withColumn("__done", F.aggregate("__asked", start, step))
    writes = rows.where(F.exists("__done.oks", lambda ok: ok)).select("key", F.col("__done.value").alias("value"))
    paired = F.arrays_zip(F.col("__asked").alias("asked"), F.col("__done.oks").alias("ok"))
    results = rows.select("key", F.inline(paired)).select("key", "asked.expected", "asked.value", f"asked.{order}", "ok")
    return writes, results


def _chain(asked: DataFrame, current: DataFrame, order: str, max_rows: int | None) -> tuple[DataFrame, DataFrame]:
    """The same for keys with any number of requests.

    Places in the total order stand for ``order``, so equal ones do no harm.
    """
    total = [order, "expected", "value"]
    places = running(asked, ["key"], total, [Running("__at", "count")], inclusive=True, split=plan_split(asked, ["key"], total, max_rows))
    places = cut_lineage(places, "places")
    # one row for each expected value meets the table, however many requests expect it
    first = places.groupBy("key", "expected").agg(F.min("__at").alias("__at"))
    heads = first.join(current, "key", "left").where(F.col("expected").eqNullSafe(F.col("__cur"))).select("key", "__at")
    links = next_match(places, ["key"], "__at", "value", "expected", max_rows)
    done = cut_lineage(follow_chain(heads, links, ["key"], "__at", max_rows).withColumn("ok", F.lit(True)), "done")
    results = places.join(done, ["key", "__at"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    writes = results.where("ok").groupBy("key").agg(F.max_by("value", "__at").alias("value"))
    return writes, results.select("key", "expected", "value", order, "ok")


def kv_get(df: DataFrame, table: DataFrame, key: str, output: str = "value") -> DataFrame:
    """Value of each row's key, null where there is none.

    A key that the table has more than once has no value: the row stays one row, with a null, on
    the ``failure`` route.
    """
    lookup = table.groupBy(F.col("key").alias("__key")).agg(F.min("value").alias(output), F.count(F.lit(1)).alias("__rows"))
    rows = df.join(lookup, F.col(key) == F.col("__key"), "left")
    several = F.coalesce(F.col("__rows") > 1, F.lit(False))
    rows = with_route(rows, [(several, "the key has more than one row")])
    return rows.withColumn(output, F.when(~several, F.col(output))).drop("__key", "__rows")


def kv_contains(df: DataFrame, table: DataFrame, key: str, output: str = "found") -> DataFrame:
    """Whether each row's key exists."""
    lookup = table.select(F.col("key").alias("__key")).distinct().withColumn(output, F.lit(True))
    return df.join(lookup, F.col(key) == F.col("__key"), "left").drop("__key").withColumn(output, F.coalesce(output, F.lit(False)))


def kv_remove(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The table without the given keys."""
    gone, small_side = measured(keys.select("key").distinct(), "removes")
    return table.join(small_side(gone), "key", "left_anti")


def kv_remove_results(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Each distinct key to remove with ``ok``: whether it was there."""
    asked, small_side = measured(keys.select("key").distinct(), "removes")
    present = _hits(table, asked, small_side).select("key", F.lit(True).alias("__hit"))
    return asked.join(small_side(present), "key", "left").select("key", F.coalesce("__hit", F.lit(False)).alias("ok"))


def duplicate_keys(table: DataFrame) -> DataFrame:
    """Keys that break the one-row-per-key rule, with their number of rows."""
    return table.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
