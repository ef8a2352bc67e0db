"""Stateful operators on streams, one micro-batch at a time, with the batch operators.

The state is a table in hash buckets (:mod:`flowops.sources.buckets`). A micro-batch reads and
rewrites only the buckets of its own keys; version ``n`` follows from version ``n - 1`` and the
batch's rows alone, so a batch that is run again after a failure writes the same version again and
the checkpoint then continues behind it. Since the batch operators do the work, a key with very
many rows in one batch is cut like in a batch job.

*Expiry.* With ``ttl`` (seconds) and ``time`` (a timestamp column), the state of a key that is idle
is forgotten: where the first of its rows in a batch comes more than ``ttl`` after its last one
in earlier batches. State that is idle for so long against the latest time of earlier batches is
dropped whenever its bucket is rewritten, so a row that comes later than that may find it gone.
Without these options nothing expires.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import change_keys, changed_table, changes_schema, fold_into, parse_trail, route_changes, start_changes
from ..operators.sequence import assign_sequence, sequence_after
from ..operators.state import check_state, check_state_after, hold_release, hold_release_after, lock_name
from ..session import scratch_scope
from ..sources.buckets import BucketTable

KEY_VALUE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
SEQUENCES = T.StructType([T.StructField("seq", T.StringType()), T.StructField("value", T.LongType())])

#: Time of a key's last row; kept only where state expires.
USED_AT = "used_at"
#: Version of the state a stream begins with.
INITIAL = -1


@dataclass(frozen=True)
class Step:
    """``run(rows, state)`` gives the routed rows and the new state.

    ``row_keys`` gives the columns of a row that are its key in the state, ``keys`` names them there.
    The state handed in holds the buckets of the rows' keys, and the new one must hold them whole.
    """

    run: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]
    schema: T.StructType
    keys: tuple[str, ...]
    row_keys: Callable[[DataFrame], list[Column]]
    initial: Callable[[DataFrame], DataFrame] = lambda frame: frame


def state_table(step: Step, folder: str, buckets: int = 64, ttl: float | None = None) -> BucketTable:
    """The stored state of a stream."""
    timed = [T.StructField(USED_AT, T.TimestampType())] if ttl is not None else []
    return BucketTable(folder, T.StructType([*step.schema.fields, *timed]), step.keys, buckets)


def read_state(spark: SparkSession, step: Step, folder: str, version: int | None = None, *, buckets: int = 64, ttl: float | None = None) -> DataFrame:
    """State after a batch, the last one if none is named."""
    return state_table(step, folder, buckets, ttl).read(spark, version)


def run_stateful(
    stream: DataFrame,
    step: Step,
    state: str,
    output: str,
    checkpoint: str,
    *,
    initial: DataFrame | None = None,
    buckets: int = 64,
    time: str | None = None,
    ttl: float | None = None,
    **trigger,
) -> StreamingQuery:
    """Start a step on every micro-batch.

    Rows are written to ``output/batch=<n>`` by overwriting the batch's own path, states to the
    table ``state``. ``initial`` is the state before the first batch, ``buckets`` the number of
    parts it is kept in: choose it so that a bucket is a good file. The triggers are those of ``writeStream.trigger``.
    """
    if (time is None) != (ttl is None):
        raise ValueError("time and ttl go together")
    stored = state_table(step, state, buckets, ttl)

    def process(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = batch - 1 if batch > 0 else INITIAL if initial is not None else None
        if batch == 0 and initial is not None:
            first = step.initial(initial)
            stored.write(first if ttl is None else first.withColumn(USED_AT, F.lit(None).cast("timestamp")), INITIAL)
        # the batch is read by several passes
        rows = rows.persist()
        try:
            with scratch_scope(spark):
                _one_batch(rows, batch, before, step, stored, output, time, ttl)
            if batch > 0:
                # a repeated batch needs the version before it, none needs an older one
                stored.forget(spark, batch - 2, batch - 1)
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _one_batch(rows: DataFrame, batch: int, before: int | None, step: Step, stored: BucketTable, output: str, time: str | None, ttl: float | None) -> None:
    spark = rows.sparkSession
    manifest = stored.manifest(spark, before)
    keys = step.row_keys(rows)
    touched = stored.touched(rows, keys)
    known = stored.read_manifest(spark, manifest, touched)
    notes = {}
    if ttl is None:
        routed, after = step.run(rows, known)
    else:
        times = _times(rows, keys, step, time)
        latest = rows.agg(F.max(F.col(time).cast("timestamp")).alias("t")).first()["t"]
        seen = [t for t in (manifest.notes.get("latest"), latest.astimezone(timezone.utc).isoformat() if latest else None) if t]
        notes = {"latest": max(seen, default=None)}
        live = _live(known, times, step, manifest.notes.get("latest"), ttl)
        routed, after = step.run(rows, live.drop(USED_AT))
        after = _dated(after, live, times, step)
    stored.write(after, batch, before, touched, notes)
    routed.write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch={batch}")


def _alike(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def _times(rows: DataFrame, keys: list[Column], step: Step, time: str) -> DataFrame:
    """First and last time of every key in the batch."""
    at = F.col(time).cast("timestamp")
    names = [f"__t{i}" for i in range(len(keys))]
    typed = [k.cast(step.schema[s].dataType).alias(n) for k, s, n in zip(keys, step.keys, names, strict=True)]
    return rows.groupBy(*typed).agg(F.min(at).alias("__first"), F.max(at).alias("__last"))


def _live(known: DataFrame, times: DataFrame, step: Step, latest: str | None, ttl: float) -> DataFrame:
    """State that has not expired; state without a time does not."""
    age = F.make_dt_interval(secs=F.lit(float(ttl)))
    names = [c for c in times.columns if c.startswith("__t")]
    joined = known.join(times, _alike(step.keys, names), "left")
    until = F.col(USED_AT) + age
    old = F.col("__first").isNotNull() & (until < F.col("__first"))
    if latest is not None:
        old = old | (F.col("__first").isNull() & (until < F.lit(datetime.fromisoformat(latest))))
    return joined.where(~F.coalesce(old, F.lit(False))).select(*known.columns)


def _dated(after: DataFrame, live: DataFrame, times: DataFrame, step: Step) -> DataFrame:
    """The new state with the time of every key's last row."""
    old = live.select(*[F.col(k).alias(f"__old_{k}") for k in step.keys], F.col(USED_AT).alias("__before"))
    names = [c for c in times.columns if c.startswith("__t")]
    joined = after.join(old, _alike(step.keys, [f"__old_{k}" for k in step.keys]), "left").join(times, _alike(step.keys, names), "left")
    return joined.select(*after.columns, F.coalesce("__last", "__before").alias(USED_AT))


def check_state_step(key: str, value: str, order_by: str | Sequence[str], **options) -> Step:
    after = {k: v for k, v in options.items() if k in ("replace_when", "content")}

    def run(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (
            check_state(rows, key, value, order_by, state=state, **options),
            check_state_after(rows, key, value, order_by, state=state, **after),
        )

    return Step(run, KEY_VALUE, ("key",), lambda rows: [F.col(key)])


def hold_release_step(topic: str, key: str, action: str, order_by: str | Sequence[str], **options) -> Step:
    def run(rows: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (
            hold_release(rows, topic, key, action, order_by, held=held, **options),
            hold_release_after(rows, topic, key, action, order_by, held=held, **options),
        )

    return Step(run, KEY_VALUE, ("key",), lambda rows: [lock_name(F.col(topic), F.col(key))])


def sequence_step(sequence: str, order_by: str | Sequence[str], **options) -> Step:
    after = {k: v for k, v in options.items() if k in ("start", "increment")}

    def run(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (
            assign_sequence(rows, sequence, order_by, state=state, **options),
            sequence_after(rows, sequence, order_by, state=state, **after),
        )

    return Step(run, SEQUENCES, ("seq",), lambda rows: [F.col(sequence)])


def apply_changes_step(table: T.StructType, keys: Sequence[str], *, content: str = "content", **options) -> Step:
    """Changes of a table with the columns ``table``; the output is the trail's text with its routes.

    The state holds for every key its row at the start and, column by column, the value that was
    written last with the place of the change. So a change that arrives in a later batch than a
    change behind it still has the effect it would have had in time; deleted keys stay in the
    state for that reason. ``initial`` is the table itself; :func:`read_changed` gives it after a batch.
    """
    keys = list(keys)

    def run(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        trail = parse_trail(rows, content)
        routed = route_changes(table, trail, keys, **options).drop("trail")
        return routed, fold_into(state, trail, table, keys, **options)

    def row_keys(rows: DataFrame) -> list[Column]:
        return change_keys(rows, table, keys, content=content, **options)

    schema = changes_schema(table, keys)
    return Step(run, schema, tuple(schema.names[: len(keys)]), row_keys, lambda base: start_changes(base, keys))


def read_changed(spark: SparkSession, step: Step, folder: str, table: T.StructType, keys: Sequence[str], version: int | None = None, *, buckets: int = 64) -> DataFrame:
    """The table after a batch of :func:`apply_changes_step`, the last one if none is named."""
    return changed_table(read_state(spark, step, folder, version, buckets=buckets), table, keys)
