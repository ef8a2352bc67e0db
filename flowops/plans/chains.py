"""Following links between ordered rows of a group without walking them one by one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, measured
from .running import DEFAULT_MAX_ROWS, Running, plan_split, running


def next_match(
    rows: DataFrame, keys: Sequence[str], order: str, wants: str, has: str, max_rows: int | None = DEFAULT_MAX_ROWS
) -> DataFrame:
    """For each row the ``order`` of the next row of its group whose ``has`` equals its ``wants``.

    Both sides are stacked and read backwards per (group, value), so no pairs are made. The
    result is (keys, order, ``next``), rows without a match left out.
    """
    asking = rows.select(*keys, F.col(wants).alias("__value"), F.col(order).alias("__at"), F.lit(None).cast(rows.schema[order].dataType).alias("__hit"))
    offering = rows.select(*keys, F.col(has).alias("__value"), F.col(order).alias("__at"), F.col(order).alias("__hit"))
    # a row must not match itself: backwards, its own offer comes after its question
    both = asking.withColumn("__side", F.lit(1)).unionByName(offering.withColumn("__side", F.lit(0)))
    group = [*keys, "__value"]
    order_by = ["__at", "__side"]
    seen = running(both, group, order_by, [Running("next", "last", F.col("__hit"))], backwards=True, split=plan_split(both, group, order_by, max_rows))
    return seen.where((F.col("__side") == 1) & F.col("next").isNotNull()).select(*keys, F.col("__at").alias(order), "next")


def follow_chain(heads: DataFrame, links: DataFrame, keys: Sequence[str], order: str, max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """All rows reached from ``heads`` over ``links`` (keys, order, next).

    Pointer doubling: the reach doubles every round, so a chain of n rows takes log2(n) rounds
    of joins. Only rows that a link leads to, or that begin a chain, can be on one; the links of all others
    (the many that wait for one and the same row) are left out first. Of what remains, several may
    still lead to one row: where more than ``max_rows`` do, they are dealt over as many copies
    of it as are needed. Every round is written to the shared folder.
    """
    reached = cut_lineage(heads.select(*keys, order), "reach")
    links = links.select(*keys, order, "next")
    # one row for every row that is led to, however many lead there
    nodes = links.select(*keys, F.col("next").alias(order)).unionByName(reached).distinct()
    jump = cut_lineage(links.join(nodes, [*keys, order], "left_semi"), "jump")
    while True:
        step = reached.join(jump, [*keys, order]).select(*keys, F.col("next").alias(order))
        step = cut_lineage(step, "step")
        if step.isEmpty():
            return reached
        reached = reached.unionByName(step)
        further = jump.select(*keys, F.col(order).alias("next"), F.col("next").alias("__far"))
        left, right, on = dealt(jump, further, [*keys, "next"], order, max_rows)
        jump = cut_lineage(left.join(right, on).select(*keys, order, F.col("__far").alias("next")), "jump")


def dealt(left: DataFrame, right: DataFrame, on: Sequence[str], by: str, max_rows: int | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join on ``on``, of which ``right`` has unique keys, and the columns to join them on.

    Keys that ``left`` has more than ``max_rows`` times are dealt over copies of their row, by the hash of ``by``.
    """
    if max_rows is None:
        return left, right, list(on)
    copies = F.ceil(F.count(F.lit(1)) / max_rows).cast("int")
    hot, small_side = measured(left.groupBy(*on).agg(copies.alias("__copies")).where("__copies > 1"), "hot")
    if hot.isEmpty():
        return left, right, list(on)
    hot = small_side(hot)
    part = F.when(F.col("__copies").isNotNull(), F.pmod(F.xxhash64(by), F.col("__copies"))).otherwise(0).cast("int")
    copy = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)) - 1))
    left = left.join(hot, list(on), "left").withColumn("__part", part).drop("__copies")
    right = right.join(hot, list(on), "left").withColumn("__part", copy).drop("__copies")
    return left, right, [*on, "__part"]
