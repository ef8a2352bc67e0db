"""Joins that broadcast a side only after counting it, or in a form of fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A stored side of at most so many rows is broadcast; its rows must be of bounded width.
BROADCAST_ROWS = 50_000
#: Rows of a bitmap, of 64 bits each: what is broadcast at most, however many keys it marks.
BITMAP_ROWS = 1 << 19


def stored(df: DataFrame, label: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written to the shared folder, marked for broadcast if it has few rows."""
    saved = cut_lineage(df, label)
    return F.broadcast(saved) if saved.limit(limit + 1).count() <= limit else saved


def marked(df: DataFrame, key: Column, keys: DataFrame, label: str, name: str = "__marked") -> DataFrame:
    """``df`` with a boolean column: false where ``key`` (a long) is not among ``keys``' only column, true where it may be.

    The keys' hashes set bits of a bitmap of fixed size, so this needs no shuffle of ``df``. With
    very many keys most rows are marked; the exact join that follows is right all the same.
    """

    def place(x: Column) -> tuple[Column, Column]:
        at = F.pmod(x, F.lit(64 * BITMAP_ROWS))
        return F.floor(at / 64).cast("int"), F.pmod(at, F.lit(64)).cast("int")

    word, bit = place(F.col(keys.columns[0]))
    bits = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__bits"))
    bits = F.broadcast(cut_lineage(bits, label))
    own_word, own_bit = place(key)
    # a null key has no word and is not marked
    held = df.select("*", own_word.alias("__own_word"), own_bit.alias("__own_bit")).join(bits, F.col("__own_word") == F.col("__word"), "left")
    found = F.coalesce(F.expr("(shiftright(__bits, __own_bit) & 1L) = 1L"), F.lit(False))
    return held.withColumn(name, found).drop("__own_word", "__own_bit", "__word", "__bits")


def thinned(df: DataFrame, key: Column, keys: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among ``keys``."""
    return marked(df, key, keys, label).where("__marked").drop("__marked")
