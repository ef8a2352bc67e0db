"""Sharding by sampled splitters.

Keys are drawn with a chance that grows with a row's size, so that as many bytes lie between two
drawn keys on average, whatever the rows' sizes. Quantiles of the draw become the splitters of
ranges; a range that turns out too large is drawn from again and subdivided. Prefix sums over the
ranges and running sums inside them then place every row at its exact offset in bytes, and equal
shares of all bytes are the shards.

A row's key is the hash of its text, then its id, so equal texts lie together and go to one shard.
Only where they are more than ``1 / GROUP_SHARE`` of a shard and more than the largest row are they
cut like other rows: kept whole they would make sizes differ by more than that, and by more than a row does anyway.
Null text has the size 1 and a key of its own; null ids are the smallest. Rows that are equal are
placed one after the other, so which gets which slot makes no difference; only rows equal in text
and id cannot be subdivided into ranges. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

#: Rows in a range, on average: what one task sorts.
RANGE_ROWS = 200_000
#: Ranges for every shard, at least.
RANGES_PER_SHARD = 4
#: Drawn keys for every range.
DRAWN = 32
#: Ranges whose splitters one draw decides; more ranges are found in further rounds.
MAX_SPLITTERS = 4096
ROUNDS = 8
GROUP_SHARE = 20


def _key(df: DataFrame) -> Column:
    return F.struct("text_hash", "id_text")


def _range_of(splitters: list[tuple[str, str]]) -> Column:
    """The number of splitters at or below a row's key, by two steps of about the square root."""
    if not splitters:
        return F.lit(0)
    width = max(1, int(len(splitters) ** 0.5))
    kind = "struct<text_hash:string,id_text:string>"

    def array(rows) -> Column:
        return F.array(*[F.struct(F.lit(h).alias("text_hash"), F.lit(i).alias("id_text")) for h, i in rows]).cast(f"array<{kind}>")

    def below(rows: Column, key: Column) -> Column:
        # splitters are sorted: the first one above the key ends the search
        return F.size(F.filter(rows, lambda x: (x["text_hash"] < key["text_hash"]) | ((x["text_hash"] == key["text_hash"]) & (x["id_text"] <= key["id_text"]))))

    groups = [splitters[at : at + width] for at in range(0, len(splitters), width)]
    key = _key(None)
    coarse = below(array([g[0] for g in groups]), key)
    fine = F.get(F.array(*[array(g) for g in groups]), coarse - 1)
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * width + below(fine, key))


def _draw(rows: DataFrame, rate: Column, salt: int) -> list[tuple[str, str, float]]:
    """Keys drawn with the chance ``rate`` (above 1: always, and counted as often), by a hash of the row.

    What reaches the driver is bounded by the caller's choice of the rates' sum.
    """
    uniform = F.pmod(F.xxhash64("text_hash", "id_text", "size", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.select("text_hash", "id_text", rate.alias("rate")).where((F.col("rate") >= 1) | (uniform < F.col("rate")))
    # equal rows are drawn alike: one row for all of them
    found = chosen.groupBy("text_hash", "id_text").agg(F.sum(F.greatest(F.col("rate"), F.lit(1.0))).alias("weight")).collect()
    return sorted((r[0], r[1], r[2]) for r in found)


def _quantiles(drawn: list[tuple[str, str, float]], parts: int) -> list[tuple[str, str]]:
    """``parts - 1`` keys at equal steps of the drawn weight; fewer if keys repeat."""
    total, seen, out = sum(w for _, _, w in drawn), 0.0, []
    for h, i, weight in drawn:
        if out and out[-1] == (h, i):
            continue
        if seen >= (len(out) + 1) * total / parts and len(out) < parts - 1:
            out.append((h, i))
        seen += weight
    return sorted(set(out))


def splitters_of(rows: DataFrame, total: int, ranges: int) -> list[tuple[str, str]]:
    """Sorted keys that cut ``rows`` into about ``ranges`` ranges of equal size."""
    ranges = min(ranges, MAX_SPLITTERS)
    found = _quantiles(_draw(rows, F.col("size") * (ranges * DRAWN / max(1, total)), 0), ranges)
    goal = total / ranges
    for round_ in range(1, ROUNDS):
        sized = rows.withColumn("range", _range_of(found))
        over = sized.groupBy("range").agg(F.sum("size").alias("bytes"), F.max("size").alias("largest"), F.min(_key(None)).alias("a"), F.max(_key(None)).alias("b"))
        over = over.where((F.col("bytes") > 2 * goal) & (F.col("a") != F.col("b"))).select("range", "bytes").collect()
        if not over:
            break
        parts = {r["range"]: int(r["bytes"] / goal) + 1 for r in over}
        rate = F.lit(None).cast("double")
        for r in over:
            rate = F.when(F.col("range") == r["range"], F.col("size") * (parts[r["range"]] * DRAWN / r["bytes"])).otherwise(rate)
        drawn = _draw(sized.where(F.col("range").isin(list(parts))), rate, round_)
        more = set(found)
        for number in parts:
            low = found[number - 1] if number else None
            high = found[number] if number < len(found) else None
            own = [x for x in drawn if (low is None or x[:2] >= low) and (high is None or x[:2] < high)]
            more.update(_quantiles(own, parts[number]))
            more.update(x[:2] for x in own if x[2] >= DRAWN)  # a row as large as a range starts one
        if more == set(found):
            break
        found = sorted(more)
    return found


def _before_groups(rows: DataFrame, splitters: list[tuple[str, str]], limit: float) -> list[tuple[str, str]]:
    """The splitters, those within equal texts of ``limit`` bytes at most moved in front of them."""
    if not splitters:
        return splitters
    # as many rows as there are splitters
    cut = rows.sparkSession.createDataFrame([(h,) for h in sorted({h for h, _ in splitters})], "text_hash string")
    sizes = rows.join(F.broadcast(cut), "text_hash").groupBy("text_hash").agg(F.sum("size").alias("bytes")).collect()
    small = {r["text_hash"] for r in sizes if r["bytes"] <= limit}
    return sorted({(h, "" if h in small else i) for h, i in splitters})


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document row: ``id_col``, ``size``, ``text_crc32``, ``shard``, ``slot`` (gapless in a shard), ``offset_bytes``."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("text_hash"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_text"),
    )
    rows = cut_lineage(rows, "sizes")
    total, count, largest = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    limit = max(total / shards / GROUP_SHARE, largest)
    ranges = max(shards * RANGES_PER_SHARD, -(-count // range_rows))
    found = _before_groups(rows, splitters_of(rows, total, ranges), limit) if count else []
    ranged = cut_lineage(rows.withColumn("range", _range_of(found)), "ranges")
    # prefix sums over the ranges: one row each, as many as there are splitters
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy("range").orderBy("text_hash", "id_text", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("range", "text_hash")
    placed = (
        ranged.withColumn("at", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .withColumn("row", F.row_number().over(inside).cast("long") - 1)
        .withColumn("group_at", F.min("at").over(group))
        .withColumn("group_bytes", F.sum("size").over(group))
        .join(F.broadcast(sums), "range")  # at most MAX_SPLITTERS rows a round
    )
    # the middle decides: of the row, or of the rows with its text if they are few
    whole = F.col("group_bytes") <= limit
    middle = F.col("bytes_before") + F.when(whole, F.col("group_at") + F.col("group_bytes") / 2).otherwise(F.col("at") + F.col("size") / 2)
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(1, total)))).cast("int"))
    placed = cut_lineage(placed.select("id", "size", "text_crc32", "shard", (F.col("rows_before") + F.col("row")).alias("row"), (F.col("bytes_before") + F.col("at")).alias("offset_bytes")), "placed")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row a shard
    return placed.join(F.broadcast(first), "shard").select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"), "offset_bytes")
