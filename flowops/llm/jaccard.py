"""N-gram Jaccard join by a token-group matrix, for components of similar documents.

A document's tokens are its distinct shingles of ``width`` words (64-bit hashes; fewer words are
one shingle). Two documents link when their sets' Jaccard similarity is ``percent`` or more.

1. Documents with equal sets fold to one class, so copies cost one row each.
2. Linked classes share a token among the first ``n - need + 1`` of each, in any order common to
   all. The order puts tokens last that many classes have; it affects the cost only.
3. The matrix has the rows token, band of sizes, class. A class with fewer cells than the sizes in a
   cell ask for leaves it: it is linked to no class there. In each cell, classes meet the one
   that has most cells in common with others; verified links make groups of similar classes.
4. Where several groups remain in a cell, a class of one group is a query to the others. It must
   share enough cells with a group, then enough tokens with the group's union, which is stored.
   Only qualifying groups are opened, and the pairs of their cells verified.

Two linked sets of ``n`` and ``m`` tokens share ``both`` of them at least, so at most ``n - both`` of
the first ones of the one are missing in the other, and they have ``least_cells`` cells in common.

So every link joins two classes of one component in the end. Null text, empty text and text without
words have no tokens and link with nothing. Null ids are members like others and are never the
smallest of a component that has any id. Rows equal in id are told apart by their texts. Empty
tables give empty results; other columns are not read; the id column may be of any type that can be
ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut_lineage, spread
from .components import connected_components
from .joins import marked, stored, thinned
from .words import blocks, mix, shingles, word_hashes

#: A token is common if the classes that meet it inside one task are so many together.
COMMON = 16
#: Common tokens that are ordered last: what is broadcast.
MAX_COMMON = 1 << 18
#: Bits that tell which classes' tokens are needed again.
BITMAP = 1 << 25
#: Tokens of a group's union in one row.
UNION_TOKENS = 1 << 16


def need_of(n, percent: int):
    """Tokens that a set of ``n`` shares with any it links to, at least."""
    return -(-(n * percent) // 100)


def least_cells(n: Column, m: Column, percent: int) -> Column:
    """First tokens that linked sets of ``n`` and ``m`` tokens have in common, at least."""
    need = F.ceil(percent * F.greatest(n, m) / 100)
    return F.ceil(percent * (n + m) / (100 + percent)) - need + 1


def fewest_cells(n: Column, low: Column, high: Column, percent: int) -> Column:
    """The minimum of ``least_cells`` over the sizes from ``low`` to ``high`` that ``n`` is linked to.

    It rises up to ``n``. Behind it falls, but for the rounding of its two terms: a size that is so
    much smaller than ``high`` that the fall is 1 or more asks for no fewer cells than ``high``.
    """
    fall = -(-100 * (100 + percent) // percent**2)
    last = F.sequence(F.greatest(low, high - fall), high)
    return F.least(least_cells(n, low, percent), F.array_min(F.transform(last, lambda m: least_cells(n, m, percent))))


def bands_of(n: int, percent: int) -> list[int]:
    """First sizes of the bands that a set of ``n`` tokens belongs to: its own, and the next if it can link there.

    A band ends where its first size can link no further, so linked sets have a band in common.
    """
    low = 1
    while low * 100 // percent < n:
        low = low * 100 // percent + 1
    high = low * 100 // percent
    return [low, high + 1] if n * 100 // percent > high else [low]


_bands: dict[tuple[int, int], list[int]] = {}


def _bands_of(n: int, percent: int) -> list[int]:
    if (n, percent) not in _bands:
        _bands[n, percent] = bands_of(n, percent)
    return _bands[n, percent]


def class_of(tokens: np.ndarray) -> int:
    """A hash of the set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in blocks(batches, "text"):
        hashes, counts = word_hashes(batch.column(batch.schema.get_field_index("text")))
        ends = np.cumsum(counts)
        yield batch, [shingles(hashes[e - c : e], width) for e, c in zip(ends, counts, strict=True)]


def _classes(rows: DataFrame, width: int) -> DataFrame:
    """``id``, ``n``, ``class`` (null without tokens) of every row, and rows with ``repeated`` tokens and their ``counts``.

    A task reports the tokens that several of its classes have: what many classes have, some tasks
    meet twice. All documents count.
    """
    schema = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.LongType()), T.StructField("class", T.LongType()), T.StructField("repeated", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))]
    )
    longs = pa.list_(pa.int64())

    def work(batches):
        seen: set[int] = set()
        held: list[np.ndarray] = []
        size, kind = 0, None

        def report():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            return pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([tokens[many].view(np.int64)], longs), pa.array([counts[many]], longs)], names=schema.names)

        for batch, sets in _sets(batches, width):
            kind = batch.column(0).type
            classes = [class_of(s) if len(s) else None for s in sets]
            for c, s in zip(classes, sets, strict=True):
                if c is not None and c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64()), pa.nulls(len(sets), longs), pa.nulls(len(sets), longs)], names=schema.names)
            if size > 8_000_000:  # bounds a task's memory
                yield report()
                held, size = [], 0
                seen.clear()
        if held:
            yield report()

    return cut_lineage(rows.mapInArrow(work, schema), "classes")


def _common_tokens(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the commonest tokens, at most MAX_COMMON, and each one's place in the order: the commonest is last."""
    reported = classes.where("repeated is not null").select(F.explode(F.arrays_zip("repeated", "counts")).alias("x"))
    found = reported.groupBy(F.col("x.repeated").alias("token")).agg(F.sum("x.counts").alias("n")).where(F.col("n") >= COMMON)
    top = found.orderBy(F.desc("n"), "token").limit(MAX_COMMON).select("token").toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], -order


def _prefixes(texts: DataFrame, width: int, percent: int, common) -> DataFrame:
    """``token``, ``class``, ``n``: the first tokens of every set."""

    def work(batches):
        last, place = common.value
        for _, sets in _sets(batches, width):
            tokens, classes, sizes = [], [], []
            for s in sets:
                if not len(s):
                    continue
                take = len(s) - need_of(len(s), percent) + 1
                if len(last):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    late = last[at] == s
                    chosen = s[~late][:take]
                    if len(chosen) < take:
                        common_ones = s[late][np.argsort(place[at[late]])]
                        chosen = np.concatenate([chosen, common_ones[: take - len(chosen)]])
                else:
                    chosen = s[:take]
                tokens.append(chosen)
                classes.append(np.full(take, class_of(s)))
                sizes.append(np.full(take, len(s)))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(classes)), pa.array(np.concatenate(sizes).astype(np.int32))], names=["token", "class", "n"])

    return texts.mapInArrow(work, "token long, class long, n int")


def _cells(prefixes: DataFrame, percent: int) -> DataFrame:
    """``cell``, ``class``, ``n``, ``own`` (the cell's band is the set's own): the matrix, without cells that one class has alone."""
    repeated = prefixes.groupBy("token").count().where("count > 1").select("token")
    met = thinned(prefixes, F.col("token"), cut_lineage(repeated, "repeated"), "repeated-bits").distinct()

    def work(batches):
        for batch in batches:
            token, cls, n = (batch.column(i).to_numpy() for i in range(3))
            lists = [_bands_of(int(x), percent) for x in n]
            times = np.array([len(x) for x in lists], np.int64)
            band = np.array([b for x in lists for b in x], np.uint64)
            own = np.zeros(len(band), bool)
            own[np.cumsum(times) - times] = True
            with np.errstate(over="ignore"):
                cell = mix(np.repeat(token.view(np.uint64), times) + mix(band)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.repeat(cls, times)), pa.array(np.repeat(n, times)), pa.array(own)], names=["cell", "class", "n", "own"])

    cells = cut_lineage(met.mapInArrow(work, "cell long, class long, n int, own boolean"), "cells")
    several = cells.groupBy("cell").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("cell")
    several = cut_lineage(several, "several")
    return cut_lineage(thinned(cells, F.col("cell"), several, "several-bits").join(several, "cell", "left_semi"), "cells")


def _pruned(cells: DataFrame, percent: int, rounds: int = 2) -> DataFrame:
    """``cells`` without rows that no link needs.

    A class that is linked to a member of a cell has ``least_cells`` of its band's cells in common with it.
    So a class with fewer cells than the sizes in a cell ask for is linked to none of its members. Rows of
    two linked classes stay in all cells that they share, whatever goes besides, and so in every round.
    """
    sizes = [F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.when(F.col("own"), F.col("n"))).alias("own_low"), F.max(F.when(F.col("own"), F.col("n"))).alias("own_high")]
    n = F.col("n")
    # of two classes that meet, one is in its own band
    low = F.greatest(F.when(F.col("own"), F.col("low")).otherwise(F.col("own_low")), F.ceil(percent * n / 100).cast("int"))
    high = F.least(F.when(F.col("own"), F.col("high")).otherwise(F.col("own_high")), F.floor(100 * n / percent).cast("int"))
    for _ in range(rounds):
        inside = cut_lineage(cells.groupBy("cell").agg(*sizes, F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").drop("a", "b"), "cell-sizes")
        held = cut_lineage(cells.groupBy("class", "own").agg(F.count(F.lit(1)).alias("held")), "held")
        kept = cells.join(inside, "cell").where(F.col("own") | F.col("own_low").isNotNull()).withColumns({"low": low, "high": high}).where("low <= high")
        kept = kept.join(held, ["class", "own"]).where(F.col("held") >= fewest_cells(n, F.col("low"), F.col("high"), percent))
        cells = cut_lineage(kept.select(*cells.columns), "pruned")
    return cells


def _meeting(pairs: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that meet in enough cells to be linked. A pair counts in its larger set's band."""
    one = cells.select(F.col("class").alias("a"), "cell", F.col("n").alias("na"), F.col("own").alias("own_a"))
    two = cells.select(F.col("class").alias("b"), "cell", F.col("n").alias("nb"), F.col("own").alias("own_b"))
    met = one.join(pairs, "a").join(two, ["cell", "b"]).where("own_a or own_b")
    met = met.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("cells"))
    return met.where(F.col("cells") >= least_cells(F.col("na"), F.col("nb"), percent)).select("a", "b")


def _bitmap(classes: DataFrame) -> np.ndarray:
    """Bits at the classes' hashes modulo BITMAP; of fixed size, so it only thins out large sets of classes."""
    at = f"pmod(class, {BITMAP})"
    words = classes.groupBy(F.expr(f"{at} div 64").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast({at} % 64 AS int)))").alias("bits")).toPandas()
    out = np.zeros(BITMAP // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _token_sets(texts: DataFrame, width: int, classes: DataFrame) -> DataFrame:
    """``class``, ``tokens`` (sorted) of the classes asked for and perhaps some more, once in a task each."""
    asked = texts.sparkSession.sparkContext.broadcast(_bitmap(classes))

    def work(batches):
        bits = asked.value
        seen: set[int] = set()  # classes this task has given, as many as are asked for at most
        for _, sets in _sets(batches, width):
            found = []
            for s in sets:
                if len(s) and (c := class_of(s)) not in seen and int(bits[c % BITMAP // 64]) >> (c % BITMAP % 64) & 1:
                    seen.add(c)
                    found.append((c, s))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))], names=["class", "tokens"])

    return cut_lineage(texts.mapInArrow(work, "class long, tokens array<long>"), "sets")


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The entries of a column of sorted hashes."""
    values, ends = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Equal entries of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are similar enough."""
    one = sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb"))

    def work(batches):
        for batch in batches:
            keep = []
            for x, y in zip(_lists(batch.column("ta")), _lists(batch.column("tb")), strict=True):
                both = _overlap(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return cut_lineage(pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(work, "a long, b long").distinct(), "links")


def _unions(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``other``, ``union``: the tokens of each group of ``members`` (``group``, ``class``), in rows of bounded length, disjoint by hash."""
    tokens = members.join(sets, "class").select("group", F.explode("tokens").alias("token")).distinct()
    tokens = cut_lineage(tokens, "group-tokens")
    sizes = stored(tokens.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / UNION_TOKENS).alias("rows")), "union-sizes")
    return cut_lineage(tokens.join(sizes, "group").groupBy(F.col("group").alias("other"), F.pmod("token", "rows").alias("row")).agg(F.collect_list("token").alias("union")), "unions")


def _opened(cells: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different groups that neither their cells nor their group's union rule out."""
    labelled = cells.join(labels, "class", "left").select("cell", "class", "n", "own", F.coalesce("root", "class").alias("group"), F.coalesce("members", F.lit(1)).alias("members"))
    labelled = cut_lineage(labelled, "labelled")
    several = labelled.groupBy("cell").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b").select("cell")
    several = cut_lineage(several, "open-cells")
    rest = cut_lineage(thinned(labelled, F.col("cell"), several, "open-bits").join(several, "cell", "left_semi"), "open")
    # a query is a class of the smaller group of two that meet
    groups = rest.groupBy("cell", F.col("group").alias("other"), F.col("members").alias("other_members")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.bool_or("own").alias("other_own"), F.count(F.lit(1)).alias("here"))
    groups = cut_lineage(groups, "cell-groups")
    met = rest.join(groups, "cell").where("members < other_members or (members = other_members and group < other)").where("own or other_own")
    met = met.groupBy("class", "n", "other").agg(F.count(F.lit(1)).alias("cells"), F.min("low").alias("low"), F.max("high").alias("high"))
    # sizes that link
    low, high = F.greatest("low", F.ceil(percent * F.col("n") / 100)), F.least("high", F.floor(100 * F.col("n") / percent))
    linked = met.withColumns({"low": low, "high": high}).where("low <= high")
    queries = cut_lineage(linked.where(F.col("cells") >= fewest_cells(F.col("n"), F.col("low"), F.col("high"), percent)).select("class", "n", "other", "cells"), "queries")

    asked = stored(queries.select(F.col("other").alias("group")).distinct(), "asked")
    inside = cut_lineage(rest.join(asked, "group", "left_semi").select("group", "class").distinct(), "members")
    unions = _unions(inside, sets)

    def bound(batches):
        for batch in batches:
            shared = [_overlap(x, np.sort(y)) for x, y in zip(_lists(batch.column("tokens")), _lists(batch.column("union")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("class", "other", "n", "cells")), pa.array(shared, pa.int64())], names=["class", "other", "n", "cells", "shared"])

    asking = stored(queries.select("class").distinct(), "asking")
    own = sets.join(asking, "class", "left_semi").dropDuplicates(["class"])
    bounds = queries.join(own, "class").join(unions, "other").select("class", "other", "n", "cells", "tokens", "union").mapInArrow(bound, "class long, other long, n int, cells long, shared long")
    bounds = bounds.groupBy("class", "other", "n", "cells").agg(F.sum("shared").alias("shared"))
    qualifying = cut_lineage(bounds.where(F.col("shared") >= F.ceil(F.col("n") * percent / 100)), "qualifying")

    # a linked member is in least_cells of the class's cells, so it is in one of the others' complement:
    # cells with few members come first
    open_cells = qualifying.join(rest.select("class", "cell", F.col("own").alias("own_a")), "class").join(groups.select("cell", "other", "here", "other_own"), ["cell", "other"])
    open_cells = open_cells.where("own_a or other_own").withColumn("rank", F.row_number().over(Window.partitionBy("class", "other").orderBy("here", "cell")))
    open_cells = cut_lineage(open_cells, "opened")
    opened = rest.select("cell", F.col("group").alias("other"), F.col("class").alias("b"), F.col("n").alias("m"), F.col("own").alias("own_b"))
    # a member shares no more than the union does, so its size may rule it out
    fits = 100 * F.col("shared") >= percent * (F.col("n") + F.col("m") - F.col("shared"))
    early = F.col("rank") <= F.col("cells") - least_cells(F.col("n"), F.col("m"), percent) + 1
    pairs = open_cells.join(opened, ["cell", "other"]).where(fits & early & (F.col("own_a") | F.col("own_b")))
    return cut_lineage(pairs.select(F.col("class").alias("a"), "b").distinct(), "pairs")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """One row per document row: ``id_col``, ``n_shingles``, ``class`` (hash of its set, null without tokens),
    ``component`` (one number per component, null without tokens), ``component_id`` (its smallest id)."""
    rows = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    texts = rows.select("text").where("text is not null")
    reported = _classes(rows, width)
    classes = reported.where("repeated is null").select("id", "n", "class")

    common = texts.sparkSession.sparkContext.broadcast(_common_tokens(reported))
    cells = _pruned(_cells(cut_lineage(_prefixes(texts, width, percent, common), "prefixes"), percent), percent)
    sets = _token_sets(texts, width, cells.select("class").distinct())
    rank = cells.groupBy("class").agg(F.count(F.lit(1)).alias("rank"))
    ranked = cut_lineage(cells.join(cut_lineage(rank, "ranks"), "class"), "ranked")
    lead = cut_lineage(ranked.groupBy("cell").agg(F.max(F.struct("rank", "class", "n")).alias("lead")), "leads")
    pairs = ranked.join(lead, "cell").where("class <> lead.class")
    pairs = pairs.where((F.col("n") * 100 >= F.col("lead.n") * percent) & (F.col("lead.n") * 100 >= F.col("n") * percent))
    pairs = cut_lineage(pairs.select(F.col("class").alias("a"), F.col("lead.class").alias("b")).distinct(), "pairs")
    pairs = cut_lineage(_meeting(pairs, cells, percent), "pairs")

    links = _verified(pairs, sets, percent)
    roots = cut_lineage(connected_components(links).select(F.col("node").alias("class"), "root"), "roots")
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    labels = stored(roots.join(cut_lineage(sizes, "sizes"), "root"), "labels")
    more = _verified(_opened(cells, labels, sets, percent), sets, percent)
    roots = cut_lineage(connected_components(links.union(more)).select(F.col("node").alias("class"), "root"), "labels")

    smallest = classes.where("class is not null").groupBy("class").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    smallest = smallest.join(roots, "class", "left").where("copies > 1 or root is not null").select("class", "least", F.coalesce("root", "class").alias("component"))
    smallest = cut_lineage(smallest, "least")
    least = smallest.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(smallest.select("class", "component").join(cut_lineage(least, "components"), "component"), "named")
    return classes.join(named, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "class",
        F.coalesce("component", "class").alias("component"),
        F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, id_col: str, text_col: str, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every group of linked texts: that of the smallest id, a null id first.

    Rows equal in id and text are one document, also without words. All columns stay; rows that
    nothing happens to are not shuffled.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.xxhash64("text").alias("hash"))
    found = jaccard_components(rows.select(name.alias("key"), "text"), "key", width=width, percent=percent)
    found = cut_lineage(found.select("key", "component"), "components")
    first = found.where("component is not null").groupBy("component").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = found.join(stored(first.select("component", "first"), "first"), "component").where("key <> first").select("key", F.lit(0).alias("kept"))
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(gone.select("key"), "key", "left_anti").select("key", F.lit(1).alias("kept"))
    changed = stored(gone.distinct().unionByName(repeated).select(F.col("key.id").alias("other_id"), F.col("key.hash").alias("other"), "kept"), "changed")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(text_col)).alias("hash"))
    told = marked(rows, F.col("hash"), changed.select(F.col("other").alias("hash")), "changed-bits")
    some = told.where("__marked").select("row", F.col(f"row.`{id_col}`").alias("id"), "hash")
    some = some.join(changed, F.col("id").eqNullSafe(F.col("other_id")) & (F.col("hash") == F.col("other")), "left").select("row", "id", "hash", "kept")
    once = some.where("kept = 1").dropDuplicates(["id", "hash"])
    return told.where("not __marked").select("row.*").unionByName(some.where("kept is null").select("row.*")).unionByName(once.select("row.*"))
