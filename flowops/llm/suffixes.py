"""Repeated passages by a sparse suffix array.

A passage is ``min_words`` consecutive words (runs of anything but ASCII white space, letter case
kept). The result is where a document's words belong to passages that another document has too,
as maximal intervals of words. Rows equal in id and text are one document.

1. A suffix is retained where the ``SEED``-word hash at its start is the smallest of any passage
   that contains it. The choice depends on the passage alone, so equal passages retain suffixes at
   equal places. Its neighbourhood is all words of the passages it was chosen in.
2. Suffixes with equal neighbourhoods fold to one; if they lie in several documents, all of the
   neighbourhood is repeated. Suffixes whose seed has one neighbourhood only are done.
3. The others are sorted by their seeds and the words to the right, and once more by those to the
   left. Neighbours are compared and the match is extended both ways. If the passages that match
   the neighbours are all there can be by the longest matches on both sides, they decide; if no
   match can reach ``min_words``, there is none.
4. What is left (gaps between neighbours' matches, ends of sorted partitions) is decided passage
   by passage, by their hashes.

Null, empty and shorter texts have no passages. Null ids are ids like others. Empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, spread
from .joins import stored, thinned
from .words import _R, _tables, blocks, mix, runs, word_hashes

MIN_WORDS = 50
SEED = 8
#: Bits that tell which seeds and neighbourhoods matter; of fixed size, exact joins follow.
BITMAP = 1 << 25
#: Bytes of a word's hash where neighbours are compared.
WORD_BYTES = 5


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of all ``width`` consecutive values."""
    out, span = values, 1
    while span * 2 <= width:
        out = best(out[: len(out) - span], out[span:])
        span *= 2
    if span < width:
        out = best(out[: len(out) - (width - span)], out[width - span :])
    return out


def retained(hashes: np.ndarray, counts: np.ndarray, min_words: int = MIN_WORDS, seed: int = SEED):
    """Of all words of several rows: positions of retained suffixes, their seeds, and the words to the left and right that count."""
    reach = min_words - seed
    none = np.zeros(0, np.int64)
    if len(hashes) < min_words:
        return none, none.view(np.uint64), none, none
    ends = np.repeat(np.cumsum(counts), counts)
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    seeds = runs(hashes, seed)
    least = _sliding(seeds, reach + 1, np.minimum)  # of the passage that begins at each word
    at = np.arange(len(least))
    least = np.where(ends[: len(least)] >= at + min_words, least, np.uint64(0))
    pad = np.zeros(reach, np.uint64)
    chosen = _sliding(np.concatenate([pad, least, pad]), reach + 1, np.maximum)
    places = np.flatnonzero((chosen == seeds) & (chosen > 0))
    left = np.minimum(reach, places - starts[places])
    right = np.minimum(min_words, ends[places] - places)
    return places, seeds[places], left, right


def _span_hash(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of the words [low, high), wherever they stand."""
    up, down = _tables(len(hashes) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * up[: len(hashes)], dtype=np.uint64)])
        return (total[high] - total[low]) * down[low]


def _neighbourhoods(hashes, places, left, right) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(_span_hash(hashes, places - left, places + right) + left.astype(np.uint64) * np.uint64(_R) + (right.astype(np.uint64) << np.uint64(32)))


def _seeds(rows: DataFrame, min_words: int) -> DataFrame:
    """``seed``: the seeds that were retained more than once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            _, seeds, _, _ = retained(*word_hashes(batch.column(1), lower=False), min_words)
            found, n = np.unique(seeds, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["seed", "n"])

    return rows.mapInArrow(work, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")


def _bitmap(keys: DataFrame):
    """A broadcast of bits at the keys (one column of longs) modulo BITMAP."""
    at = f"pmod({keys.columns[0]}, {BITMAP})"
    words = keys.groupBy(F.expr(f"{at} div 64").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast({at} % 64 AS int)))").alias("bits")).toPandas()
    out = np.zeros(BITMAP // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of the keys whose bit is set."""
    at = (keys.view(np.int64) % BITMAP).astype(np.int64)
    return np.flatnonzero((bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1))


def _suffixes(rows: DataFrame, min_words: int, seeds: DataFrame) -> DataFrame:
    """``seed``, ``area``, ``left``, ``right``, ``doc``, ``at`` of every retained suffix whose seed may be repeated."""
    shared = _bitmap(seeds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            hashes, counts = word_hashes(batch.column(1), lower=False)
            places, seeds, left, right = retained(hashes, counts, min_words)
            asked = _marked(shared.value, seeds)
            places, seeds, left, right = places[asked], seeds[asked], left[asked], right[asked]
            area = _neighbourhoods(hashes, places, left, right) if len(places) else seeds
            ends = np.cumsum(counts)
            row = np.searchsorted(ends, places, side="right")
            docs = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(seeds.view(np.int64)), pa.array(area.view(np.int64)), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(docs[row]), pa.array(places - (ends - counts)[row])],
                names=["seed", "area", "left", "right", "doc", "at"],
            )

    return rows.mapInArrow(work, "seed long, area long, left int, right int, doc long, at long")


def _contexts(rows: DataFrame, min_words: int, wanted: DataFrame) -> DataFrame:
    """``seed``, ``area``, ``doc``, ``before`` (words to the left, nearest first), ``after`` (behind the seed):
    of the areas wanted, in the document ``low`` that each is wanted from, and perhaps some more. Words are hashes that sort as bytes."""
    shared = _bitmap(wanted.select(F.col("area").bitwiseXOR(F.col("low")).alias("place")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # areas this task has given, as many as are wanted at most
        for batch in blocks(batches, "text"):
            hashes, counts = word_hashes(batch.column(1), lower=False)
            places, seeds, left, right = retained(hashes, counts, min_words)
            if not len(places):
                continue
            area = _neighbourhoods(hashes, places, left, right)
            docs = batch.column(0).to_numpy()[np.searchsorted(np.cumsum(counts), places, side="right")]
            asked = [k for k in _marked(shared.value, area ^ docs.view(np.uint64)).tolist() if (a := int(area[k])) not in seen and not seen.add(a)]
            words = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WORD_BYTES :]
            before = [words[p - n : p][::-1].tobytes() for p, n in zip(places[asked].tolist(), left[asked].tolist(), strict=True)]
            after = [words[p + SEED : p + n].tobytes() for p, n in zip(places[asked].tolist(), right[asked].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(seeds[asked].view(np.int64)), pa.array(area[asked].view(np.int64)), pa.array(docs[asked]), pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=["seed", "area", "doc", "before", "after"])

    return rows.mapInArrow(work, "seed long, area long, doc long, before binary, after binary")


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as a matrix, zero behind each row's last, and the numbers of words."""
    raw, ends = column.buffers()[2], np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw else np.zeros(0, np.uint8)
    words = _numbers(data)
    ends = (ends - ends[0]) // WORD_BYTES
    size = np.diff(ends)
    out = np.zeros((len(size), width), np.uint64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(ends[:-1], size)] = words
    return out, size


def _numbers(data: np.ndarray) -> np.ndarray:
    """Words of WORD_BYTES bytes as numbers."""
    wide = np.zeros((len(data) // WORD_BYTES, 8), np.uint8)
    wide[:, 8 - WORD_BYTES :] = data.reshape(-1, WORD_BYTES)
    return wide.view(">u8").ravel().astype(np.uint64)


def _common(matrix: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Words that each row and the next begin with alike."""
    differ = matrix[1:] != matrix[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    return np.minimum(first, np.minimum(size[1:], size[:-1]))


def _compared(contexts: DataFrame, order: list[str], min_words: int) -> DataFrame:
    """For each area and each of its neighbours in sorted order: ``seed``, ``area``, ``l`` and ``r``, the words
    that match to the left and right; null if the neighbour is not seen here or may be in the same document only."""
    ranged = contexts.repartitionByRange(*["seed", *order, "area"]).sortWithinPartitions("seed", *order, "area")
    names = ["seed", "area", "l", "r"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None

        def unseen(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column("seed"), batch.column("area"), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32())], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                yield unseen(batch.slice(0, 1))
                table = batch
            else:
                table = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            area = table.column("area").to_numpy()
            once = np.concatenate([[True], area[1:] != area[:-1]])  # tasks may have given an area each
            table = table.filter(pa.array(once))
            seed, area, doc = (table.column(n).to_numpy() for n in ("seed", "area", "doc"))
            r = _common(*_matrix(table.column("after"), min_words)) + SEED
            l = _common(*_matrix(table.column("before"), min_words))  # noqa: E741
            pair = np.flatnonzero(seed[1:] == seed[:-1])
            both = np.concatenate([pair, pair + 1])
            mask = np.tile((doc[1:] == doc[:-1])[pair], 2)
            yield pa.RecordBatch.from_arrays([pa.array(seed[both]), pa.array(area[both]), pa.array(np.tile(l[pair], 2).astype(np.int32), mask=mask), pa.array(np.tile(r[pair], 2).astype(np.int32), mask=mask)], names=names)
            last = table.slice(table.num_rows - 1, 1)
        if last is not None:
            yield unseen(last)

    return ranged.mapInArrow(work, "seed long, area long, l int, r int")


def _passages(rows: DataFrame, min_words: int) -> DataFrame:
    """``seed``, ``area``, ``start``, ``passage``: hash of every passage that a match as long as ``l`` and ``r`` allows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int, bool, int, int]] = []
            for seed, area, low, high, open_, before, after, l, r in zip(*(batch.column(n).to_pylist() for n in ("seed", "area", "low", "high", "open", "before", "after", "l", "r")), strict=True):  # noqa: E741
                left, right = _numbers(np.frombuffer(before, np.uint8))[::-1], _numbers(np.frombuffer(after, np.uint8))
                words = np.concatenate([left, np.zeros(SEED, np.uint64), right])  # the seed is equal anyway
                at = len(left)
                starts = np.arange(max(at - l, 0), min(at, at + r - min_words) + 1)
                if len(starts):
                    hashes = _span_hash(words, starts, starts + min_words).view(np.int64)
                    out += [(seed, area, low, high, open_, int(s - at), int(h)) for s, h in zip(starts, hashes, strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 7
            names = ["seed", "area", "low", "high", "open", "start", "passage"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n == "open" else pa.int64()) for n, c in zip(names, columns, strict=True)], names=names)

    return rows.mapInArrow(work, "seed long, area long, low long, high long, open boolean, start long, passage long")


def _covered(pairs, l, r, min_words: int):  # noqa: E741
    """Whether the passages inside the matches ``pairs`` (``l``, ``r``) are all that ``l`` and ``r`` allow."""
    long = F.array_sort(F.transform(F.filter(pairs, lambda p: p["l"] + p["r"] >= min_words), lambda p: F.struct((-p["l"]).alias("first"), (p["r"] - min_words).alias("last"))))
    end = F.aggregate(long, -l - 1, lambda last, p: F.when(p["first"] <= last + 1, F.greatest(last, p["last"])).otherwise(last))
    return end >= r - min_words


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per maximal interval: ``id_col``, ``start`` (its first word's number, from 0) and ``n_words``."""
    id_, text = F.col(id_col), F.col(text_col)
    rows = spread(docs.select(F.xxhash64(F.to_json(F.struct(id_.alias("i"))), text).alias("doc"), id_.alias("id"), text.alias("text")))
    texts = rows.select("doc", "text").where("text is not null")
    suffixes = cut_lineage(_suffixes(texts, min_words, cut_lineage(_seeds(texts, min_words), "seeds")), "suffixes")

    areas = cut_lineage(suffixes.groupBy("seed", "area", "left", "right").agg(F.min("doc").alias("low"), F.max("doc").alias("high")), "areas")
    several = areas.groupBy("seed").agg(F.min("area").alias("a"), F.max("area").alias("b"), F.min("low").alias("low"), F.max("high").alias("high"))
    several = cut_lineage(several.where("a <> b and low <> high").select("seed"), "seeds")
    wanted = cut_lineage(thinned(areas, F.col("seed"), several, "seed-bits").join(several, "seed", "left_semi"), "compared")
    contexts = cut_lineage(_contexts(texts, min_words, wanted), "contexts")

    seen = _compared(contexts, ["after", "before"], min_words).unionByName(_compared(contexts, ["before", "after"], min_words))
    # the areas go through the same shuffle as what was seen of them; some are seen that are not wanted
    known = ["left", "right", "low", "high"]
    seen = seen.unionByName(wanted.select("seed", "area", *known), allowMissingColumns=True)
    match = F.when(F.col("l").isNotNull(), F.struct("l", "r"))
    hidden = F.bool_or(F.when(F.col("low").isNull(), F.col("l").isNull())).alias("hidden")
    best = seen.groupBy("seed", "area").agg(F.max("l").alias("l"), F.max("r").alias("r"), F.collect_set(match).alias("pairs"), hidden, *[F.max(c).alias(c) for c in known])
    best = best.where("low is not null and hidden is not null")
    # a hidden neighbour may match as far as the neighbourhood goes
    free = F.col("hidden") | (F.col("low") != F.col("high"))
    best = best.withColumn("decided", ~F.col("hidden") & _covered(F.col("pairs"), F.col("l"), F.col("r"), min_words)).drop("pairs")
    best = best.select("seed", "area", "low", "high", "decided", F.when(free, F.col("left")).otherwise(F.col("l")).alias("l"), F.when(free, F.col("right")).otherwise(F.col("r")).alias("r"))
    best = cut_lineage(best.where(F.col("l") + F.col("r") >= min_words), "best")

    def span(left, right):
        return F.array(F.struct((-left).cast("long").alias("start"), right.cast("long").alias("end"))).alias("spans")

    whole = areas.where("low <> high").select("seed", "area", span(F.col("left"), F.col("right")))
    decided = best.where("low = high and decided").select("seed", "area", span(F.col("l"), F.col("r")))
    best = best.withColumn("open", F.expr("low = high and not decided")).drop("decided")
    involved = best.join(stored(best.where("open").select("seed").distinct(), "open-seeds"), "seed", "left_semi")
    involved = cut_lineage(involved, "involved")
    given = thinned(contexts.select("seed", "area", "before", "after"), F.col("area"), involved.select("area"), "involved-bits").dropDuplicates(["seed", "area"])
    passages = cut_lineage(_passages(involved.join(given, ["seed", "area"]), min_words), "passages")
    # areas that are decided only tell where else a passage is
    twice = passages.groupBy("seed", "start", "passage").agg(F.min("low").alias("a"), F.max("high").alias("b"), F.bool_or("open").alias("asked"))
    twice = cut_lineage(twice.where("asked and a <> b").select("seed", "start", "passage"), "twice")
    found = thinned(passages.where("open"), F.col("passage"), twice.select("passage"), "twice-bits").join(twice, ["seed", "start", "passage"], "left_semi")
    found = found.groupBy("seed", "area").agg(F.collect_list(F.struct("start", (F.col("start") + min_words).alias("end"))).alias("spans"))

    spans = stored(whole.unionByName(decided).unionByName(found), "spans")
    placed = thinned(suffixes, F.col("area"), spans.select("area"), "span-bits").join(spans, ["seed", "area"])
    placed = placed.select("doc", F.explode(F.transform("spans", lambda x: F.struct((F.col("at") + x["start"]).alias("start"), (F.col("at") + x["end"]).alias("end")))).alias("s"))
    placed = placed.groupBy("doc").agg(F.collect_list("s").alias("spans"))
    merged = cut_lineage(placed.mapInArrow(_merge, "doc long, start long, n_words long"), "merged")
    return rows.select("doc", "id").join(merged, "doc").select(F.col("id").alias(id_col), "start", "n_words")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of every document joined where they overlap or touch."""
    for batch in batches:
        docs, starts, sizes = [], [], []
        for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = spans.values
            low, high = own.field("start").to_numpy(), own.field("end").to_numpy()
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order])
            first = np.concatenate([[True], low[1:] > high[:-1]])
            begin = low[first]
            end = high[np.concatenate([first[1:], [True]])]
            docs.append(np.full(len(begin), doc))
            starts.append(begin)
            sizes.append(end - begin)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (docs, starts, sizes)], names=["doc", "start", "n_words"])
