"""Periodic runs of words, found by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that is at least ``least_length``
words and ``least_exponent`` periods long and cannot be extended on either side. The texts of a
batch get one suffix array over their words (each text has symbols of its own, so texts never
share a prefix), an inverse array and an LCP array, all by prefix doubling in numpy. Every LCP
interval of depth d enumerates the suffixes i of its smaller child only: the inverse array tells
whether suffix i + d or i - d lies in the other child, and then the words from the smaller of the
two are a square of period d that no word extends to the right. Rotating that square to the left
as far as it goes gives the run; of equal stretches the smallest period stays. No tree is built.

Words are compared exactly. Null text has no words and empty text neither; both have no runs.
Rows are worked on one by one, also repeated ones and those without id; an empty table gives an
empty result; other columns are not read, whatever their names. A text is worked on whole: it
takes about 150 bytes of memory a word in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread
from .words import blocks, column

#: Bytes of text that share one suffix array; a longer text has one of its own.
BLOCK_BYTES = 1 << 20
#: Suffixes of smaller children that are looked at at once.
LOOK = 1 << 20


def _suffix_array(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and a rank array for every power of two: equal ranks, equal words.

    A rank is the place of the first suffix of its group, so groups are refined where they lie;
    suffixes that are alone are not sorted again. Level k compares 2**k words.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable").astype(np.int64)

    def ranked(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The first place of every group of equal keys."""
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        return np.maximum.accumulate(np.where(fresh, places, 0))

    ranks = np.empty(n, np.int64)
    ranks[order] = ranked(codes[order], np.arange(n))
    levels, width = [], 1
    while True:
        first = ranks[order]
        alone = np.ones(n, bool)
        alone[1:] &= first[1:] != first[:-1]
        alone[:-1] &= first[:-1] != first[1:]
        places = np.flatnonzero(~alone)
        if not len(places):
            return order, levels
        levels.append(ranks.astype(np.int32))
        some = order[places]
        after = some + width
        inside = after < ends[some]
        keys = ranks[some] * (n + 1) + np.where(inside, ranks[np.where(inside, after, 0)] + 1, 0)
        by = np.argsort(keys)
        some, keys = some[by], keys[by]
        order[places] = some
        ranks = ranks.copy()
        ranks[some] = ranked(keys, places)
        width *= 2


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` have in common."""
    length = np.zeros(len(a), np.int64)
    last = len(ends) - 1
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + length, b + length
        inside = (i < ends[a]) & (j < ends[b])
        same = inside & (levels[k][np.minimum(i, last)] == levels[k][np.minimum(j, last)])
        length[same] += 1 << k
    return length


def _rotations(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words by which the squares at ``at`` can be rotated to the left."""
    moved = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i = at - moved - (1 << k)
        inside = i >= starts[at]
        i = np.where(inside, i, 0)
        same = inside & (levels[k][i] == levels[k][np.minimum(i + period, len(starts) - 1)])
        moved[same] += 1 << k
    return moved


def _extents(lcp: np.ndarray, nodes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For LCP entries: where the child before them begins, and where the one behind them ends.

    Among equal entries of one interval the first is the root, so every pair of suffixes is parted
    by exactly one entry: the first smallest between them.
    """
    tables = [lcp]
    while (1 << len(tables)) <= longest:
        half, width = tables[-1], 1 << (len(tables) - 1)
        whole = np.zeros_like(half)
        whole[width:] = np.minimum(half[width:], half[:-width])
        tables.append(whole)
    own, last = lcp[nodes], len(lcp) - 1
    low, high = nodes - 1, nodes + 1
    for k in range(len(tables) - 1, -1, -1):
        low = np.where((low >= 0) & (tables[k][np.maximum(low, 0)] > own), low - (1 << k), low)
        to = high + (1 << k) - 1
        high = np.where((to <= last) & (tables[k][np.minimum(to, last)] >= own), high + (1 << k), high)
    return low, high


def find_runs(codes: np.ndarray, sizes: np.ndarray, least_length: int = 6, least_exponent: int = 4) -> np.ndarray:
    """Rows ``text, start, length, period`` of all runs, sorted; start is counted within the text.

    ``codes`` are the symbols of all texts in a row; no symbol may be in two texts.
    """
    none = np.zeros((0, 4), np.int64)
    n = len(codes)
    if n < 2 or least_exponent < 2:
        if least_exponent < 2:
            raise ValueError("a run has at least two periods")
        return none
    sizes = np.asarray(sizes, np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    starts, ends = bounds[text], bounds[text + 1]
    order, levels = _suffix_array(codes, ends)
    if not levels:
        return none
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    lcp = np.zeros(n + 1, np.int32)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    lcp[near] = _common(levels, order[near - 1], order[near], ends)
    # a run needs so many periods, and each but the last begins a suffix of the same interval
    nodes = near[least_exponent * lcp[near].astype(np.int64) <= sizes[text[order[near]]]]
    low, high = _extents(lcp, nodes, int(sizes.max()))
    wide = high - low >= least_exponent
    nodes, low, high = nodes[wide], low[wide], high[wide]
    if not len(nodes):
        return none
    left = nodes - low <= high - nodes
    first = np.where(left, low, nodes)
    count = np.where(left, nodes - low, high - nodes)
    other_low, other_high = np.where(left, nodes, low), np.where(left, high, nodes)
    squares = []
    total = np.cumsum(count)
    at = 0
    while at < len(nodes):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + LOOK, side="right")))
        own = np.repeat(np.arange(at, to), count[at:to])
        step = np.arange(len(own)) - np.repeat(total[at:to] - count[at:to] - (total[at - 1] if at else 0), count[at:to])
        i = order[first[own] + step]
        depth = lcp[nodes[own]].astype(np.int64)
        for begin, partner in ((i, i + depth), (i - depth, i - depth)):
            inside = (partner >= starts[i]) & (partner < ends[i])
            there = place[np.where(inside, partner, 0)]
            hit = inside & (there >= other_low[own]) & (there < other_high[own])
            squares.append(np.stack([begin[hit], depth[hit]], axis=1))
        at = to
    found = np.concatenate(squares)
    begin, period = found[:, 0], found[:, 1]
    moved = _rotations(levels, begin, period, starts)
    length = 2 * period + moved
    long = length >= np.maximum(least_length, least_exponent * period)
    begin, period, length = (begin - moved)[long], period[long], length[long]
    by = np.lexsort((period, length, begin))
    begin, period, length = begin[by], period[by], length[by]
    least = np.ones(len(begin), bool)
    least[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, period, length = begin[least], period[least], length[least]
    rows = np.stack([text[begin], begin - starts[begin], length, period], axis=1) if len(begin) else none
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def word_codes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the words of every text, and the number of words; no symbol is in two texts."""
    parts, sizes, base = [], [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + base)
        sizes.append(len(words))
        base += len(known)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array(sizes, np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without those that repeat a run's first period."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    kept = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_PA_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, keep: list, text_col: str = "text", least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """``keep`` and, for every row, ``runs`` (start, length, period in words; by start, then period),
    ``strongest`` (the run of the greatest length / period; of equal ones the first, then the one of
    the smallest period; null without runs), ``collapsed`` (text without the repetitions, words
    joined by one space) and ``collapsed_sha256``.
    """
    names = [docs.select(c).columns[0] for c in keep]
    rows = spread(docs.select(F.struct(*keep).alias("row"), F.col(text_col).cast("binary").alias("text")))
    schema = T.StructType([rows.schema["row"], T.StructField("runs", T.ArrayType(_RUN)), T.StructField("strongest", _RUN), T.StructField("collapsed", T.BinaryType()), T.StructField("collapsed_sha256", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES):
            raw, starts = column(batch.column(1))
            whole = raw.tobytes()
            texts = [whole[a:b].split() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            found = find_runs(*word_codes(texts), least_length, least_exponent)
            cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
            runs, strongest, rest, digests = [], [], [], []
            for k, words in enumerate(texts):
                own = found[cuts[k] : cuts[k + 1]]
                runs.append([{"start": s, "length": n, "period": p} for _, s, n, p in own.tolist()])
                strongest.append(min(runs[-1], key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None))
                rest.append(collapsed(words, own))
                digests.append(hashlib.sha256(rest[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, _PA_RUN), pa.array(strongest, _PA_RUN.value_type), pa.array(rest, pa.binary()), pa.array(digests, pa.string())], names=schema.names)

    found = rows.mapInArrow(work, schema)
    return found.select(*[F.col(f"row.`{n}`").alias(n) for n in names], "runs", "strongest", F.col("collapsed").cast("string").alias("collapsed"), "collapsed_sha256")


def repeated_tail(text: F.Column, key: F.Column) -> F.Column:
    """The text with a tail that repeats, in one of ten documents, chosen and shaped by the key's CRC-32.

    With g the checksum's tenth and n the number of words, the words from ``a = g % n`` on repeat
    with the period ``1 + (n - a) // (3 + g % 8)``. Words of such a text are joined by spaces.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def tail(x: F.Column) -> F.Column:
        n = F.size(x["words"])
        a = (x["g"] % n).cast("int")
        period = (1 + F.floor((n - a) / (3 + x["g"] % 8))).cast("int")
        repeated = F.transform(x["words"], lambda w, i: F.when(i < a, w).otherwise(F.get(x["words"], a + (i - a) % period)))
        return F.array_join(repeated, " ")

    # a one-element array gives the words a name, so that they are taken from the text once
    shaped = F.get(F.transform(F.array(F.struct(words.alias("words"), g.alias("g"))), tail), 0)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), shaped).otherwise(text)
