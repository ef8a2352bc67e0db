"""Benchmark decontamination: one Aho-Corasick automaton over normalised test passages.

Texts are normalised to lower-case words (letters A-Z, digits, any non-ASCII character; all else
separates). A test item gives its windows of ``window`` consecutive words, or all its words if it
has fewer. The windows, with a space on either side, are the automaton's patterns; each document
is normalised and scanned once, and word numbers lead back to offsets in the original.

Rows without text have no words. Empty tables give empty results. An item without
words is passed over; the windows of one without id are hits, but it is not among ``items``; equal items and repeated rows count once in ``items``, and each repeated
document row has its own result row. Other columns of the inputs, whatever their names, are not
read. The id column may be of any type, also a struct that carries a whole row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, spread

#: Fixed by the word pattern: what separates words.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: The same pattern for original texts, where capitals are not lowered yet.
ORIGINAL_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Bytes of test text in one automaton; more test text is scanned for in several passes.
BLOCK_BYTES = 8 << 20


def _table() -> bytes:
    table = bytearray(range(256))
    for code in range(0x41, 0x5B):
        table[code] = code + 32
    for code in set(SEPARATORS) - set(range(0x41, 0x5B)):
        table[code] = 0x20
    return bytes(table)


_NORMAL = _table()


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of an UTF-8 text."""
    return text.translate(_NORMAL).split()


def windows_of(items: list[tuple[str | None, str]], window: int) -> dict[bytes, tuple[int, tuple[str, ...]]]:
    """Pattern to its number of words and the ids of the items it comes from."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text.encode("utf-8", "surrogatepass"))
        width = min(window, len(words))
        for at in range(len(words) - width + 1 if width else 0):
            ids = found.setdefault(b" " + b" ".join(words[at : at + width]) + b" ", (width, set()))[1]
            if item is not None:
                ids.add(item)
    return {k: (n, tuple(sorted(ids))) for k, (n, ids) in found.items()}


_built: dict[int, object] = {}


def _automaton(patterns):
    """The automaton of a broadcast, built once in each Python worker."""
    import ahocorasick

    if patterns.id not in _built:
        _built.clear()
        automaton = ahocorasick.Automaton()
        for pattern, (width, ids) in patterns.value.items():
            automaton.add_word(pattern.decode("latin-1"), (width, ids))
        if len(automaton):
            automaton.make_automaton()
        _built[patterns.id] = automaton
    return _built[patterns.id]


class _Patterns:
    """A broadcast together with a number that tells it from others inside a worker."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def hits(automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Word intervals covered by a pattern, merged, and the ids of the patterns' items."""
    if not words or not len(automaton):
        return [], set()
    scanned = b" " + b" ".join(words) + b" "
    spans: list[tuple[int, int]] = []
    ids: set[str] = set()
    places = None
    for end, (width, items) in automaton.iter(scanned.decode("latin-1")):
        if places is None:
            places = np.flatnonzero(np.frombuffer(scanned, dtype=np.uint8) == 0x20)
        after = int(np.searchsorted(places, end))  # the space behind the window's last word
        if spans and spans[-1][0] <= after - width <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], after))
        else:
            spans.append((after - width, after))
        ids.update(items)
    return _merged(spans), ids


_SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
_PA_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan(docs: DataFrame, patterns: _Patterns) -> DataFrame:
    """``id``, ``text`` to ``id``, ``n_words``, ``words_hit``, ``spans`` (code points of the original), ``items``."""
    schema = T.StructType([docs.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("words_hit", _SPAN), T.StructField("spans", _SPAN), T.StructField("items", T.ArrayType(T.StringType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(patterns)
        for batch in batches:
            n_words, hit, spans, items = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                words = words_of(text.encode("utf-8", "surrogatepass"))
                found, ids = hits(automaton, words)
                n_words.append(len(words))
                hit.append([{"first": a, "end": b} for a, b in found])
                places = [m.span() for m in ORIGINAL_WORD.finditer(text)] if found else []
                spans.append([{"first": places[a][0], "end": places[b - 1][1]} for a, b in found])
                items.append(sorted(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(hit, _PA_SPAN), pa.array(spans, _PA_SPAN), pa.array(items, pa.list_(pa.string()))], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The test items in groups of bounded size; an item longer than that is a group of its own."""
    chosen = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("item_text")).where("item_text is not null")
    held, size = [], 0
    for item, text in chosen.distinct().orderBy("item", "item_text").toLocalIterator():
        if held and size + len(text) > block_bytes:
            yield held
            held, size = [], 0
        held.append((item, text))
        size += len(text)
    yield held


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13, percent: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: ``id_col``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (ids as
    text, sorted), ``spans`` (offsets in the original text, in code points), ``contaminated``: words
    are hit, and at least ``percent`` of a hundred of all.

    The automaton holds at most ``block_bytes`` of test text and is broadcast; if there is more,
    the documents are scanned once for each block and the blocks' hits are joined.
    """
    spark: SparkSession = docs.sparkSession
    chosen = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    parts = []
    held = None
    for block in _blocks(items, item_id_col, item_text_col, block_bytes):
        if held is not None:  # more than one block: keep what the earlier one found
            parts.append(cut_lineage(_keyed(held, chosen), "hits"))
        held = _Patterns(spark.sparkContext.broadcast(windows_of(block, window)))
    if not parts:
        found = _scan(chosen, held)
    else:
        parts.append(cut_lineage(_keyed(held, chosen), "hits"))
        found = _joined(parts)
    size = F.aggregate("words_hit", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["first"])
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        size.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        ((size > 0) & (100 * size >= percent * F.col("n_words"))).alias("contaminated"),
    )


def _keyed(patterns: _Patterns, docs: DataFrame) -> DataFrame:
    keyed = docs.select(F.struct("id", F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c")).alias("id"), "text")
    return _scan(keyed, patterns)


def _joined(parts: list[DataFrame]) -> DataFrame:
    """Hits of several blocks by document; rows equal in id and text have equal results."""
    rows = parts[0].select("id", "n_words")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = every.where(F.size("words_hit") > 0).dropDuplicates(["id", "items", "words_hit"])
    every = every.groupBy("id").agg(F.flatten(F.collect_list("words_hit")).alias("a"), F.flatten(F.collect_list("spans")).alias("b"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def union(spans):
        """Intervals joined where they overlap or touch."""
        last = F.element_at
        return F.aggregate(
            F.array_sort(spans),
            F.array().cast(_SPAN),
            lambda out, x: F.when(
                (F.size(out) > 0) & (x["first"] <= F.coalesce(F.get(out, F.size(out) - 1)["end"], F.lit(-1))),
                F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(F.get(out, F.size(out) - 1)["first"].alias("first"), F.greatest(F.get(out, F.size(out) - 1)["end"], x["end"]).alias("end")))),
            ).otherwise(F.concat(out, F.array(F.struct(x["first"].alias("first"), x["end"].alias("end"))))),
        )

    every = every.select(F.col("id").alias("key"), union("a").alias("words_hit"), union("b").alias("spans"), "items")
    none = F.array().cast(_SPAN)
    same = F.col("id.h").eqNullSafe(F.col("key.h")) & F.col("id.c").eqNullSafe(F.col("key.c")) & F.col("id.id").eqNullSafe(F.col("key.id"))
    joined = rows.join(every, same, "left")
    return joined.select(F.col("id.id").alias("id"), "n_words", F.coalesce("words_hit", none).alias("words_hit"), F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
