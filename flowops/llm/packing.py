"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts become token ids, one end id follows each; only what is longer than a sequence is cut. The
pieces are dealt into shards of bounded size. Each shard is a bin-packing problem that several
islands work on, every island a group of its own: crossover takes well-filled bins of one parent
whole into the other, removes the bins that hold the same pieces, and best-fits the displaced ones.
Between epochs each island's elite moves to the next one. The emptiest bins of every shard, up to half
of its tokens, are then taken apart and packed together with those of the others, until one shard
holds them.

Null text is empty: one piece, the end id. Repeated rows are pieces of their own, also those with a
null id. An empty table gives an empty result. Other columns are not read; the id may be of any type.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, spread
from .words import blocks

#: Pieces in one bin-packing problem, on average.
SHARD_PIECES = 4096
ISLANDS = 2
POPULATION = 4
EPOCHS = 2
GENERATIONS = 3
#: Bins filled less than this share of the capacity are packed again with those of other shards.
REPACK_BELOW = 0.98
#: Partitions that shards are spread over at most; a partition holds its shards one after another.
MAX_PARTITIONS = 4096
#: Distinct words, and parts of words, whose ids a Python worker remembers if nothing else is asked for, and their longest.
CACHE_WORDS, CACHE_LENGTH = 500_000, 64

# ---------------------------------------------------------------------------------- token ids

#: The normaliser and the word pattern of tokenizers whose words are looked up one by one.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The pattern over lower-case Latin-1 without white space: letters and numbers are spelled out.
_LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
#: What words may not hold to be looked up by parts: other white space, other alphabets, the beginning of a special token.
_NOT_PLAIN = re.compile("[\x85\xa0\u0100-\U0010ffff]|<[|]")


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(others)) for b in range(256)]


class _Parts(dict):
    """A part of a word, as Latin-1 text, to its packed ids."""

    def __init__(self, tokenizer):
        self.most = CACHE_WORDS
        self.tokenize = tokenizer.model.tokenize
        self.packed = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        self.characters = _byte_characters()

    def __missing__(self, part: str) -> bytes:
        mapped = part if part.isascii() and part.isalnum() else "".join([self.characters[b] for b in part.encode()])
        ids = b"".join([self.packed[t.id] for t in self.tokenize(mapped)])
        if len(self) >= self.most:
            self.clear()
        if len(part) <= CACHE_LENGTH:
            self[part] = ids
        return ids


class _Words(dict):
    """A run between ASCII white space, as UTF-8, to its packed ids."""

    def __init__(self, tokenizer):
        self.most = CACHE_WORDS
        self.tokenizer, self.parts = tokenizer, _Parts(tokenizer)

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if word.isalpha():
            ids = self.parts[text.lower()]
        elif word[:-1].isalpha() and word[-1] in b".,;:!?":
            ids = self.parts[text[:-1].lower()] + self.parts[text[-1]]
        elif _NOT_PLAIN.search(text):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        else:
            ids = b"".join(map(self.parts.__getitem__, _LATIN.findall(text.lower())))
        if len(self) >= self.most:
            self.clear()
        if len(word) <= CACHE_LENGTH:
            self[word] = ids
        return ids


_tokenizers: dict[str, tuple[object, _Words | None]] = {}


class TokenIds:
    """Token ids of a text as packed little-endian 32-bit numbers.

    A tokenizer with the pattern above gives every run between ASCII white space its own ids,
    whatever stands around it, so a worker remembers them; others encode whole texts.
    """

    def __init__(self, path: str, by_words: bool = True, remembered: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        if path not in _tokenizers:
            tokenizer = Tokenizer.from_file(path)
            said = json.loads(tokenizer.to_str())
            split = (said["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
            known = said["normalizer"] == NORMALIZER and split.get("pattern") == {"Regex": PATTERN} and said["model"]["type"] == "BPE"
            _tokenizers[path] = (tokenizer, _Words(tokenizer) if known else None)
        self.tokenizer, self.words = _tokenizers[path]
        for held in (self.words, self.words.parts) if self.words is not None else ():
            held.most = remembered
            if len(held) > remembered:
                held.clear()
        if not by_words:
            self.words = None

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.words is None:
            return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        ids_of = self.words.__getitem__
        return [b"".join(map(ids_of, x.encode("utf-8", "surrogatepass").split())) for x in texts]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, with_ids: bool = False, remembered: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, ``with_ids``, the ``ids``.

    ``tokenizer`` is the path of a tokenizer file that every executor can read. A worker holds the ids of ``remembered``
    words, and of as many parts of words: fewer take less memory and more time.
    """
    chosen = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    fields = [T.StructField(id_col, chosen.schema["id"].dataType)] + [T.StructField(x, T.LongType()) for x in ("piece", "start", "length", "ids_crc32")]
    fields[1] = T.StructField("piece", T.IntegerType())
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenIds(tokenizer, remembered=remembered)
        for batch in blocks(batches, "text"):
            rows, numbers = [], []
            for row, ids in enumerate(ids_of([x or "" for x in batch.column(1).to_pylist()])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        numbers.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            row, piece, start, length, crc = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
            arrays = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(numbers, pa.list_(pa.int32()))] if with_ids else []), names=schema.names)

    return chosen.mapInArrow(cut, schema)


# ------------------------------------------------------------------------- one island's evolution


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> list[int]:
    """Put the pieces of ``order`` where least room is left after them; opens bins, returns the room of all."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, left in enumerate(room):
        if left:
            open_at[left].append(b)
            mask |= 1 << left
    for item in order.tolist():
        need = int(lengths[item])
        fitting = mask >> need
        if fitting:
            left = need + (fitting & -fitting).bit_length() - 1
            b = open_at[left].pop()
            if not open_at[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bins[item] = b
        left -= need
        room[b] = left
        if left:
            open_at[left].append(b)
            mask |= 1 << left
    return room


def fitness(lengths: np.ndarray, bins: np.ndarray) -> tuple[int, float]:
    """Smaller is better: bins, then how unevenly they are filled."""
    fill = np.bincount(bins, weights=lengths)
    return len(fill), -float((fill**2).sum())


def cross(lengths: np.ndarray, mother: np.ndarray, father: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Well-filled bins of ``father`` whole; ``mother``'s bins without their pieces; the rest best-fitted."""
    fill = np.bincount(father, weights=lengths)
    well = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = rng.permutation(well)[: max(1, len(well) // 2)]
    injected = np.isin(father, chosen)
    hit = np.unique(mother[injected])
    displaced = np.isin(mother, hit) & ~injected
    kept = ~injected & ~displaced
    child = np.empty(len(lengths), np.int64)
    _, child[injected] = np.unique(father[injected], return_inverse=True)
    if kept.any():
        _, again = np.unique(mother[kept], return_inverse=True)
        child[kept] = again + len(chosen)
    placed = injected | kept
    room = (capacity - np.bincount(child[placed], weights=lengths[placed])).astype(int).tolist()
    order = np.flatnonzero(displaced)
    best_fit(lengths, order[np.argsort(-lengths[order], kind="stable")], child, room, capacity)
    return child


def evolve(lengths: np.ndarray, members: list[np.ndarray], capacity: int, population: int, generations: int, rng: np.random.Generator) -> list[np.ndarray]:
    """The fittest members after some generations, best first."""
    while len(members) < population:
        weight = lengths * (1 if not members else rng.uniform(0.8, 1.2, len(lengths)))
        bins = np.empty(len(lengths), np.int64)
        best_fit(lengths, np.argsort(-weight, kind="stable"), bins, [], capacity)
        members.append(bins)
    least = ceil(lengths.sum() / capacity)
    scored = sorted(((fitness(lengths, x), k, x) for k, x in enumerate(members)), key=lambda x: x[:2])
    for _ in range(generations):
        if scored[0][0][0] <= least:
            break
        children = []
        for k in range(population // 2):
            mother, father = rng.permutation(len(scored))[:2]
            child = cross(lengths, scored[mother][2], scored[father][2], capacity, rng)
            children.append((fitness(lengths, child), len(scored) + k, child))
        scored = sorted(scored + children, key=lambda x: x[:2])[:population]
    return [x for _, _, x in scored[:population]]


def emptiest(fill: np.ndarray, capacity: int) -> np.ndarray:
    """Which bins are packed again: those below the share, the emptiest first, up to half of all tokens.

    Of two bins or more the emptiest always is within half; a single one goes if it is below.
    """
    order = np.argsort(fill, kind="stable")
    again = np.zeros(len(fill), bool)
    again[order] = (2 * np.cumsum(fill[order]) <= fill.sum()) | (len(fill) == 1)
    return again & (fill < REPACK_BELOW * capacity) & (fill > 0)


# ---------------------------------------------------------------------------- islands and shards

_MEMBER = "shard long, island int, lengths binary, bins binary"


def _dealt(pieces: DataFrame, shards: int) -> DataFrame:
    """Stored ``pieces`` with ``shard`` and ``item`` (0.. in falling length), stored so that they stay."""
    schema = T.StructType([*pieces.schema.fields, T.StructField("shard", T.LongType()), T.StructField("item", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = -1, 0
        for batch in batches:
            shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            place = np.arange(len(shard))
            first = np.concatenate([[True], shard[1:] != shard[:-1]])[: len(shard)]
            item = place - np.maximum.accumulate(np.where(first, place, 0))
            if len(shard):
                item[shard == last] += seen if shard[0] == last else 0
                last, seen = shard[-1], item[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(item)], schema=pa.schema([*batch.schema, pa.field("item", pa.int64())]))

    # the place of a row in what is stored tells equal rows apart, so copies of one text spread
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("long")
    placed = pieces.withColumn("shard", shard).repartition(min(shards, MAX_PARTITIONS), "shard")
    return cut_lineage(placed.sortWithinPartitions("shard", F.desc("length")).mapInArrow(number, schema), "pieces")


def _packed(items: DataFrame, shards: int, capacity: int, islands: int, population: int, epochs: int, generations: int) -> DataFrame:
    """``shard``, ``item``, ``bin``, ``place`` and ``again`` (to be packed with other shards' items) for the items of every shard."""

    def evolved(key, rows: pd.DataFrame) -> pd.DataFrame:
        shard, island, epoch = (int(x) for x in key)
        lengths = np.frombuffer(rows["lengths"].iloc[0], dtype=np.int32).astype(np.int64)
        members = [np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in sorted(x for x in rows["bins"] if x is not None)]
        best = evolve(lengths, members, capacity, population, generations, np.random.default_rng([shard, island, epoch]))
        raw = [x.astype(np.int32).tobytes() for x in best]
        out = [(shard, island, rows["lengths"].iloc[0], x) for x in raw]
        return pd.DataFrame([*out, (shard, (island + 1) % islands, rows["lengths"].iloc[0], raw[0])], columns=["shard", "island", "lengths", "bins"])

    def collected(rows):  # one row per shard: its lengths in falling order
        return F.sort_array(F.collect_list(rows), asc=False)

    def packed_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [np.array(x, dtype=np.int32).tobytes() for x in batch.column(1).to_pylist()]
            for island in range(islands):
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, island, np.int32)), pa.array(lengths, pa.binary()), pa.nulls(n, pa.binary())], names=["shard", "island", "lengths", "bins"])

    state = items.groupBy("shard").agg(collected("length").alias("lengths")).mapInArrow(packed_lengths, _MEMBER)
    for epoch in range(epochs):
        # rows are few and small, but each is a problem to solve: a number of partitions that is not merged
        state = state.repartition(min(shards * islands, MAX_PARTITIONS), "shard", "island")
        state = state.groupBy("shard", "island", F.lit(epoch).alias("epoch")).applyInPandas(evolved, _MEMBER)

    def chosen(key, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = np.frombuffer(rows["lengths"].iloc[0], dtype=np.int32).astype(np.int64)
        bins = min((np.frombuffer(x, dtype=np.int32) for x in sorted(rows["bins"])), key=lambda x: fitness(lengths, x))
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
        place = np.empty(len(bins), np.int64)
        place[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        again = emptiest(np.bincount(bins, weights=lengths), capacity)
        return pd.DataFrame({"shard": int(key[0]), "item": np.arange(len(bins)), "bin": bins.astype(np.int64), "place": place, "again": again[bins]})

    return state.repartition(min(shards, MAX_PARTITIONS), "shard").groupBy("shard").applyInPandas(chosen, "shard long, item long, bin long, place long, again boolean")


def pack(pieces: DataFrame, capacity: int = 2048, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS, generations: int = GENERATIONS) -> DataFrame:
    """``pieces`` (with ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``, gapless in a sequence."""
    result, level, left = None, 0, pieces
    columns = [F.col(c) for c in pieces.columns]
    left = cut_lineage(pieces, "unpacked")
    count = left.count()
    while True:
        shards = max(1, ceil(count / shard_pieces))
        items = _dealt(left, shards)
        placed = cut_lineage(_packed(items, shards, capacity, islands, population, epochs, generations), "placed")
        level += 1
        # every level has its own range of numbers
        number = F.col("bin") * shards + F.col("shard") + F.lit(level << 48).cast("long")
        joined = items.join(placed, ["shard", "item"])
        left = cut_lineage(joined.where("again").select(*columns), "unpacked") if shards > 1 else None
        again = left.count() if shards > 1 else 0
        ended = again in (0, count)  # each level leaves half of its tokens behind, or all in single bins
        done = joined if ended else joined.where("not again")
        done = done.select(*columns, number.alias("sequence_id"), F.col("place").alias("offset"))
        result = done if result is None else result.unionByName(done)
        if ended:
            return result
        count = again
