"""Words of whole Arrow text columns as 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Fixed by the word patterns: white space of ``[^\x20\x09-\x0D]+``.
SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes hashed at once; bounds the memory that one text takes.
SEGMENT = 1 << 20
#: Bytes of text that are worked on at once.
BLOCK = 4 << 20

_M1, _M2, _R = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, size=256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_cache: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("up", ())) < n:
        _cache["up"], _cache["down"] = _powers(_R, n), _powers(pow(_R, -1, 2**64), n)
    return _cache["up"], _cache["down"]


def lower_table() -> np.ndarray:
    """A-Z to a-z, all other bytes unchanged."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where each row starts (one more entry: the end). Null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = np.int64 if array.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, dtype=wide)[array.offset : array.offset + len(array) + 1].astype(np.int64) if offsets else np.zeros(len(array) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        _, starts = column(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_spans(raw: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of words of every row."""
    word = inside[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    own = starts[:-1][starts[:-1] < len(raw)]
    first[own] = word[own]
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends = starts[1:][starts[1:] > 0] - 1
    last[ends] = word[ends]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, np.diff(np.searchsorted(begin, starts))


def inside_of(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = False
    return table


_NOT_SPACE = inside_of(SPACE)


def _hash_words(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words [begin, end) of ``raw``; the bytes between words must not matter."""
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(end, begin[at] + SEGMENT, side="right")))
        low, high = int(begin[at]), int(end[to - 1])
        up, down = _tables(high - low)
        with np.errstate(over="ignore"):
            values = _BYTE[raw[low:high]]
            values *= up[: high - low]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            out[at:to] = (total[end[at:to] - low] - total[begin[at:to] - low]) * down[begin[at:to] - low]
            out[at:to] = mix(out[at:to] + (end[at:to] - begin[at:to]).astype(np.uint64))
        at = to
    return out


def word_hashes(array: pa.Array, lower: bool = True, inside: np.ndarray = _NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column in order, and the number of words of every row."""
    raw, starts = column(array)
    if lower:
        raw = LOWER[raw]
    begin, end, counts = word_spans(raw, starts, inside)
    return _hash_words(raw, begin, end), counts


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width`` consecutive words; the i-th begins at word i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for j in range(1, width):
            out = mix(out) + hashes[j : j + n]
        return mix(out)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; fewer words are one shingle, none none."""
    if len(hashes) == 0:
        return hashes
    return np.unique(runs(hashes, min(width, len(hashes))))
