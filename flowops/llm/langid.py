"""Language identification by a bidirectional gated recurrent network over bytes.

The whole text is cut into windows of ``WINDOW`` bytes. One layer reads a window forwards, one
backwards; from both states at a byte the network gives the chance of every language there. The
document's chances are the mean over all its bytes. Training is backpropagation through time in
numpy on the driver, over a bounded sample: ``SAMPLE_DOCS`` distinct texts of every language at most,
chosen by a hash, and at most ``SAMPLE_WINDOWS`` windows spread over each.

Text that is null or has no letter is ``und`` with score 0. If nothing can be learned from, every
text is ``und``. Labels are compared as they are; rows without label teach nothing. Each repeated
row has its own result; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut_lineage, spread
from .gated import Adam, backward, forward, table_gradient
from .joins import stored
from .words import blocks, column

WINDOW = 128
SIZE = 8
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 4
EPOCHS = 5
BATCH = 128
RATE = 0.02
#: Windows that go through the network at once.
LANES = 1024


def _cut(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every window, and the row it belongs to."""
    sizes = np.diff(starts)
    counts = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[:-1][row] + number * WINDOW
    return begin, np.minimum(WINDOW, starts[1:][row] - begin), row


def _windows(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(WINDOW, windows) bytes, zero behind a window's end."""
    at = begin[None, :] + np.arange(WINDOW)[:, None]
    inside = np.arange(WINDOW)[:, None] < length[None, :]
    return np.where(inside, raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint8)


def _states(weights, symbols: np.ndarray, keep: np.ndarray | None, trace: bool):
    """States of both directions at every byte; ``keep`` is 0 behind a window's end."""
    zero = np.zeros((SIZE, symbols.shape[1]), np.float32)
    ahead = forward(weights["table_ahead"], weights["own_ahead"], symbols, zero, None, trace)
    back = forward(weights["table_back"], weights["own_back"], symbols[::-1], zero, None if keep is None else _restart(keep), trace)
    return ahead, back


def _restart(keep: np.ndarray) -> np.ndarray:
    """For the backward direction: the state is empty until the window's last byte has been passed."""
    seen = np.zeros_like(keep)
    seen[1:] = keep[::-1][:-1]
    return seen


def position_chances(weights, symbols: np.ndarray, keep: np.ndarray | None) -> np.ndarray:
    """(WINDOW, languages, windows): the chance of each language at each byte."""
    (ahead, _), (back, _) = _states(weights, symbols, keep, False)
    logits = np.matmul(weights["out"][:, :SIZE], ahead)
    logits += np.matmul(weights["out"][:, SIZE:], back[::-1])
    logits += weights["bias"][:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def initial(languages: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    weights = {}
    for way in ("ahead", "back"):
        weights[f"table_{way}"] = draw(2 * SIZE, 256, scale=0.5)
        weights[f"own_{way}"] = draw(2 * SIZE, SIZE, scale=0.3)
    return weights | {"out": draw(languages, 2 * SIZE, scale=0.3), "bias": np.zeros(languages, np.float32)}


def gradients(weights, symbols: np.ndarray, keep: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all bytes, each labelled with its document's language."""
    (ahead, trace_ahead), (back, trace_back) = _states(weights, symbols, keep, True)
    back = back[::-1]
    both = np.concatenate([ahead, back], axis=1)
    logits = np.matmul(weights["out"], both) + weights["bias"][:, None]
    logits -= logits.max(axis=1, keepdims=True)
    chances = np.exp(logits)
    chances /= chances.sum(axis=1, keepdims=True)
    lanes = np.arange(symbols.shape[1])
    total = np.float32(keep.sum())
    loss = float(-(np.log(chances[:, labels, lanes] + 1e-9) * keep).sum() / total)
    chances[:, labels, lanes] -= 1
    chances *= (keep / total)[:, None, :]
    grads = {"out": np.tensordot(chances, both, axes=([0, 2], [0, 2])), "bias": chances.sum(axis=(0, 2))}
    at_states = np.matmul(weights["out"].T, chances)
    rows, grads["own_ahead"] = backward(weights["own_ahead"], trace_ahead, at_states[:, :SIZE])
    grads["table_ahead"] = table_gradient(rows, symbols, 256)
    rows, grads["own_back"] = backward(weights["own_back"], trace_back, at_states[::-1, SIZE:], _restart(keep))
    grads["table_back"] = table_gradient(rows, symbols[::-1], 256)
    return loss, grads


def train(windows: list[bytes], labels: np.ndarray, languages: int, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """The network's weights from labelled windows."""
    rng = np.random.default_rng(seed)
    weights = initial(languages, rng)
    adam = Adam(weights, RATE)
    raw = np.frombuffer(b"".join(windows) + b"\0", dtype=np.uint8)
    length = np.array([len(x) for x in windows], np.int64)
    begin = np.cumsum(length) - length
    steps, total = 0, epochs * -(-len(windows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            symbols = _windows(raw, begin[chosen], length[chosen])
            keep = (np.arange(WINDOW)[:, None] < length[chosen][None, :]).astype(np.float32)
            adam.rate = RATE * (1 - 0.9 * steps / total)
            adam.update(weights, gradients(weights, symbols, keep, labels[chosen])[1])
            steps += 1
    return weights


def chances_of(weights, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(rows, languages): mean chances over all bytes of every text; zero for empty ones."""
    begin, length, row = _cut(raw, starts)
    total = np.zeros((len(starts) - 1, len(weights["bias"])))
    for whole in (True, False):
        chosen = np.flatnonzero((length == WINDOW) == whole)
        for at in range(0, len(chosen), LANES):
            part = chosen[at : at + LANES]
            keep = None
            if whole:
                symbols = raw[begin[part][None, :] + np.arange(WINDOW)[:, None]]
                pooled = position_chances(weights, symbols, None).sum(axis=0)
            else:
                keep = (np.arange(WINDOW)[:, None] < length[part][None, :]).astype(np.float32)
                pooled = np.einsum("tkb,tb->kb", position_chances(weights, _windows(raw, begin[part], length[part]), keep), keep)
            np.add.at(total, row[part], pooled.T)
    return total / np.maximum(1, np.diff(starts))[:, None]


def _sample(rows: DataFrame) -> DataFrame:
    """``lang``, ``windows`` of SAMPLE_DOCS distinct texts of each language, or of all if it has fewer.

    The texts with the smallest hashes are taken, so copies neither help a text in nor bring more of it.
    """
    keyed = rows.select("lang", "text", F.xxhash64("text").alias("hash"))
    distinct = cut_lineage(keyed.select("lang", "hash").distinct(), "label-texts")
    counts = stored(distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "label-counts")
    # hashes are spread evenly: more than enough of them are below this, and few enough for a window
    place = F.pmod("hash", F.lit(1 << 30))
    near = distinct.join(counts, "lang").where(place < F.lit(float(1 << 30)) * 2 * SAMPLE_DOCS / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "hash"))
    chosen = stored(near.select("lang", "hash", rank.alias("rank")).where(F.col("rank") <= SAMPLE_DOCS).select("lang", "hash"), "label-sample")
    raw = F.col("text").cast("binary")
    count = F.ceil(F.octet_length("text") / WINDOW)
    at = F.array_distinct(F.array(*[F.floor((j + 0.5) * count / SAMPLE_WINDOWS).cast("int") for j in range(SAMPLE_WINDOWS)]))
    windows = F.transform(at, lambda k: F.substring(raw, k * WINDOW + 1, F.lit(WINDOW)))
    # one row of each text, whatever its copies
    return keyed.join(chosen, ["lang", "hash"]).select("lang", "hash", windows.alias("windows")).groupBy("lang", "hash").agg(F.min("windows").alias("windows")).select("lang", "windows")


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[dict[str, np.ndarray] | None, list[str]]:
    """Weights and languages from rows that have a language and a letter."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = [(r["lang"], bytes(w)) for r in _sample(rows).collect() for w in r["windows"]]
    sample = sorted(x for x in sample if x[1])
    langs = sorted({x[0] for x in sample})
    if not langs:
        return None, []
    return train([x[1] for x in sample], np.array([langs.index(x[0]) for x in sample]), len(langs)), langs


def identify(docs: DataFrame, model, keep: list, text_col: str = "text") -> DataFrame:
    """``keep`` and, for every row, ``lang_pred``, ``score`` (0 to 1) and ``chances`` by language."""
    weights, langs = model
    names = [docs.select(c).columns[0] for c in keep]
    rows = spread(docs.select(F.struct(*keep).alias("row"), F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("text")))
    schema = T.StructType([rows.schema["row"], T.StructField("chances", T.MapType(T.StringType(), T.DoubleType())), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            text = batch.column(1)
            known = np.array(text.is_valid(), dtype=bool) if langs else np.zeros(batch.num_rows, bool)
            if langs:
                chances = chances_of(shared.value, *column(text))
            else:
                chances = np.zeros((batch.num_rows, 1))
            best = chances.argmax(axis=1)
            maps = [list(zip(langs, c.tolist(), strict=True)) if k else [] for c, k in zip(chances, known, strict=True)]
            pred = [langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
            score = [min(1.0, float(c[b])) if k else 0.0 for c, b, k in zip(chances, best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(maps, pa.map_(pa.string(), pa.float64())), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return rows.mapInArrow(work, schema).select(*[F.col(f"row.`{n}`").alias(n) for n in names], "lang_pred", "score", "chances")
