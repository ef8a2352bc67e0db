"""Scoring by a gated recurrent language model with class-factored output.

Tokens are lower-cased words (runs of anything but ASCII white space) and one end of every text.
All training texts are counted. The commonest ``VOCABULARY`` words are symbols of the network,
each in one of ``CLASSES`` classes of about equal weight by frequency; the end is a symbol, and so
are all other words together. The network gives the chance of the next symbol's class, and of the
symbol within its class; another word has, within "all others", its smoothed share of the counts.
So the chances of all known words, the end and one unknown word add up to 1.

Training is truncated backpropagation through time: streams of whole documents side by side, the
state carried from one window to the next and emptied where a document begins. A bounded sample
warms the network up on the driver; then each task trains on through all of its training texts, and
the weights are averaged, weighted by tokens. Scoring carries the state through each
whole document.

Null text is empty: its only token is the end. A null id is not held out. Rows are scored one by
one, also repeated ones; empty tables give empty results, and without training text every chance
is that of one unknown word. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, spread
from .gated import Adam, backward, forward, table_gradient
from .words import blocks, word_hashes

#: Words that are symbols of the network, and the classes they fall in.
VOCABULARY = 4094
CLASSES = 64
SIZE = 16
#: Words whose counts every task holds; the counts of rarer ones are joined.
HELD_COUNTS = 1 << 18
#: Steps of a window of truncated backpropagation, streams side by side, learning rate.
STEPS, LANES, RATE = 64, 128, 0.015
#: About so many documents, none longer than WARM_BYTES, warm the network up.
WARM_DOCS, WARM_BYTES = 600, 1 << 16
#: Text that is scored at once, and tokens that go through the output layer at once.
SCORE_BYTES, SCORE_TOKENS = 16 << 20, 1 << 14
#: Weights averaged by one task.
FAN_IN = 16

END, OTHER = 0, 1


@dataclass
class Vocabulary:
    """``words``: sorted hashes, ``counts``; ``symbols``: the network's, by rank; totals of all training tokens."""

    words: np.ndarray
    counts: np.ndarray
    top: np.ndarray  # sorted hashes of the network's words
    top_symbol: np.ndarray  # their symbols
    ends: int
    tokens: int
    types: int
    bounds: np.ndarray  # first symbol of every class, and the number of symbols
    log_share: np.ndarray  # log of every symbol's share of the tokens, smoothed

    @property
    def other(self) -> float:
        """The divisor of a rare word's count within all rare words."""
        return self.other_tokens + self.other_types + 1.0

    other_tokens: int = 0
    other_types: int = 0


# ------------------------------------------------------------------------------------- counting


def _counted(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` over whole texts; the ends are not among them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in blocks(batches, "text", SCORE_BYTES):
            hashes, _ = word_hashes(batch.column(0))
            if len(hashes):
                held.append(np.unique(hashes, return_counts=True))
                size += len(held[-1][0])
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:  # bounds a task's memory
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["word", "n"])
                    held, size = [], 0
        if held:
            words, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    return texts.mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, documents: int, size: int = VOCABULARY, held: int = HELD_COUNTS) -> Vocabulary:
    """What tasks hold: the commonest words, at most ``held``, and totals."""
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # the smallest count that no more than ``held`` words reach: from the numbers of words of each count,
    # of which there are no more than the root of twice the tokens
    of_count = counts.groupBy(F.least("n", F.lit(held)).alias("n")).count().toPandas().sort_values("n", ascending=False)
    reached = of_count["count"].cumsum()
    whole = reached <= held
    chosen = F.col("n") >= int(of_count["n"][whole].min()) if whole.any() else F.lit(False)
    if not whole.all():
        # of the words of the next count, those of the smallest hashes fill what is left, by a margin for their spread
        count, words_of = (int(of_count[c][~whole].iloc[0]) for c in ("n", "count"))
        room = held - int(reached[whole].max() if whole.any() else 0)
        room = max(0.0, room - 6 * room**0.5)
        low = F.pmod(F.xxhash64("word", F.lit(3)), F.lit(1 << 30)) < int(room / words_of * (1 << 30))
        chosen = chosen | ((F.least("n", F.lit(held)) == count) & low)
    most = counts.where(chosen).toPandas()
    most = most.sort_values(["n", "word"], ascending=[False, True])
    words, n = most["word"].to_numpy(np.int64).view(np.uint64), most["n"].to_numpy(np.int64)
    top, top_n = words[:size], n[:size]
    share = np.concatenate([[documents, total - top_n.sum()], top_n]).astype(np.float64) + 1
    share /= share.sum()
    # symbols by falling share, but the end and the other words first; classes of equal root weight
    weight = np.sqrt(share)
    cut = np.searchsorted(np.cumsum(weight), np.linspace(0, weight.sum(), CLASSES + 1)[1:-1])
    bounds = np.unique(np.concatenate([[0, 1, 2], cut + 1, [len(share)]]))
    bounds = bounds[bounds <= len(share)]
    order, all_order = np.argsort(top), np.argsort(words)
    known = 1 if documents else 0
    return Vocabulary(words[all_order], n[all_order], top[order], order + 2, documents, total + documents, types + known, bounds, np.log(share).astype(np.float32), int(total - top_n.sum()), int(types - len(top)))


def _lookup(sorted_words: np.ndarray, values: np.ndarray, asked: np.ndarray, missing) -> np.ndarray:
    if not len(sorted_words):
        return np.full(len(asked), missing)
    at = np.minimum(np.searchsorted(sorted_words, asked), len(sorted_words) - 1)
    return np.where(sorted_words[at] == asked, values[at], missing)


# -------------------------------------------------------------------------------------- network


def initial(vocab: Vocabulary, seed: int = 11) -> dict[str, np.ndarray]:
    """Small random weights; the biases give every symbol its share."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    symbols, bounds = len(vocab.log_share), vocab.bounds
    of_class = np.array([np.logaddexp.reduce(vocab.log_share[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.float32)
    return {
        "table": draw(2 * SIZE, symbols, scale=0.3),
        "own": draw(2 * SIZE, SIZE, scale=0.2),
        "class_out": draw(len(bounds) - 1, SIZE, scale=0.05),
        "class_bias": of_class,
        "out": draw(symbols, SIZE, scale=0.05),
        "bias": vocab.log_share.copy(),
    }


def log_chances(weights, bounds: np.ndarray, states: np.ndarray, targets: np.ndarray, grads: dict[str, np.ndarray] | None = None):
    """Natural logs of the targets' chances; ``states``: (SIZE, tokens).

    With ``grads``, adds the gradients of the mean negative log and returns those at the states too.
    """
    cls = (np.searchsorted(bounds, targets, side="right") - 1).astype(np.int16)
    order = np.argsort(cls, kind="stable")
    # in the order of classes, so that each class is a slice
    cls, targets, sorted_states = cls[order], targets[order], states[:, order]
    ends = np.searchsorted(cls, np.arange(len(bounds)))
    count = len(targets)
    every = np.arange(count)

    def softmax(x: np.ndarray, at: np.ndarray, columns: np.ndarray):
        x -= x.max(axis=0)
        logs = x[at, columns]
        np.exp(x, out=x)
        total = x.sum(axis=0)
        if grads is not None:  # the gradient at the logits
            x /= total * count
            x[at, columns] -= 1 / count
        return logs - np.log(total), x

    logs, errors = softmax(weights["class_out"] @ sorted_states + weights["class_bias"][:, None], cls, every)
    if grads is not None:
        grads["class_out"] += errors @ sorted_states.T
        grads["class_bias"] += errors.sum(axis=1)
        sorted_grads = weights["class_out"].T @ errors
    for c in range(len(bounds) - 1):
        low, high = bounds[c], bounds[c + 1]
        own = slice(ends[c], ends[c + 1])
        if high - low < 2 or ends[c] == ends[c + 1]:
            continue
        h = sorted_states[:, own]
        inner, errors = softmax(weights["out"][low:high] @ h + weights["bias"][low:high, None], targets[own] - low, every[: h.shape[1]])
        logs[own] += inner
        if grads is not None:
            grads["out"][low:high] += errors @ h.T
            grads["bias"][low:high] += errors.sum(axis=1)
            sorted_grads[:, own] += weights["out"][low:high].T @ errors
    out = np.empty_like(logs)
    out[order] = logs
    if grads is None:
        return out, None
    at_states = np.empty_like(sorted_grads)
    at_states[:, order] = sorted_grads
    return out, at_states


def streams(symbols: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid end to end in lanes of about equal length: target symbols, starts of documents, places.

    (steps, lanes) arrays; ``place`` is the document's number, -1 behind a lane's last.
    """
    sizes = np.array([len(x) for x in symbols], np.int64)
    lanes = int(max(1, min(lanes, len(symbols), -(-sizes.sum() // sizes.max()))))
    order = np.argsort(-sizes, kind="stable")
    # longest first, each to the lane that is shortest so far
    lane, shortest = np.empty(len(order), np.int64), [(0, k) for k in range(lanes)]
    for i, size in enumerate(sizes[order].tolist()):
        filled, lane[i] = shortest[0]
        heapq.heapreplace(shortest, (filled + size, int(lane[i])))
    lengths = np.bincount(lane, weights=sizes[order], minlength=lanes).astype(np.int64)
    steps = int(lengths.max())
    target = np.zeros((steps, lanes), np.int32)
    fresh = np.zeros((steps, lanes), bool)
    place = np.full((steps, lanes), -1, np.int32)
    filled = np.zeros(lanes, np.int64)
    for doc, k in zip(order.tolist(), lane.tolist(), strict=True):
        a, b = filled[k], filled[k] + sizes[doc]
        target[a:b, k] = symbols[doc]
        place[a:b, k] = doc
        fresh[a, k] = True
        filled[k] = b
    return target, fresh, place


def _inputs(target: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The symbol before each target; before a document's first one, the end."""
    before = np.zeros_like(target)
    before[1:] = target[:-1]
    before[fresh] = END
    return before


def train(weights, bounds: np.ndarray, documents: list[np.ndarray], adam: Adam, lanes: int = LANES) -> int:
    """One pass over the documents; returns the tokens seen."""
    if not documents:
        return 0
    target, fresh, place = streams(documents, lanes)
    before = _inputs(target, fresh)
    state = np.zeros((SIZE, target.shape[1]), np.float32)
    steps = max(STEPS, STEPS * lanes // target.shape[1])  # long documents leave fewer lanes: longer windows
    for at in range(0, len(target), steps):
        part = slice(at, at + steps)
        keep = (~fresh[part]).astype(np.float32)
        states, trace = forward(weights["table"], weights["own"], before[part], state, keep, True)
        state = states[-1].copy()
        real = (place[part] >= 0).ravel()
        flat = states.transpose(1, 0, 2).reshape(SIZE, -1)
        grads = {k: np.zeros_like(v) for k, v in weights.items()}
        _, at_states = log_chances(weights, bounds, flat[:, real], target[part].ravel()[real], grads)
        full = np.zeros_like(flat)
        full[:, real] = at_states
        rows, grads["own"] = backward(weights["own"], trace, full.reshape(SIZE, *target[part].shape).transpose(1, 0, 2), keep)
        grads["table"] = table_gradient(rows, before[part], weights["table"].shape[1])
        adam.update(weights, grads)
    return int((place >= 0).sum())


def score(weights, bounds: np.ndarray, documents: list[np.ndarray], lanes: int = 256, steps: int = 64) -> np.ndarray:
    """The natural log of every document's chance, the state carried through all of it."""
    total = np.zeros(len(documents))
    target, fresh, place = streams(documents, lanes)
    steps = max(steps, SCORE_TOKENS // target.shape[1])
    before = _inputs(target, fresh)
    state = np.zeros((SIZE, target.shape[1]), np.float32)
    for at in range(0, len(target), steps):
        part = slice(at, at + steps)
        starts = fresh[part]
        states, _ = forward(weights["table"], weights["own"], before[part], state, (~starts).astype(np.float32) if starts.any() else None)
        state = states[-1].copy()
        docs = place[part].ravel()
        real = docs >= 0
        logs, _ = log_chances(weights, bounds, states.transpose(1, 0, 2).reshape(SIZE, -1)[:, real], target[part].ravel()[real])
        total += np.bincount(docs[real], weights=logs, minlength=len(documents))
    return total


# ---------------------------------------------------------------------------------- distribution


def _symbols(vocab: Vocabulary, hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Every document's symbols, its end included."""
    found = _lookup(vocab.top, vocab.top_symbol, hashes, OTHER).astype(np.int32)
    ends = np.cumsum(counts)
    end = np.array([END], np.int32)
    return [np.concatenate([found[e - n : e], end]) for e, n in zip(ends, counts, strict=True)]


def _to_bytes(weights) -> bytes:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)]).astype(np.float32).tobytes()


def _from_bytes(raw: bytes, like) -> dict[str, np.ndarray]:
    flat, out, at = np.frombuffer(raw, dtype=np.float32), {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _averaged(trained: DataFrame, parts: int) -> list:
    """The mean of the rows' ``weights``, weighted by ``tokens``, by groups of groups."""

    def mean(_, rows: pd.DataFrame) -> pd.DataFrame:
        tokens = rows["tokens"].sum()
        total = sum(np.frombuffer(w, dtype=np.float32) * np.float64(n / tokens) for w, n in zip(rows["weights"], rows["tokens"], strict=True))
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN_IN], "tokens": [tokens], "weights": [total.astype(np.float32).tobytes()]})

    while parts > 1:
        trained = trained.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(mean, "part long, tokens long, weights binary")
        parts = -(-parts // FAN_IN)
    return trained.collect()


def learn(texts: DataFrame, text_col: str = "text", train_share: float = 1.0) -> tuple[dict[str, np.ndarray], Vocabulary, DataFrame]:
    """The network's weights, the vocabulary, and all counts (``word``, ``n``) of training texts."""
    spark = texts.sparkSession
    texts = spread(texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    counts = cut_lineage(_counted(texts), "word-counts")
    documents = texts.count()
    vocab = vocabulary(counts, documents)
    weights = initial(vocab)
    uniform = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)

    short = texts.where(F.octet_length("text") <= WARM_BYTES)
    sample = short.where(uniform < WARM_DOCS / max(1, documents)).limit(2 * WARM_DOCS).toPandas()["text"]
    if len(sample):
        warm = _symbols(vocab, *word_hashes(pa.array(sorted(sample), pa.string())))
        adam = Adam(weights, RATE)
        for _ in range(2):
            train(weights, vocab.bounds, warm, adam, LANES // 4)

    shared = spark.sparkContext.broadcast((weights, vocab))
    share = F.pmod(F.xxhash64("text", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start, vocab = shared.value
        own = {k: v.copy() for k, v in start.items()}
        adam, tokens = Adam(own, RATE / 4), 0
        for batch in blocks(batches, "text", SCORE_BYTES):
            tokens += train(own, vocab.bounds, _symbols(vocab, *word_hashes(batch.column(0))), adam)
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([tokens], pa.int64()), pa.array([_to_bytes(own)], pa.binary())], names=["part", "tokens", "weights"])

    chosen = texts.where(share < train_share)
    trained = cut_lineage(chosen.mapInArrow(work, "part long, tokens long, weights binary"), "weights")
    rows = _averaged(trained, max(1, chosen.rdd.getNumPartitions()))
    if rows:
        weights = _from_bytes(rows[0]["weights"], weights)
    return weights, vocab, counts


def score_texts(docs: DataFrame, model, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` and, for every row, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10)."""
    weights, vocab, counts = model
    spark = docs.sparkSession
    names = [docs.select(c).columns[0] for c in keep]
    rows = spread(docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    fields = [rows.schema["row"], T.StructField("number", T.LongType()), *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "n_other")], *[T.StructField(n, T.DoubleType()) for n in ("log_counts", "log_other", "log_model")], T.StructField("rare", T.ArrayType(T.LongType()))]
    schema = T.StructType(fields)
    shared = spark.sparkContext.broadcast((weights, vocab))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        weights, vocab = shared.value
        number = TaskContext.get().partitionId() << 40
        top_count = _lookup(vocab.words, vocab.counts, vocab.top, 0)
        for batch in blocks(batches, "text", SCORE_BYTES):
            hashes, words = word_hashes(batch.column(1))
            symbols = _symbols(vocab, hashes, words)
            top = _lookup(vocab.top, top_count, hashes, 0)
            seldom = top == 0
            n = top.astype(np.int64)
            n[seldom] = _lookup(vocab.words, vocab.counts, hashes[seldom], 0)
            ends = np.cumsum(words)
            sums = lambda x, ends=ends, words=words: (lambda s: s[ends] - s[ends - words])(np.concatenate([[0], np.cumsum(x)]))
            logs = np.log10(n + 1.0)
            unheld = n == 0
            rare = hashes[unheld].view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(sums(unheld))]).astype(np.int32)
            count = batch.num_rows
            arrays = [
                batch.column(0),
                pa.array(number + np.arange(count)),
                pa.array((words + 1).astype(np.int64)),
                pa.array((sums(~unheld) + (vocab.ends > 0)).astype(np.int64)),
                pa.array(sums(seldom).astype(np.int64)),
                pa.array(sums(logs) + np.log10(vocab.ends + 1.0)),
                pa.array(sums(np.where(seldom, logs, 0.0))),
                pa.array(score(weights, vocab.bounds, symbols) / np.log(10)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare)),
            ]
            number += count
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    scored = cut_lineage(rows.mapInArrow(work, schema), "scored")
    # words that tasks don't hold are rare, so no key of this join is hot
    rare = scored.select("number", F.explode("rare").alias("word"))
    found = rare.join(counts, "word").groupBy("number").agg(F.sum(F.log10(F.col("n") + 1.0)).alias("more"), F.count(F.lit(1)).alias("known"))
    found = cut_lineage(found, "rare-words")
    joined = scored.drop("rare").join(found, "number", "left")
    more, known = F.coalesce("more", F.lit(0.0)), F.coalesce("known", F.lit(0))
    base = F.col("log_counts") + more - F.col("n_tokens") * F.log10(F.lit(float(vocab.tokens + vocab.types + 1)))
    model_score = F.col("log_model") + F.col("log_other") + more - F.col("n_other") * F.log10(F.lit(vocab.other))
    return joined.select(
        *[F.col(f"row.`{n}`").alias(n) for n in names],
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        model_score.alias("score"),
    )
