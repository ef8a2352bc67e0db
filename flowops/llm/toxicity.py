"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

*Terms.* Words (letters A-Z lowered, digits, any non-ASCII character) whose rate among labelled
examples differs between the two labels by chi-square, at a level that grows with the number of
words looked at, so that about one word passes by chance; at most ``TERMS``. A text's vector has
``1 + ln(tf)`` times ``ln((1 + n) / (1 + df)) + 1`` for every term, at unit length; n and df count
all documents, whichever have labels.

*Index.* Examples that have terms lie in blocks of ``BLOCK_EXAMPLES``, alike ones together. For
every term and block the index holds the largest weight. A text's products with those bound what
any example of a block can reach; blocks are scored from the highest bound down until no bound
reaches the ``NEIGHBOURS``-th best cosine found, so the neighbours are exact. Equal cosines are
taken in the order of the index.

*Score.* Neighbours vote for their labels, weighted by ``1 / (1 + SHARPNESS * distance)``, with a prior vote of the
mean label. Votes of all examples, each without itself, calibrate the score: a monotone
step function (pool adjacent violators) of vote to share of label 1, drawn towards the mean
where examples are few, and interpolated. Texts without terms, so also empty and null ones, get
the share among such examples.

Labels are learnt from a bounded sample of the rows given, those of the smallest hashes
(``EXAMPLES`` at most; equal texts count once, with the label that most of them have); all else
covers all documents. Rows are scored one by one, repeated ones too; a null id is a row like
any other. Empty tables give empty results; without labels every score is 0. Labels other than
0 and 1, null ones, and keys whose labels disagree are passed over. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, spread
from .decontaminate import SEPARATORS
from .words import blocks, inside_of, word_hashes

#: Labelled rows that are learnt from, and terms of the vectors, at most.
EXAMPLES, TERMS = 20_000, 4096
NEIGHBOURS, BLOCK_EXAMPLES = 16, 32
#: How fast a vote fades with distance, and the weight of the prior vote.
SHARPNESS, PRIOR = 8.0, 0.5
#: Weight of the mean label in each step of the calibration.
DRAWN = 2.0
#: Texts whose bounds are computed at once.
LANES = 512
#: What separates words, but capitals, which are lowered before.
_INSIDE = inside_of(bytes(SEPARATORS))


@dataclass
class Model:
    """``terms``: sorted hashes, ``idf``; the index; ``steps`` and ``values`` of the calibration."""

    terms: np.ndarray
    idf: np.ndarray
    mean: float
    none: float  # score of texts without terms
    ids: list
    labels: np.ndarray
    # postings by block, then term, then example: where each (block, term) begins
    keys: np.ndarray
    begins: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    # by term: its blocks and the largest weight in each
    term_begins: np.ndarray
    term_blocks: np.ndarray
    term_most: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    @property
    def n_blocks(self) -> int:
        return -(-len(self.labels) // BLOCK_EXAMPLES)


def text_terms(hashes: np.ndarray, counts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and frequency of every term in every text, by row and term."""
    if not len(terms) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    rows = np.repeat(np.arange(len(counts)), counts)
    # most words are no terms: a table of their last 16 bits tells
    known = np.zeros(1 << 16, bool)
    known[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True
    some = np.flatnonzero(known[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(terms, hashes[some]), len(terms) - 1)
    hit = terms[at] == hashes[some]
    keys, tf = np.unique(rows[some[hit]] * len(terms) + at[hit], return_counts=True)
    return keys // len(terms), keys % len(terms), tf


def vectors(rows: np.ndarray, terms: np.ndarray, tf: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Weights of the entries of ``n`` texts, each text at unit length."""
    weight = (1.0 + np.log(tf)) * idf[terms]
    norm = np.sqrt(np.bincount(rows, weight * weight, n))
    return weight / norm[rows]


def build_index(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_examples: int, n_terms: int) -> dict[str, np.ndarray]:
    """The block-max index of examples' entries; examples are numbered in the order they lie in."""
    block = rows // BLOCK_EXAMPLES
    by = np.lexsort((rows, terms, block))
    rows, terms, weights, block = rows[by], terms[by], weights[by], block[by]
    own = block * n_terms + terms
    keys, begins = np.unique(own, return_index=True)
    most = np.maximum.reduceat(weights, begins) if len(begins) else weights
    by_term = np.lexsort((keys // n_terms, keys % n_terms))
    return {
        "keys": keys,
        "begins": np.append(begins, len(own)),
        "examples": rows,
        "weights": weights,
        "term_begins": np.searchsorted(keys[by_term] % n_terms, np.arange(n_terms + 1)),
        "term_blocks": (keys // n_terms)[by_term],
        "term_most": most[by_term],
    }


def _flat(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number in the ranges, and the range it comes from."""
    sizes = ends - begins
    own = np.repeat(np.arange(len(begins)), sizes)
    return np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[own], own


def neighbours(model: Model, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest examples of ``n`` texts and their cosines, best first; -1 where there are fewer.

    All texts go side by side: in each round every text that is not settled scores its next block.
    """
    n_terms, n_blocks = len(model.terms), model.n_blocks
    found = np.full((n, k), -1, np.int64)
    cosine = np.zeros((n, k))
    if not n_blocks or not len(rows):
        return found, cosine
    at, entry = _flat(model.term_begins[terms], model.term_begins[terms + 1])
    bounds = np.bincount(rows[entry] * n_blocks + model.term_blocks[at], weights[entry] * model.term_most[at], n * n_blocks).reshape(n, n_blocks)
    order = np.argsort(-bounds, axis=1, kind="stable")
    starts = np.searchsorted(rows, np.arange(n + 1))
    active = np.flatnonzero(bounds.max(axis=1) > 0)
    for turn in range(n_blocks):
        block = order[active, turn]
        bound = bounds[active, block]
        # sums may differ in their last bits
        still = (bound > 0) & (bound * (1 + 1e-9) >= cosine[active, -1])
        active, block = active[still], block[still]
        if not len(active):
            break
        entry, lane = _flat(starts[active], starts[active + 1])
        key = block[lane] * n_terms + terms[entry]
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        hit = model.keys[at] == key
        post, own = _flat(model.begins[at[hit]], model.begins[at[hit] + 1])
        lane, entry = lane[hit][own], entry[hit][own]
        inside = model.examples[post] - block[lane] * BLOCK_EXAMPLES
        scores = np.bincount(lane * BLOCK_EXAMPLES + inside, weights[entry] * model.weights[post], len(active) * BLOCK_EXAMPLES).reshape(len(active), BLOCK_EXAMPLES)
        ids = np.where(scores > 0, block[:, None] * BLOCK_EXAMPLES + np.arange(BLOCK_EXAMPLES), -1)
        every = np.concatenate([cosine[active], scores], axis=1)
        every_id = np.concatenate([found[active], ids], axis=1)
        # equal cosines by place in the index; texts without a further example have -1
        best = np.lexsort((every_id, -np.round(every, 12)), axis=1)[:, :k]
        cosine[active] = np.take_along_axis(every, best, axis=1)
        found[active] = np.take_along_axis(every_id, best, axis=1)
    return found, cosine


def votes(model: Model, found: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """Share of label 1 among the neighbours, nearer ones counting more."""
    weight = np.where(found >= 0, 1.0 / (1.0 + SHARPNESS * np.maximum(0.0, 1.0 - cosine)), 0.0)
    label = np.where(found >= 0, model.labels[np.maximum(found, 0)] if len(model.labels) else 0.0, 0.0)
    return ((weight * label).sum(axis=1) + PRIOR * model.mean) / (weight.sum(axis=1) + PRIOR)


def calibration(vote: np.ndarray, label: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Votes and the shares of label 1 there, not falling: pooled adjacent violators."""
    at, own = np.unique(np.round(vote, 9), return_inverse=True)
    pools: list[list[float]] = []  # label sum, count, vote sum
    for x, y, n in zip(at.tolist(), np.bincount(own, label).tolist(), np.bincount(own).tolist(), strict=True):
        pools.append([y, float(n), x * n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            y, n, x = pools.pop()
            pools[-1] = [pools[-1][0] + y, pools[-1][1] + n, pools[-1][2] + x]
    steps = np.array([p[2] / p[1] for p in pools])
    values = np.array([(p[0] + DRAWN * mean) / (p[1] + DRAWN) for p in pools])
    return steps, np.maximum.accumulate(values) if len(values) else values


def fit(terms: np.ndarray, idf: np.ndarray, ids: list, labels: np.ndarray, rows: np.ndarray, entries: np.ndarray, tf: np.ndarray) -> Model:
    """The model of examples whose entries are given by ``rows``, ``entries`` (term numbers), ``tf``."""
    mean = float(labels.mean()) if len(labels) else 0.0
    has = np.zeros(len(labels), bool)
    has[rows] = True
    bare = labels[~has]
    none = float((bare.sum() + DRAWN * mean) / (len(bare) + DRAWN))
    weights = vectors(rows, entries, tf, idf, len(labels))
    # alike examples together: by their heaviest term, then the next heaviest
    heavy = np.lexsort((entries, -weights, rows))
    first = np.searchsorted(rows[heavy], np.arange(len(labels)))
    last = len(heavy) - 1
    top = [np.where(has, entries[heavy[np.minimum(first, last)]], -1) if last >= 0 else np.zeros(len(labels), np.int64)]
    second = np.minimum(first + 1, max(last, 0))
    top.append(np.where(has & (rows[heavy[second]] == np.arange(len(labels))), entries[heavy[second]], -1) if last >= 0 else top[0])
    kept = np.flatnonzero(has)
    kept = kept[np.lexsort((kept, top[1][kept], top[0][kept]))]
    number = np.full(len(labels), -1, np.int64)
    number[kept] = np.arange(len(kept))
    model = Model(terms, idf, mean, none, [ids[k] for k in kept], labels[kept], steps=np.zeros(0), values=np.zeros(0), **build_index(number[rows], entries, weights, len(kept), max(1, len(terms))))
    if not len(kept):
        return model
    # every example's vote without itself
    by = np.lexsort((entries, number[rows]))
    rows, entries, weights = number[rows][by], entries[by], weights[by]
    vote = np.zeros(len(kept))
    for at in range(0, len(kept), LANES):
        to = min(at + LANES, len(kept))
        part = slice(*np.searchsorted(rows, [at, to]))
        found, cosine = neighbours(model, rows[part] - at, entries[part], weights[part], to - at, NEIGHBOURS + 1)
        self = found == np.arange(at, to)[:, None]
        self[:, -1] |= ~self.any(axis=1)  # many equal ones: then the last one goes
        rest = ~self
        vote[at:to] = votes(model, found[rest].reshape(to - at, NEIGHBOURS), cosine[rest].reshape(to - at, NEIGHBOURS))
    model.steps, model.values = calibration(vote, model.labels, mean)
    return model


def predict(model: Model, rows: np.ndarray, terms: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of ``n`` texts, their neighbours and the cosines."""
    weights = vectors(rows, terms, tf, model.idf, n) if len(rows) else np.zeros(0)
    found = np.full((n, NEIGHBOURS), -1, np.int64)
    cosine = np.zeros((n, NEIGHBOURS))
    for at in range(0, n, LANES):
        to = min(at + LANES, n)
        part = slice(*np.searchsorted(rows, [at, to]))
        found[at:to], cosine[at:to] = neighbours(model, rows[part] - at, terms[part], weights[part], to - at, NEIGHBOURS)
    score = np.full(n, model.none)
    near = found[:, 0] >= 0
    if near.any():
        score[near] = np.interp(votes(model, found[near], cosine[near]), model.steps, model.values)
    return np.clip(score, 0.0, 1.0), found, cosine


# --------------------------------------------------------------------------------------- Spark


def _sample(labelled: DataFrame) -> DataFrame:
    """``example`` (a hash of the text), ``id``, ``label``, and the distinct ``words`` of every text with their ``tf``."""
    rows = labelled.select(F.xxhash64("text").alias("example"), "id", "label", "text")
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("words", T.ArrayType(T.LongType())), T.StructField("tf", T.ArrayType(T.LongType()))])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            hashes, counts = word_hashes(batch.column(3), inside=_INSIDE)
            cuts = np.cumsum(counts)
            lists = [np.unique(hashes[b - c : b].view(np.int64), return_counts=True) for b, c in zip(cuts, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array([x[k] for x in lists], pa.list_(pa.int64())) for k in range(2)]], names=schema.names)

    found = rows.mapInArrow(words, schema)
    # equal texts are one example
    once = found.groupBy("example").agg(F.min("id").alias("id"), F.avg("label").alias("share"), F.first("words").alias("words"), F.first("tf").alias("tf"))
    return once.select("example", "id", (F.col("share") >= 0.5).cast("double").alias("label"), "words", "tf")


def _example_entries(sample: DataFrame, terms: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the examples, by hash: ids, labels, and their entries as row, term number and frequency."""
    schema = T.StructType([*sample.schema.fields[:3], T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("tf", T.ArrayType(T.LongType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words = _listed(batch.column(3))
            tf = _listed(batch.column(4))[1]
            at = np.minimum(np.searchsorted(terms, words.view(np.uint64)), max(len(terms) - 1, 0))
            hit = terms[at] == words.view(np.uint64) if len(terms) else np.zeros(len(words), bool)
            cuts = pa.array(np.searchsorted(rows[hit], np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.ListArray.from_arrays(cuts, pa.array(x[hit])) for x in (at, tf)]], names=schema.names)

    own = sorted(sample.mapInArrow(work, schema).collect(), key=lambda r: r["example"])
    flat = lambda name: np.array([x for r in own for x in r[name]], np.int64)
    rows = np.repeat(np.arange(len(own)), np.array([len(r["terms"]) for r in own], np.int64))
    return [r["id"] for r in own], np.array([r["label"] for r in own], float), rows, flat("terms"), flat("tf")


def _chosen_labels(labels: DataFrame, key_col: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled keys, those of the smallest hashes."""
    kept = labels.where(F.col(key_col).isNotNull()).orderBy(F.xxhash64(F.col(key_col)), key_col).limit(limit)
    return F.broadcast(cut_lineage(kept, "labels"))


def informative_terms(sample: DataFrame, limit: int = TERMS) -> np.ndarray:
    """Sorted hashes of the words whose rates differ between the labels."""
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = size["n"], size["toxic"] or 0.0
    if not 0 < toxic < n:
        return np.zeros(0, np.uint64)
    counted = cut_lineage(sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.sum("label").alias("hit")).where("df > 1"), "words")
    looked = counted.count()
    if not looked:
        return np.zeros(0, np.uint64)
    df, hit = F.col("df"), F.col("hit")
    chi = n * F.pow(hit * (n - toxic) - (df - hit) * toxic, 2) / (F.lit(float(toxic)) * (n - toxic) * df * F.greatest(n - df, F.lit(1)))
    least = 2.0 * float(np.log(looked))
    best = counted.select("word", chi.alias("chi")).where(F.col("chi") >= least).orderBy(F.desc("chi"), "word").limit(limit)
    return np.sort(np.array([r["word"] for r in best.collect()], np.int64).view(np.uint64))


def _entries(docs: DataFrame, keep: list, text_col: str, terms: np.ndarray) -> DataFrame:
    """``row`` (``keep`` as a struct), ``example``, and the text's ``terms`` (numbers) and ``tf``: one pass over the texts."""
    rows = spread(docs.select(F.struct(*keep).alias("row"), F.xxhash64(text_col).alias("example"), F.col(text_col).alias("text")))
    schema = T.StructType([rows.schema["row"], rows.schema["example"], T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))])
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            at, term, tf = text_terms(*word_hashes(batch.column(2), inside=_INSIDE), shared.value)
            cuts = pa.array(np.searchsorted(at, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (term, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=schema.names)

    return rows.mapInArrow(work, schema)


def _listed(column) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a column of lists."""
    sizes = np.array(column.value_lengths().fill_null(0), np.int64)
    return np.repeat(np.arange(len(column)), sizes), np.array(column.flatten(), np.int64)


def document_frequencies(entries: DataFrame, n_terms: int) -> np.ndarray:
    """How many rows have each term; a task counts its own rows, so it gives a row per term at most, however many rows share it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(n_terms, np.int64)
        for batch in batches:
            own += np.bincount(_listed(batch.column(0))[1], minlength=n_terms)
        found = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(own[found])], names=["term", "n"])

    df = np.zeros(n_terms)
    for r in entries.select("terms").mapInArrow(work, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        df[r["term"]] = r["n"]
    return df


def toxicity(docs: DataFrame, labels: DataFrame, keep: list, key_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = EXAMPLES) -> DataFrame:
    """``keep`` and, for every row of ``docs``, ``score`` and ``evidence``: the nearest examples
    (``id``, ``label``, ``cosine``), best first.

    ``labels`` has the key and label of the rows to learn from.
    """
    names = [docs.select(c).columns[0] for c in keep]
    known = labels.select(F.col(key_col).alias("__key"), F.col(label_col).cast("double").alias("__label")).where("__label in (0, 1)")
    known = known.groupBy("__key").agg(F.avg("__label").alias("__label"))
    chosen = _chosen_labels(known, "__key", limit).where("__label in (0, 1)")
    texts = docs.select(F.col(key_col).alias("__key"), F.col(text_col).alias("__text")).join(chosen, "__key")
    sample = cut_lineage(_sample(texts.select(F.col("__key").alias("id"), F.col("__label").alias("label"), F.col("__text").alias("text"))), "examples")
    terms = informative_terms(sample)

    entries = cut_lineage(_entries(docs, keep, text_col, terms), "entries")
    counted = entries.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    idf = np.log((1.0 + counted) / (1.0 + document_frequencies(entries, len(terms)))) + 1.0

    ids, own_labels, own_rows, own_terms, own_tf = _example_entries(sample, terms)
    model = fit(terms, idf, ids, own_labels, own_rows, own_terms, own_tf)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    id_type = docs.schema[key_col].dataType
    evidence = T.ArrayType(T.StructType([T.StructField("id", id_type), T.StructField("label", T.DoubleType()), T.StructField("cosine", T.DoubleType())]))
    schema = T.StructType([entries.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("evidence", evidence)])
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(evidence)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            rows, term = _listed(batch.column(1))
            score, found, cosine = predict(held, rows, term, _listed(batch.column(2))[1], batch.num_rows)
            near = [[{"id": held.ids[e], "label": float(held.labels[e]), "cosine": float(min(c, 1.0))} for e, c in zip(f, cs, strict=True) if e >= 0] for f, cs in zip(found.tolist(), cosine.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(near, kind)], names=schema.names)

    scored = entries.select("row", "terms", "tf").mapInArrow(work, schema)
    return scored.select(*[F.col(f"row.`{n}`").alias(n) for n in names], "score", "evidence")
