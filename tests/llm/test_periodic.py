"""Periodic runs against a plain search by period, and odd inputs."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from flowops.llm.periodic import find_runs, periodic_runs, repeated_tail, word_codes

SPACE = b" \t\n\x0b\x0c\r"


def plain(words):
    """(start, length, period) of all runs: for every period, stretches of words equal to those a period on."""
    found = {}
    known = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    for q in range(1, len(words) // 4 + 1):
        other = np.flatnonzero(codes[:-q] != codes[q:])
        edges = np.concatenate([[-1], other, [len(words) - q]])
        for k in np.flatnonzero(np.diff(edges) > 1):
            start, length = int(edges[k]) + 1, int(edges[k + 1] - edges[k]) - 1 + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words):
    gone = {i for s, n, q in plain(words) for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rnd):
    n = rnd.choice([0, 1, 5, 6, 12, 40, 100])
    words = [str(rnd.randrange(rnd.choice([1, 2, 3, 8]))).encode() for _ in range(n)]
    if words and rnd.random() < 0.5:
        a = rnd.randrange(n)
        p = 1 + (n - a) // rnd.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_agree_with_a_search():
    rnd = random.Random(1)
    for _ in range(600):
        texts = [some_words(rnd) for _ in range(rnd.randint(0, 5))]
        want = [[k, *r] for k, words in enumerate(texts) for r in plain(words)]
        assert find_runs(*word_codes(texts)).tolist() == want


def test_runs_of_other_shapes():
    codes = np.array([1, 2] * 5 + [3] * 3 + [1, 2, 1])
    assert find_runs(codes, [len(codes)], least_length=3, least_exponent=3).tolist() == [[0, 0, 10, 2], [0, 10, 3, 1]]
    assert find_runs(codes, [len(codes)]).tolist() == [[0, 0, 10, 2]]
    assert find_runs(np.zeros(0, np.int64), []).tolist() == []
    # a run of 200,000 words, and one of a long period
    assert find_runs(np.zeros(200_000, np.int64), [200_000]).tolist() == [[0, 0, 200_000, 1]]
    codes = np.concatenate([np.arange(900), np.tile(np.arange(1000, 6000), 5)[:-7]])
    assert find_runs(codes, [len(codes)]).tolist() == [[0, 900, 24_993, 5000]]


def test_rows(spark, odd_docs, no_docs):
    got = periodic_runs(odd_docs, ["doc_id", "text"]).collect()
    assert len(got) == odd_docs.count()
    for row in got:
        words = (row["text"] or "").encode().split()
        assert [tuple(r) for r in row["runs"]] == plain(words)
        assert row["collapsed"].encode() == collapsed(words)
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words)).hexdigest()
        best = min(plain(words), key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        assert (tuple(row["strongest"]) if row["strongest"] else None) == best
    assert any(row["strongest"] for row in got)
    empty = periodic_runs(no_docs, ["doc_id"])
    assert empty.columns == ["doc_id", "runs", "strongest", "collapsed", "collapsed_sha256"]
    assert empty.count() == 0


def test_repeated_tail(spark):
    rnd = random.Random(2)
    rows = [(k, " \n".join(f"w{rnd.randrange(50)}" for _ in range(rnd.choice([0, 1, 2, 7, 60])))) for k in range(300)] + [(None, "a b"), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", repeated_tail(F.col("text"), F.col("doc_id")).alias("tail"))
    changed = 0
    for doc_id, text, tail in frame.collect():
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert (tail or "").encode().split() == words
    assert changed > 10
