"""The pipeline's stages on small documents against plain Python."""

from collections import Counter

import numpy as np
import pytest
from test_operators import WORD, check_packed, plain_components, plain_counts, plain_hits, plain_line_dedup, plain_pieces, prose

import corpus_pipeline as pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    clean = lambda n: "the of and " * (1 + n // 50) + prose(rng, n, 5000)
    texts = [clean(int(rng.integers(50, 200))) for _ in range(30)]
    texts += [texts[0], texts[1] + " one more", texts[2].replace("t1", "tt1")]  # copies and near copies
    edited = texts[3].split()
    edited[5], edited[-9] = "edit", "edit"
    texts += [" ".join(edited)]
    texts += [texts[4] + "\n" + clean(60), clean(60) + "\n" + texts[4] + "\n" + clean(80)]  # lines that occurred before
    question = prose(rng, 40, 5000)
    texts += [clean(70) + " " + question, clean(2000) + " " + " ".join(question.split()[:13])]  # much and little of a benchmark
    texts += ["too short", "### " * 100, "again and again the same words " * 30, "", None, texts[5], texts[6]]
    ids = [*range(len(texts) - 2), None, 5]
    path = tmp_path_factory.mktemp("docs")
    rows = [(i, t, None if k % 4 == 0 else "en", "s", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    rows += [rows[7], (0, texts[0], "en", "s", len(texts[0]))]  # repeated rows
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, question), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def order(row):
    return (row[0] is None, row[0] or 0, row[1] or "")


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=order)

    stage = dict(pipeline.STAGES)
    kept = stage["quality rules"](spark, docs, folder)
    rows = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=order)
    passed = [(i, t) for i, t in before if (c := plain_counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0] and c[2] <= 0.4 * c[0]]
    assert kept.columns == docs.columns and rows == passed

    lines = stage["line dedup"](spark, kept, folder)
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    assert len({i for i, _ in distinct}) >= len(distinct) - 1
    # rows of one id are ordered by a hash of their texts: taken from the result's own order
    by_hash = {(r[0], r[1]): r[2] for r in kept.selectExpr("doc_id", "text", "xxhash64(text)").collect()}
    distinct.sort(key=lambda r: (r[0] is None, r[0] or 0, by_hash[r]))
    gone = plain_line_dedup(list(enumerate(t for _, t in distinct)), 8)
    left = {}
    for k, (i, t) in enumerate(distinct):
        left[i, t] = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[k])
    want = Counter((i, left[i, t]) for i, t in rows if WORD.search(left[i, t]))
    after = lines.collect()
    assert lines.columns == docs.columns and Counter((r["doc_id"], r["text"]) for r in after) == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    near = stage["near duplicates"](spark, lines, folder)
    texts = sorted(want, key=order)
    groups = plain_components(texts, 5, 80)
    got = [(r["doc_id"], r["text"]) for r in near.collect()]
    assert near.columns == docs.columns and len(got) == len(set(got))
    # one of each group, and nothing else is lost
    assert len(plain_components(got, 5, 80)) == len(got) and {c for _, _, c in plain_components(got, 5, 80)} == {c for _, _, c in groups}

    clean = stage["benchmark decontamination"](spark, near, folder)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if r["text"]]
    judged = {x: plain_hits(x[1], items) for x in got}
    wanted = Counter(x for x, (n, hit, _) in judged.items() if not (hit > 0 and 20 * hit >= n))
    rest = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert clean.columns == docs.columns and Counter(rest) == wanted and len(wanted) < len(judged)

    packed = stage["best-fit packing"](spark, clean, folder).collect()
    assert Counter(tuple(r[:5]) for r in packed) == plain_pieces(rest, pipeline.CAPACITY)
    check_packed(packed, pipeline.CAPACITY)


def test_run_is_all_stages(spark, folder):
    got = pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert Counter(tuple(r[:5]) for r in got) == Counter(tuple(r[:5]) for r in docs.collect())


def test_empty(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").where("false").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


