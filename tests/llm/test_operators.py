"""Operators on small and odd inputs, against plain Python."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowops.llm import decontaminate as deco
from flowops.llm import jaccard, langid, linededup, lm, packing, quality, sharding, suffixes, urlfilter, words
from flowops.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def texts_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def frame_of(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


def prose(rng, n, pool=400):
    return " ".join(f"t{int(x)}" for x in rng.integers(0, pool, n))


# ----------------------------------------------------------------------------------------- words


def test_word_hashes_match_words():
    texts = ["Aa bb", None, "", "  x\ty\n", "aa BB", "é\u00a0z 漢", "q" * 3000 + " end"]
    hashes, counts = words.word_hashes(pa.array(texts))
    split = [WORD.findall(lower(t)) for t in texts]
    assert counts.tolist() == [len(x) for x in split]
    flat = list(itertools.chain(*split))
    assert len(set(hashes.tolist())) == len(set(flat))
    assert {w: h for w, h in zip(flat, hashes.tolist())} == {w: h for w, h in reversed(list(zip(flat, hashes.tolist())))}


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    texts = pa.array([" ".join(f"word{i % 50}" for i in range(500))] * 2)
    whole, _ = words.word_hashes(texts)
    monkeypatch.setattr(words, "SEGMENT", 64)
    parts, _ = words.word_hashes(texts)
    assert (whole == parts).all()


def test_blocks_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (k % 7) for k in range(50)])], names=["id", "text"])
    parts = list(words.blocks(iter([batch]), "text", 10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(50)) and len(parts) > 5


# -------------------------------------------------------------------------------------- sharding


def check_shards(placed, count, shards=8):
    assert len(placed) == count
    by = defaultdict(list)
    for r in placed:
        by[r["shard"]].append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {k: sum(r["size"] for r in own) for k, own in by.items()}


def test_sharding_odd(spark, odd_docs, no_docs):
    placed = sharding.shard(odd_docs).collect()
    check_shards(placed, odd_docs.count())
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in placed)
    assert sizes == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts_of(odd_docs))
    assert sharding.shard(no_docs).count() == 0


def test_sharding_hot_text_is_cut(spark):
    """A third of all rows have one text: shards stay equal, and other equal texts stay together."""
    rng = np.random.default_rng(1)
    texts = ["hot " * 20] * 700 + [prose(rng, int(rng.integers(1, 200))) for _ in range(1000)] + [f"pair {k}" for k in range(200)] * 2
    placed = sharding.shard(frame_of(spark, texts), range_rows=100).collect()
    sizes = check_shards(placed, len(texts))
    assert max(sizes.values()) <= 1.03 * min(sizes.values())
    shard_of = {r["doc_id"]: r["shard"] for r in placed}
    assert all(shard_of[1700 + k] == shard_of[1900 + k] for k in range(200))


def test_splitters_subdivide(spark, monkeypatch):
    """A bad first draw is mended: no range holds much more than its share."""
    monkeypatch.setattr(sharding, "DRAWN", 1)
    rows = spark.range(4000).selectExpr("md5(cast(id as string)) AS text_hash", "cast(id as string) AS id_text", "1 + id % 7 AS size")
    total = rows.agg(F.sum("size")).first()[0]
    found = sharding.splitters_of(rows, total, 16)
    largest = rows.withColumn("r", sharding._range_of(found)).groupBy("r").agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0]
    assert found == sorted(set(found)) and largest <= 2 * total / 16


# --------------------------------------------------------------------------------------- quality


def plain_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if twice[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_quality_odd(spark, odd_docs, no_docs):
    got = quality.quality(odd_docs, [F.col("doc_id"), F.col("text")]).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        n, chars, symbols, dup, repeat = plain_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality(no_docs, [F.col("doc_id")]).count() == 0


def test_quality_keeps_languages_and_capitals(spark):
    """Clean texts in capitals, of more languages, and of scripts without listed words are kept; bare keywords are not."""
    swedish = "Hon gick genom skogen mot sjön och såg att vattnet låg stilla, men ingen båt väntade vid bryggan den kvällen."
    clean = [
        "WE WALKED ALONG THE RIVER AND FOUND A SMALL HOUSE THAT NOBODY HAD SEEN BEFORE.",
        swedish,
        "Мы шли вдоль реки и увидели маленький дом, которого никто раньше не замечал у старой дороги.",
        "Wij liepen langs de rivier en zagen een klein huis dat niemand eerder had gezien.",
    ]
    texts = [" ".join(f"{x[:-1]} {k}." for k in range(9)) for x in clean] + [" ".join(f"cheap{k} shoes{k}" for k in range(60)), None, ""]
    got = quality.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), [F.col("doc_id")]).orderBy("doc_id").collect()
    judged = [r for r in got if r["n_words"] >= 50]
    assert [("stop_word_ratio" in r["failed_rules"]) for r in judged] == [False] * 4 + [True]
    assert [r["kept"] for r in got[4:]] == [False] * 3


def test_quality_plan_is_one_projection(spark, odd_docs):
    plan = quality.quality(odd_docs, [F.col("doc_id")])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Python" not in plan


# --------------------------------------------------------------------------------------- Jaccard


def plain_components(docs, width, percent):
    """By row: (set size, smallest id reachable); rows with equal sets are linked."""
    sets = []
    for _, text in docs:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(docs)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(docs)):
        groups[find(k)].append(docs[k][0])
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [x for x in groups[find(k)] if x is not None]
        out.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    return Counter(out)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard_odd(spark, odd_docs, no_docs, width, percent):
    got = jaccard.jaccard_components(odd_docs, width=width, percent=percent)
    assert Counter(rows_of(got.select("doc_id", "n_shingles", "component_id"))) == plain_components(texts_of(odd_docs), width, percent)
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_jaccard_finds_every_link(spark):
    """Families of edited copies, chains of links, and a passage that many documents share."""
    rng = np.random.default_rng(5)
    passage = prose(rng, 40, 10_000)
    texts = []
    for size in (8, 14, 30, 60, 150):
        for _ in range(6):
            base = prose(rng, size, 5000).split()
            for _ in range(8):
                w = list(base)
                for _ in range(int(rng.integers(0, 3))):
                    w[int(rng.integers(0, len(w)))] = f"e{int(rng.integers(0, 9999))}"
                base = w if rng.random() < 0.5 else base
                texts.append(" ".join(w))
    texts += [prose(rng, int(rng.integers(3, 60)), 10_000) + " " + passage for _ in range(60)]
    docs = list(enumerate(texts))
    got = jaccard.jaccard_components(frame_of(spark, texts))
    assert Counter(rows_of(got.select("doc_id", "n_shingles", "component_id"))) == plain_components(docs, 4, 85)


def test_jaccard_common_tokens_only_change_the_order(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [prose(rng, 50, 60) for _ in range(5)]
    texts = [b + " " + prose(rng, int(rng.integers(0, 9)), 60) for b in base for _ in range(12)]
    monkeypatch.setattr(jaccard, "COMMON", 2)
    got = jaccard.jaccard_components(frame_of(spark, texts))
    assert Counter(rows_of(got.select("doc_id", "n_shingles", "component_id"))) == plain_components(list(enumerate(texts)), 4, 85)


def least_cells(n, m, percent):
    return -(-percent * (n + m) // (100 + percent)) - -(-percent * max(n, m) // 100) + 1


def test_lm_vocabulary_of_equal_counts(spark):
    counts = spark.range(3000).selectExpr("xxhash64(id) AS word", "CASE WHEN id < 10 THEN 7L ELSE 2L END AS n")
    vocab = lm.vocabulary(counts, 5, size=50, held=400)
    assert len(vocab.top) == 50
    assert 50 < len(vocab.words) <= 400
    assert vocab.counts.tolist().count(7) == 10
    assert vocab.tokens == 10 * 7 + 2990 * 2 + 5
    again = lm.vocabulary(counts.repartition(7), 5, size=50, held=400)
    assert again.words.tolist() == vocab.words.tolist()
    assert len(lm.vocabulary(counts.limit(0), 0).top) == 0


def test_jaccard_cells_of_a_common_passage_go(spark):
    passage = [f"p{i}" for i in range(132)]

    def cells_of(documents):
        rows = frame_of(spark, [" ".join([*passage, *(f"d{d}w{i}" for i in range(18))]) for d in range(documents)])
        texts = rows.select("text")
        common = spark.sparkContext.broadcast(jaccard._common_tokens(jaccard._classes(rows.select(F.col("doc_id").alias("id"), "text"), 4)))
        cells = jaccard._cells(jaccard._prefixes(texts, 4, 85, common), 85)
        return rows, cells.count(), jaccard._pruned(cells, 85).count()

    rows, before, after = cells_of(2000)
    # all of them have places of the passage among their first tokens, and none can be linked
    assert before >= 2000
    assert after == 0
    got = jaccard.jaccard_components(rows)
    assert got.where("component_id <> doc_id").count() == 0
    assert got.count() == 2000


def test_jaccard_fewest_cells(spark):
    """The bound is the minimum over every size between, though the two roundings make it go up and down."""
    cases = [(p, n, a, b) for p in (80, 85) for n in (7, 40, 100, 101, 333) for a in range(-(-n * p // 100), n * 100 // p + 1, 2) for b in range(a, n * 100 // p + 1)]
    assert (85, 100, 112, 114) in {(p, n, a + d, b) for p, n, a, b in cases for d in (0, 1)}
    frame = spark.createDataFrame([(85, 100, 112, 114), *cases], "percent int, n int, low long, high long")
    for percent in (80, 85):
        some = frame.where(F.col("percent") == percent)
        for r in some.withColumn("fewest", jaccard.fewest_cells(F.col("n"), F.col("low"), F.col("high"), percent)).collect():
            assert r["fewest"] == min(least_cells(r["n"], m, percent) for m in range(r["low"], r["high"] + 1)), r


def test_jaccard_link_to_a_group_of_sizes_around(spark):
    """Sets of 112, 113 and 114 tokens are a group; one of 100 is linked to the second only and meets them in 2 cells."""
    for seed in range(99):
        pool = [f"s{seed}w{i}" for i in range(140)]
        hashes, _ = words.word_hashes(pa.array([" ".join(pool)]))
        # in the order of the tokens' hashes, for a width of one word
        pool = [w for _, w in sorted(zip(words.runs(hashes, 1).tolist(), pool))]
        extra, common = pool[2:18], pool[18:116]
        sets = [pool[:2] + common, extra[:15] + common[:97], extra[:15] + common, extra[:16] + common]
        classes = [jaccard.class_of(words.shingles(words.word_hashes(pa.array([" ".join(s)]))[0], 1)) for s in sets]
        if classes[2] < max(classes[1:]):  # it does not lead the cells, so only the opened group gives its link
            break
    assert [len(s) for s in sets] == [100, 112, 113, 114]
    texts = [" ".join(s) for s in sets]
    got = jaccard.jaccard_components(frame_of(spark, texts), width=1)
    want = plain_components(list(enumerate(texts)), 1, 85)
    assert {c for _, _, c in want} == {0}
    assert Counter(rows_of(got.select("doc_id", "n_shingles", "component_id"))) == want


def test_bands_meet():
    for percent in (80, 85):
        for n in range(1, 400):
            for m in range(n, n * 100 // percent + 1):
                assert set(jaccard.bands_of(n, percent)) & set(jaccard.bands_of(m, percent))


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    got = dict(rows_of(connected_components(spark.createDataFrame(edges, "a long, b long"))))
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {x: find(x) for x in parent}


# ------------------------------------------------------------------------------------------ urls


def test_urls(spark):
    rules = [
        urlfilter.UrlRule("com", "/", "allow"),
        urlfilter.UrlRule("example.com", "/en/", "block"),
        urlfilter.UrlRule("bad.org", "", "block"),
        urlfilter.UrlRule("bad.org", "/fine", "allow"),
        urlfilter.UrlRule("tie.net", "/", "allow"),
        urlfilter.UrlRule("tie.net", "/", "block"),
    ]
    hosts = ["EXAMPLE.com", "www.example.com", "notexample.com", "com", "bad.org", "a.bad.org", "abad.org", "tie.net", ".com", "a..com", ""]
    paths = ["", "/", "/en/", "/en/x?y=/z", "/fine", "/fineprint", "/EN/", "?q", "#f", "/a://b"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] * 2 + [None, "", "no scheme/en/", "://", "x://example.com/en/"]
    pages = spark.createDataFrame([(k if k % 9 else None, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, host string").repartition(3)

    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: (len(r.key), r.host.count("."), r.key, r.verdict), default=None)
        return host, path, best and best.key, best.verdict if best else "allow"

    got = urlfilter.filter_urls(pages, rules)
    assert Counter(rows_of(got)) == Counter((k if k % 9 else None, *plain(u)) for k, u in enumerate(urls))
    assert urlfilter.filter_urls(pages.where("false"), rules).count() == 0
    assert {r["verdict"] for r in urlfilter.filter_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact(spark, monkeypatch):
    """Few cells a key: many false positives, several levels, and exact answers on the universe."""
    monkeypatch.setattr(urlfilter, "CELLS_PER_KEY", 2)
    monkeypatch.setattr(urlfilter, "HASHES", 1)
    universe = spark.range(3000).selectExpr("concat('k', id) AS key")
    listed = universe.where("hash(key) % 5 = 0")
    cascade = urlfilter.Cascade.build(listed, universe)
    got = {r["key"] for r in universe.where(cascade.contains(F.col("key"))).collect()}
    assert got == {r["key"] for r in listed.collect()} and len(cascade.levels) > 2


# ------------------------------------------------------------------------------------ line dedup


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_line_dedup(docs, min_words):
    """docs: distinct (order, text); by order, positions dropped."""
    seen, out = [], {}
    for order, text in docs:
        gone = []
        for at, line in enumerate(text.split("\n")):
            w = WORD.findall(line)
            if w:
                if any(w == v or (min(len(w), len(v)) >= min_words and within_one(w, v)) for v in seen):
                    gone.append(at)
                seen.append(w)
        out[order] = gone
    return out


def test_line_dedup(spark):
    rng = np.random.default_rng(8)
    base = [prose(rng, int(rng.integers(1, 14)), 30).split() for _ in range(40)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(int(rng.integers(1, 6))):
            w = list(base[int(rng.integers(0, len(base)))])
            for _ in range(int(rng.integers(0, 3))):
                at, kind = int(rng.integers(0, len(w) + 1)), int(rng.integers(0, 3))
                if kind == 0:
                    w.insert(at, f"t{int(rng.integers(0, 30))}")
                elif at < len(w):
                    w[at : at + 1] = [] if kind == 1 else [f"t{int(rng.integers(0, 30))}"]
            lines.append("  ".join(w))
        texts.append("\n".join(lines))
    texts += [f"item number {k} of a long list of equal lines" for k in range(40)]  # one hot variant
    for min_words in (1, 4):
        got = linededup.line_dedup(frame_of(spark, texts), [F.col("doc_id")], min_words=min_words).collect()
        want = plain_line_dedup(list(enumerate(texts)), min_words)
        assert {r["doc_id"]: r["dropped"] for r in got} == want
        for r in got:
            lines = texts[r["doc_id"]].split("\n")
            assert r["text"] == "\n".join(x for k, x in enumerate(lines) if k not in want[r["doc_id"]])
            assert (r["n_lines"], r["n_dropped"]) == (len(lines), len(want[r["doc_id"]]))


def test_line_dedup_odd(spark, odd_docs, no_docs):
    got = linededup.line_dedup(odd_docs, [F.col("doc_id"), F.col("text").alias("before")], min_words=2).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert [r["n_dropped"] for r in by[1]] == [0, 0] and [r["n_dropped"] for r in by[2]] == [1]
    assert by[2][0]["text"] == "" and by[3][0]["text"] is None and by[4][0]["text"] == "" and by[4][0]["n_lines"] == 1
    assert by[8][0]["dropped"] == [3] and by[8][0]["text"] == "Éléphant ñandú 漢字 😀\nline two\n"
    assert linededup.line_dedup(no_docs, [F.col("doc_id")]).count() == 0


# --------------------------------------------------------------------------------------- packing


def plain_pieces(docs, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    out = Counter()
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out[i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_odd(spark, odd_docs, no_docs):
    pieces = packing.token_pieces(odd_docs, TOKENIZER, 256)
    got = packing.pack(pieces, 256).collect()
    assert Counter(tuple(r[:5]) for r in got) == plain_pieces(texts_of(odd_docs), 256)
    total = sum(r["length"] for r in got)
    assert check_packed(got, 256) <= math.ceil(total / 256) + 1
    assert packing.pack(packing.token_pieces(no_docs, TOKENIZER, 256), 256).count() == 0


def test_token_ids_by_words_are_the_tokenizers(spark):
    texts = ["Don't stop: it's 1,234 o'clock!", "naïve café\u0301 ÀÉ İstanbul ΑΣ", "a\u00a0b\u2003c\x85d\x1ce", "<|endoftext|> x<|startoftext|>y", "漢字 かな 😀👍🏽", "'s 'LL we'Re", "tab\tnew\nline\x0bvt\x0cff\rcr", "\u0301a e\u0301", ""]
    assert packing.TokenIds(TOKENIZER, True)(texts) == packing.TokenIds(TOKENIZER, False)(texts)


def test_token_ids_remember_no_more_than_asked():
    rng = np.random.default_rng(13)
    texts = [prose(rng, 200, 5_000) + f" Alpha{i % 50}, beta-{i}!" for i in range(60)]
    many = packing.TokenIds(TOKENIZER)(texts)
    few = packing.TokenIds(TOKENIZER, remembered=40)
    for text, ids in zip(texts, many, strict=True):
        assert few([text]) == [ids] and len(few.words) <= 40 and len(few.words.parts) <= 40
    assert packing.TokenIds(TOKENIZER)(texts) == many


def test_packing_levels_end_with_long_pieces(spark):
    """Pieces of which few fit beside another: every level still hands on its emptiest bins, and none is lost."""
    lengths = [int(x) for x in np.random.default_rng(3).integers(820, 1840, 3000)]
    pieces = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id int, length int")
    got = packing.pack(pieces, 2048, shard_pieces=200).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == list(enumerate(lengths))
    bins = np.empty(len(lengths), np.int64)
    packing.best_fit(np.array(lengths), np.argsort([-n for n in lengths], kind="stable"), bins, [], 2048)
    # shards of 200 alone leave 1.8 % more than one search over all
    assert check_packed(got, 2048) <= 1.016 * (bins.max() + 1)
    assert len({r["sequence_id"] >> 48 for r in got}) > 3


def test_emptiest_bins():
    fill = np.array([2048, 100, 2000, 1900, 0])
    assert list(packing.emptiest(fill, 2048)) == [False, True, False, True, False]
    assert list(packing.emptiest(np.array([7]), 2048)) == [True] and list(packing.emptiest(np.array([9, 9]), 9)) == [False, False]


def test_pieces_keep_all_ids(spark):
    docs = frame_of(spark, ["one two three " * 50, "", "four"])
    pieces = packing.token_pieces(docs, TOKENIZER, 64, with_ids=True).orderBy("doc_id", "piece").collect()
    whole = packing.token_pieces(docs, TOKENIZER, 10**6, with_ids=True).orderBy("doc_id").collect()
    for r in whole:
        assert [x for p in pieces if p["doc_id"] == r["doc_id"] for x in p["ids"]] == r["ids"]


def test_packing_over_many_shards(spark):
    """Shards lose little: what they leave half empty is packed together."""
    rng = np.random.default_rng(2)
    lengths = [int(x) for x in np.minimum(2048, rng.lognormal(5.5, 1.2, 3000).astype(int) + 1)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").repartition(4)
    got = packing.pack(pieces, 2048, shard_pieces=300).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == list(enumerate(lengths))
    assert check_packed(got, 2048) <= math.ceil(sum(lengths) / 2048) * 1.01 + 1


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 600, 200)
    a, b = (np.empty(200, np.int64) for _ in range(2))
    packing.best_fit(lengths, np.argsort(-lengths), a, [], 1000)
    packing.best_fit(lengths, rng.permutation(200), b, [], 1000)
    for _ in range(20):
        child = packing.cross(lengths, a, b, 1000, rng)
        fill = np.bincount(child, weights=lengths)
        assert fill.max() <= 1000 and fill.min() > 0
        b = child
    best = packing.evolve(lengths, [], 1000, 4, 10, rng)[0]
    assert packing.fitness(lengths, best) <= packing.fitness(lengths, a)


# ------------------------------------------------------------------------------- decontamination


def plain_hits(text, items, window=13):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, hit, ids = norm(text), set(), set()
    for item, own in items:
        v = norm(own)
        k = min(window, len(v))
        grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i : i + k]) in grams:
                hit.update(range(i, i + k))
                ids.update([] if item is None else [str(item)])
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [10**6, 40])
def test_decontaminate(spark, odd_docs, no_docs, block):
    items = [(1, "The quick-brown fox; jumps over THE lazy dog and runs far away, from the old house!"), (2, "line two"), (2, "some text"), (10, "漢字"), (None, "the"), (3, None), (4, "..."), (11, "lazy dog and")]
    table = spark.createDataFrame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if t is not None]
    got = deco.decontaminate(odd_docs, table, block_bytes=block)
    want = Counter()
    for i, t in texts_of(odd_docs):
        n, hit, ids = plain_hits(t, known)
        want[i, n, hit, len(ids), tuple(ids), hit > 0 and 20 * hit >= n] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"]) for r in got.collect()) == want
    assert deco.decontaminate(no_docs, table).count() == 0
    assert deco.decontaminate(odd_docs, table.where("false")).where("n_hit > 0").count() == 0


def test_decontaminate_offsets(spark):
    text = "Before — it: 'Líne, TWO' after"
    got = deco.decontaminate(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, "líne two")], "item_id long, text string")).first()
    assert [text[s["first"] : s["end"]] for s in got["spans"]] == ["Líne, TWO"]


# ----------------------------------------------------------------------------- repeated passages


def plain_passages(docs, size):
    """docs: (key, text), equal keys are one document; intervals by row."""
    where = defaultdict(set)
    split = [WORD.findall(t or "") for _, t in docs]
    for (key, _), w in zip(docs, split):
        for i in range(len(w) - size + 1):
            where[tuple(w[i : i + size])].add(key)
    out = []
    for w in split:
        hit = np.zeros(len(w) + 2, bool)
        for i in range(len(w) - size + 1):
            if len(where[tuple(w[i : i + size])]) > 1:
                hit[i + 1 : i + 1 + size] = True
        edges = np.flatnonzero(hit[1:] != hit[:-1])
        out.append([(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])])
    return out


def test_passages(spark):
    rng = np.random.default_rng(9)
    shared = [prose(rng, 30, 50).split() for _ in range(6)]
    texts = []
    for _ in range(120):
        w = []
        for _ in range(int(rng.integers(1, 5))):
            own = list(shared[int(rng.integers(0, len(shared)))])
            if rng.random() < 0.5:
                own = own[int(rng.integers(0, 10)) : len(own) - int(rng.integers(0, 10))]
            if rng.random() < 0.3:
                own[int(rng.integers(0, len(own)))] = "edit"
            w += own + prose(rng, int(rng.integers(0, 6)), 50).split()
        texts.append(" ".join(w))
    texts += ["a a a " * 40, "a a a " * 30, "once more " * 25]
    got = defaultdict(list)
    for i, start, n in rows_of(suffixes.repeated_passages(frame_of(spark, texts), min_words=20)):
        got[i].append((start, n))
    want = plain_passages(list(enumerate(texts)), 20)
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, x in enumerate(want) if x}


def test_passages_odd(spark, odd_docs, no_docs):
    docs = texts_of(odd_docs)
    want = Counter((i, *x) for (i, _), own in zip(docs, plain_passages([((i, t), t) for i, t in docs], 50)) for x in own)
    assert Counter(rows_of(suffixes.repeated_passages(odd_docs))) == want and want
    assert suffixes.repeated_passages(no_docs).count() == 0


def test_passages_of_decided_areas_are_not_joined(spark, monkeypatch):
    """Only passages that an open area asks for are looked up; what is seen of areas is shuffled to them once."""
    rng = np.random.default_rng(12)
    core = prose(rng, 60, 10_000).split()
    texts = [" ".join(core[: int(rng.integers(20, 60))] + prose(rng, 30, 10_000).split()) for _ in range(60)]
    saved, labels = {}, []
    cut = suffixes.cut_lineage

    def keeping(frame, label):
        saved[label] = cut(frame, label)
        labels.append(label)
        return saved[label]

    monkeypatch.setattr(suffixes, "cut_lineage", keeping)
    got = defaultdict(list)
    for i, start, n in rows_of(suffixes.repeated_passages(frame_of(spark, texts), min_words=20)):
        got[i].append((start, n))
    want = plain_passages(list(enumerate(texts)), 20)
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, x in enumerate(want) if x} and got
    assert labels.count("best") == 1
    asked = saved["passages"].where("open").select("seed", "start", "passage")
    assert saved["twice"].exceptAll(asked.distinct()).count() == 0
    assert saved["passages"].where("not open").count() and asked.count()


def test_every_passage_retains_a_suffix():
    rng = np.random.default_rng(10)
    hashes = rng.integers(1, 2**64, 900, dtype=np.uint64)
    hashes[200:400] = hashes[200]
    counts = np.array([0, 300, 49, 50, 1, 500])
    places, _, left, right = suffixes.retained(hashes, counts)
    ends = np.cumsum(counts)
    for low, high in zip(ends - counts, ends):
        for a in range(low, high - 49):
            assert ((places >= a) & (places + suffixes.SEED <= a + 50)).any()
    assert ((left <= 42) & (right <= 50)).all()


# ----------------------------------------------------------------------------------- language id


def test_language_id(spark, odd_docs, no_docs):
    rng = np.random.default_rng(12)
    say = {"x": "aeiou lmn", "y": "äöü krst", "z": "чшщ абв"}
    speak = lambda lang: " ".join("".join(rng.choice(list(say[lang].replace(" ", "")), 5)) for _ in range(60))
    labelled = spark.createDataFrame([(k, speak(lang), lang) for k in range(60) for lang in say], "doc_id long, text string, lang string")
    model = langid.learn(labelled)
    held_out = spark.createDataFrame([(speak(lang), lang) for _ in range(20) for lang in say], "text string, lang string")
    got = langid.identify(held_out, model, [F.col("lang")]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.95
    odd = langid.identify(odd_docs, model, [F.col("doc_id"), F.col("text")]).collect()
    assert len(odd) == odd_docs.count()
    for r in odd:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert langid.identify(no_docs, model, [F.col("doc_id")]).count() == 0
    none = langid.learn(no_docs)
    assert {r["lang_pred"] for r in langid.identify(odd_docs, none, [F.col("doc_id")]).collect()} == {"und"}


def test_language_id_samples_distinct_texts(spark, monkeypatch):
    """Copies of one text neither keep a language out of the sample nor fill it."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 12)
    rows = [("x", "one text")] * 2000 + [("x", f"text {k} of the first") for k in range(10)] + [("y", f"text {k} of the second " * 30) for k in range(300)]
    labelled = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    found = defaultdict(list)
    for r in langid._sample(labelled).collect():
        found[r["lang"]].append([bytes(w) for w in r["windows"]])
    assert sorted(w[0].decode() for w in found["x"]) == sorted({t for lang, t in rows if lang == "x"})
    texts = {t.encode() for lang, t in rows if lang == "y"}
    assert len(found["y"]) == 12 and len({tuple(w) for w in found["y"]}) == 12
    assert all(1 < len(w) <= langid.SAMPLE_WINDOWS and any(all(x in t for x in w) for t in texts) for w in found["y"])
    assert langid.learn(labelled)[1] == ["x", "y"]


def test_language_id_gradients():
    rng = np.random.default_rng(0)
    weights = langid.initial(3, rng)
    symbols = rng.integers(0, 256, (langid.WINDOW, 4)).astype(np.uint8)
    keep = (np.arange(langid.WINDOW)[:, None] < np.array([128, 50, 3, 128])).astype(np.float32)
    labels = np.array([0, 1, 2, 1])
    _, grads = langid.gradients(weights, symbols, keep, labels)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        loss = []
        for step in (0.01, -0.01):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += step
            loss.append(langid.gradients(moved, symbols, keep, labels)[0])
        assert abs((loss[0] - loss[1]) / 0.02 - grad[at]) < 0.02 * abs(grad[at]) + 1e-4


def test_window_ends_do_not_matter():
    """A short window gives the same chances alone and beside longer ones."""
    rng = np.random.default_rng(1)
    weights = langid.initial(3, rng)
    texts = [b"short", b"x" * 300, b"", bytes(rng.integers(1, 255, 128, dtype=np.uint8))]
    starts = np.cumsum([0, *map(len, texts)])
    together = langid.chances_of(weights, np.frombuffer(b"".join(texts), np.uint8), starts)
    for k, text in enumerate(texts):
        if text:
            alone = langid.chances_of(weights, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            assert np.allclose(alone[0], together[k], atol=1e-5) and abs(alone[0].sum() - 1) < 1e-4


# ------------------------------------------------------------------------------------ LM scoring


def test_lm_scoring(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm, "HELD_COUNTS", 20)  # most words are joined
    monkeypatch.setattr(lm, "VOCABULARY", 10)
    docs = texts_of(odd_docs)
    model = lm.learn(odd_docs, train_share=1.0)
    got = lm.score_texts(odd_docs, model, [F.col("doc_id"), F.col("text")]).collect()
    counts = Counter(w for _, t in docs for w in WORD.findall(lower(t)))
    total, types = sum(counts.values()) + len(docs), len(counts) + 1
    assert len(got) == len(docs)
    for r in got:
        w = WORD.findall(lower(r["text"]))
        base = sum(math.log10((counts[x] + 1) / (total + types + 1)) for x in w) + math.log10((len(docs) + 1) / (total + types + 1))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, len(w) + 1, total)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0
    assert lm.score_texts(no_docs, model, [F.col("doc_id")]).count() == 0
    empty = lm.score_texts(odd_docs, lm.learn(no_docs), [F.col("doc_id")]).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in empty)


def test_lm_chances_add_up():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 1, 2, 5, 9])
    weights = {"class_out": rng.normal(size=(4, lm.SIZE)), "class_bias": rng.normal(size=4), "out": rng.normal(size=(9, lm.SIZE)), "bias": rng.normal(size=9)}
    state = rng.normal(size=(lm.SIZE, 1))
    logs = [lm.log_chances(weights, bounds, state, np.array([k]))[0][0] for k in range(9)]
    assert abs(np.exp(logs).sum() - 1) < 1e-9


def test_lm_learns_and_carries_state():
    """A language of fixed order: the network beats the shares; scores do not depend on windows or lanes."""
    rng = np.random.default_rng(4)
    share = np.log(np.full(8, 1 / 8)).astype(np.float32)
    vocab = lm.Vocabulary(*(np.zeros(0),) * 4, 1, 1, 1, np.array([0, 1, 2, 5, 8]), share)
    documents = [np.array([*((start + np.arange(n)) % 6 + 2), lm.END], np.int32) for start, n in zip(rng.integers(0, 6, 200), rng.integers(1, 60, 200))]
    weights = lm.initial(vocab)
    adam = lm.Adam(weights, 0.03)
    for _ in range(12):
        lm.train(weights, vocab.bounds, documents, adam, lanes=8)
    found = lm.score(weights, vocab.bounds, documents)
    assert found.sum() / sum(map(len, documents)) > -0.8  # the shares alone: -2.08
    assert np.allclose(found, lm.score(weights, vocab.bounds, documents, lanes=3, steps=7), rtol=1e-4, atol=1e-3)
    assert np.allclose(found[:3], [lm.score(weights, vocab.bounds, [d])[0] for d in documents[:3]], rtol=1e-4, atol=1e-3)


def test_lm_gradients():
    rng = np.random.default_rng(5)
    bounds = np.array([0, 1, 2, 5, 9])
    weights = {"class_out": rng.normal(size=(4, lm.SIZE)), "class_bias": rng.normal(size=4), "out": rng.normal(size=(9, lm.SIZE)), "bias": rng.normal(size=9)}
    states, targets = rng.normal(size=(lm.SIZE, 30)), rng.integers(0, 9, 30)
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    _, at_states = lm.log_chances(weights, bounds, states, targets, grads)
    loss = lambda w, s: -lm.log_chances(w, bounds, s, targets)[0].mean()
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        moved = {k: v.copy() for k, v in weights.items()}
        moved[name][at] += 1e-5
        assert abs((loss(moved, states) - loss(weights, states)) / 1e-5 - grad[at]) < 1e-4
    moved = states.copy()
    moved[3, 7] += 1e-5
    assert abs((loss(weights, moved) - loss(weights, states)) / 1e-5 - at_states[3, 7]) < 1e-4




def test_lm_trains_on_every_document(spark, monkeypatch):
    """Tasks take gradient steps on all tokens, whatever the texts' hashes, also on copies of one text."""
    rng = np.random.default_rng(31)
    texts = [prose(rng, int(rng.integers(1, 40)), 50) for _ in range(60)] + ["one text many times"] * 40
    seen, averaged = [], lm._averaged
    monkeypatch.setattr(lm, "_averaged", lambda trained, parts: seen.append(trained.agg(F.sum("tokens")).first()[0]) or averaged(trained, parts))
    lm.learn(frame_of(spark, texts))
    assert seen == [sum(len(t.split()) + 1 for t in texts)]


def test_lm_training_carries_state_through_long_documents(monkeypatch):
    """The state is emptied once a document, and no word inside one follows an end."""
    share = np.log(np.full(8, 1 / 8)).astype(np.float32)
    vocab = lm.Vocabulary(*(np.zeros(0),) * 4, 1, 1, 1, np.array([0, 1, 2, 5, 8]), share)
    documents = [np.array([*(np.arange(n) % 6 + 2), lm.END], np.int32) for n in (5000, 3000, 1500, 200, 40)]
    emptied, starts, forward = [], [], lm.forward

    def watched(table, own, symbols, state, keep=None, trace=False):
        emptied.append((keep == 0).sum())
        starts.append((symbols == lm.END)[keep == 1].sum())
        return forward(table, own, symbols, state, keep, trace)

    monkeypatch.setattr(lm, "forward", watched)
    weights = lm.initial(vocab)
    tokens = lm.train(weights, vocab.bounds, documents, lm.Adam(weights, 0.01))
    assert tokens == sum(map(len, documents)) and sum(emptied) == len(documents)


def test_an_item_without_id_is_hit_but_not_named(spark):
    docs = spark.createDataFrame([(1, "x a b c y"), (2, "d e f"), (3, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b c"), ("i", "d e"), (None, None), (None, "d e")], "item_id string, text string")
    for block in (1 << 20, 3):
        got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in deco.decontaminate(docs, items, block_bytes=block).collect()}
        assert got == {1: (2, 0, [], True), 2: (2, 1, ["i"], True), 3: (0, 0, [], False)}


def test_equal_texts_are_not_parted_by_splitters(spark):
    texts = [f"text number {k} " * 5 for k in range(2000) for _ in range(5)]
    rows = sharding.shard(frame_of(spark, texts), 8, range_rows=25).collect()
    shards, sizes = defaultdict(set), Counter()
    for r in rows:
        shards[r["text_crc32"]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert len(rows) == 10_000 and all(len(s) == 1 for s in shards.values())
    assert max(sizes.values()) < 1.02 * min(sizes.values())
    # a group of a third of all rows is cut, since whole it would fill shards
    texts = ["the same text"] * 1000 + [f"other text {k}" for k in range(2000)]
    sizes = Counter()
    for r in sharding.shard(frame_of(spark, texts), 8, range_rows=50).collect():
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) < 1.06 * min(sizes.values())


def test_short_lines_go_if_equal(spark):
    texts = ["Home | About | Contact\nsome words of the first page", "Home  | About | Contact \n日本語の文章です。\nHome | About | Imprint", "日本語の文章です。\n\n \nwords", "words\nword"]
    got = {r["doc_id"]: r["dropped"] for r in linededup.line_dedup(frame_of(spark, texts), [F.col("doc_id")]).collect()}
    assert got == {0: [], 1: [0], 2: [0], 3: [0]}
