"""Repair of conversations against a plain search over strings, and odd inputs."""

import hashlib
import random
import zlib

import pytest

from flowops.llm import conversations as C
from flowops.llm.conversations import damaged, digests, edits, repaired, report

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Cost, edits and repaired lines; ``rows`` are (role, text, must go, truncated)."""
    step = {"n": "u", "s": "u", "u": "a", "a": "u"}
    role = {"u": "user", "a": "assistant"}
    best = {"n": (0, "", ())}

    def put(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def insert(ways):
        for _ in range(3):
            for state, (cost, letters, out) in list(ways.items()):
                put(ways, step[state], (cost + 3, letters + "I", (*out, role[step[state]] + ":")))
        return ways

    for own, text, gone, late in rows:
        ways = {}
        for state, (cost, letters, out) in insert(best).items():
            put(ways, state, (cost + 4, letters + "D", out))
            if not gone:
                to = step[state]
                put(ways, to, (cost + 3 + 3 * late, letters + "R", (*out, f"{role[to]}:{text}")))
                if own[:1] == to or (own[:1] == "s" and state == "n"):
                    put(ways, own[:1], (cost + 3 * late, letters + "K", (*out, f"{own}:{text}")))
        best = ways
    cost, letters, out = min(x for k, x in insert(best).items() if k in "na")
    return cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain(rows):
    """The report of one conversation, of rows (turn, role, text)."""
    said = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{len(text)}:{text}".encode()).hexdigest()
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], said(r[1], r[2])))
    seen, judged, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, *cheapest(judged))


def reported(frame):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in frame.collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


def conversation(rnd, n):
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Hi.", "Oh!", "Why?", "cut", "", " \n", None, "Da. ", "No… end"]
    return [(rnd.choice([None, *range(n + 1)]), rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.4 else f"text {rnd.random()}" + rnd.choice([".", "", "!\n"])) for _ in range(n)]


def test_block_tables_agree_with_a_search():
    rnd = random.Random(3)
    for _ in range(1500):
        symbols = [rnd.choice(rnd.choice([range(9), [1, 2, 3], [2, 3, 0]])) for _ in range(rnd.choice([0, 3, 9, 50]))]
        rows = [("sua-"[(y - 1) % 4], "x", y == 0, y > 4) for y in symbols]
        cost, letters, _ = cheapest(rows)
        assert "".join(C.trace(symbols, C.AT_END)[0]) == letters
        size = rnd.choice([1, 3, 20])
        parts = [symbols[k : k + size] for k in range(0, len(symbols), size)]
        ends, total = C.vectors_behind([C.matrix(p) for p in parts])
        assert total == cost
        state, found = C.START, ""
        for k, part in enumerate(parts):
            own, state = C.trace(part, ends[k], state, k == len(parts) - 1)
            found += "".join(own)
        assert found == letters or not symbols


@pytest.mark.parametrize("chunk", [2, 5, 4096])
def test_report_in_one_chunk_or_many(spark, chunk):
    rnd = random.Random(chunk)
    talks = {k: conversation(rnd, rnd.choice([1, 2, 5, 9, 14, 30])) for k in [None, *range(40)]}
    rows = [(k, *r) for k, talk in talks.items() for r in talk]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "'x' AS conv", "1 AS place", "2 AS members", "'y' AS id")
    assert reported(report(frame, chunk=chunk)) == {k: plain(talk) for k, talk in talks.items()}


def test_one_large_conversation_of_equal_rows(spark):
    rows = [(7, 1, "user", "Hi.")] * 3000 + [(7, t, "assistant", "Same.") for t in range(2, 3000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert reported(report(frame, chunk=512)) == {7: plain([r[1:] for r in rows])}


def test_every_conversation_is_reported(spark):
    none = spark.createDataFrame([], SCHEMA)
    every = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reported(report(none, every)) == {1: empty, None: empty}
    assert report(none).count() == 0


def test_repaired_rows_are_legal_and_long_texts_whole(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, 0, "assistant", long), (1, 1, "user", "Hm"), (1, 1, "user", "Hm"), (2, None, "system", "Be kind.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found, _ = edits(frame)
    lines = repaired(frame, found)
    got = [(r["conv_id"], r["role"], r["text"]) for r in lines.orderBy("conv_id", "place", "step").collect()]
    # the second is cheapest as it goes: an empty user and an empty assistant cost more
    assert got == [(1, "user", ""), (1, "assistant", long)]
    assert {r["conv_id"]: r["sha256"] for r in digests(lines).collect()} == {1: hashlib.sha256(f"user:\nassistant:{long}".encode()).hexdigest()}


def test_damage(spark):
    rows = [(c, t, "assistant", f"A.b! c? {c} {t}") for c in range(30) for t in [None, *range(8)]] + [(None, 1, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        if kind == 4:
            role = "user"
        want += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, damaged(frame).collect()), key=repr) == sorted(want, key=repr)
