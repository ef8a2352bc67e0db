"""Repair of the structure of conversations by cheapest edits, with Four-Russians block tables.

A conversation's rows are taken by turn (nulls first; rows of one turn by role, then by the digest
of their text). A row's first fault counts: blank (no character but ASCII white space), duplicate (role and text
seen earlier), truncated (its last such character is none of ``.!?``). Edits make the initials of
the roles match ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 3, Delete 4 (required for
blank and duplicate rows), Insert of an empty user or assistant 3; a truncated row that stays adds
3. Of the cheapest edits those win whose initials (D, I, K, R) are least as ASCII text.

*Method.* What the rest of a conversation costs is a vector over the four states of that pattern.
Less its minimum it is one of few; ``tables`` lists them and, for every block of ``BLOCK`` row symbols, the
vector before the block and the cost added, for every vector behind it. So costs run backward
through a conversation block by block, by lookup. The way is traced forward: each block is
expanded backward into the vectors of its rows, and at every step the least initial on a cheapest
way is taken, which makes ties safe.

*Large conversations.* Equal rows are folded to one with a count. Rows are then sorted over all
tasks and cut into chunks of ``CHUNK``, so one conversation may fill many tasks. A conversation of
several chunks needs three more steps: chunks become cost matrices, the vectors behind them and the
states before them come from one small row per chunk, and all chunks are traced apart. Texts take
no part; they are joined to the kept rows at the end. Only the digest of the repaired text must
read one conversation in order: one task streams it, holding a batch at a time.

Null role and null text count as one space; a null id is a conversation like any other. Empty
tables give empty results. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
#: Rows of a block; a block's symbols are the digits of its number.
BLOCK = 4
#: Rows of a conversation that one task traces at once.
CHUNK = 4096
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State that an inserted or reroled row leads to, and the role it gets.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: State that a kept row leads to, by its initial.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "-": {}}
INITIALS = "sua-"
#: Symbols: 0 a row that must go, 1-4 a whole row by initial, 5-8 a truncated one, 9 no row.
GONE, NOTHING, SYMBOLS = 0, 9, 10
#: Stands for "cannot be": more than any cost within a vector.
NEVER = 1 << 20
#: The same in the cost matrix of a chunk, whose costs grow with its rows.
IMPOSSIBLE = 1 << 60
#: Cost of ending in each state: rows are inserted until an assistant was last.
AT_END = (0, 6, 3, 0)

Vector = tuple[int, int, int, int]


def _before(after: Vector, symbol: int) -> Vector:
    """Costs before a row, from those behind it."""
    if symbol == NOTHING:
        return after
    own = [DELETE + after[s] for s in range(4)]
    if symbol != GONE:
        extra = CUT_SHORT if symbol > 4 else 0
        kept = KEEP[INITIALS[(symbol - 1) % 4]]
        for s in range(4):
            own[s] = min(own[s], REROLE + extra + after[NEXT[s]])
            if s in kept:
                own[s] = min(own[s], extra + after[kept[s]])
    user, assistant = min(own[USER], INSERT + own[ASSISTANT]), min(own[ASSISTANT], INSERT + own[USER])
    return min(own[START], INSERT + user), min(own[SYSTEM], INSERT + user), user, assistant


def _normal(vector) -> tuple[Vector, int]:
    least = min(vector)
    return tuple(x - least if x < NEVER // 2 else NEVER for x in vector), least


def _units() -> list[Vector]:
    """Costs of reaching one given state, where no row is left: inserted rows count to the chunk behind."""
    return [tuple(0 if s == to else NEVER for s in range(4)) for to in range(4)]


@lru_cache(maxsize=1)
def tables() -> tuple[list[Vector], dict[Vector, int], list[list[int]], list[list[int]]]:
    """All normalised vectors, their numbers, and for vector and block: the vector before it, the cost added."""
    vectors = [_normal(AT_END)[0], *_units()]
    number = {v: i for i, v in enumerate(vectors)}
    steps, adds = [], []
    at = 0
    while at < len(vectors):
        steps.append([])
        adds.append([])
        for symbol in range(SYMBOLS):
            vector, least = _normal(_before(vectors[at], symbol))
            if vector not in number:
                number[vector] = len(vectors)
                vectors.append(vector)
            steps[-1].append(number[vector])
            adds[-1].append(least)
        at += 1
    step, add = np.array(steps), np.array(adds)
    code = np.arange(SYMBOLS**BLOCK)
    state = np.repeat(np.arange(len(vectors))[:, None], len(code), axis=1)
    cost = np.zeros_like(state)
    for k in range(BLOCK):  # the last row is the lowest digit, and comes first
        symbol = code // SYMBOLS**k % SYMBOLS
        cost += add[state, symbol]
        state = step[state, symbol]
    return vectors, number, state.tolist(), cost.tolist()


def _blocks(symbols: list[int]) -> list[int]:
    """Numbers of the blocks; the last one is filled up."""
    padded = symbols + [NOTHING] * (-len(symbols) % BLOCK)
    codes = []
    for at in range(0, len(padded), BLOCK):
        code = 0
        for symbol in padded[at : at + BLOCK]:
            code = code * SYMBOLS + symbol
        codes.append(code)
    return codes


def _backward(codes: list[int], vector: int) -> tuple[list[int], int]:
    """The vector behind every block, that before the first one, and the cost added."""
    _, _, state, cost = tables()
    behind, total = [0] * len(codes), 0
    for k in range(len(codes) - 1, -1, -1):
        behind[k] = vector
        total += cost[vector][codes[k]]
        vector = state[vector][codes[k]]
    return [*behind, vector], total


@lru_cache(maxsize=1 << 16)
def _trace_block(code: int, vector: int, state: int) -> tuple[tuple[str, ...], int]:
    """Edits of each row of a block, inserts before it first, and the state behind it."""
    symbols = [code // SYMBOLS**k % SYMBOLS for k in range(BLOCK - 1, -1, -1)]
    costs = [tables()[0][vector]]
    for symbol in reversed(symbols):
        costs.append(_before(costs[-1], symbol))
    costs.reverse()
    edits = []
    for symbol, here, after in zip(symbols, costs, costs[1:], strict=False):
        if symbol == NOTHING:
            break
        own = ""
        extra = CUT_SHORT if symbol > 4 else 0
        kept = KEEP[INITIALS[(symbol - 1) % 4]] if symbol != GONE else {}
        while True:
            if DELETE + after[state] == here[state]:
                own += "D"
            elif INSERT + here[NEXT[state]] == here[state]:
                own += "I"
                state = NEXT[state]
                continue
            elif state in kept and extra + after[kept[state]] == here[state]:
                own += "K"
                state = kept[state]
            else:
                own += "R"
                state = NEXT[state]
            break
        edits.append(own)
    return tuple(edits), state


def trace(symbols: list[int], end: Vector, state: int = START, last: bool = True) -> tuple[list[str], int]:
    """Edits of every row, inserts before it first, and the state behind the last.

    ``end`` is the vector behind the rows. Inserts behind all rows (``last``) are one more entry.
    """
    codes = _blocks(symbols)
    behind, _ = _backward(codes, tables()[1][_normal(end)[0]])
    edits: list[str] = []
    for code, vector in zip(codes, behind, strict=False):
        own, state = _trace_block(code, vector, state)
        edits += own
    if last:
        edits.append({USER: "I", SYSTEM: "II"}.get(state, ""))
    return edits, state


def matrix(symbols: list[int]) -> list[list[int]]:
    """Cost of getting from each state to each state by these rows."""
    vectors, number, _, _ = tables()
    codes = _blocks(symbols)
    columns = []
    for unit in _units():
        behind, total = _backward(codes, number[unit])
        columns.append([total + x if x < NEVER else IMPOSSIBLE for x in vectors[behind[-1]]])
    return [list(row) for row in zip(*columns, strict=True)]


def vectors_behind(matrices: list[list[list[int]]]) -> tuple[list[Vector], int]:
    """The vector behind each chunk of a conversation, and what all of it costs."""
    out, vector, total = [], AT_END, 0
    for m in reversed(matrices):
        out.append(vector)
        whole = [min(m[s][t] + vector[t] for t in range(4)) for s in range(4)]
        user, assistant = min(whole[USER], INSERT + whole[ASSISTANT]), min(whole[ASSISTANT], INSERT + whole[USER])
        vector, least = _normal((min(whole[START], INSERT + user), min(whole[SYSTEM], INSERT + user), user, assistant))
        total += least
    return out[::-1], total + vector[START]


# --------------------------------------------------------------------------------------- Spark


def _mapped(df: DataFrame, schema: T.StructType, work: Callable[..., tuple], keep: int) -> DataFrame:
    """``df``'s first ``keep`` columns as they are, and what ``work`` makes of the others of every row."""
    types = [f.dataType for f in schema.fields[keep:]]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(t) for t in types]

    def batch_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [work(*row) for row in zip(*[c.to_pylist() for c in batch.columns[keep:]], strict=True)]
            columns = list(zip(*made, strict=True)) if made else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *[pa.array(c, t) for c, t in zip(columns, arrow, strict=True)]], names=schema.names)

    return df.mapInArrow(batch_of, schema)


def _schema(df: DataFrame, keep: int, more: str) -> T.StructType:
    return T.StructType([*df.schema.fields[:keep], *T.StructType.fromDDL(more).fields])


def _encoded(*parts: Column) -> Column:
    """Text that differs wherever the parts differ, nulls included."""
    return F.concat(*[F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts])


def _facts(rows: DataFrame) -> DataFrame:
    """Digests and faults of every row; its text stays behind."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return rows.select(
        "conv",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.sha2(_encoded(role, text).cast("binary"), 256).alias("said"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("open"),
    ).withColumn("id", F.sha2(F.concat(_encoded(F.col("conv"), F.col("turn")), F.lit("|"), "said").cast("binary"), 256))


def _placed(facts: DataFrame) -> DataFrame:
    """Rows without text, equal ones as one, in their order over all tasks: ``place``, ``symbol``, ``n``, ``id``."""
    folded = facts.groupBy("conv", "turn", "role", "said", "id").agg(F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"), F.max("open").alias("open"))
    folded = cut_lineage(folded, "turns")
    again = folded.groupBy("conv", "said").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    again = again.select(F.col("conv").alias("other"), F.col("said").alias("other_said"), "first")
    told = folded.join(again, F.col("conv").eqNullSafe(F.col("other")) & (F.col("said") == F.col("other_said")), "left")
    repeated = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    fault = F.when(F.col("blank"), "blank").when(repeated, "duplicate").when(F.col("open"), "truncated")
    symbol = F.when(F.coalesce(fault.isin("blank", "duplicate"), F.lit(False)), GONE).when(fault == "truncated", kind + 4).otherwise(kind)
    rows = told.select("conv", "turn", "role", "said", "id", "n", fault.alias("fault"), kind.alias("kind"), symbol.alias("symbol"))
    order = ["conv", "turn", "role", "said"]
    return cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "placed")


def _chunks(placed: DataFrame, size: int) -> DataFrame:
    """``conv``, ``chunk`` (parts of the place, in order), ``members`` and their ``symbols``; what its adjacent rows hold."""
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    chunk = F.struct(part.alias("part"), F.floor(row / size).alias("piece"))
    members = F.sort_array(F.collect_list(F.struct("place", "symbol", "n", "id", "kind")))
    return placed.groupBy("conv", chunk.alias("chunk")).agg(members.alias("members"))


#: Kinds of adjacent rows that are legal: system and user, user and assistant, assistant and user.
_LEGAL = [12, 23, 32]


def _illegal(pairs: Column) -> Column:
    """Neighbours in an array of kinds that may not be neighbours."""
    size = F.size(pairs)
    both = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.get(pairs, i - 1) * 10 + F.get(pairs, i))
    return F.when(size > 1, F.size(F.filter(both, lambda x: ~x.isin(_LEGAL)))).otherwise(0)


def edits(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """What ``repaired`` and ``report`` need: the rows' chunks with their edits, and counts of faults.

    The first frame has ``conv``, ``chunk``, ``members``, ``edits`` (of each member, inserts before it
    first; the last chunk of a conversation has one more entry: inserts behind all rows), ``roles``
    (role given to each inserted or reroled row, in order) and ``cost``.
    """
    facts = _facts(rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")))
    placed = _placed(facts.drop("text"))
    n = F.col("n")
    counted = placed.groupBy("conv").agg(
        F.max("turn").alias("high"),
        F.min("turn").alias("low"),
        F.countDistinct("turn").alias("turns"),
        # copies of a row that is not blank are duplicates of it
        F.sum(F.when(F.col("fault") == "blank", n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", n).otherwise(n - 1)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
        F.sum(n - 1).alias("copies"),
    )
    chunks = cut_lineage(_chunks(placed, chunk), "chunks")
    borders = chunks.select("conv", "chunk", _illegal(F.col("members.kind")).alias("illegal"), F.get("members.kind", 0).alias("first"), F.element_at("members.kind", -1).alias("last"))
    borders = borders.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sort_array(F.collect_list(F.struct("chunk", "first", "last"))).alias("parts"))
    across = _illegal(F.flatten(F.transform("parts", lambda p: F.array(p["first"], p["last"]))))
    # of the pairs of that array, those within a chunk were not asked for
    within = F.size(F.filter("parts", lambda p: ~(p["first"] * 10 + p["last"]).isin(_LEGAL)))
    counted = counted.join(borders.select(F.col("conv").alias("other"), (F.col("illegal") + across - within).alias("illegal"), F.size("parts").alias("chunks")), F.col("conv").eqNullSafe(F.col("other"))).drop("other")
    counted = cut_lineage(counted.withColumn("illegal", F.col("illegal") + F.col("copies")), "counted")

    many = counted.where("chunks > 1").select(F.col("conv").alias("other"))
    alike = F.col("conv").eqNullSafe(F.col("other"))
    single = chunks.join(many, alike, "left_anti").select("conv", "chunk", "members", F.lit(None).cast("array<int>").alias("end"), F.lit(START).alias("state"), F.lit(True).alias("last"))
    ready = single
    if many.limit(1).count():
        parts = cut_lineage(chunks.join(many, alike, "left_semi"), "parts")
        ready = single.unionByName(_joined_chunks(parts))
    schema = _schema(ready, 3, "edits array<string>, roles array<string>, cost long")

    def work(members, end, state, last):
        symbols = [m["symbol"] for m in members]
        own, _ = trace(symbols, tuple(end or AT_END), state, last)
        roles, cost = [], 0
        for k, edit in enumerate(own):
            for letter in edit:
                if letter == "K":
                    state = KEEP[INITIALS[(symbols[k] - 1) % 4]][state]
                elif letter != "D":
                    state = NEXT[state]
                    roles.append(ROLE[state])
                cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter]
            if k < len(symbols) and symbols[k] > 4 and not edit.endswith("D"):
                cost += CUT_SHORT
        return own, roles, cost + DELETE * sum(m["n"] - 1 for m in members)

    found = _mapped(ready.select("conv", "chunk", "members", F.col("members").alias("seen"), "end", "state", "last"), schema, work, 3)
    return cut_lineage(found, "edits"), counted


def _joined_chunks(parts: DataFrame) -> DataFrame:
    """Of conversations that have several chunks: the vector behind each chunk and the state before it."""
    costs = _mapped(parts.select("conv", "chunk", "members"), _schema(parts, 2, "costs array<array<long>>"), lambda members: (matrix([m["symbol"] for m in members]),), 2)
    listed = costs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "costs"))).alias("parts")).select("conv", "parts.chunk", "parts.costs")
    behind = _mapped(listed, _schema(listed, 2, "ends array<array<int>>"), lambda costs: (vectors_behind(costs)[0],), 2)

    def each(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("conv").alias("other"), F.explode(F.arrays_zip("chunk", name)).alias("x")).select("other", F.col("x.chunk").alias("at"), f"x.{name}")

    same = F.col("conv").eqNullSafe(F.col("other")) & (F.col("chunk") == F.col("at"))
    ended = cut_lineage(parts.join(each(behind, "ends"), same).select("conv", "chunk", "members", F.col("ends").alias("end")), "ended")

    def ways(members, end):
        return ([trace([m["symbol"] for m in members], tuple(end), s, False)[1] for s in range(4)],)

    led = _mapped(ended, _schema(ended, 2, "leads array<int>"), ways, 2)
    led = led.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "leads"))).alias("parts")).select("conv", "parts.chunk", "parts.leads")

    def states(leads):
        found = [START]
        for lead in leads:
            found.append(lead[found[-1]])
        return (found[:-1],)

    begun = _mapped(led, _schema(led, 2, "states array<int>"), states, 2)
    begun = begun.select("conv", "chunk", "states", F.element_at("chunk", -1).alias("final"))
    begun = begun.select(F.col("conv").alias("other"), "final", F.explode(F.arrays_zip("chunk", "states")).alias("x")).select("other", "final", F.col("x.chunk").alias("at"), F.col("x.states").alias("state"))
    return ended.join(begun, same).select("conv", "chunk", "members", "end", "state", (F.col("chunk") == F.col("final")).alias("last"))


def _lines(found: DataFrame) -> DataFrame:
    """Rows that are there after the repair: ``conv``, ``place``, ``step``, ``role`` (null: its own), ``id`` (null: inserted)."""
    # edits of all members side by side: letters, the member each belongs to, and how many roles were given before
    letters = F.flatten(F.transform("edits", lambda e, k: F.transform(F.filter(F.split(e, ""), lambda x: x != ""), lambda x: F.struct(x.alias("letter"), k.alias("member")))))
    steps = found.select("conv", "members", "roles", letters.alias("letters"))
    given = F.transform("letters", lambda x: x["letter"].isin("I", "R").cast("int"))
    nth = F.aggregate(given, F.array(F.lit(0)), lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x)))
    steps = steps.select("conv", "members", "roles", F.posexplode(F.arrays_zip("letters", nth.alias("nth"))).alias("step", "x"))
    steps = steps.where("x.letters.letter <> 'D'")
    member = F.get("members", F.least(F.col("x.letters.member"), F.size("members") - 1))
    letter = F.col("x.letters.letter")
    return steps.select("conv", member["place"].alias("place"), "step", F.when(letter != "K", F.get("roles", F.col("x.nth"))).alias("role"), F.when(letter != "I", member["id"]).alias("id"))


def repaired(rows: DataFrame, found: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations as rows ``conv_id``, ``place``, ``step`` (their order), ``role``, ``text``."""
    lines = _lines(found)
    facts = _facts(rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")))
    texts = facts.select("id", F.col("role").alias("own"), "text").dropDuplicates(["id"])
    said = lines.where("id is not null").join(texts, "id").select("conv", "place", "step", F.coalesce("role", "own").alias("role"), "text")
    added = lines.where("id is null").select("conv", "place", "step", "role", F.lit("").alias("text"))
    return said.unionByName(added).withColumnRenamed("conv", conv_col)


def digests(lines: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """SHA-256 of every conversation's ``role:text`` lines, joined by newlines; its rows stream through one task."""
    ordered = lines.select(F.col(conv_col).alias("conv"), "place", "step", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "place", "step").select("conv", "line")
    schema = _schema(ordered, 1, "sha256 string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            done: list[tuple] = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if state is None or conv != held:
                    if state is not None:
                        done.append((held, state.hexdigest()))
                    held, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], names=schema.names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], kind), pa.array([state.hexdigest()], pa.string())], names=schema.names)

    return ordered.mapInArrow(work, schema).withColumnRenamed("conv", conv_col)


def report(rows: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost and edits of its repair, digest of the result.

    ``every`` lists conversations (column ``conv_id``) that are reported also if ``rows`` has none of theirs.
    """
    names = dict(conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    found, counted = edits(rows, chunk=chunk, **names)
    letters = F.zip_with("edits", F.col("members.n"), lambda e, n: F.concat(e, F.repeat(F.lit("D"), F.coalesce(n - 1, F.lit(0)).cast("int"))))
    pieces = found.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("chunk", F.array_join(letters, "").alias("audit")))).alias("parts"))
    audits = pieces.select("conv", "cost", F.array_join("parts.audit", "").alias("audit"))
    faults = counted.select("conv", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal")
    parts = [faults, audits, digests(repaired(rows, found, **names), conv_col).select(F.col(conv_col).alias("conv"), "sha256")]
    if every is not None:
        parts.append(every.select(F.col(conv_col).alias("conv")).distinct())
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = whole.groupBy("conv").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
    return whole.withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after a known damage, chosen by the CRC-32 of ``conv_id:turn`` (nulls: one space) modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user.
    """
    whole = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(whole[0], F.lit(":"), whole[1]).cast("binary")) % 20
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    chosen = rows.select("conv_id", "turn", whole[2].alias("role"), whole[3].alias("text"), kind.alias("kind")).where("kind <> 0")
    hit = chosen.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return hit.drop("copy")
