"""Running aggregates, state operators and sequences against sequential simulations."""

import random

import pytest
from pyspark.sql import functions as F

from flowops.operators.sequence import assign_sequence, number_fragments, sequence_after
from flowops.operators.state import HOLDING, REPLACE_WHEN, check_state, check_state_after, hold_release, hold_release_after
from flowops.plans import Running, place_among, plan_split, running, search_tree, with_part

LIMITS = [None, 7]  # 7 rows per group: nearly every group is cut


def _events(n=600, keys=6, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one key holds about a third of all rows
        key = "k0" if rnd.random() < 0.33 else (None if rnd.random() < 0.1 else f"k{rnd.randrange(keys)}")
        rows.append((i * 3, key, rnd.choice(["10", "9", "a", "b", "", None, "zz", "m"])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("backwards", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_matches_loop(spark, limit, backwards, inclusive):
    rows = _events()
    df = spark.createDataFrame(rows, "id long, k string, v string").repartition(5)
    df = df.withColumn("n", F.length("v"))
    kinds = {"max": "v", "min": "v", "first": "v", "last": "v", "sum": "n", "count": "v"}
    specs = [Running(k, k, F.col(c)) for k, c in kinds.items()]
    got = {
        r["id"]: tuple(r[k] for k in kinds)
        for r in running(df, ["k"], ["id"], specs, inclusive=inclusive, backwards=backwards, split=plan_split(df, ["k"], ["id"], limit)).collect()
    }
    want, seen = {}, {}
    for i, k, v in sorted(rows, reverse=backwards):
        past = seen.setdefault(k, [])
        if inclusive and v is not None:
            past.append(v)
        vals = list(past)
        want[i] = (
            max(vals) if vals else None,
            min(vals) if vals else None,
            vals[0] if vals else None,
            vals[-1] if vals else None,
            sum(map(len, vals)) if vals else None,
            len(vals),
        )
        if not inclusive and v is not None:
            past.append(v)
    assert got == want


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("setting", REPLACE_WHEN)
@pytest.mark.parametrize("stored", [False, True])
def test_check_state(spark, limit, setting, stored):
    rows = _events(seed=len(setting))
    df = spark.createDataFrame(rows, "id long, k string, v string")
    start = {"k0": "b", "k1": "", "other": "q"} if stored else {}
    state = spark.createDataFrame(list(start.items()), "key string, value string") if stored else None
    got = {r["id"]: (r["previous_state"], r["route"]) for r in check_state(df, "k", "v", "id", replace_when=setting, state=state, max_rows=limit).collect()}
    cache, want = dict(start), {}
    for i, k, v in sorted(rows):
        if not v:
            want[i] = (None, "empty")
            continue
        old = cache.get(k)
        if not old:
            cache[k] = v
            want[i] = (None, "initial")
            continue
        route = "less" if v < old else "equal" if v == old else "greater"
        want[i] = (old, route)
        if (setting, route) in {("Less Than", "less"), ("Greater Than", "greater"), ("Equal To", "equal")} or (setting == "Not Equal To" and route != "equal"):
            cache[k] = v
    assert got == want
    after = {r["key"]: r["value"] for r in check_state_after(df, "k", "v", "id", replace_when=setting, state=state).collect()}
    assert after == cache


def test_check_state_content_fallback(spark):
    df = spark.createDataFrame([(1, "k", "", "m"), (2, "k", None, ""), (3, "k", "9", "z")], "id int, k string, v string, content string")
    got = check_state(df, "k", "v", "id", content="content").orderBy("id").collect()
    assert [(r["previous_state"], r["route"]) for r in got] == [(None, "initial"), (None, "empty"), ("m", "less")]


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("stored", [False, True])
def test_hold_release(spark, limit, stored):
    rnd = random.Random(4)
    rows = [
        (i, "t", "hot" if rnd.random() < 0.33 else f"k{rnd.randrange(5)}", rnd.choice(["hold", "hold", "release", "other"]), rnd.choice(["x", "y", "", None]))
        for i in range(700)
    ]
    df = spark.createDataFrame(rows, "id long, topic string, k string, action string, dup string").repartition(4)
    start = {"t.k1": "x", "t.k2": HOLDING, "t.zz": "y"} if stored else {}
    held = spark.createDataFrame(list(start.items()), "key string, value string") if stored else None
    got = {r["id"]: r["route"] for r in hold_release(df, "topic", "k", "action", "id", duplicate="dup", held=held, max_rows=limit).collect()}
    locks, want = dict(start), {}
    for i, t, k, action, dup in rows:
        lock = f"{t}.{k}"
        if action == "hold":
            if dup and locks.get(lock) == dup:
                want[i] = "duplicate"
            elif lock in locks:
                want[i] = "busy"
            else:
                locks[lock] = dup or HOLDING
                want[i] = "success"
        elif action == "release":
            want[i] = "success" if locks.pop(lock, None) is not None else "missing"
        else:
            want[i] = "failure"
    assert got == want
    after = {r["key"]: r["value"] for r in hold_release_after(df, "topic", "k", "action", "id", duplicate="dup", held=held, max_rows=limit).collect()}
    assert after == locks


@pytest.mark.parametrize("limit", LIMITS)
def test_assign_sequence(spark, limit):
    rows = [(i, f"s{i % 4 if i % 3 else 0}", i % 5 - 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, seq string, step long").repartition(3)
    state = spark.createDataFrame([("s0", 100), ("s2", -5), ("unused", 7)], "seq string, value long")
    for inc in (3, -2, F.col("step")):
        got = {r["id"]: r["sequence_value"] for r in assign_sequence(df, "seq", "id", state=state, start=10, increment=inc, max_rows=limit).collect()}
        cur, want = {"s0": 100, "s2": -5, "unused": 7}, {}
        for i, s, step in rows:
            by = inc if isinstance(inc, int) else step
            cur[s] = cur[s] + by if s in cur else 10
            want[i] = cur[s]
        assert got == want
        assert {r["seq"]: r["value"] for r in sequence_after(df, "seq", "id", state=state, start=10, increment=inc).collect()} == cur


def test_global_sequence_is_not_one_partition(spark):
    df = spark.range(5000).repartition(6).withColumn("x", F.col("id") * 7 % 5003)
    out = assign_sequence(df, None, "x", start=5, increment=2)
    got = [r["sequence_value"] for r in out.orderBy("x").collect()]
    assert got == [5 + 2 * i for i in range(5000)]
    empty = assign_sequence(df.where("id < 0"), None, "x")
    assert empty.count() == 0


@pytest.mark.parametrize("limit", LIMITS)
def test_fragments(spark, limit):
    df = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(50)], "id long, p string").repartition(3)
    rows = number_fragments(df, ["p"], "id", max_rows=limit).orderBy("id").collect()
    for parent in ("a", None):
        mine = [r for r in rows if r["p"] == parent]
        assert [r["frag_index"] for r in mine] == list(range(1, len(mine) + 1))
        assert {r["frag_count"] for r in mine} == {len(mine)}
        assert len({r["frag_id"] for r in mine}) == 1
    every = number_fragments(df, [], "id").orderBy("id").collect()
    assert [(r["frag_index"], r["frag_count"]) for r in every] == [(i + 1, 50) for i in range(50)]


def test_order_column_must_be_splittable(spark):
    df = spark.createDataFrame([("a", {"x": 1})], "k string, pos map<string,int>")
    with pytest.raises(TypeError):
        plan_split(df, ["k"], ["pos"])
    with pytest.raises(ValueError):
        plan_split(df, ["k"], [])


@pytest.mark.parametrize("limit", LIMITS)
def test_text_order(spark, limit):
    df = spark.createDataFrame([(f"r{i * 37 % 211:03d}é", "a") for i in range(211)], "o string, k string").repartition(4)
    for keys in ([], ["k"]):
        got = number_fragments(df, keys, "o", max_rows=limit).orderBy("o").collect()
        assert [r["frag_index"] for r in got] == list(range(1, 212))


def test_small_groups_get_few_cuts(spark):
    big = spark.range(20000).select("id", F.lit("big").alias("k"))
    some = spark.range(1500).select("id", F.concat(F.lit("s"), (F.col("id") % 10).cast("string")).alias("k"))
    for order in ("id", "text"):
        rows = big.unionByName(some).withColumn("text", F.lpad(F.col("id").cast("string"), 8, "0"))
        split = plan_split(rows, ["k"], [order], 100)
        leaves = split.cuts.levels[0][0]
        cuts = {r["__k0"]: r["n"] for r in leaves.groupBy("__k0").agg(F.sum(F.size("__tree_values")).alias("n")).collect()}
        assert len(cuts) == 11 and 100 <= cuts["big"] <= 400
        assert all(1 <= n <= 4 for k, n in cuts.items() if k != "big")


def test_a_group_of_one_day_is_cut_by_its_second_column(spark):
    # most rows lie on one day, some on none; ids are unique
    days = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 40 == 1, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("date")
    rows = spark.range(3000).repartition(4).select(days.alias("day"), (F.col("id") * 7919 % 3001).alias("id"), F.lit("a").alias("k"))
    split = plan_split(rows, ["k"], ["day", "id"], 100)
    parts = [r["count"] for r in with_part(rows, ["day", "id"], split).groupBy("__part").count().collect()]
    assert len(parts) >= 20 and max(parts) <= 250
    for keys in ([], ["k"]):
        got = number_fragments(rows, keys, ["day", "id"], max_rows=100).collect()
        order = sorted(got, key=lambda r: (r["day"] is not None, r["day"] or 0, r["id"]))
        assert [r["frag_index"] for r in order] == list(range(1, 3001))


def test_ten_thousand_parts(spark):
    rows = spark.range(40_000).repartition(4).select((F.col("id") % 3).alias("a"), (F.col("id") * 17 % 40_009).alias("b"), F.lit("x").alias("k"))
    split = plan_split(rows, ["k"], ["a", "b"], 4)
    assert len(split.cuts.levels) == 2
    assert split.cuts.levels[0][0].agg(F.sum(F.size("__tree_values")).alias("n")).first()["n"] >= 9_900
    got = running(rows, ["k"], ["a", "b"], [Running("n", "count"), Running("top", "max", F.col("b"))], split=split)
    want = running(rows, ["k"], ["a", "b"], [Running("n", "count"), Running("top", "max", F.col("b"))])
    assert got.exceptAll(want).isEmpty() and got.count() == 40_000


@pytest.mark.parametrize("setting", REPLACE_WHEN)
def test_check_state_by_two_order_columns(spark, setting):
    rows = [(i % 2, i, "hot", v) for i, _, v in _events(400)]
    df = spark.createDataFrame(rows, "day int, id long, k string, v string").repartition(3)
    order = ["day", "id"]
    want = check_state(df, "k", "v", order, replace_when=setting, max_rows=None)
    assert check_state(df, "k", "v", order, replace_when=setting, max_rows=9).exceptAll(want).isEmpty()


def test_hold_release_by_two_order_columns(spark):
    rnd = random.Random(8)
    rows = [(i % 3, i, "t", "hot", rnd.choice(["hold", "hold", "release"]), rnd.choice(["x", "y", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "day int, id long, topic string, k string, action string, dup string").repartition(3)
    one, cut = (hold_release(df, "topic", "k", "action", ["day", "id"], duplicate="dup", max_rows=n) for n in (None, 11))
    assert cut.exceptAll(one).isEmpty() and cut.count() == 500


@pytest.mark.parametrize("inclusive", [False, True])
def test_places_in_a_search_tree(spark, inclusive):
    import bisect

    rnd = random.Random(4)
    groups = {"a": sorted(rnd.sample(range(300_000), 70_000)), "b": [5, 7], None: [1]}
    values = spark.createDataFrame([(g, i, v) for g, vs in groups.items() for i, v in enumerate(vs)], "g string, __n long, __o long").withColumn("tag", F.array("__o", "__n"))
    tree = search_tree(values, ["g"], ["tag"])
    assert len(tree.levels) == 3
    asked = [(g, rnd.randrange(-5, 300_005)) for g in ["a"] * 300 + ["b", None, "c"] * 10] + [("b", v) for v in (4, 5, 6, 7, 8)]
    rows = spark.createDataFrame(asked, "g string, v long")
    got = place_among(rows, tree, [F.col("g")], F.col("v"), "place", inclusive=inclusive, entry="last").collect()
    assert len(got) == len(asked)
    for r in got:
        own = groups.get(r["g"])
        want = None if own is None else (bisect.bisect_right if inclusive else bisect.bisect_left)(own, r["v"])
        assert r["place"] == want
        assert (r["last"]["__o"] if r["last"] else None) == (own[want - 1] if want else None)
        assert not want or r["last"]["tag"] == [own[want - 1], want - 1]


def test_tasks_hold_no_level_of_many_values(spark):
    """Values that differ little take few bytes in files, so neither their bytes nor the rows of their level tell what a task would hold."""
    values = spark.range(150_000).select(F.col("id").alias("__n"), F.lpad(F.col("id").cast("string"), 18, "0").alias("__o"))
    rows = spark.range(0, 150_000, 1000).select(F.lpad(F.col("id").cast("string"), 18, "0").alias("v"))
    placed = place_among(rows, search_tree(values, []), [], F.col("v"), "place", inclusive=True)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2
    assert placed.where(F.col("place") != F.col("v").cast("long") + 1).isEmpty() and placed.count() == 150
