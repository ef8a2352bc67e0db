"""Trail decoding, statement text, merged views and replay."""

import json
import random

import pytest
from pyspark.sql import functions as F

from flowops.operators.cdc import apply_changes, count_replaced, merge_views, parse_trail, route_changes, trail_statements

# The expected texts below are fixed values.
RECORD = {
    "table": "MOCK.MYTABLE",
    "op_type": "U",
    "op_ts": "2017-09-22 14:56:35.000167",
    "current_ts": "2017-09-22T10:56:40.270000",
    "pos": "00000000040094292834",
    "primary_keys": ["PK1_ID", "PK2_ID", "PK3_ID"],
    "before": {
        "PK1_ID": 1, "PK2_ID": 2, "PK3_ID": 3, "SOURCE_LANG": "US", "NAME": "Name Before Update",
        "LAST_UPDATE_DATE": "2017-09-22 10:56:35", "LAST_UPDATED_BY": 1433, "LAST_UPDATE_LOGIN": 333912,
        "CREATED_BY": 1156, "CREATION_DATE": "2017-09-19 11:16:25", "ZD_SYNC": None,
    },
    "after": {"PK1_ID": 1, "PK2_ID": 2, "PK3_ID": 3, "NAME": "Name After Update", "ZD_SYNC": "SYNCED"},
}


def trail_of(spark, *records):
    texts = [r if isinstance(r, str) or r is None else json.dumps(r) for r in records]
    return parse_trail(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, content string"))


def statements(spark, *records, **options):
    rows = trail_statements(trail_of(spark, *records), **options).orderBy("n").collect()
    return [(r["route"], r["statement"]) for r in rows]


def test_update_statement(spark):
    want = (
        "UPDATE gg.mytable SET name = 'Name After Update', zd_sync = 'SYNCED' "
        "WHERE pk1_id = '1' AND pk2_id = '2' AND pk3_id = '3'"
    )
    assert statements(spark, RECORD, case="Lower", schema="gg") == [("success", want)]


def test_statement_forms(spark):
    ins = {"table": "S.T", "op_type": "I", "primary_keys": ["a"], "after": {"b": "it's", "a": 1, "c": None}}
    dele = {"table": "T", "op_type": "D", "primary_keys": ["a", "z"], "before": {"a": 5, "z": None}}
    noop = {"table": "S.T", "op_type": "U", "primary_keys": ["a"], "before": {"a": 1}, "after": {"a": 2}}
    nokey = {"table": "S.T", "op_type": "U", "before": {"a": 1}, "after": {"b": 2}}
    other = {"table": "S.T", "op_type": "T"}
    got = statements(spark, ins, dele, noop, nokey, other, "{bad", None, "[1]", semicolon=True)
    assert got == [
        ("success", "INSERT INTO S.T (b, a, c) VALUES ('it''s', '1', null);"),
        ("success", "DELETE FROM T WHERE a = '5' AND z IS null;"),
        ("noop", None),
        ("failure", None),
        ("unsupported", None),
        ("failure", None),
        ("failure", None),
        ("failure", None),
    ]
    assert statements(spark, ins, schema="", case="Upper") == [("success", "INSERT INTO T (B, A, C) VALUES ('it''s', '1', null)")]
    mapped = statements(spark, nokey, key_columns="a", column_map={"T.b": "bee", "U.a": "no"})
    assert mapped == [("success", "UPDATE S.T SET bee = '2' WHERE a = '1'")]
    assert statements(spark, dele, schema="x")[0][1].startswith("DELETE FROM x.T ")


def test_merged_view(spark):
    want = (
        '{"created_by":1156,"creation_date":"2017-09-19 11:16:25","last_update_date":"2017-09-22 10:56:35",'
        '"last_update_login":333912,"last_updated_by":1433,"my_prop":"Hi!","name":"Name After Update","pk1_id":1,'
        '"pk2_id":2,"pk3_id":3,"source_lang":"US","table":"gg_test.mytable","zd_sync":"SYNCED"}'
    )
    rows = merge_views(
        trail_of(spark, RECORD, {**RECORD, "op_type": "T"}, "{"),
        case="Lower", schema="gg_test", header_fields="table, op_type, op_ts, pos", constants={"my_prop": "Hi!"},
    ).orderBy("n").collect()
    assert [(r["route"], r["merged"]) for r in rows] == [("success", want), ("unsupported", None), ("failure", None)]


def test_merged_view_precedence(spark):
    rec = {"table": "A.B", "op_type": "U", "before": {"Pos": 1, "x": 1, "X": 2, "n": 3}, "after": {"x": None, "big": 12345678901234567890.0}, "pos": "7"}
    got = merge_views(trail_of(spark, rec), case="Upper", header_fields="pos, op_ts,op_type", trim=True, constants={"n": "c"}).first()["merged"]
    assert json.loads(got) == {"POS": 1, "X": None, "N": 3, "n": "c", "BIG": 12345678901234567890.0, "OP_TYPE": "U"}


def replay(base, records, keys):
    """Sequential replay of the same changes."""
    table = {tuple(r[k] for k in keys): dict(r) for r in base}
    for rec in sorted(records, key=lambda r: int(r["pos"])):
        image = rec["after"] if rec["op_type"] == "I" else rec["before"]
        key = tuple(image.get(k) for k in keys)
        if rec["op_type"] == "I":
            table[key] = {c: rec["after"].get(c) for c in ("a", "b", "x", "y")}
        elif rec["op_type"] == "D":
            table.pop(key, None)
        elif key in table:
            table[key].update({c: v for c, v in rec["after"].items() if c in ("x", "y")})
    return sorted((tuple(r.values()) for r in table.values()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_apply_changes(spark, seed):
    rnd = random.Random(seed)
    keys = ["a", "b"]
    base = [{"a": i, "b": None if i == 3 else f"k{i}", "x": i * 10, "y": f"y{i}"} for i in range(10)]
    records = []
    for pos in rnd.sample(range(1000), 400):
        a = rnd.randrange(14)
        key = {"a": a, "b": None if a == 3 else f"k{a}"}
        values = {c: v for c, v in {"x": rnd.choice([None, rnd.randrange(99)]), "y": rnd.choice([None, "it", "z;"]), "zz": 1}.items() if rnd.random() < 0.6}
        op = rnd.choice("IUUUUD")
        rec = {"table": "S.T", "op_type": op, "pos": f"{pos:020d}", "primary_keys": keys}
        if op in "UD":
            rec["before"] = {**key, "x": -1}
        if op in "IU":
            rec["after"] = {**key, **values}
        records.append(rec)
    frame = spark.createDataFrame([(r["a"], r["b"], r["x"], r["y"]) for r in base], "a long, b string, x int, y string")
    got = apply_changes(frame, trail_of(spark, *records, "{bad"), keys).collect()
    assert sorted((tuple(r) for r in got), key=str) == replay(base, records, keys)
    upper = [json.loads(json.dumps(r).replace('"a":', '"A":').replace('"x":', '"X":')) for r in records]
    got = apply_changes(frame, trail_of(spark, *upper), keys, case="Lower").collect()
    assert sorted((tuple(r) for r in got), key=str) == replay(base, records, keys)
    # an insert replaces a row of the base or of an earlier insert, unless a delete came between
    there, want = {(r["a"], r["b"]) for r in base}, 0
    for r in sorted(records, key=lambda r: r["pos"]):
        image = r["after"] if r["op_type"] == "I" else r["before"]
        key = (image["a"], image["b"])
        if r["op_type"] == "I":
            want += key in there
            there.add(key)
        elif r["op_type"] == "D":
            there.discard(key)
    assert count_replaced(frame, trail_of(spark, *records), keys).first()["replaced"] == want


def test_changes_need_a_place(spark):
    base = spark.range(3).withColumn("x", F.lit("a"))
    change = {"table": "T", "op_type": "U", "pos": "?", "op_ts": "2", "before": {"id": 1}, "after": {"x": "b"}}
    routed = route_changes(base, trail_of(spark, change), ["id"]).first()
    assert (routed["route"], routed["reason"]) == ("failure", "the change has no usable place")
    assert sorted(map(tuple, apply_changes(base, trail_of(spark, change), ["id"]).collect())) == [(0, "a"), (1, "a"), (2, "a")]
    placed = apply_changes(base, trail_of(spark, change), ["id"], order_by=F.col("trail.op_ts").cast("int"))
    assert sorted(map(tuple, placed.collect())) == [(0, "a"), (1, "b"), (2, "a")]


def test_apply_changes_plan(spark):
    base = spark.range(100).withColumn("x", F.col("id"))
    plan = apply_changes(base, trail_of(spark, RECORD), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_changes_that_cannot_be_applied_leave_the_table_alone(spark):
    base = spark.createDataFrame([(None, 5), (1, 7)], "id long, n int")
    bad = [
        {"table": "T", "op_type": "D", "pos": "1", "before": {"id": "abc"}},
        {"table": "T", "op_type": "D", "pos": "2"},
        {"table": "T", "op_type": "U", "pos": "3", "before": {"id": 1}, "after": {"n": "abc"}},
        {"table": "T", "op_type": "U", "pos": "4", "before": {"n": 7}, "after": {"n": 8}},
        {"table": "T", "op_type": "I", "pos": "5"},
        {"table": "T", "op_type": "I", "pos": "x", "after": {"id": 2, "n": 1}},
    ]
    assert {r["route"] for r in route_changes(base, trail_of(spark, *bad), ["id"]).collect()} == {"failure"}
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(apply_changes(base, trail_of(spark, *bad), ["id"])) == rows(base)
    # an explicit null is a value, and a key
    good = [{"table": "T", "op_type": "U", "pos": "1", "before": {"id": None}, "after": {"n": "6"}}, {"table": "T", "op_type": "U", "pos": "2", "before": {"id": 1}, "after": {"n": None}}]
    assert rows(apply_changes(base, trail_of(spark, *bad, *good), ["id"])) == [(1, None), (None, 6)]


def test_statements_need_a_before_image(spark):
    records = [{"table": "s.t", "op_type": op, "pos": "1", "primary_keys": ["id"], "after": {"id": 1, "n": 2}} for op in "UD"]
    got = trail_statements(trail_of(spark, *records)).collect()
    assert [(r["statement"], r["route"], r["reason"]) for r in got] == [(None, "failure", "before image is missing")] * 2


def test_any_scalar_header_field_keeps_its_type(spark):
    record = {"table": "T", "op_type": "I", "pos": 17, "csn": 12345678901, "ok": True, "gone": None, "tokens": {"a": 1}, "after": {"id": 1}}
    got = merge_views(trail_of(spark, record), header_fields="pos,csn,ok,gone,tokens,absent").first()["merged"]
    assert json.loads(got) == {"id": 1, "pos": 17, "csn": 12345678901, "ok": True}
