"""Key/value tables, wide-column cells, SQL sources and enrichment."""

import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from flowops.operators import cells as C
from flowops.operators import kv as K
from flowops.operators.enrich import enrich, enrich_rows
from flowops.session import shared_dir
from flowops.sources import sql as S


def pairs(df):
    return {r["key"]: r["value"] for r in df.collect()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([("a", "1"), ("b", ""), ("c", "3")], "key string, value string")


@pytest.fixture(scope="module")
def updates(spark):
    return spark.createDataFrame([("a", "x", 1), ("d", "y", 2), ("d", "z", 3), ("a", "w", 4)], "key string, value string, ord long")


def test_writes(table, updates):
    assert pairs(K.kv_put(table, updates, "ord")) == {"a": "w", "b": "", "c": "3", "d": "z"}
    assert pairs(K.kv_put_if_absent(table, updates, "ord")) == {"a": "1", "b": "", "c": "3", "d": "y"}
    ok = {r["ord"]: r["ok"] for r in K.kv_put_if_absent_results(table, updates, "ord").collect()}
    assert ok == {1: False, 2: True, 3: False, 4: False}
    old = {r["ord"]: r["previous"] for r in K.kv_get_and_put_if_absent(table, updates, "ord").collect()}
    assert old == {1: "1", 2: None, 3: "y", 4: "1"}


def test_reads_and_removes(spark, table):
    ask = spark.createDataFrame([("a",), ("q",), (None,)], "k string")
    assert {r["k"]: r["value"] for r in K.kv_get(ask, table, "k").collect()} == {"a": "1", "q": None, None: None}
    assert {r["k"]: r["found"] for r in K.kv_contains(ask, table, "k").collect()} == {"a": True, "q": False, None: False}
    gone = ask.select(F.col("k").alias("key"))
    assert pairs(K.kv_remove(table, gone)) == {"b": "", "c": "3"}
    assert {r["key"]: r["ok"] for r in K.kv_remove_results(table, gone).collect()} == {"a": True, "q": False, None: False}
    assert K.duplicate_keys(table).count() == 0
    assert K.duplicate_keys(table.union(table)).count() == 3


@pytest.mark.parametrize("fold,limit", [(1000, None), (50, None), (50, 9), (0, 9)])
def test_check_and_put(spark, fold, limit):
    rnd = random.Random(5)
    start = {"hot": "v1", "k1": "v0", "k2": "v2"}
    requests = []
    for i in range(300):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(5)}"
        expected = None if rnd.random() < 0.1 else f"v{rnd.randrange(4)}"
        requests.append((i, key, expected, f"v{rnd.randrange(4)}"))
    frame = spark.createDataFrame(requests, "ord long, key string, expected string, value string").repartition(3)
    table = spark.createDataFrame(list(start.items()), "key string, value string")
    after, results = K.kv_check_and_put(table, frame, "ord", fold_rows=fold, max_rows=limit)
    store, want = dict(start), {}
    for i, key, expected, value in requests:
        want[i] = store.get(key) == expected
        if want[i]:
            store[key] = value
    assert {r["ord"]: r["ok"] for r in results.collect()} == want
    assert pairs(after) == store


@pytest.mark.parametrize("fold,limit", [(1000, None), (0, None), (0, 9)])
def test_check_and_put_with_equal_order(spark, fold, limit):
    """Requests of equal order are taken by what they expect, null first, then by their value."""
    rnd = random.Random(6)
    requests = [(i // 4, rnd.choice(["hot", "k"]), rnd.choice([None, "A", "B", "C"]), rnd.choice("ABC")) for i in range(120)]
    frame = spark.createDataFrame(requests, "ord long, key string, expected string, value string").repartition(3)
    table = spark.createDataFrame([("hot", "A")], "key string, value string")
    after, results = K.kv_check_and_put(table, frame, "ord", fold_rows=fold, max_rows=limit)
    store, want = {"hot": "A"}, []
    for i, key, expected, value in sorted(requests, key=lambda r: (r[1], r[0], r[2] is not None, r[2] or "", r[3])):
        ok = store.get(key) == expected
        want.append((i, key, expected, value, ok))
        if ok:
            store[key] = value
    assert sorted(map(tuple, results.select("ord", "key", "expected", "value", "ok").collect()), key=str) == sorted(want, key=str)
    assert pairs(after) == store


def test_get_of_a_key_with_several_rows(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2")], "key string, value string")
    ask = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    got = [(r["k"], r["value"], r["route"]) for r in K.kv_get(ask, table, "k").collect()]
    assert sorted(got, key=str) == [("a", "1", "success"), ("b", None, "failure"), ("c", None, "success"), (None, None, "success")]


@pytest.fixture(scope="module")
def cells(spark):
    rows = [
        ("emp", "e1", "f", "name", "Ann", 1),
        ("emp", "e1", "g", "name", "Anna", 1),
        ("emp", "e1", "f", "age", "40", 1),
        ("emp", "e12", "f", "name", "Bob", 1),
        ("emp", "x9", "f", "name", "Cy", 1),
        ("dep", "e1", "f", "name", "Dep", 1),
    ]
    return spark.createDataFrame(rows, "table string, row_key string, family string, qualifier string, value string, ts long")


def test_scan_cells(cells):
    got = {r["id"]: r["attrs"] for r in C.scan_cells(cells, "emp", F.col("row_key").startswith("e"), row_key_name="id").collect()}
    assert got == {"e1": {"name": "Anna", "age": "40"}, "e12": {"name": "Bob"}}
    full = C.scan_cells(cells, "emp", name_format="tablename.family.qualifier", fragments=True).orderBy("row_key").collect()
    assert full[0]["attrs"] == {"emp.f.name": "Ann", "emp.f.age": "40", "emp.g.name": "Anna"}
    assert [(r["frag_index"], r["frag_count"]) for r in full] == [(1, 3), (2, 3), (3, 3)]
    assert set(C.scan_cells(cells, "emp", name_format="tablename.qualifier").first()["attrs"]) <= {"emp.name", "emp.age"}
    wide = C.scan_cells(cells, "emp", name_format="family.qualifier", names=["f.name", "g.name"]).orderBy("row_key").collect()
    assert [tuple(r) for r in wide] == [("e1", "Ann", "Anna"), ("e12", "Bob", None), ("x9", "Cy", None)]
    one = C.scan_cells(cells, "emp", F.col("row_key") == "e1", name_format="family.qualifier")
    assert one.select(C.cell_value(F.col("attrs"), "g", "name"), C.cell_value(F.col("attrs"), "g", "no")).first()[:] == ("Anna", None)
    assert {r["table"] for r in C.truncate_cells(cells, "emp,other").collect()} == {"dep"}
    with pytest.raises(ValueError):
        C.scan_cells(cells, "emp", name_format="nope")


def test_cell_lookups(spark, cells):
    emp = C.scan(cells, "emp")
    one = C.cell_by_filter(emp, F.col("row_key") == "e1", "f", "age").first()
    assert (one["route"], one["value"]) == ("success", "40")
    assert C.cell_by_filter(emp, F.col("row_key") == "e1").first()["value"] == "Anna"
    many = C.cell_by_filter(emp, F.col("row_key").startswith("e")).first()
    assert (many["route"], many["value"]) == ("failure", None)
    assert C.cell_by_filter(emp, F.col("row_key") == "zz").first()["route"] == "empty"
    missing_cell = C.cell_by_filter(emp, F.col("row_key") == "x9", "f", "age").first()
    assert (missing_cell["route"], missing_cell["value"]) == ("success", None)
    ask = spark.createDataFrame([("e",), ("e1",), ("e12",), ("x",), ("zzzzzz",), (None,)], "p string")
    got = {r["p"]: (r["route"], r["value"]) for r in C.lookup_cells(ask, emp, "p", prefix=True).collect()}
    assert got == {"e": ("failure", None), "e1": ("failure", None), "e12": ("success", "Bob"), "x": ("success", "Cy"), "zzzzzz": ("empty", None), None: ("empty", None)}
    got = {r["p"]: r["value"] for r in C.lookup_cells(ask, emp, "p").collect()}
    assert got["e1"] == "Anna" and got["e"] is None


def test_to_cells(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 5)], "id int, a string, b int")
    got = {(r["row_key"], r["qualifier"], r["value"]) for r in C.to_cells(df, "t", "id", ["a", "b"]).collect()}
    assert got == {("1", "a", "x"), ("2", "b", "5")}


@pytest.fixture(scope="module")
def emp_view(spark):
    spark.createDataFrame([(1, "x", 5), (1, "y", 3), (2, None, 1)], "rec long, f string, o int").createOrReplaceTempView("recs")
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "it's"), (3, None, None)], "id long, s string, want string")


def test_sql_rows(spark, emp_view):
    got = S.sql_rows(emp_view, "select f as `t.f`, o from recs where rec = ${id}", parent=["id"], order_by="o", remove_qualifiers=True)
    rows = [(r["id"], r["f"], r["o"], r["frag_index"], r["frag_count"], r["route"]) for r in got.orderBy("id", "frag_index").collect()]
    assert rows == [(1, "y", "3", 1, 2, "success"), (1, "x", "5", 2, 2, "success"), (2, "", "1", 1, 1, "success"), (3, None, None, None, None, "empty")]
    flat = S.query_rows(spark, "select f, o from recs", order_by="o").orderBy("frag_index").collect()
    assert [(r["f"], r["o"], r["frag_index"], r["frag_count"]) for r in flat] == [("", "1", 1, 3), ("y", "3", 2, 3), ("x", "5", 3, 3)]


def test_sql_scalar(emp_view):
    rows = S.sql_scalar(emp_view, "select f, o from recs where rec = ${id}", "v", order_by="o").orderBy("id").collect()
    assert [(r["v"], r["route"]) for r in rows] == [("y", "success"), ("", "success"), (None, "empty")]
    text = S.sql_scalar(emp_view, "select max(o) from recs where f = '${want}' or concat('${s}', '${') = 'b${'", "v").orderBy("id")
    assert [r["v"] for r in text.collect()] == ["5", "5", ""]
    for query in (S.sql_scalar, lambda *a, **k: S.sql_rows(*a, parent=["id"], **k)):
        refused = query(emp_view, "select f from no_such_table where rec = ${id}").collect()
        assert {r["route"] for r in refused} == {"failure"} and len(refused) == 3 and refused[0]["reason"]
        with pytest.raises(Exception):
            query(emp_view, "select f from no_such_table", block_on_failure=True)
    same = S.sql_scalar(emp_view, "select f, o from recs", "v", order_by="o").collect()
    assert [(r["v"], r["route"]) for r in same] == [("", "success")] * 3
    none = S.sql_scalar(emp_view, "select f from recs where o > 99", "v").collect()
    assert [(r["v"], r["route"]) for r in none] == [(None, "empty")] * 3
    with pytest.raises(ValueError):
        S.sql_scalar(emp_view, "select 1 where 1 = ${nope}", "v")
    with pytest.raises(ValueError):
        S.sql_scalar(emp_view, "select f from recs where rec = ${id} Order  By o", "v")
    with pytest.raises(ValueError):
        S.sql_scalar(emp_view, "select f from recs where rec = ${id}", "v", order_by="o")


def test_sql_to_kv(spark):
    rows = [("a", "1", None, 1), ("b", None, "a", 2), ("b", "3", "", 3), (None, "n", "b", 0)]
    df = spark.createDataFrame(rows, "c0 string, c1 string, c2 string, ord int")
    assert pairs(S.sql_to_kv(df, "ord")) == {"a": "", "b": "3", "": "3"}
    assert pairs(S.sql_to_kv(df.select("c0", "c1", "ord"), "ord")) == {"a": "1", "b": "3", "": "n"}


def test_statements(spark):
    assert S.split_statements("a;; 'x;y' ;b\n;\n") == ["a", " 'x;y' ", "b\n"]
    assert S.split_statements("a GO b", r"\s+GO\s+") == ["a", "b"]
    log, last = S.run_statements(spark, "create or replace temp view tv as select 'a;b' as x; select x from tv")
    assert [r["ok"] for r in log.orderBy("n").collect()] == [True, True]
    assert last.first()["x"] == "a;b"
    log, _ = S.run_statements(spark, "select 1; select nope from nowhere; select 2")
    rows = log.orderBy("n").collect()
    assert [(r["n"], r["ok"]) for r in rows] == [(1, True), (2, False)] and rows[1]["error"]
    with pytest.raises(Exception):
        S.run_statements(spark, "select nope", block_on_error=True)


def test_truncate_tables(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("t_trunc")
    rows = S.truncate_tables(spark, "t_trunc,no_such_table,t_trunc").collect()
    assert [(r["table"], r["route"]) for r in rows] == [("t_trunc", "success"), ("no_such_table", "failure")]
    assert spark.table("t_trunc").count() == 0


def test_enrich_literals(spark):
    config = {
        "extract-to-attributes": {"test.result": "Good!"},
        "extract-to-json": {
            "test.result": "Hello World!",
            "test.no": {"value": "21020", "to-type": "long"},
            "test.exp": {"value": "${exp}", "to-type": "long"},
            "null.exp": {"value": None, "default": -1, "to-type": "long"},
        },
    }
    row = enrich(spark.createDataFrame([("2", "old")], "exp string, content string"), json.dumps(config)).first()
    assert row["test.result"] == "Good!" and row["route"] == "success"
    assert row["content"] == '{"null.exp":-1,"test.exp":2,"test.no":21020,"test.result":"Hello World!"}'


def test_enrich_lookups(spark, cells, table, emp_view):
    df = spark.createDataFrame([(1, "a", "e1", "x"), (2, "b", "e12", "9"), (3, "q", None, ""), (4, "c", "x", "1.5")], "id long, k string, emp string, num string")
    config = {
        "extract-to-attributes": {"hello": "Hi ${k}!", "cached": {"type": "CACHE", "value": "${k}", "default": "none"}},
        "extract-to-json": {
            "c": {"type": "CACHE_KEY", "value": "${k}", "default": -1},
            "e": {"type": "HBASE_FILTER", "hbase-table": "emp", "value": "PrefixFilter('${emp}') AND RowFilter(=, 'binary:${emp}')", "default": None},
            "s": {"type": "SQL", "value": "SELECT f, o FROM recs WHERE rec = ${id}", "order-by": "o", "default": "dflt", "to-type": "string"},
            "n": {"value": "${num}", "default": 0, "to-type": "double"},
        },
    }
    got = {r["id"]: r for r in enrich(df, config, kv=table, cells=cells).collect()}
    assert got[1]["route"] == "failure" and "n" in got[1]["reason"] and got[1]["content"] is None
    assert got[2]["content"] == '{"c":-1,"e":"Bob","n":9.0,"s":"dflt"}'
    assert got[3]["content"] == '{"c":-1,"e":null,"n":0.0,"s":"dflt"}'
    assert got[4]["content"] == '{"c":"3","e":null,"n":1.5,"s":"dflt"}'
    assert [got[i]["cached"] for i in (2, 3, 4)] == ["none", "none", "3"] and got[2]["hello"] == "Hi b!"
    by_prefix = {"extract-to-json": {"p": {"type": "HBASE", "hbase-table": "emp", "value": "PrefixFilter('${emp}')"}}}
    got = {r["id"]: (r["route"], r["content"]) for r in enrich(df, by_prefix, cells=cells).collect()}
    assert got == {1: ("failure", None), 2: ("success", '{"p":"Bob"}'), 3: ("failure", None), 4: ("success", '{"p":"Cy"}')}
    with pytest.raises(ValueError):
        enrich(df, {"extract-to-json": {"p": {"type": "HBASE", "value": "x"}}}, cells=cells)


def test_lookup_by_nested_prefixes(spark):
    rnd = __import__("random").Random(2)
    keys = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(0, 6))) for _ in range(300)})
    cells = spark.createDataFrame([("t", k, "f", "q", f"v{k}", 0) for k in keys], "table string, row_key string, family string, qualifier string, value string, ts long")
    asked = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 5))) for _ in range(400)}) + ["", "zz", None]
    got = C.lookup_cells(spark.createDataFrame([(p,) for p in asked], "p string"), cells, "p", prefix=True).collect()
    assert len(got) == len(asked)
    for r in got:
        hits = [] if r["p"] is None else [k for k in keys if k.startswith(r["p"])]
        assert (r["route"], r["value"]) == (("empty", None) if not hits else ("failure", None) if len(hits) > 1 else ("success", f"v{hits[0]}"))
    # a cell is copied for its hits only
    some = spark.createDataFrame([("ab",), ("abab",), ("zz",)], "__find string")
    copies = [(r["row_key"], r["__find"]) for r in C._by_prefix(cells, some).collect()]
    assert sorted(copies) == sorted((k, p) for k in keys for p in ("ab", "abab", "zz") if k.startswith(p))
    assert C.lookup_cells(spark.createDataFrame([(None,)], "p string"), cells, "p", prefix=True).first()["route"] == "empty"


def test_queries_from_the_record(spark):
    spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "it's", 7)], "k int, v string, n long").createOrReplaceTempView("content_rows")
    queries = [
        "SELECT v, n FROM content_rows WHERE k = 1",
        "select v,  n FROM content_rows WHERE k = 2;",
        "SELECT v, n FROM content_rows WHERE k = 2",
        "SELECT v, n FROM content_rows WHERE k = 77",
        "SELECT n FROM content_rows WHERE v = 'it''s' -- 5 is no literal",
        "SELECT v FROM content_rows WHERE v = 'a' AND n > 3 LIMIT 1",
        "SELECT DATE '2020-01-02' AS d, substr('hello', 2, 3) AS s, 1.50 + 1 AS z, '${id}' AS lit, cast(1 AS decimal(10, 2)) AS dec",
        "SELECT nope FROM content_rows",
        "DROP TABLE content_rows",
        "SELECT v FROM content_rows WHERE k = ${id}",
        " ; ",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(queries)), "id int, content string")
    rows = S.sql_rows_content(df, parent=["id"], order_by=["n", "v"]).collect()
    assert all(r["content"] == queries[r["id"]] for r in rows)
    got = {(r["id"], r["frag_index"]): r for r in rows}
    assert {k: (r["v"], r["n"]) for k, r in got.items() if k[0] < 3} == {(0, 1): ("a", "5"), (0, 2): ("b", "6"), (1, 1): ("it's", "7"), (2, 1): ("it's", "7")}
    assert got[3, None]["route"] == "empty"
    assert got[4, 1]["n"] == "7" and got[5, 1]["v"] == "a"
    assert tuple(got[6, None][c] for c in ("d", "s", "z", "lit", "dec")) == ("2020-01-02", "ell", "2.50", "${id}", "1.00")
    assert [got[n, None]["route"] for n in range(7, 12)] == ["failure"] * 5
    assert len(rows) == 13 and all(got[n, None]["reason"] for n in range(7, 12))
    one = {r["id"]: (r["route"], r["out"]) for r in S.sql_scalar_content(df.where("id in (1, 3, 4, 6, 7)"), output="out").collect()}
    assert one == {1: ("success", "it's"), 3: ("empty", None), 4: ("success", "7"), 6: ("success", "2020-01-02"), 7: ("failure", None)}
    # shapes beyond the limit are failures; the commonest one runs
    few = {r["id"]: r["route"] for r in S.sql_rows_content(df.where("id in (2, 3, 5)"), parent=["id"], max_shapes=1).collect()}
    assert few == {2: "success", 3: "empty", 5: "failure"}
    assert S.sql_rows_content(df.where("false"), parent=["id"]).count() == 0


def test_equal_shapes_share_a_plan(spark):
    spark.range(100).selectExpr("id AS k", "concat('v', id) AS v").createOrReplaceTempView("shape_rows")
    query = F.concat(F.lit("SELECT v FROM shape_rows WHERE k = "), F.col("id").cast("string"), F.lit(" AND v <> 'x''"), F.col("id").cast("string"), F.lit("'"))
    told = S.sql_rows_content(spark.range(100).select("id", query.alias("content")), parent=["id"], max_shapes=1)
    assert {r["id"]: (r["route"], r["v"]) for r in told.collect()} == {i: ("success", f"v{i}") for i in range(100)}


def test_all_shapes_run(spark, monkeypatch):
    """70 shapes of queries, in several plans; what orders their rows is a number or a text, and some texts cannot run."""
    monkeypatch.setattr(S, "PLAN_SHAPES", 16)
    spark.range(10).selectExpr("id AS k", "concat('v', id) AS v").createOrReplaceTempView("all_shapes")
    queries = [f"SELECT {'k' if n % 2 else 'v'} AS o, v AS c{n % 3} FROM all_shapes AS a{n} WHERE k >= {n % 10} AND k < {n % 10 + 2}" for n in range(70)]
    queries += ["SELECT nope FROM all_shapes", "SELECT k FROM gone WHERE k = 1", "SELECT k FROM gone WHERE k = 2", "", "SELECT ${k}", "SELECT v -- all\nFROM all_shapes WHERE k = 3"]
    df = spark.createDataFrame([*enumerate(queries)], "id int, content string")
    rows = S.sql_rows_content(df, parent=["id"], order_by=["o"]).collect()
    got = {(r["id"], r["frag_index"]): r for r in rows}
    assert len(rows) == len(got) == sum(1 if n % 10 == 9 else 2 for n in range(70)) + 6
    for n in range(70):
        wanted = [k for k in (n % 10, n % 10 + 1) if k < 10]
        assert [(got[n, i]["o"], got[n, i][f"c{n % 3}"], got[n, i]["frag_count"]) for i in range(1, len(wanted) + 1)] == [(str(k) if n % 2 else f"v{k}", f"v{k}", len(wanted)) for k in wanted]
    assert {n: got[n, None]["route"] for n in range(70, 76)} == {70: "failure", 71: "failure", 72: "failure", 73: "failure", 74: "failure", 75: "success"}
    assert "nope" in got[70, None]["reason"] and "gone" in got[72, None]["reason"] and got[73, None]["reason"] == "the record has no query" and got[74, None]["reason"] == "the query refers to a name"
    assert got[75, None]["v"] == "v3"


def test_every_text_runs_where_literals_cannot_leave_it(spark):
    """A size of a type is no value, so these are 70 queries; keys that are compared leave them."""
    spark.range(10).selectExpr("id AS k").createOrReplaceTempView("sizes")
    query = F.concat(F.lit("SELECT cast(k AS decimal("), (F.col("id") % 35 + 2).cast("string"), F.lit(", "), F.floor(F.col("id") / 35).cast("string"), F.lit(")) FROM sizes WHERE k = "), (F.col("id") % 10).cast("string"))
    told = S.sql_scalar_content(spark.range(210).where("id < 70 or id >= 140").withColumn("id", F.col("id") % 70).select("id", query.alias("content")), output="out").collect()
    assert sorted((r["id"], r["route"], r["out"]) for r in told) == sorted((n, "success", f"{n % 10}{'.0' if n >= 35 else ''}") for n in range(70) for _ in range(2))


def test_unions_of_any_number_of_frames(spark, monkeypatch):
    monkeypatch.setattr(S, "PLAN_SHAPES", 2)
    parts = S._Parts()
    for n in range(9):
        parts.add(spark.createDataFrame([(n, "x")], f"n int, c{n % 2} string"))
    assert len(parts.levels) == 3 and all(len(level) <= 2 for level in parts.levels)
    assert sorted((r["n"], r["c0"], r["c1"]) for r in parts.whole().collect()) == [(n, *((None, "x") if n % 2 else ("x", None))) for n in range(9)]
    assert S._Parts().whole() is None


def test_enrich_rows_agrees_with_enrich(spark):
    kv = spark.createDataFrame([("a", "A!"), ("b", ""), ("d", "1"), ("d", "2")], "key string, value string")
    cells = spark.createDataFrame(
        [("t", "r1", "f", "q1", "x", 0), ("t", "r1", "f", "q2", "7", 0), ("t", "r22", "f", "q", "y", 0), ("u", "r1", "f", "q", "z", 0)],
        "table string, row_key string, family string, qualifier string, value string, ts long",
    )
    spark.createDataFrame([(1, "one"), (2, "it's")], "k int, v string").createOrReplaceTempView("enrich_values")
    attributes, fields = "extract-to-attributes", "extract-to-json"
    cell = lambda value, **more: {"type": "HBASE", "hbase-table": "t", "value": value, **more}
    configs = [
        {
            attributes: {"p": "${n}-${s}${literal('x')}${zz}", "c": {"type": "CACHE", "value": "${s}", "default": "none"}, "i": {"value": "12", "to-type": "int"}, "nul": None},
            fields: {
                "n": {"value": "${n}", "to-type": "long"},
                "dflt": {"type": "CACHE_KEY", "value": "zz", "default": -1},
                "dd": {"value": "", "default": 1.5},
                "q": {"type": "SQL", "value": "SELECT v FROM enrich_values WHERE k = ${n}"},
                "h": cell("RowFilter(=, 'binary:r1')", **{"to-type": "int"}),
                "z": None,
            },
        },
        {attributes: {"h": cell("PrefixFilter('r2')"), "w": cell("RowFilter(=, 'binary:r1') AND PrefixFilter('r1')"), "k": {"type": "SQL", "value": "SELECT v FROM enrich_values WHERE v = 'it''s'"}}},
        {attributes: {"b": {"value": "x", "to-type": "double", "default": "3"}}},
        {fields: {}},
        {attributes: {"m": {"type": "CACHE", "value": "d"}}},
        {attributes: {"h": cell("PrefixFilter('r')")}},
        {
            attributes: {"f": {"value": "2.50", "to-type": "decimal"}, "t": {"value": "", "default": True}},
            fields: {"f": {"value": "2.50", "to-type": "float"}, "t": {"value": "", "default": True}, 's"q': "tab\there"},
        },
        {},
    ]
    broken = [
        [1],
        "no json",
        None,
        {attributes: {"h": {"type": "HBASE", "value": "PrefixFilter('r')"}}},
        {attributes: {"h": cell("KeyOnlyFilter()")}},
        {attributes: {"q": {"type": "SQL", "value": "SELECT nope FROM enrich_values"}}},
    ]
    texts = [c if isinstance(c, str) or c is None else json.dumps(c) for c in configs + broken]
    df = spark.createDataFrame([(i + 1, "a", t) for i, t in enumerate(texts)], "n int, s string, content string")
    got = {r["n"]: r for r in enrich_rows(df, kv=kv, cells=cells).collect()}
    assert len(got) == len(texts)
    for n, config in enumerate(configs, 1):
        want = enrich(df.where(F.col("n") == n), config, kv=kv, cells=cells).first().asDict()
        assert (got[n]["route"], got[n]["reason"], got[n]["content"]) == (want["route"], want["reason"], want["content"])
        if want["route"] == "success":
            assert got[n]["attributes"] == {k: want[k] for k in config.get(attributes, {})}
    for n in range(len(configs) + 1, len(texts) + 1):
        assert got[n]["route"] == "failure" and got[n]["reason"] and got[n]["content"] == texts[n - 1]
    bare = enrich_rows(df.where("n in (1, 2, 4)")).collect()
    assert {r["n"]: r["route"] for r in bare} == {1: "failure", 2: "failure", 4: "success"}


def test_many_requests_wait_for_one_write(spark):
    """100,000 requests write what one request expects."""
    from flowops.plans.chains import dealt

    hot = spark.range(100_000).select(F.col("id").alias("ord"), F.lit("hot").alias("key"), F.lit("never").alias("expected"), F.lit("A").alias("value"))
    rest = [(200_000, "hot", "start", "A"), (200_001, "hot", "A", "B"), (200_002, "hot", "A", "C"), (200_003, "hot", "B", "end")]
    requests = hot.unionByName(spark.createDataFrame(rest, "ord long, key string, expected string, value string"))
    table = spark.createDataFrame([("hot", "start")], "key string, value string")
    after, results = K.kv_check_and_put(table, requests, "ord", fold_rows=0, max_rows=1000)
    assert pairs(after) == {"hot": "end"}
    assert {r["ord"] for r in results.where("ok").collect()} == {200_000, 200_001, 200_003}
    assert results.count() == 100_004

    left = spark.range(5000).select(F.lit("k").alias("key"), F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("next"), F.col("id").alias("at"))
    right = spark.range(5000).select(F.lit("k").alias("key"), F.col("id").alias("next"), (F.col("id") * 2).alias("far"))
    a, b, on = dealt(left, right, ["key", "next"], "at", 100)
    assert a.groupBy(*on).count().agg(F.max("count")).first()[0] < 150
    assert {(r["at"], r["far"]) for r in a.join(b, on).collect()} == {(i, 2 if i < 4000 else 2 * i) for i in range(5000)}


def test_queries_of_records_are_read_by_every_core(spark):
    """A small file is one split; telling the shapes of its queries costs far more than its bytes do."""
    folder = pathlib.Path(shared_dir(spark)) / "flowops"
    before = set(folder.glob("queries-*"))
    rows = spark.range(0, 400, 1, 1).select("id", F.concat(F.lit("SELECT "), F.col("id").cast("string"), F.lit(" AS n")).alias("content"))
    told = S.sql_rows_content(rows, parent=["id"], order_by="n").select("id", "n").collect()
    assert sorted((r["id"], r["n"]) for r in told) == [(k, str(k)) for k in range(400)]
    (made,) = set(folder.glob("queries-*")) - before
    assert len({p.name.split("-")[1] for p in made.rglob("part-*.parquet")}) > 1


def test_configs_are_read_once_or_with_their_records(spark, monkeypatch):
    """Few configs are read apart from the records; more of them with every record, to the same result."""
    from flowops.operators import enrich as E

    shapes = ['{"extract-to-attributes": {"a": "${n}"}}', '{"extract-to-json": {"b": {"type": "CACHE", "value": "k${n}", "default": 7}}}', "no", None, "[1]", '{"extract-to-json": {}}']
    shapes += ['{"extract-to-attributes": {"q": {"type": "SQL", "value": "SELECT ${n} + 1"}, "e": "", "t": {"value": "x", "to-type": "int"}}}', '{"extract-to-json": {"s": {"type": "SQL", "value": "SELECT kind"}}}']
    df = spark.createDataFrame([(k, shapes[k % len(shapes)]) for k in range(40)], "n int, content string").coalesce(1)
    kv = spark.createDataFrame([("k1", "one"), ("k9", "x"), ("k9", "y")], "key string, value string")

    def run(limit):
        monkeypatch.setattr(E, "MAX_CONFIGS", limit)
        folder = pathlib.Path(shared_dir(spark)) / "flowops"
        before = set(folder.glob("config-entries-*"))
        rows = [(r["n"], r["content"], r["attributes"], r["route"], (r["reason"] or "")[:20]) for r in enrich_rows(df, kv=kv).orderBy("n").collect()]
        return rows, len(set(folder.glob("config-entries-*")) - before)

    (few, once), (many, never) = run(10_000), run(3)
    assert few == many and len(few) == 40 and (once, never) == (1, 0)
    assert few[0][2] == {"a": "0"} and few[1][1] == '{"b":"one"}' and few[9][3] == "failure" and few[17][1] == '{"b":7}'
    assert {r[3] for r in few if r[0] % 8 in (2, 3, 4, 6, 7)} == {"failure"}


def test_enrich_rows_runs_all_queries(spark):
    """Configs with 70 different queries: none is left out."""
    spark.range(10).selectExpr("id AS k", "concat('v', id) AS v").createOrReplaceTempView("enrich_shapes")
    config = F.concat(F.lit('{"extract-to-attributes": {"q": {"type": "SQL", "value": "SELECT max(v) FROM enrich_shapes AS a'), F.col("n").cast("string"), F.lit(' WHERE k = ${n} % 10"}}}'))
    got = enrich_rows(spark.range(70).select(F.col("id").cast("int").alias("n")).withColumn("content", config)).collect()
    assert sorted((r["n"], r["route"], r["attributes"]["q"]) for r in got) == [(n, "success", f"v{n % 10}") for n in range(70)]
