"""Columns, JSON documents and templates."""

import json

import pytest
from pyspark.sql import functions as F

from flowops.functions import apply_case, attribute_name, convert, default_if_empty, map_column, override_schema, sql_literal, strip_qualifier, template, text_or
from flowops.operators.columns import columns_to_json, content_to_column, map_to_json, update_columns
from flowops.operators.jsonops import json_to_csv, json_to_rows
from flowops.routes import split_routes


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, content string")


def test_content_to_column(spark):
    df = spark.createDataFrame([("Hello World!", "x")], "content string, other string")
    row = content_to_column(df, "test.result").first()
    assert (row["test.result"], row["content"]) == ("Hello World!", "Hello World!")
    row = content_to_column(df, "test.result", "<${test.result}|${other}|${missing}|${literal('k')}>").first()
    assert (row["test.result"], row["content"]) == ("<Hello World!|x||k>", "Hello World!")


def test_update_columns(spark):
    df = spark.createDataFrame([("${b}", "Z", "old"), (None, "${c}", "old")], "a string, b string, content string")
    plain = update_columns(df, {"a": "n ${b}"}, new_content="C ${a}").collect()
    assert [(r["a"], r["content"], r["route"]) for r in plain] == [("n ${b}", "C ${a}", "success")] * 2
    once = update_columns(df, {"x": "Hi ${a}", "y": "${x}!"}, evaluate_columns=True).collect()
    assert [(r["x"], r["y"], r["content"]) for r in once] == [("Hi ${b}", "Hi ${b}!", "old"), ("Hi ", "Hi !", "old")]
    deep = update_columns(df, {"x": "Hi ${a}${b}"}, new_content="-${a}-", evaluate_content=True, evaluate_columns=True, recursive=True).collect()
    assert [(r["x"], r["content"], r["route"]) for r in deep] == [("Hi ZZ", "-Z-", "success"), ("Hi ", "--", "success")]
    loop = spark.createDataFrame([("${b}", "${a}")], "a string, b string")
    row = update_columns(loop, {"x": "${a}"}, evaluate_columns=True, recursive=True).first()
    assert row["route"] == "failure" and "x" in row["reason"]
    wide = spark.range(1).select(*[F.lit("${c%d}" % (i + 1) if i < 5 else "end").alias(f"c{i}") for i in range(300)])
    row = update_columns(wide, {"x": "<${c0}>"}, evaluate_columns=True, recursive=True).first()
    assert (row["x"], row["route"]) == ("<end>", "success")


def test_columns_to_json(spark):
    df = spark.createDataFrame([("2", 1, "4", "3")], "`pre.b` string, a int, d string, c string")
    row = columns_to_json(df, prefix="pre.", regex="^c$", names="a,d").first()
    assert row["content"] == '{"a":"1","b":"2","c":"3","d":"4"}'
    row = columns_to_json(df, prefix="pre.", strip_prefix=False, names="zz", constants={"k": "${a}!", "a": "x"}).first()
    assert row["content"] == '{"a":"x","k":"1!","pre.b":"2","zz":null}'
    assert columns_to_json(df).first()["content"] == "{}"
    nulls = spark.createDataFrame([(None, None)], "`p.x` string, y string")
    assert columns_to_json(nulls, prefix="p.", names="y").first()["content"] == '{"y":null}'
    attrs = df.select(F.create_map(F.lit("pre.b"), F.lit("2"), F.lit("c"), F.lit("3"), F.lit("b"), F.lit("9")).alias("m"))
    got = attrs.select(map_to_json(F.col("m"), prefix="pre.", regex="[bc]", names=["q"], constants={"c": "K"}).alias("j")).first()["j"]
    assert got == '{"b":"9","c":"K","q":null}'


def test_json_rows(spark):
    df = docs(spark, '{"a":1,"b":null,"n":{"x":1},"l":[1],"t":true}', '[{"a":1},5,{a:2,\'b\':"q"},null,[1]]', '5', '{bad', None, '[]')
    rows = [(r["doc"], r["route"], r["attrs"], r["frag_index"], r["frag_count"]) for r in json_to_rows(df, prefix="p.").orderBy("doc", "frag_index").collect()]
    assert rows == [
        (0, "success", {"p.a": "1", "p.b": "", "p.t": "true"}, None, None),
        (1, "success", {"p.a": "1"}, 1, 2),
        (1, "success", {"p.a": "2", "p.b": "q"}, 2, 2),
        (2, "failure", None, None, None),
        (3, "failure", None, None, None),
        (4, "failure", None, None, None),
    ]
    routes = split_routes(json_to_rows(df, original=True, fragments="Always"), ["success", "failure", "original"])
    assert [routes[r].count() for r in ("success", "failure", "original")] == [3, 3, 3]
    ids = {(r["doc"], r["frag_id"]) for r in routes["success"].collect()}
    assert len(ids) == 2 and all(i for _, i in ids)
    assert json_to_rows(df, fragments="Never").where("frag_id is not null").count() == 0


def test_json_rename(spark):
    df = docs(spark, '{"a":1,"b":null,"c":3,"d":"x"}')
    row = json_to_rows(df, rename="a|c|d", new_names="A|C", delimiter="|", prefix="z_").first()
    assert row["attrs"] == {"z_A": "1", "z_C": "3", "z_b": "", "z_d": "x"}
    row = json_to_rows(df, rename=["q"], new_names=["Q", "R"], null_fields=False).first()
    assert row["attrs"] == {"a": "1", "c": "3", "d": "x"}
    row = json_to_rows(df, rename=["q"], new_names=["Q", "R"], names=["Q", "a", "zz"]).first()
    assert (row["Q"], row["a"], row["zz"]) == ("", "1", None)
    # single columns agree with the map, whatever is renamed to what
    many = docs(spark, '{"a":1,"b":null,"c":3,"d":"x"}', '{"a":null,"B":2,"b":{"z":1},"d":[1]}', '{"c":"", "p_a":7}')
    cases = [
        {"rename": "a,b,c", "new_names": "B,B"},
        {"rename": "a,a,b", "new_names": "x,y,a", "prefix": "p_"},
        {"rename": "a,b", "new_names": "b,a", "null_fields": False},
        {"rename": "c", "new_names": "d,e", "always_add": False},
        {},
    ]
    wanted = ["a", "b", "B", "c", "d", "e", "x", "p_a", "p_x", "p_y", "p_b"]
    for case in cases:
        maps = json_to_rows(many, **case).orderBy("doc").collect()
        flat = json_to_rows(many, names=wanted, **case).orderBy("doc").collect()
        assert [[r["attrs"].get(n) for n in wanted] for r in maps] == [[r[n] for n in wanted] for r in flat], case
    row = json_to_rows(df, rename=["q"], new_names=["Q"], always_add=False).first()
    assert "Q" not in row["attrs"]


def test_json_csv(spark):
    schema = json.dumps({"type": "record", "name": "data", "fields": [{"name": "a", "type": ["long", "null"]}, {"name": "b", "type": ["string", "null"]}]})
    df = docs(spark, '["{\\"a\\": 1, \\"b\\": \\"two\\"}"]', '{"b":"x\\"y","z":1}', '[{"a":null},{"a":2,"b":"q"}]', '[]', '[1]', '["x"]', '{', '7')
    got = [(r["route"], r["csv"]) for r in json_to_csv(df, schema).orderBy("doc").collect()]
    assert got == [
        ("success", '"a","b"\n"1","two"'),
        ("success", '"a","b"\n"","x""y"'),
        ("success", '"a","b"\n"",""\n"2","q"'),
        ("success", ""),
        ("failure", None),
        ("failure", None),
        ("failure", None),
        ("success", '"a","b"'),
    ]
    got = [r["csv"] for r in json_to_csv(df, ["a", "b"], delimiter="|", headers=False, quoted_fields=False).orderBy("doc").collect()]
    assert got[:3] == ["1|two", '|x"y', "|\n2|q"]


def test_scalar_functions(spark):
    df = spark.createDataFrame([("S.T.u", "c", "it's", "")], "t string, c string, v string, e string")
    t, c, v, e = (F.col(x) for x in df.columns)
    row = df.select(
        apply_case(t, "Upper"), apply_case(t, "Lower"), apply_case(t, "None"),
        map_column(F.lit("T"), c, {"T.c": "x"}, "Upper"), map_column(F.lit("T"), c, {"U.c": "x"}),
        override_schema(t, "N"), override_schema(t, ""), override_schema(t, None), override_schema(c, "N"),
        sql_literal(v), sql_literal(F.lit(None).cast("string")),
        default_if_empty(e, "d"), text_or(F.lit(None).cast("int")), text_or(F.lit(5), "x"),
        attribute_name(t, c, v, "tablename.family.qualifier"), attribute_name(t, c, v, "family.qualifier"),
        template("${t}-${nope}-${'c'}", df.columns),
    ).first()
    assert list(row) == [
        "S.T.U", "s.t.u", "S.T.u", "X", "c", "N.T.u", "T.u", "S.T.u", "N.c", "'it''s'", "null", "d", "", "5",
        "S.T.u.c.it's", "c.it's", "S.T.u--c",
    ]
    assert strip_qualifier("a.b.c") == "c" and strip_qualifier("c") == "c"
    types = {"int": 5, "long": 5, "float": 5.0, "double": 5.0, "decimal": 5.0, "string": "5", "odd": "5", None: "5"}
    for name, want in types.items():
        assert df.select(convert(F.lit("5"), name)).first()[0] == want
    assert df.select(convert(F.lit("x"), "int")).first()[0] is None
    with pytest.raises(ValueError):
        apply_case(t, "Title")


def test_update_columns_follows_a_chain_of_any_length(spark):
    """Twelve names, each in the value of the one before; only a cycle fails."""
    row = {f"c{i}": f"${{c{i + 1}}}" for i in range(12)} | {"c12": "end", "x": "${y}", "y": "${x}", "content": ""}
    df = spark.createDataFrame([tuple(row.values())], list(row))
    got = update_columns(df, {"out": "${c0}"}, evaluate_columns=True, recursive=True).first()
    assert (got["out"], got["route"]) == ("end", "success")
    assert update_columns(df, {"out": "${x}"}, evaluate_columns=True, recursive=True).first()["route"] == "failure"


def test_fragment_ids_tell_equal_documents_apart(spark):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (2, '[{"a":1},{"a":2}]')], "doc int, content string")
    ids = {(r["doc"], r["frag_id"]) for r in json_to_rows(df, id_columns=["doc"]).collect()}
    assert len(ids) == 2 and len({i for _, i in ids}) == 2
    assert len({r["frag_id"] for r in json_to_rows(df).collect()}) == 1
