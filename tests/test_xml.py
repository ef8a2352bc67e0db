"""XML records, XPath extraction and validation."""

import pytest
from pyspark.sql import functions as F

from flowops.operators.xmlops import extract_xml, validate_xml, xml_to_rows

# fixed values: the schema and its documents below, and texts that are no documents
BAD = ["<a/>junk", "<a/><b/>", "", " ", "plain", "<a>", None, "﻿<a/>", '<!DOCTYPE a SYSTEM "file:///no.dtd"><a/>', '<!DOCTYPE a [<!ENTITY e "x"><!ENTITY f "&e;&e;">]><a>&f;</a>']


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, content string")


def test_record_mode(spark):
    row = xml_to_rows(docs(spark, "<root><my.name>Dude</my.name></root>"), "/root", parse_type="record", prefix="test.").first()
    assert row["attrs"] == {"test.my.name": "Dude"} and row["frag_index"] is None


def test_table_mode(spark):
    df = docs(spark, "<root><names><my.name>Dude</my.name></names></root>")
    rows = xml_to_rows(df, "/root", prefix="test.", original=True).collect()
    assert [(r["route"], r["attrs"]) for r in rows] == [("success", {"test.my.name": "Dude"}), ("original", None)]
    assert (rows[0]["frag_index"], rows[0]["frag_count"], rows[0]["frag_size"]) == (1, 1, "0")


def test_rows_details(spark):
    text = '<?xml version="1.0"?><r><g><n:a xmlns:n="u">x<b>y</b>z</n:a><c>1</c><c>2</c></g><g/><g><d><![CDATA[<&]]></d></g></r>'
    rows = xml_to_rows(docs(spark, text, *BAD), "/r", rename="c|zz|d", new_names="C|Z", delimiter="|", prefix="p.").orderBy("doc", "frag_index").collect()
    assert [(r["doc"], r["route"], r["attrs"]) for r in rows[:3]] == [
        (0, "success", {"C": "", "Z": "", "p.n:a": "xyz", "p.C": "2"}),
        (0, "success", {"C": "", "Z": ""}),
        (0, "success", {"C": "", "Z": "", "p.d": "<&"}),
    ]
    assert [(r["doc"], r["route"]) for r in rows[3:]] == [(i + 1, "failure") for i in range(len(BAD))]
    assert all(r["reason"] for r in rows[3:])
    named = xml_to_rows(docs(spark, text), "//n:a", parse_type="record", names=["b", "q"]).collect()
    assert [(r["b"], r["q"]) for r in named] == [("y", None)]
    assert xml_to_rows(docs(spark, text), "/r/child::g[3]", parse_type="record").first()["attrs"] == {"d": "<&"}
    assert xml_to_rows(docs(spark, text)).count() == 3
    assert xml_to_rows(docs(spark, text), "/none").count() == 0
    bad = xml_to_rows(docs(spark, text), "/r/[").collect()
    assert [r["route"] for r in bad] == ["failure"] and "/r/[" in bad[0]["reason"]


def test_document_order_and_no_repeats(spark):
    text = "<r><a><a><b>1</b></a><b>2</b></a></r>"
    got = extract_xml(docs(spark, text).withColumn("n", F.lit("b")), {"v": "//a/b", "w": "//a//b", "x": "//a/${n}"}).first()
    assert (got["v"], got["w"], got["x"]) == ("1", "1", "1")
    text = "<r><a><a><b><c>1</c></b></a><b><c>2</c></b></a></r>"
    rows = xml_to_rows(docs(spark, text), "//a//b", parse_type="record").collect()
    assert [r["attrs"] for r in rows] == [{"c": "1"}, {"c": "2"}]


def test_documents_that_are_not_one(spark):
    texts = ["<a>1</a>", '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<!-- x --><a>1</a><?p?>', "<?xml?><a>1</a>", ' <?xml version="1.0"?><a>1</a>', "<a>1</a>&amp;", "<!DOCTYPE a><a>1</a>", "</w><w><a/>", "<a>&#0;</a>", "<a b='1' b='2'/>", "<a>1</a><!-- -- -->"]
    got = extract_xml(docs(spark, *texts), {"v": "/a"}).orderBy("doc").collect()
    assert [r["v"] for r in got] == ["1", "1"] + [None] * 8 and [r["route"] for r in got] == ["success"] * 2 + ["failure"] * 8


def test_extract(spark):
    df = docs(spark, "<root><name>Dude</name><n a='1'>x<b>y</b></n></root>", *BAD)
    rows = extract_xml(df, {"extracted_name": '/root/${literal("name")}', "n": "/root/n", "cnt": "count(//b)", "no": "//zz", "at": "/root/n/@a"}).orderBy("doc").collect()
    assert rows[0][2:] == ("Dude", "xy", "1", "", "1", "success", None)
    assert [r["route"] for r in rows[1:]] == ["failure"] * len(BAD)
    # plain paths and full XPath agree, also where names have prefixes
    texts = ["<a i='1'><b>x</b><b i='2'>y<c>z</c></b><d><b> q </b></d></a>", "<n:a xmlns:n='u' n:i='3'><n:b>p</n:b><b>w</b></n:a>", "<a><![CDATA[<b>]]>&amp;</a>", "<z/>"]
    paths = ["/a", "/a/b", "//b", "/a/d/b", "/a/@i", "//b/@i", "/*/b", "//c", "/a//b", "/b", "/*/@i"]
    plain = extract_xml(docs(spark, *texts), {f"p{i}": p for i, p in enumerate(paths)}).orderBy("doc").collect()
    full = extract_xml(docs(spark, *texts), {f"p{i}": f"string({p})" for i, p in enumerate(paths)}).orderBy("doc").collect()
    assert plain == full and plain[0]["p1"] == "x" and plain[0]["p5"] == "2"
    bad = extract_xml(df, {"x": "/root["}).collect()
    assert {r["route"] for r in bad} == {"failure"}
    dyn = spark.createDataFrame([("1", "b"), ("2", "c"), ("9", "b"), ("1", "]["), ("2", "@i")], "i string, n string").withColumn("content", F.lit("<a i='A'><b i='1'>x</b><b i='2'>y</b><c i='2'>z</c></a>"))
    got = extract_xml(dyn, {"v": "/a/${n}[@i='${i}']", "w": "/a/b"}).collect()
    assert [(r["v"], r["w"], r["route"]) for r in got[:3]] == [("x", "x", "success"), ("z", "x", "success"), ("", "x", "success")]
    assert got[3]["route"] == "failure" and got[3]["reason"]
    assert [r["v"] for r in extract_xml(dyn, {"v": "/a/${n}"}).collect()][4] == "A"
    kv = spark.createDataFrame([("k", "<a>1</a>")], "key string, value string")
    keyed = spark.createDataFrame([("k",), ("z",)], "k string")
    got = {r["k"]: (r["v"], r["route"]) for r in extract_xml(keyed.withColumn("content", F.lit("")), {"v": "/a"}, kv=kv, cache_key="k").collect()}
    assert got == {"k": ("1", "success"), "z": (None, "failure")}


XSD = """<xsd:schema xmlns:xsd="http://www.w3.org/2001/XMLSchema">{}</xsd:schema>"""
ROOT = '<xsd:element name="root"><xsd:complexType><xsd:sequence><xsd:element name="name" type="xsd:string"/><xsd:element name="age" type="{}"/></xsd:sequence></xsd:complexType></xsd:element>'


def test_validate(spark, tmp_path):
    good, wrong = "<root><name>Dude</name><age>40</age></root>", "<root><name>Dude</name><age>x</age></root>"
    df = docs(spark, good, wrong, "<root>", good + "junk", None, "")
    text = XSD.format(ROOT.format("xsd:integer"))
    want = [("success", None), ("invalid", "does not conform to the schema"), ("invalid", "malformed XML"), "invalid", ("invalid", "no XML"), ("invalid", "no XML")]

    def check(rows):
        for row, expected in zip(rows, want):
            if isinstance(expected, str):
                assert row["route"] == expected
            else:
                assert (row["route"], row["reason"]) == expected

    check(validate_xml(df, xsd_text=text).orderBy("doc").collect())
    (tmp_path / "one.xsd").write_text(text)
    check(validate_xml(df, xsd_path=str(tmp_path / "one.xsd")).orderBy("doc").collect())
    (tmp_path / "types.xsd").write_text(XSD.format('<xsd:simpleType name="years"><xsd:restriction base="xsd:integer"/></xsd:simpleType>'))
    (tmp_path / "root.xsd").write_text(XSD.format('<xsd:include schemaLocation="types.xsd"/>' + ROOT.format("years")))
    check(validate_xml(df, xsd_path=f"{tmp_path / 'types.xsd'},{tmp_path / 'root.xsd'}").orderBy("doc").collect())
    assert {r["route"] for r in validate_xml(df).collect()} == {"failure"}
    assert {r["route"] for r in validate_xml(df, xsd_path=str(tmp_path / "no.xsd")).collect()} == {"failure"}
    # text goes before path
    check(validate_xml(df, xsd_text=text, xsd_path=str(tmp_path / "no.xsd")).orderBy("doc").collect())


def test_all_paths_are_asked_at_once(spark):
    docs = ["<a x='1'><b>one</b><b>two</b><c/></a>", "<?xml version='1.0'?><a><b>\n t </b></a>", "<a/><a/>", "<a", "text", None, " <a><b>x</b></a> ", "<a><b>&amp;'\"</b></a>"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, content string")
    plain = {"x": "/a/@x", "b": "/a/b", "deep": "//b", "none": "/z"}
    other = {"x": "string(/a/@x)", "n": "count(//b)", "last": "/a/b[last()]", "t": "boolean(/a/b)", "both": "concat(/a/@x, '-', /a/b)"}
    got = [tuple(r[c] for c in (*plain, "route")) for r in extract_xml(df, plain).orderBy("id").collect()]
    bad = (None,) * 4 + ("failure",)
    assert got == [("1", "one", "one", "", "success"), ("", "\n t ", "\n t ", "", "success"), bad, bad, bad, bad, ("", "x", "x", "", "success"), ("", "&'\"", "&'\"", "", "success")]
    got = [tuple(r[c] for c in (*other, "route")) for r in extract_xml(df, other).orderBy("id").collect()]
    assert got[0] == ("1", "2", "two", "true", "1-one", "success") and got[2] == (None,) * 5 + ("failure",)
    assert extract_xml(df, {"a": "/a", "b": "///"}).select("reason").distinct().collect()[0][0] == "bad XPath '///'"
    assert extract_xml(df, {}).where("route = 'success'").count() == 4


@pytest.mark.parametrize(
    ("path", "want"),
    [
        ("/r/g[@k][2]", ["g2"]),
        ("//*[self::g or self::e]", ["g0", "g1", "g2", "e"]),
        ("/r/g[i='a'] | g[last()]", ["g0", "g2"]),
        ("g[position() > 1]", ["g1", "g2"]),
        ("/r/*[2]", ["g1"]),
        ("(//g)[3]", ["g2"]),
        ("//n:z/..", ["g2"]),
        ("//i[ancestor::g[@k='2']]/parent::g", ["g2"]),
        ("/r/g[not(@*)]", ["g1"]),
        ("/r/g[count(node()) = 0] | /r/e[contains(., '|')]", []),
        ("//text()", []),
    ],
)
def test_any_root_path(spark, path, want):
    text = "<r a='>'><!-- <x> --><g k='1'><i>a</i><j/></g><g><i>b<u>c</u>d</i></g><g k='2'><i><![CDATA[<g>]]></i><n:z xmlns:n='u'>q</n:z></g><e/></r>"
    attrs = {"g0": {"i": "a", "j": ""}, "g1": {"i": "bcd"}, "g2": {"i": "<g>", "n:z": "q"}, "e": {}}
    rows = xml_to_rows(docs(spark, text, *BAD), path, parse_type="record").collect()
    assert [r["attrs"] for r in rows if r["route"] == "success"] == [attrs[w] for w in want]
    assert sorted(r["doc"] for r in rows if r["route"] == "failure" and r["reason"]) == list(range(1, len(BAD) + 1))


def test_any_root_path_of_tables(spark):
    text = "<r><t n='1'><row><a>1</a></row></t><t n='2'><row><a>2</a></row><row><a>3</a><b/></row></t></r>"
    rows = xml_to_rows(docs(spark, text, "<r/>").withColumn("records", F.lit("x")), "/r/t[@n > 1]", prefix="p.").orderBy("frag_index").collect()
    assert [(r["doc"], r["attrs"], r["frag_index"], r["frag_count"], r["records"]) for r in rows] == [(0, {"p.a": "2"}, 1, 2, "x"), (0, {"p.a": "3", "p.b": ""}, 2, 2, "x")]
    for bad in ("count(//t)", "/r/t[", "$x/t"):
        rows = xml_to_rows(docs(spark, text), bad).collect()
        assert [(r["route"], r["reason"]) for r in rows] == [("failure", f"bad XPath {bad!r}")]
    # long texts and tags with very many attributes
    wide = "<r>" + "<t " + " ".join(f"a{k}='{k}'" for k in range(900)) + "><c>" + "x " * 200_000 + "</c></t>" + "<u/>" * 5000 + "</r>"
    rows = xml_to_rows(docs(spark, wide), "/r/t[@a899 = 899]", parse_type="record").collect()
    assert [len(r["attrs"]["c"]) for r in rows] == [400_000]


NAMESPACED = """<s:schema xmlns:s="http://www.w3.org/2001/XMLSchema" targetNamespace="{0}" xmlns:own="{0}" {1} elementFormDefault="qualified">{2}</s:schema>"""


def test_schemas_of_several_namespaces(spark, tmp_path):
    """One schema imports another; given together, without places, they find each other too."""
    years = '<s:simpleType name="years"><s:restriction base="s:integer"><s:minInclusive value="0"/></s:restriction></s:simpleType>'
    person = '<s:element name="p"><s:complexType><s:sequence><s:element name="age" type="t:years"/></s:sequence></s:complexType></s:element>'
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "types.xsd").write_text(NAMESPACED.format("urn:t", "", years))
    (tmp_path / "placed.xsd").write_text(NAMESPACED.format("urn:p", 'xmlns:t="urn:t"', '<s:import namespace="urn:t" schemaLocation="sub/types.xsd"/>' + person))
    (tmp_path / "bare.xsd").write_text(NAMESPACED.format("urn:p", 'xmlns:t="urn:t"', '<s:import namespace="urn:t"/>' + person))
    (tmp_path / "note.xsd").write_text(XSD.format('<xsd:element name="note" type="xsd:date"/>'))
    (tmp_path / "wrong.xsd").write_text(NAMESPACED.format("urn:p", "", '<s:import namespace="urn:z" schemaLocation="sub/types.xsd"/>'))
    texts = ["<p xmlns='urn:p'><age>4</age></p>", "<x:p xmlns:x='urn:p'><x:age>-4</x:age></x:p>", "<p><age>4</age></p>", "<note>2020-01-01</note>", "<note>no</note>"]
    df = docs(spark, *texts)

    def routes(**given):
        return [r["route"] for r in validate_xml(df, **given).orderBy("doc").collect()]

    assert routes(xsd_path=str(tmp_path / "placed.xsd")) == ["success", "invalid", "invalid", "invalid", "invalid"]
    together = f"{tmp_path / 'note.xsd'},{tmp_path / 'bare.xsd'},{tmp_path / 'sub' / 'types.xsd'}"
    assert routes(xsd_path=together) == ["success", "invalid", "invalid", "success", "invalid"]
    assert routes(xsd_path=str(tmp_path / "wrong.xsd")) == ["failure"] * 5
    text = NAMESPACED.format("urn:p", 'xmlns:t="urn:t"', f'<s:import namespace="urn:t" schemaLocation="{tmp_path / "sub" / "types.xsd"}"/>' + person)
    assert routes(xsd_text=text) == ["success", "invalid", "invalid", "invalid", "invalid"]
