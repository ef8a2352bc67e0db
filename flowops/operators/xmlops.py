"""XML documents: records, XPath extraction, validation.

Spark's XPath functions end the job on malformed text, so a document is checked first: put inside
an element of its own it must read as XML, and be one element. XPath and validation stay in the
JVM, and so does the search for the nodes of a root path of any form; records of names that only
the data knows, and paths that differ from row to row, are read in Arrow batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import xmltree
from ..functions.maps import materialise
from ..functions.names import split_list
from ..functions.template import Template, quoted, template
from ..routes import FAILURE, REASON, ROUTE, SUCCESS, with_route
from ..session import shared_dir
from .jsonops import _finish, all_attributes, attribute_pairs, chosen_attributes, explode_records
from .sequence import fragment_id

# What a root path stands for.
PARSE_TYPES = ("table", "record")

_PAIR = pa.struct([("k", pa.string()), ("v", pa.string())])
_PARSED = pa.struct([("records", pa.list_(pa.list_(_PAIR))), ("problem", pa.string())])


_RECORDS = "struct<records: array<array<struct<k: string, v: string>>>, problem: string>"


def _parsed(found: list | None, why: str | None) -> dict:
    return {"records": None if found is None else [[{"k": n, "v": t} for n, t in record] for record in found], "problem": why}


def _parse_udf(path: str, children: bool):
    def parse(batch: pa.Array) -> pa.Array:
        return pa.array([_parsed(*xmltree.records(text, path, children)) for text in batch.to_pylist()], _PARSED)

    return F.arrow_udf(parse, _RECORDS)


def _read_udf():
    def read(batch: pa.Array, places: pa.Array) -> pa.Array:
        return pa.array([_parsed(None, None) if at is None else _parsed(*xmltree.records_at(text, at)) for text, at in zip(batch.to_pylist(), places.to_pylist())], _PARSED)

    return F.arrow_udf(read, _RECORDS)


# a declaration that any reader takes; others stay in the text and make it malformed
_DECLARATION = (
    r"""^<\?xml\s+version\s*=\s*("1\.0"|'1\.0')(\s+encoding\s*=\s*("[A-Za-z][A-Za-z0-9._-]*"|'[A-Za-z][A-Za-z0-9._-]*'))?"""
    r"""(\s+standalone\s*=\s*("(yes|no)"|'(yes|no)'))?\s*\?>"""
)


#: Parts the answers of several paths; no XML document can hold it.
_SEPARATOR = "\x01"
#: Of a document inside an element: whether it is one element and nothing else.
_ONE_ELEMENT = "count(/*/*) = 1 and not(/*/text()[normalize-space() != ''])"


def _xml_texts(rows: DataFrame, text: Column, paths: Sequence[str]) -> DataFrame:
    """Add ``__why``, what keeps a text from being one XML document (null if nothing does), and ``__texts``, one per path.

    A DTD is not read. All paths are asked at once, together with the check where they are
    plain steps from the root, which lead to the same place from inside an element.
    """
    own = f"w{uuid.uuid4().hex}"  # a text that holds the name could close the element
    inside = F.concat(F.lit(f"<{own}>"), F.regexp_replace(text, _DECLARATION, ""), F.lit(f"</{own}>"))
    bad = text.contains(own) | F.from_xml(inside, "__bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})["__bad"].isNotNull()
    rows = materialise(rows, {"__inside": inside, "__unread": F.when(F.coalesce(F.trim(text), F.lit("")) == "", "no XML").when(bad, "malformed XML")})
    plain = all(xmltree.plain_path(p) and not p.strip().startswith("//*") for p in paths)
    # a search from the root stays one: the element around the document has a name of its own
    asked = [_ONE_ELEMENT, *(p if p.strip().startswith("//") else f"/*{p.strip()}" for p in paths if plain)]
    answers = F.split(F.when(F.col("__unread").isNull(), F.xpath_string(F.col("__inside"), F.lit(_all_of(asked)))), _SEPARATOR, -1)
    rows = materialise(rows, {"__answers": answers})
    why = F.coalesce("__unread", F.when(F.get("__answers", 0) != "true", "not one XML document"))
    if plain or not paths:
        texts = F.slice("__answers", 2, max(1, len(paths)))
    else:
        texts = F.split(F.when(why.isNull(), F.xpath_string(text, F.lit(_all_of(paths)))), _SEPARATOR, -1)
    return materialise(rows, {"__why": why, "__texts": texts}).drop("__inside", "__unread", "__answers")


def _all_of(paths: Sequence[str]) -> str:
    """One XPath whose value is that of several, parted."""
    return "concat(" + f", '{_SEPARATOR}', ".join(f"string({p})" for p in paths) + ", '')"


# comments, CDATA, instructions, tags, and text between them
_TOKENS = r"""(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+>|[^<]++"""


def _places(text: Column, path: str) -> Column:
    """Which elements of a well-formed text an XPath leads to, counted from 1 by their starts, in document order.

    Every element gets its number as an instruction in front of all it holds, which no name,
    attribute, position of elements or text of the document sees; the path ends in it.
    """
    own = f"w{uuid.uuid4().hex}"
    mark = F.lit(f"<?{own} {_SEPARATOR}?>")

    def numbered(token: Column) -> Column:
        name = F.regexp_extract(token, r"^<([^\s/>]+)", 1)
        whole = F.concat(F.substring(token, F.lit(1), F.length(token) - 2), F.lit(">"), mark, F.lit("</"), name, F.lit(">"))
        return F.when(~token.rlike("^<[^/!?]"), token).when(token.endswith("/>"), whole).otherwise(F.concat(token, mark))

    joined = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKENS), 0), numbered), "")
    pieces = F.transform(F.split(joined, _SEPARATOR, -1), lambda x, k: F.when(k == 0, x).otherwise(F.concat(k.cast("string"), x)))
    return F.xpath(F.array_join(pieces, ""), F.lit(f"({path})/processing-instruction('{own}')")).cast("array<int>")


def _row_text_udf():
    kind = pa.struct([("text", pa.string()), ("problem", pa.string())])

    def read(batch: pa.Array, paths: pa.Array) -> pa.Array:
        found = [xmltree.text_at(text, path) for text, path in zip(batch.to_pylist(), paths.to_pylist())]
        return pa.array([{"text": value, "problem": why} for value, why in found], kind)

    return F.arrow_udf(read, "struct<text: string, problem: string>")


def xml_to_rows(
    df: DataFrame,
    root: str | None = None,
    column: str = "content",
    *,
    parse_type: str = "table",
    prefix: str = "",
    delimiter: str = ",",
    rename: str | Sequence[str] | None = None,
    new_names: str | Sequence[str] | None = None,
    always_add: bool = True,
    names: Sequence[str] | None = None,
    original: bool = False,
    id_columns: Sequence[str] = (),
) -> DataFrame:
    """One row per record element of a document, its child elements as attributes.

    ``table``: the children of the root path are records, with fragment columns; ``record``: the
    nodes at the root path are. An attribute is all the text below the child element; of children
    with one name the last stays. Renaming is by position, then the prefix is put in front;
    ``always_add`` starts every record with the (unprefixed) new names empty. Without a root path
    it is the document element. Records come in document order. Malformed text goes to ``failure``,
    as does every row if the root path is no XPath that leads to nodes. Nodes that are no elements
    are no records. Steps with one plain predicate at most are followed where the records are read;
    other paths take one reading more, and documents with a DTD are failures then.
    ``id_columns`` name what tells documents of equal text apart, for their fragment ids.
    """
    if parse_type not in PARSE_TYPES:
        raise ValueError(f"parse_type must be one of {PARSE_TYPES}, not {parse_type!r}")
    table = parse_type == "table"
    old, new = split_list(rename, delimiter), split_list(new_names, delimiter)
    source = F.col(quoted(column))
    if xmltree.simple_path(root):
        parsed = materialise(df, {"__xml": _parse_udf(xmltree.element_path(root), table)(source)})
    else:
        path = xmltree.from_document(f"{root.strip()}/child::*" if table else root)
        bad = _path_problem(df.sparkSession, [f"({path})/*"])
        if bad:
            nothing = F.lit(None).cast(_RECORDS)
            parsed = df.withColumn("__xml", F.struct(nothing["records"].alias("records"), F.lit(f"bad XPath {root!r}").alias("problem")))
        else:
            parsed = _xml_texts(df, source, [])
            parsed = materialise(parsed, {"__at": F.when(F.col("__why").isNull(), _places(source, path))})
            parsed = materialise(parsed, {"__read": _read_udf()(source, F.col("__at"))})
            read = F.struct(F.col("__read.records").alias("records"), F.coalesce("__why", "__read.problem").alias("problem"))
            parsed = parsed.withColumn("__xml", read).drop("__why", "__texts", "__at", "__read")
    records, why = F.col("__xml.records"), F.col("__xml.problem")
    rows = explode_records(parsed, records, fragment_id(F.col(quoted(column)), *[F.col(quoted(c)) for c in id_columns]), why.isNotNull(), why, original)
    attributes = attribute_pairs(F.col("__row.record"), prefix=prefix, renames=(old, new), blanks=new if always_add else [])
    ok = F.col(ROUTE) == SUCCESS
    shown = all_attributes() if names is None else chosen_attributes(names)
    return _finish(rows.withColumn("__pairs", F.when(ok, attributes)), df.columns, ok & F.lit(table), shown)


def extract_xml(
    df: DataFrame,
    paths: Mapping[str, str],
    column: str = "content",
    *,
    kv: DataFrame | None = None,
    cache_key: str | None = None,
) -> DataFrame:
    """One text column per XPath, ``""`` where nothing matches.

    The XML is the column or, with ``kv`` and ``cache_key`` (a column), the table's value for
    that key. ``${literal("x")}`` in a path is filled in when the plan is built. A path with
    ``${column}`` is read row by row and may be an element path with simple predicates
    (``/a/b[@id='${k}']``) or end in an attribute. Malformed XML and a path that cannot be read
    send the row to ``failure``.
    """
    rows = df
    source = quoted(column)
    if kv is not None and cache_key is not None:
        lookup = kv.select(F.col("key").alias("__key"), F.col("value").alias("__text"))
        rows = rows.join(lookup, F.col(quoted(cache_key)) == F.col("__key"), "left")
        source = "__text"
    queries, by_row = {}, []
    for name, text in paths.items():
        path = Template.parse(text).constant()
        if path is None:
            rows = materialise(rows, {f"__at_{name}": _row_text_udf()(F.col(source), template(text, df.columns))})
            by_row.append(name)
            continue
        queries[name] = path
    bad_path = _path_problem(df.sparkSession, list(queries.values()))
    if bad_path:
        rows = with_route(rows, [(F.lit(True), bad_path)])
        outputs = {n: F.lit(None).cast("string") for n in paths}
    else:
        rows = _xml_texts(rows, F.col(source), list(queries.values()))
        why = F.col("__why")
        outputs = {name: F.when(why.isNull(), F.get("__texts", k)) for k, name in enumerate(queries)}
        problems = [why, *[F.col(quoted(f"__at_{n}"))["problem"] for n in by_row]]
        outputs.update({n: F.when(why.isNull(), F.col(quoted(f"__at_{n}"))["text"]) for n in by_row})
        outputs = {n: outputs[n] for n in paths}
        rows = with_route(rows, [(p.isNotNull(), p) for p in problems])
    keep = [F.col(quoted(c)) for c in df.columns if c not in outputs]
    return rows.select(*keep, *[v.alias(n) for n, v in outputs.items()], ROUTE, REASON)


def _path_problem(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """The first path that cannot be read, if there is one."""

    def read(some: Sequence[str]) -> bool:
        try:
            spark.range(1).select(*[F.xpath_string(F.lit("<x/>"), F.lit(p)) for p in some]).first()
        except (PySparkException, Py4JJavaError):
            return False
        return True

    return None if not paths or read(paths) else next((f"bad XPath {p!r}" for p in paths if not read([p])), None)


def validate_xml(
    df: DataFrame, column: str = "content", *, xsd_path: str | Sequence[str] | None = None, xsd_text: str | None = None
) -> DataFrame:
    """Route documents by an XML schema: ``success`` or ``invalid`` with a reason.

    ``xsd_text`` goes before ``xsd_path`` (one path or several, as a list or separated by
    commas; several make one schema, of one target namespace or more). What a file includes or
    imports by place is taken along. Without a readable schema all rows are ``failure``.
    """
    spark = df.sparkSession
    text = F.col(quoted(column))
    try:
        schema = _ship_schema(spark, xsd_path, xsd_text)
    except (PySparkException, ValueError, SyntaxError, xmltree.expat.ExpatError) as error:
        why = str(error).splitlines()[0]
        return df.withColumns({ROUTE: F.lit(FAILURE), REASON: F.lit(f"XSD cannot be read: {why}")})
    corrupt = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    checked = F.from_xml(text, "__bad string", {**corrupt, "rowValidationXSDPath": schema})
    plain = F.from_xml(text, "__bad string", corrupt)
    rows = materialise(df, {"__checked": checked})
    missing = text.isNull() | (F.trim(text) == "")
    bad = missing | F.col("__checked")["__bad"].isNotNull()
    reason = F.when(missing, "no XML").when(plain["__bad"].isNotNull(), "malformed XML").otherwise("does not conform to the schema")
    return rows.withColumns({ROUTE: F.when(bad, "invalid").otherwise(SUCCESS), REASON: F.when(bad, reason)}).drop("__checked")


def _ship_schema(spark: SparkSession, xsd_path: str | Sequence[str] | None, xsd_text: str | None) -> str:
    """Give every executor the schema; returns the name that the reader finds it by."""
    paths = [""] if xsd_text else split_list(xsd_path)
    if not paths:
        raise ValueError("no XSD given")

    def load(path: str) -> str:
        if not path:
            return xsd_text
        found = spark.read.text(path, wholetext=True).first()
        if found is None:
            raise ValueError(f"{path} is empty")
        return found[0]

    own = f"schema-{uuid.uuid4().hex}"
    return _ship_texts(spark, {f"{own}-{k}.xsd": text for k, text in enumerate(xmltree.schema_set(paths, load, lambda k: f"{own}-{k}.xsd"))})


def _ship_texts(spark: SparkSession, texts: dict[str, str]) -> str:
    """Write small files to the shared folder and ship them with the job; returns how tasks name the first.

    Files that lead to each other are found beside the first: in a shared folder that is mounted
    by that folder's name, elsewhere in the folder that executors work and keep shipped files in.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    places = {}
    for name, text in texts.items():
        path = hadoop.Path(f"{shared_dir(spark)}/flowops/{name}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        stream = files.create(path)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        places[name] = files.makeQualified(path).toString()
        spark.sparkContext.addFile(places[name])
    first = next(iter(texts))
    mounted = len(texts) > 1 and places[first].startswith("file:")
    return places[first] if mounted else first
