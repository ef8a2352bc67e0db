"""Registered queries: every operator over whole driver tables, with its SQL equivalent."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import cdc, cells, columns, enrich, jsonops, kv, sequence, state, xmlops
from .session import scratch_path, spread
from .sources import files, sql
from .sources.buckets import BucketTable, change_stored
from .streaming import batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


# --------------------------------------------------------------------------- change data capture

ORDER_OP = "CASE WHEN o_orderpriority = '5-LOW' THEN 'T' WHEN o_orderstatus = 'F' THEN 'I' WHEN o_orderstatus = 'O' THEN 'U' ELSE 'D' END"


def orders_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trail record per order, the operation chosen by its status and priority."""
    orders = spread(table(spark, sf_dir, "orders")).withColumn("op", F.expr(ORDER_OP))

    def image(priority: Column) -> Column:
        return F.struct(F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_custkey").alias("O_CUSTKEY"), priority.alias("O_ORDERPRIORITY"))

    record = F.struct(
        F.lit("SALES.ORDERS").alias("table"),
        F.col("op").alias("op_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("op_ts"),
        F.lpad(text("o_orderkey"), 20, "0").alias("pos"),
        F.array(F.lit("O_ORDERKEY")).alias("primary_keys"),
        F.when(F.col("op").isin("U", "D"), image(F.lit("0-OLD"))).alias("before"),
        F.when(F.col("op").isin("I", "U"), image(F.col("o_orderpriority"))).alias("after"),
    )
    return cdc.parse_trail(orders.select("o_orderkey", F.to_json(record).alias("content")))


@register(
    "cdc_parse",
    f"""
    WITH t AS (SELECT *, {ORDER_OP} AS op FROM orders)
    SELECT o_orderkey, 'SALES.ORDERS' AS source_table, op AS op_type, strftime(o_orderdate, '%Y-%m-%d') AS op_ts,
           lpad(o_orderkey::VARCHAR, 20, '0') AS pos, 'O_ORDERKEY' AS key_column,
           CASE WHEN op IN ('U', 'D') THEN '0-OLD' END AS old_priority,
           CASE WHEN op IN ('I', 'U') THEN o_orderpriority END AS new_priority,
           CASE WHEN op IN ('I', 'U') THEN o_custkey END AS new_custkey, 'success' AS route
    FROM t""",
)
def cdc_parse(spark, sf_dir):
    trail = F.col("trail")
    return orders_trail(spark, sf_dir).select(
        "o_orderkey",
        trail["table"].alias("source_table"),
        trail["op_type"].alias("op_type"),
        trail["op_ts"].alias("op_ts"),
        trail["pos"].alias("pos"),
        F.array_join(trail["primary_keys"], ",").alias("key_column"),
        F.element_at(trail["before"], "O_ORDERPRIORITY").cast("string").alias("old_priority"),
        F.element_at(trail["after"], "O_ORDERPRIORITY").cast("string").alias("new_priority"),
        F.element_at(trail["after"], "O_CUSTKEY").cast("bigint").alias("new_custkey"),
        "route",
    )


@register(
    "cdc_statements",
    f"""
    WITH t AS (SELECT *, {ORDER_OP} AS op FROM orders)
    SELECT o_orderkey,
      CASE op
        WHEN 'I' THEN 'INSERT INTO dw.orders (o_orderkey, o_custkey, o_orderpriority) VALUES (''' || o_orderkey || ''', ''' || o_custkey || ''', ''' || o_orderpriority || ''')'
        WHEN 'U' THEN 'UPDATE dw.orders SET o_custkey = ''' || o_custkey || ''', o_orderpriority = ''' || o_orderpriority || ''' WHERE o_orderkey = ''' || o_orderkey || ''''
        WHEN 'D' THEN 'DELETE FROM dw.orders WHERE o_orderkey = ''' || o_orderkey || ''''
      END AS statement,
      CASE WHEN op = 'T' THEN 'unsupported' ELSE 'success' END AS route
    FROM t""",
)
def cdc_statements(spark, sf_dir):
    rows = cdc.trail_statements(orders_trail(spark, sf_dir), case="Lower", schema="dw")
    return rows.select("o_orderkey", "statement", "route")


@register(
    "cdc_statements_mapped",
    f"""
    WITH t AS (SELECT *, {ORDER_OP} AS op FROM orders)
    SELECT o_orderkey,
      CASE op
        WHEN 'I' THEN 'INSERT INTO ORDERS (O_ORDERKEY, BUYER, O_ORDERPRIORITY) VALUES (''' || o_orderkey || ''', ''' || o_custkey || ''', ''' || o_orderpriority || ''');'
        WHEN 'U' THEN 'UPDATE ORDERS SET O_ORDERPRIORITY = ''' || o_orderpriority || ''' WHERE O_ORDERKEY = ''' || o_orderkey || ''' AND BUYER = ''' || o_custkey || ''';'
        WHEN 'D' THEN 'DELETE FROM ORDERS WHERE O_ORDERKEY = ''' || o_orderkey || ''' AND BUYER = ''' || o_custkey || ''';'
      END AS statement
    FROM t""",
)
def cdc_statements_mapped(spark, sf_dir):
    rows = cdc.trail_statements(
        orders_trail(spark, sf_dir),
        case="Upper",
        schema="",
        semicolon=True,
        key_columns="O_ORDERKEY,O_CUSTKEY",
        column_map={"ORDERS.O_CUSTKEY": "buyer"},
    )
    return rows.select("o_orderkey", "statement")


@register(
    "cdc_merge_views",
    f"""
    WITH t AS (SELECT *, {ORDER_OP} AS op FROM orders)
    SELECT o_orderkey,
      CASE WHEN op <> 'T' THEN '{{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"'
        || CASE WHEN op = 'D' THEN '0-OLD' ELSE o_orderpriority END || '","op_type":"' || op || '","origin":"sales","table":"dw.orders"}}' END AS merged,
      CASE WHEN op = 'T' THEN 'unsupported' ELSE 'success' END AS route
    FROM t""",
)
def cdc_merge_views(spark, sf_dir):
    rows = cdc.merge_views(
        orders_trail(spark, sf_dir), case="Lower", schema="dw", header_fields="table,op_type", constants={"origin": "sales"}
    )
    return rows.select("o_orderkey", "merged", "route")


def events_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change to the customer with the user's number."""
    return cdc.parse_trail(_event_changes(spread(table(spark, sf_dir, "events"))))


def _event_changes(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    key = F.col("user_id").alias("C_CUSTKEY")
    after = (
        F.when(kind == "signup", F.to_json(F.struct(key, F.concat(F.lit("new-"), text("event_id")).alias("C_NAME"))))
        .when(kind == "purchase", F.to_json(F.struct(key, F.concat(F.lit("buyer-"), k.cast("string")).alias("C_NAME"))))
        .when(kind == "click", F.to_json(F.struct(F.concat(F.lit("seg-"), k.cast("string")).alias("C_MKTSEGMENT"))))
        # an explicit null is a value too
        .when(kind == "view", F.to_json(F.struct(F.when(k >= 50, k).alias("C_NATIONKEY")), {"ignoreNullFields": "false"}))
    )
    op = F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")
    head = F.to_json(F.struct(F.lit("S.CUSTOMER").alias("table"), op.alias("op_type"), F.lpad(text("event_id"), 20, "0").alias("pos")))
    before = F.to_json(F.struct(key))
    body = F.concat_ws(
        ",",
        F.regexp_replace(head, r"\}$", ""),
        F.when(kind != "signup", F.concat(F.lit('"before":'), before)),
        F.concat(F.lit('"after":'), after),
    )
    return events.select(F.concat(body, F.lit("}")).alias("content"))


def customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


CDC_APPLY_SQL = """
    WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
    a AS (SELECT user_id, max(event_id) FILTER (event_type IN ('signup', 'error')) AS anchor,
                 arg_max(event_type, event_id) FILTER (event_type IN ('signup', 'error')) AS op FROM e GROUP BY user_id),
    l AS (SELECT e.user_id, any_value(a.op) AS op,
                 arg_max(CASE WHEN event_type = 'signup' THEN 'new-' || event_id ELSE 'buyer-' || k END, event_id) FILTER (event_type IN ('signup', 'purchase')) AS name,
                 arg_max('seg-' || k, event_id) FILTER (event_type = 'click') AS seg,
                 arg_max(CASE WHEN k >= 50 THEN k ELSE -1 END, event_id) FILTER (event_type = 'view') AS nat
          FROM e JOIN a USING (user_id) WHERE anchor IS NULL OR event_id >= anchor GROUP BY e.user_id)
    SELECT c_custkey, coalesce(name, c_name) AS c_name, CASE WHEN nat IS NULL THEN c_nationkey WHEN nat >= 0 THEN nat END AS c_nationkey,
           coalesce(seg, c_mktsegment) AS c_mktsegment
    FROM customer LEFT JOIN l ON user_id = c_custkey WHERE op IS NULL
    UNION ALL
    SELECT user_id, name, CASE WHEN nat >= 0 THEN nat END, seg FROM l WHERE op = 'signup'"""


@register("cdc_apply", CDC_APPLY_SQL)
def cdc_apply(spark, sf_dir):
    return cdc.apply_changes(customer_base(spark, sf_dir), events_trail(spark, sf_dir), ["c_custkey"], case="Lower")


@register(
    "cdc_replaced",
    """
    WITH i AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
               FROM events WHERE event_type IN ('signup', 'error'))
    SELECT count(*) AS replaced FROM i
    WHERE event_type = 'signup' AND (previous = 'signup' OR (previous IS NULL AND user_id IN (SELECT c_custkey FROM customer)))""",
)
def cdc_replaced(spark, sf_dir):
    return cdc.count_replaced(customer_base(spark, sf_dir), events_trail(spark, sf_dir), ["c_custkey"], case="Lower")


BROKEN = "event_id % 7"


def broken_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change, some of which cannot be applied, by the remainder of the event's number."""
    kind = F.expr(BROKEN)
    key = F.when(kind == 1, F.lit('"abc"')).when(kind == 2, F.lit("null")).otherwise(text("user_id"))
    number = F.when(kind == 3, F.lit('"many"')).when(kind == 4, F.lit('"12"')).otherwise(text("event_id"))
    place = F.when(kind == 5, F.lit("later")).otherwise(text("event_id"))
    before = F.when(kind == 6, F.lit("")).otherwise(F.concat(F.lit('"before":{"c_custkey":'), key, F.lit("},")))
    content = F.concat(F.lit('{"table":"s.customer","op_type":"U","pos":"'), place, F.lit('",'), before, F.lit('"after":{"c_nationkey":'), number, F.lit("}}"))
    return cdc.parse_trail(spread(table(spark, sf_dir, "events")).select("event_id", content.alias("content")))


@register(
    "cdc_apply_rejected",
    f"""
    SELECT event_id, CASE WHEN {BROKEN} IN (1, 3, 5, 6) THEN 'failure' ELSE 'success' END AS route,
           CASE {BROKEN} WHEN 1 THEN 'key c_custkey does not convert' WHEN 3 THEN 'c_nationkey does not convert'
                WHEN 5 THEN 'the change has no usable place' WHEN 6 THEN 'before image is missing' END AS reason
    FROM events""",
)
def cdc_apply_rejected(spark, sf_dir):
    routed = cdc.route_changes(customer_base(spark, sf_dir), broken_trail(spark, sf_dir), ["c_custkey"], case="Lower")
    return routed.select("event_id", "route", "reason")


@register(
    "cdc_apply_with_rejects",
    f"""
    WITH base AS (SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT NULL, 'nobody', 0),
    e AS (SELECT CASE WHEN {BROKEN} = 2 THEN NULL ELSE user_id END AS k, event_id,
                 CASE WHEN {BROKEN} = 4 THEN 12 ELSE event_id END AS n FROM events WHERE {BROKEN} IN (0, 2, 4)),
    l AS (SELECT k, arg_max(n, event_id) AS n FROM e GROUP BY k)
    SELECT c_custkey, c_name, coalesce(l.n, c_nationkey)::INTEGER AS c_nationkey FROM base LEFT JOIN l ON l.k IS NOT DISTINCT FROM c_custkey""",
)
def cdc_apply_with_rejects(spark, sf_dir):
    """Changes that cannot be applied leave the table alone, its row with a null key too."""
    base = customer_base(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey")
    nobody = spark.range(1).select(F.lit(None).cast("long").alias("c_custkey"), F.lit("nobody").alias("c_name"), F.lit(0).alias("c_nationkey"))
    return cdc.apply_changes(base.unionByName(nobody), broken_trail(spark, sf_dir), ["c_custkey"], case="Lower")


# --------------------------------------------------------------------------- documents


def event_batches(spark: SparkSession, sf_dir: str, item: Column) -> DataFrame:
    """Documents of at most 16 consecutive events: ids are unique, so no group can grow."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct("event_id", item.alias("item"))))
    items = F.transform(ordered, lambda e: e["item"])
    return events.groupBy(F.floor(F.col("event_id") / 16).alias("doc")).agg(items.alias("items"), F.max("k").alias("top"))


def json_item() -> Column:
    return F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("type"),
            F.when(F.col("event_type") != "view", F.col("k")).alias("k"),
            F.struct(F.col("user_id")).alias("nested"),
        ),
        {"ignoreNullFields": "false"},
    )


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_batches(spark, sf_dir, json_item()).select("doc", F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("content"))


DOCS_SQL = "e AS (SELECT *, event_id // 16 AS doc, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"


@register(
    "json_rows",
    f"""
    WITH {DOCS_SQL}
    SELECT doc, event_id::VARCHAR AS ev_id, event_type AS ev_kind, CASE WHEN event_type = 'view' THEN '' ELSE k::VARCHAR END AS ev_k,
           NULL::VARCHAR AS ev_nested, row_number() OVER (PARTITION BY doc ORDER BY event_id) AS frag_index,
           count(*) OVER (PARTITION BY doc) AS frag_count, 'success' AS route
    FROM e""",
)
def json_rows(spark, sf_dir):
    rows = jsonops.json_to_rows(
        json_documents(spark, sf_dir), prefix="ev_", rename="type", new_names="kind", names=["ev_id", "ev_kind", "ev_k", "ev_nested"]
    )
    return rows.select("doc", "ev_id", "ev_kind", "ev_k", "ev_nested", "frag_index", "frag_count", "route")


@register(
    "json_rows_original",
    f"""
    WITH {DOCS_SQL} SELECT doc, 'success' AS route, count(*) AS n FROM e GROUP BY doc UNION ALL SELECT doc, 'original', 1 FROM e GROUP BY doc""",
)
def json_rows_original(spark, sf_dir):
    rows = jsonops.json_to_rows(json_documents(spark, sf_dir), original=True)
    return rows.groupBy("doc", "route").agg(F.count(F.lit(1)).alias("n"))


@register("json_props", "SELECT event_id, json_extract_string(props, '$.k') AS k, 'success' AS route FROM events")
def json_props(spark, sf_dir):
    return jsonops.json_to_rows(spread(table(spark, sf_dir, "events")), "props", names=["k"]).select("event_id", "k", "route")


@register("json_not_json", "SELECT page_id, 'failure' AS route FROM pages")
def json_not_json(spark, sf_dir):
    return jsonops.json_to_rows(table(spark, sf_dir, "pages"), "html").select("page_id", "route")


@register(
    "json_csv",
    f"""
    WITH {DOCS_SQL}
    SELECT doc, '"id","type","k","none"' || chr(10) || string_agg('"' || event_id || '","' || event_type || '","'
           || CASE WHEN event_type = 'view' THEN '' ELSE k::VARCHAR END || '",""', chr(10) ORDER BY event_id) AS csv
    FROM e GROUP BY doc""",
)
def json_csv(spark, sf_dir):
    return jsonops.json_to_csv(json_documents(spark, sf_dir), ["id", "type", "k", "none"]).select("doc", "csv")


def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.concat(
        F.lit("<e><id>"), text("event_id"), F.lit("</id><type>"), F.col("event_type"), F.lit("<b>!</b></type></e>")
    )
    rows = event_batches(spark, sf_dir, item)
    body = F.concat(F.lit("<events><list>"), F.array_join("items", ""), F.lit("</list>"))
    # a document with a high top value loses its end
    return rows.select("doc", F.concat(body, F.when(F.col("top") >= 97, "").otherwise("</events>")).alias("content"))


@register(
    "xml_rows",
    f"""
    WITH {DOCS_SQL}, d AS (SELECT doc, max(k) AS top FROM e GROUP BY doc)
    SELECT doc, event_id::VARCHAR AS "e.id", event_type || '!' AS "e.kind", row_number() OVER (PARTITION BY doc ORDER BY event_id) AS frag_index,
           count(*) OVER (PARTITION BY doc) AS frag_count, 'success' AS route
    FROM e JOIN d USING (doc) WHERE top < 97
    UNION ALL SELECT doc, NULL, NULL, NULL, NULL, 'failure' FROM d WHERE top >= 97""",
)
def xml_rows(spark, sf_dir):
    rows = xmlops.xml_to_rows(
        xml_documents(spark, sf_dir), "/events/list", prefix="e.", rename="type", new_names="kind", always_add=False, names=["e.id", "e.kind"]
    )
    return rows.select("doc", "`e.id`", "`e.kind`", "frag_index", "frag_count", "route")


@register(
    "xml_record",
    f"""
    WITH {DOCS_SQL}, d AS (SELECT doc, max(k) AS top FROM e GROUP BY doc)
    SELECT doc, CASE WHEN top < 97 THEN string_agg(event_id || event_type || '!', '' ORDER BY event_id) END AS list, CASE WHEN top < 97 THEN 'success' ELSE 'failure' END AS route
    FROM e JOIN d USING (doc) GROUP BY doc, top""",
)
def xml_record(spark, sf_dir):
    return xmlops.xml_to_rows(xml_documents(spark, sf_dir), "/events", parse_type="record", names=["list"]).select("doc", "list", "route")


@register(
    "xml_rows_path",
    f"""
    WITH {DOCS_SQL}, d AS (SELECT doc, max(k) AS top FROM e GROUP BY doc),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY event_id) AS place FROM e JOIN d USING (doc))
    SELECT doc, event_id::VARCHAR AS id, event_type || '!' AS type, 'success' AS route FROM n WHERE top < 97 AND place > 1 AND event_type <> 'view'
    UNION ALL SELECT doc, NULL, NULL, 'failure' FROM d WHERE top >= 97""",
)
def xml_rows_path(spark, sf_dir):
    path = "/events/list/e[position() > 1][not(starts-with(type, 'view'))]"
    return xmlops.xml_to_rows(xml_documents(spark, sf_dir), path, parse_type="record", names=["id", "type"]).select("doc", "id", "type", "route")


@register(
    "xml_extract",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id::VARCHAR END AS id, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
           CASE WHEN event_type <> 'error' THEN '' END AS missing, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS route
    FROM events""",
)
def xml_extract(spark, sf_dir):
    kind = F.col("event_type")
    content = F.concat(
        F.lit("<e no='"), text("event_id"), F.lit("'><kind>"), kind, F.lit("</kind>"), F.when(kind == "error", "").otherwise("</e>")
    )
    rows = spread(table(spark, sf_dir, "events")).select("event_id", content.alias("content"))
    found = xmlops.extract_xml(rows, {"id": "/e/@no", "kind": '/e/${literal("kind")}', "missing": "//none"})
    return found.select("event_id", "id", "kind", "missing", "route")


# Fixed value: the schema the order documents are checked against.
ORDER_XSD = """<xsd:schema xmlns:xsd="http://www.w3.org/2001/XMLSchema"><xsd:element name="o"><xsd:complexType><xsd:sequence>
<xsd:element name="key" type="xsd:integer"/><xsd:element name="cust" type="xsd:integer"/></xsd:sequence></xsd:complexType></xsd:element></xsd:schema>"""


@register(
    "xml_validate",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN 'invalid' ELSE 'success' END AS route,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'malformed XML' WHEN o_orderstatus = 'P' THEN 'does not conform to the schema' END AS reason
    FROM orders""",
)
def xml_validate(spark, sf_dir):
    content = F.concat(
        F.lit("<o><key>"),
        text("o_orderkey"),
        F.lit("</key><cust>"),
        F.when(F.col("o_orderstatus") == "P", "x").otherwise(""),
        text("o_custkey"),
        F.lit("</cust>"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("</o>"),
    )
    rows = spread(table(spark, sf_dir, "orders")).select("o_orderkey", content.alias("content"))
    return xmlops.validate_xml(rows, xsd_text=ORDER_XSD).select("o_orderkey", "route", "reason")


# Two schemas, of which the first uses the second.
LINE_XSD = """<xsd:schema xmlns:xsd="http://www.w3.org/2001/XMLSchema" xmlns:a="urn:amounts" targetNamespace="urn:lines" elementFormDefault="qualified">
<xsd:import namespace="urn:amounts"/><xsd:element name="line"><xsd:complexType><xsd:sequence><xsd:element name="part" type="xsd:integer"/>
<xsd:element ref="a:amount"/></xsd:sequence></xsd:complexType></xsd:element></xsd:schema>"""
AMOUNT_XSD = """<xsd:schema xmlns:xsd="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:amounts"><xsd:element name="amount"><xsd:simpleType>
<xsd:restriction base="xsd:integer"><xsd:maxInclusive value="40"/></xsd:restriction></xsd:simpleType></xsd:element></xsd:schema>"""


@register(
    "xml_validate_namespaces",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 OR l_returnflag = 'R' THEN 'invalid' ELSE 'success' END AS route FROM lineitem""",
)
def xml_validate_namespaces(spark, sf_dir):
    amount = F.col("l_quantity").cast("int").cast("string")
    # returned lines have an amount of no namespace
    inner = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("<amount>"), amount, F.lit("</amount>"))).otherwise(F.concat(F.lit("<y:amount xmlns:y='urn:amounts'>"), amount, F.lit("</y:amount>")))
    content = F.concat(F.lit("<x:line xmlns:x='urn:lines'><x:part>"), text("l_partkey"), F.lit("</x:part>"), inner, F.lit("</x:line>"))
    rows = spread(table(spark, sf_dir, "lineitem")).select("l_orderkey", "l_linenumber", content.alias("content"))
    folder = scratch_path(spark, "schemas")
    for name, xsd in (("line", LINE_XSD), ("amount", AMOUNT_XSD)):
        spark.range(1).select(F.lit(xsd)).coalesce(1).write.text(f"{folder}/{name}", lineSep="\n")
    return xmlops.validate_xml(rows, xsd_path=[f"{folder}/line", f"{folder}/amount"]).select("l_orderkey", "l_linenumber", "route")


# --------------------------------------------------------------------------- columns


@register("content_to_column", "SELECT c_custkey, c_name AS content, c_name || '@' || c_mktsegment AS label FROM customer")
def content_to_column(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("content"), "c_mktsegment")
    return columns.content_to_column(rows, "label", "${label}@${c_mktsegment}").select("c_custkey", "content", "label")


@register(
    "update_columns",
    """
    SELECT c_custkey, 'Dear ' || c_name || ' of ' || c_nationkey AS content, c_custkey || '-' || c_mktsegment AS tag,
           '<' || c_custkey || '-' || c_mktsegment || '>' AS twice, 'success' AS route
    FROM customer""",
)
def update_columns(spark, sf_dir):
    # the letter is a value that holds names itself
    rows = table(spark, sf_dir, "customer").withColumn("letter", F.lit("Dear ${c_name} of ${c_nationkey}"))
    changed = columns.update_columns(
        rows,
        {"tag": "${c_custkey}-${c_mktsegment}", "twice": "<${tag}>"},
        new_content="${letter}",
        evaluate_content=True,
        evaluate_columns=True,
        recursive=True,
    )
    return changed.select("c_custkey", "content", "tag", "twice", "route")


@register(
    "symbols_json",
    """
    SELECT c_custkey, '{"c_custkey":"' || c_custkey || '","name":"' || n_name || '","origin":"r' || n_regionkey || '","regionkey":"' || n_regionkey || '"}' AS content
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def symbols_json(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("n.name"), F.col("n_regionkey").alias("n.regionkey"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    made = columns.columns_to_json(rows, prefix="n.", regex="c_cust.*", constants={"origin": "r${n.regionkey}"})
    return made.select("c_custkey", "content")


@register(
    "symbols_json_map",
    """
    SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '","none":null,"type":"' || event_type || '"}' AS content FROM events""",
)
def symbols_json_map(spark, sf_dir):
    rows = jsonops.json_to_rows(spread(table(spark, sf_dir, "events")), "props", prefix="p.")
    made = columns.map_to_json(F.col("attrs"), prefix="p.", names=["none"], constants={"type": F.col("event_type")})
    return rows.select("event_id", made.alias("content"))


# --------------------------------------------------------------------------- key/value tables


def supplier_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("k"), text("s_suppkey")).alias("key"), F.col("s_name").alias("value"))


def order_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("k"), text("o_custkey")).alias("key"), F.col("o_orderpriority").alias("value"), F.col("o_orderkey").alias("ord")
    )


KV_SQL = """
    t AS (SELECT 'k' || s_suppkey AS key, s_name AS value FROM supplier),
    u AS (SELECT 'k' || o_custkey AS key, o_orderpriority AS value, o_orderkey AS ord FROM orders)"""


@register(
    "kv_put",
    f"WITH {KV_SQL} SELECT key, arg_max(value, ord) AS value FROM u GROUP BY key UNION ALL SELECT key, value FROM t WHERE key NOT IN (SELECT key FROM u)",
)
def kv_put(spark, sf_dir):
    return kv.kv_put(supplier_kv(spark, sf_dir), order_updates(spark, sf_dir), "ord")


@register(
    "kv_put_if_absent",
    f"WITH {KV_SQL} SELECT key, value FROM t UNION ALL SELECT key, arg_min(value, ord) FROM u WHERE key NOT IN (SELECT key FROM t) GROUP BY key",
)
def kv_put_if_absent(spark, sf_dir):
    return kv.kv_put_if_absent(supplier_kv(spark, sf_dir), order_updates(spark, sf_dir), "ord")


@register(
    "kv_put_if_absent_results",
    f"WITH {KV_SQL} SELECT key, value, ord, key NOT IN (SELECT key FROM t) AND ord = min(ord) OVER (PARTITION BY key) AS ok FROM u",
)
def kv_put_if_absent_results(spark, sf_dir):
    return kv.kv_put_if_absent_results(supplier_kv(spark, sf_dir), order_updates(spark, sf_dir), "ord")


@register(
    "kv_get_put_if_absent",
    f"""WITH {KV_SQL}, f AS (SELECT key, arg_min(value, ord) AS first_value, min(ord) AS first_ord FROM u GROUP BY key)
    SELECT u.key, ord, CASE WHEN t.key IS NOT NULL THEN t.value WHEN ord <> first_ord THEN first_value END AS previous
    FROM u JOIN f USING (key) LEFT JOIN t ON t.key = u.key""",
)
def kv_get_put_if_absent(spark, sf_dir):
    rows = kv.kv_get_and_put_if_absent(supplier_kv(spark, sf_dir), order_updates(spark, sf_dir), "ord")
    return rows.select("key", "ord", "previous")


@register("kv_get", f"WITH {KV_SQL} SELECT ord, t.value AS found FROM u LEFT JOIN t USING (key)")
def kv_get(spark, sf_dir):
    rows = order_updates(spark, sf_dir).select("ord", "key")
    return kv.kv_get(rows, supplier_kv(spark, sf_dir), "key", "found").select("ord", "found")


@register(
    "kv_get_duplicates",
    f"""
    WITH {KV_SQL}, d AS (SELECT key, min(value) AS value, count(*) AS n FROM (SELECT key, value FROM t UNION ALL SELECT key, value FROM t WHERE length(key) = 2) GROUP BY key)
    SELECT ord, CASE WHEN n = 1 THEN d.value END AS found, CASE WHEN n > 1 THEN 'failure' ELSE 'success' END AS route FROM u LEFT JOIN d USING (key)""",
)
def kv_get_duplicates(spark, sf_dir):
    """A key that the table has twice is a failure; the row is not doubled."""
    rows = order_updates(spark, sf_dir).select("ord", "key")
    stored = supplier_kv(spark, sf_dir)
    return kv.kv_get(rows, stored.unionByName(stored.where(F.length("key") == 2)), "key", "found").select("ord", "found", "route")


@register("kv_contains", f"WITH {KV_SQL} SELECT ord, key IN (SELECT key FROM t) AS found FROM u")
def kv_contains(spark, sf_dir):
    return kv.kv_contains(order_updates(spark, sf_dir), supplier_kv(spark, sf_dir), "key").select("ord", "found")


@register("kv_remove", f"WITH {KV_SQL} SELECT key, value FROM t WHERE key NOT IN (SELECT key FROM u WHERE value = '5-LOW')")
def kv_remove(spark, sf_dir):
    return kv.kv_remove(supplier_kv(spark, sf_dir), order_updates(spark, sf_dir).where("value = '5-LOW'"))


@register("kv_remove_results", f"WITH {KV_SQL} SELECT DISTINCT key, key IN (SELECT key FROM t) AS ok FROM u WHERE value = '5-LOW'")
def kv_remove_results(spark, sf_dir):
    return kv.kv_remove_results(supplier_kv(spark, sf_dir), order_updates(spark, sf_dir).where("value = '5-LOW'"))


NEW_STATUS = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'F' WHEN '2' THEN 'O' WHEN '3' THEN 'P' WHEN '4' THEN 'O' ELSE 'F' END"

CAS_SQL = f"""
    WITH RECURSIVE r AS (SELECT o_custkey, o_orderkey, o_orderstatus AS expected, {NEW_STATUS} AS value,
                                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
    s AS (SELECT c_custkey, 0::BIGINT AS n, NULL::BIGINT AS ord, false AS ok, 'F' AS cur FROM customer
          UNION ALL
          SELECT s.c_custkey, r.n, r.o_orderkey, r.expected = s.cur, CASE WHEN r.expected = s.cur THEN r.value ELSE s.cur END
          FROM s JOIN r ON r.o_custkey = s.c_custkey AND r.n = s.n + 1)"""


def check_and_put(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    held = table(spark, sf_dir, "customer").select(text("c_custkey").alias("key"), F.lit("F").alias("value"))
    requests = table(spark, sf_dir, "orders").select(
        text("o_custkey").alias("key"), F.col("o_orderstatus").alias("expected"), F.expr(NEW_STATUS).alias("value"), F.col("o_orderkey").alias("ord")
    )
    return kv.kv_check_and_put(held, requests, "ord")


@register("kv_check_and_put", CAS_SQL + " SELECT c_custkey::VARCHAR AS key, arg_max(cur, n) AS value FROM s GROUP BY c_custkey")
def kv_check_and_put(spark, sf_dir):
    return check_and_put(spark, sf_dir)[0]


@register("kv_check_and_put_results", CAS_SQL + " SELECT c_custkey::VARCHAR AS key, ord, ok FROM s WHERE n > 0")
def kv_check_and_put_results(spark, sf_dir):
    return check_and_put(spark, sf_dir)[1].select("key", "ord", "ok")


# --------------------------------------------------------------------------- wide-column tables


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return cells.to_cells(rows, "customer", "c_custkey", ["c_name", "c_mktsegment", "c_nationkey"])


@register(
    "to_cells",
    """
    SELECT 'customer' AS "table", c_custkey::VARCHAR AS row_key, 'f' AS family, 'c_name' AS qualifier, c_name AS value FROM customer
    UNION ALL SELECT 'customer', c_custkey::VARCHAR, 'f', 'c_mktsegment', c_mktsegment FROM customer
    UNION ALL SELECT 'customer', c_custkey::VARCHAR, 'f', 'c_nationkey', c_nationkey::VARCHAR FROM customer""",
)
def to_cells(spark, sf_dir):
    return customer_cells(spark, sf_dir).drop("ts")


@register(
    "scan_cells",
    """
    SELECT c_custkey::VARCHAR AS id, c_name AS "f.c_name", c_mktsegment AS "f.c_mktsegment", row_number() OVER (ORDER BY c_custkey::VARCHAR) AS frag_index,
           count(*) OVER () AS frag_count
    FROM customer""",
)
def scan_cells(spark, sf_dir):
    rows = cells.scan_cells(
        customer_cells(spark, sf_dir), "customer", name_format="family.qualifier", row_key_name="id", names=["f.c_name", "f.c_mktsegment"], fragments=True
    )
    return rows.select("id", "`f.c_name`", "`f.c_mktsegment`", "frag_index", "frag_count")


@register(
    "scan_cells_map",
    """
    SELECT c_custkey::VARCHAR AS row_key, '{"customer.c_mktsegment":"' || c_mktsegment || '","customer.c_name":"' || c_name || '","customer.c_nationkey":"'
           || c_nationkey || '"}' AS attrs FROM customer""",
)
def scan_cells_map(spark, sf_dir):
    rows = cells.scan_cells(customer_cells(spark, sf_dir), "customer", name_format="tablename.qualifier")
    return rows.select("row_key", F.to_json("attrs").alias("attrs"))


@register(
    "cells_by_filter",
    "SELECT o_orderkey, c_mktsegment AS value, CASE WHEN c_custkey IS NULL THEN 'empty' ELSE 'success' END AS route FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
)
def cells_by_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text("o_custkey").alias("row"))
    found = cells.lookup_cells(rows, cells.scan(customer_cells(spark, sf_dir), "customer"), "row", family="f", qualifier="c_mktsegment")
    return found.select("o_orderkey", "value", "route")


@register(
    "cells_last_value",
    """
    WITH l AS (SELECT o_orderkey, o_orderstatus, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS name FROM orders),
    c AS (SELECT left(c_name, 17) AS head, count(*) AS n, any_value(c_nationkey)::VARCHAR AS v FROM customer GROUP BY 1)
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN c_nationkey::VARCHAR WHEN n = 1 THEN v END AS value,
           CASE WHEN o_orderstatus = 'P' AND n > 1 THEN 'failure' ELSE 'success' END AS route
    FROM l JOIN customer ON c_name = name JOIN c ON head = left(name, 17)""",
)
def cells_last_value(spark, sf_dir):
    # orders with status P ask with a prefix that several customers share
    named = cells.to_cells(table(spark, sf_dir, "customer"), "customer", "c_name", ["c_mktsegment", "c_nationkey"])
    name = F.concat(F.lit("Customer#"), F.lpad(text("o_custkey"), 9, "0"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.substring(name, 1, 17)).otherwise(name).alias("row")
    )
    return cells.lookup_cells(rows, named, "row", prefix=True).select("o_orderkey", "value", "route")


#: Prefixes of 13 to 18 letters, one within the other, of customers' names.
PREFIX_SQL = """
    WITH a AS (SELECT o_orderkey, left('Customer#' || lpad(o_custkey::VARCHAR, 9, '0'), 13 + (o_orderkey % 6)::INTEGER) AS head FROM orders),
    h AS (SELECT left(c_name, n::INTEGER) AS head, count(*) AS n, any_value(c_mktsegment) AS v FROM customer, range(13, 19) t(n) GROUP BY left(c_name, n::INTEGER))
    SELECT o_orderkey, CASE WHEN n = 1 THEN v END AS value,
           CASE WHEN n IS NULL THEN 'empty' WHEN n > 1 THEN 'failure' ELSE 'success' END AS route
    FROM a LEFT JOIN h ON a.head = h.head"""


@register("lookup_cells_prefix", PREFIX_SQL)
def lookup_cells_prefix(spark, sf_dir):
    named = cells.to_cells(table(spark, sf_dir, "customer"), "customer", "c_name", ["c_mktsegment", "c_nationkey"])
    name = F.concat(F.lit("Customer#"), F.lpad(text("o_custkey"), 9, "0"))
    asked = table(spark, sf_dir, "orders").select("o_orderkey", F.substring(name, F.lit(1), (13 + F.col("o_orderkey") % 6).cast("int")).alias("head"))
    found = cells.lookup_cells(asked, named, "head", family="f", qualifier="c_mktsegment", prefix=True)
    return found.select("o_orderkey", "value", "route")


@register("kv_put_stored", f"WITH {KV_SQL} SELECT key, arg_max(value, ord) AS value FROM u GROUP BY key UNION ALL SELECT key, value FROM t WHERE key NOT IN (SELECT key FROM u)")
def kv_put_stored(spark, sf_dir):
    """The same on a stored table of which only the buckets of changed keys are rewritten."""
    stored = BucketTable(scratch_path(spark, "kv"), batches.KEY_VALUE, ("key",), 32)
    stored.write(supplier_kv(spark, sf_dir), 0)
    change_stored(stored, order_updates(spark, sf_dir), ["key"], lambda rows, updates: kv.kv_put(rows, updates, "ord"))
    return stored.read(spark)


@register("truncate_cells", """SELECT 'customer' AS "table", count(*) AS rows FROM customer""")
def truncate_cells(spark, sf_dir):
    both = customer_cells(spark, sf_dir).unionByName(cells.to_cells(table(spark, sf_dir, "supplier"), "supplier", "s_suppkey", ["s_name"]))
    left = cells.truncate_cells(both, "supplier")
    return left.groupBy("table", "row_key").agg(F.count(F.lit(1)).alias("n")).groupBy("table").agg(F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------- SQL and enrichment


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    alias = f"flow_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(alias)
    return alias


@register(
    "sql_rows",
    """
    SELECT c_custkey, o_orderkey::VARCHAR AS o_orderkey, o_orderstatus,
           CASE WHEN o_orderkey IS NOT NULL THEN row_number() OVER (PARTITION BY c_custkey ORDER BY orders.o_orderkey) END AS frag_index,
           CASE WHEN o_orderkey IS NOT NULL THEN count(*) OVER (PARTITION BY c_custkey) END AS frag_count,
           CASE WHEN o_orderkey IS NULL THEN 'empty' ELSE 'success' END AS route
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
)
def sql_rows(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    rows = sql.sql_rows(
        table(spark, sf_dir, "customer").select("c_custkey"),
        f"SELECT o_orderkey AS `o.o_orderkey`, o_orderstatus AS `o.o_orderstatus` FROM {orders} WHERE o_custkey = ${{c_custkey}}",
        parent=["c_custkey"],
        order_by="o_orderkey",
        remove_qualifiers=True,
    )
    return rows.select("c_custkey", "o_orderkey", "o_orderstatus", "frag_index", "frag_count", "route")


@register(
    "query_rows",
    "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, row_number() OVER (ORDER BY orders.o_orderkey) AS frag_index, count(*) OVER () AS frag_count FROM orders",
)
def query_rows(spark, sf_dir):
    rows = sql.query_rows(spark, f"SELECT o_orderkey, o_orderstatus FROM {view(spark, sf_dir, 'orders')}", order_by="o_orderkey")
    return rows.select("o_orderkey", "o_orderstatus", "frag_index", "frag_count")


@register(
    "sql_scalar",
    """
    SELECT c_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, CASE WHEN count(o_orderkey) = 0 THEN 'empty' ELSE 'success' END AS route
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def sql_scalar(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    rows = sql.sql_scalar(
        table(spark, sf_dir, "customer").select("c_custkey"),
        f"SELECT o_orderpriority, o_orderkey FROM {orders} WHERE o_custkey = ${{c_custkey}}",
        "first_priority",
        order_by="o_orderkey",
    )
    return rows.select("c_custkey", "first_priority", "route")


@register(
    "sql_to_kv",
    """
    WITH p AS (SELECT 'c' || o_custkey AS key, o_orderpriority AS value, o_orderkey AS ord FROM orders
               UNION ALL SELECT 's' || o_custkey, o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus = 'P')
    SELECT key, arg_max(value, ord) AS value FROM p GROUP BY key""",
)
def sql_to_kv(spark, sf_dir):
    result = spark.sql(
        f"SELECT concat('c', o_custkey), o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN concat('s', o_custkey) END, o_orderkey AS ord FROM {view(spark, sf_dir, 'orders')}"
    )
    return sql.sql_to_kv(result, "ord")


@register("run_statements", "SELECT o_orderstatus || ';' AS status, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY o_orderstatus")
def run_statements(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    script = f"""CREATE OR REPLACE TEMPORARY VIEW flow_marked AS SELECT *, concat(o_orderstatus, ';') AS status FROM {orders};;
    SELECT status, count(*) AS n, min(o_orderkey) AS first_key FROM flow_marked GROUP BY status;"""
    return sql.run_statements(spark, script, block_on_error=True)[1]


@register(
    "enrich",
    """
    SELECT o_orderkey, 'order ' || o_orderkey AS label, coalesce(s_name, 'nobody') AS supplier,
           '{"cust":' || o_custkey || ',"miss":-1,"nation":' || c_nationkey || ',"plain":"' || o_orderstatus || '","segment":"' || c_mktsegment || '"}' AS content,
           'success' AS route
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey""",
)
def enrich_orders(spark, sf_dir):
    config = {
        "extract-to-attributes": {
            "label": "order ${o_orderkey}",
            "supplier": {"type": "CACHE", "value": "k${o_custkey}", "default": "nobody"},
        },
        "extract-to-json": {
            "plain": "${o_orderstatus}",
            "cust": {"value": "${o_custkey}", "to-type": "long"},
            "miss": {"type": "CACHE_KEY", "value": "none-${o_custkey}", "default": -1, "to-type": "int"},
            # the last cell of a customer row is c_nationkey
            "nation": {"type": "HBASE_FILTER", "hbase-table": "customer", "value": "RowFilter(=, 'binary:${o_custkey}')", "to-type": "int"},
            "segment": {"type": "SQL", "value": f"SELECT max(c_mktsegment) FROM {view(spark, sf_dir, 'customer')} WHERE c_custkey = ${{o_custkey}}"},
        },
    }
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    done = enrich.enrich(rows, config, kv=supplier_kv(spark, sf_dir), cells=customer_cells(spark, sf_dir))
    return done.select("o_orderkey", "label", "supplier", "content", "route")


CONTENT_SQL = """
    WITH q AS (SELECT c_custkey, c_nationkey, c_custkey % 4 AS kind FROM customer),
    a AS (SELECT c_custkey, o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, NULL::VARCHAR AS n_name, NULL::VARCHAR AS priority, orders.o_orderkey AS ord
          FROM q LEFT JOIN orders ON o_custkey = c_custkey WHERE kind = 0
          UNION ALL SELECT c_custkey, o_orderkey::VARCHAR, NULL, NULL, o_orderpriority, orders.o_orderkey
          FROM q LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderkey > 10 WHERE kind = 2
          UNION ALL SELECT c_custkey, NULL, NULL, n_name, NULL, NULL FROM q LEFT JOIN nation ON n_nationkey = c_nationkey WHERE kind = 1)
    SELECT c_custkey, o_orderkey, o_orderstatus, n_name, priority,
           CASE WHEN ord IS NOT NULL THEN row_number() OVER (PARTITION BY c_custkey ORDER BY ord) END AS frag_index,
           CASE WHEN ord IS NOT NULL OR n_name IS NOT NULL THEN 'success' ELSE 'empty' END AS route FROM a
    UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL, NULL, 'failure' FROM q WHERE kind = 3"""


def customer_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, each with the text of a query of one of three shapes, or of one that cannot run."""
    orders, nation = view(spark, sf_dir, "orders"), view(spark, sf_dir, "nation")
    kind = F.col("c_custkey") % 4
    key = text("c_custkey")
    query = (
        F.when(kind == 0, F.concat(F.lit(f"SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_custkey = "), key))
        .when(kind == 1, F.concat(F.lit(f"SELECT n_name FROM {nation} WHERE n_nationkey = "), text("c_nationkey")))
        .when(kind == 2, F.concat(F.lit(f"SELECT o_orderkey, o_orderpriority AS priority FROM {orders} WHERE o_custkey = "), key, F.lit(" AND o_orderstatus = 'F' AND o_orderkey > 10;")))
        .otherwise(F.lit("SELECT FROM nothing"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", query.alias("content"))


@register("sql_rows_content", CONTENT_SQL)
def sql_rows_content(spark, sf_dir):
    rows = sql.sql_rows_content(customer_queries(spark, sf_dir), parent=["c_custkey"], order_by="o_orderkey")
    return rows.select("c_custkey", "o_orderkey", "o_orderstatus", "n_name", "priority", "frag_index", "route")


@register(
    "sql_scalar_content",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN coalesce(n, 0)::VARCHAR ELSE coalesce(low::VARCHAR, '') END AS answer
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS low FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def sql_scalar_content(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    what = F.when(F.col("c_custkey") % 2 == 0, "count(*)").otherwise("min(o_orderkey)")
    query = F.concat(F.lit("SELECT "), what, F.lit(f" FROM {orders} WHERE o_custkey = "), text("c_custkey"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", query.alias("query"))
    return sql.sql_scalar_content(rows, "query", "answer").select("c_custkey", "answer")


@register(
    "enrich_rows",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'order ' || o_orderkey END AS label,
           CASE WHEN o_orderkey % 2 = 0 THEN coalesce(s_name, 'nobody') END AS supplier,
           CASE WHEN o_orderkey % 2 = 1 THEN '{"cust":' || o_custkey || ',"miss":-1,"nation":' || c_nationkey || ',"plain":"' || o_orderstatus || '","segment":"' || c_mktsegment || '"}' END AS content,
           'success' AS route
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey""",
)
def enrich_rows(spark, sf_dir):
    """Two configs in one table."""
    attributes = {"extract-to-attributes": {"label": "order ${o_orderkey}", "supplier": {"type": "CACHE", "value": "k${o_custkey}", "default": "nobody"}}}
    fields = {
        "plain": "${o_orderstatus}",
        "cust": {"value": "${o_custkey}", "to-type": "long"},
        "miss": {"type": "CACHE_KEY", "value": "none-${o_custkey}", "default": -1, "to-type": "int"},
        "nation": {"type": "HBASE_FILTER", "hbase-table": "customer", "value": "RowFilter(=, 'binary:${o_custkey}')", "to-type": "int"},
        "segment": {"type": "SQL", "value": f"SELECT max(c_mktsegment) FROM {view(spark, sf_dir, 'customer')} WHERE c_custkey = ${{o_custkey}}"},
    }
    config = F.when(F.col("o_orderkey") % 2 == 0, json.dumps(attributes)).otherwise(json.dumps({"extract-to-json": fields}))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", config.alias("config"))
    done = enrich.enrich_rows(rows, "config", kv=supplier_kv(spark, sf_dir), cells=customer_cells(spark, sf_dir))
    return done.select("o_orderkey", F.col("attributes.label").alias("label"), F.col("attributes.supplier").alias("supplier"), "content", "route")


@register("truncate_tables", "SELECT 'success' AS route, count(*) AS rows_before, 0::BIGINT AS rows_after FROM supplier")
def truncate_tables(spark, sf_dir):
    """A catalog table is filled, emptied and read."""
    name = f"flow_{uuid.uuid4().hex}"
    table(spark, sf_dir, "supplier").write.saveAsTable(name)
    try:
        before = spark.table(name).count()
        done = sql.truncate_tables(spark, name)
        after = spark.table(name).count()
    finally:
        spark.sql(f"DROP TABLE {name}")
    return done.select("route", F.lit(before).cast("bigint").alias("rows_before"), F.lit(after).cast("bigint").alias("rows_after"))


@register("cell_value", "SELECT c_custkey::VARCHAR AS row_key, c_mktsegment AS segment, NULL::VARCHAR AS missing FROM customer")
def cell_value(spark, sf_dir):
    rows = cells.scan_cells(customer_cells(spark, sf_dir), "customer", name_format="family.qualifier")
    return rows.select("row_key", cells.cell_value(F.col("attrs"), "f", "c_mktsegment").alias("segment"), cells.cell_value(F.col("attrs"), "g", "c_mktsegment").alias("missing"))


@register(
    "fragment_ids",
    """
    SELECT o_orderkey, sha256(o_custkey::VARCHAR || chr(31) || o_orderstatus) AS frag_id,
           row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS frag_index,
           count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS frag_count FROM orders""",
)
def fragment_ids(spark, sf_dir):
    rows = sequence.number_fragments(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])
    return rows.select("o_orderkey", "frag_id", "frag_index", "frag_count")


# --------------------------------------------------------------------------- state and sequences

STATE_SQL = {
    "gt": ("Greater Than", "max(event_type)"),
    "lt": ("Less Than", "min(event_type)"),
    "eq": ("Equal To", "first_value(event_type)"),
    "ne": ("Not Equal To", "last_value(event_type)"),
    "never": ("Never", "first_value(event_type)"),
}


def _state_sql(aggregate: str) -> str:
    return f"""
    WITH p AS (SELECT event_id, event_type, {aggregate} OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_state FROM events)
    SELECT event_id, previous_state, CASE WHEN previous_state IS NULL THEN 'initial' WHEN event_type < previous_state THEN 'less'
           WHEN event_type > previous_state THEN 'greater' ELSE 'equal' END AS route FROM p"""


def _state_query(setting: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = state.check_state(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id", replace_when=setting)
        return rows.select("event_id", "previous_state", "route")

    return query


for _name, (_setting, _aggregate) in STATE_SQL.items():
    register(f"check_state_{_name}", _state_sql(_aggregate))(_state_query(_setting))


@register("check_state_after", "SELECT user_id AS key, max(event_type) AS value FROM events GROUP BY user_id")
def check_state_after(spark, sf_dir):
    return state.check_state_after(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


HOLD_SQL = """
    WITH e AS (SELECT event_id, user_id || '.' || (CAST(json_extract_string(props, '$.k') AS INT) % 3) AS lock, 'd' || (value > 20)::INT AS dup,
                      CASE WHEN event_type IN ('purchase', 'error') THEN 'release' ELSE 'hold' END AS action FROM events),
    p AS (SELECT *, lag(action) OVER w AS last, coalesce(count(*) FILTER (action = 'release') OVER (PARTITION BY lock ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
          FROM e WINDOW w AS (PARTITION BY lock ORDER BY event_id)),
    h AS (SELECT *, CASE WHEN last = 'hold' THEN first_value(dup) OVER (PARTITION BY lock, seg ORDER BY event_id) END AS holder FROM p)
    SELECT event_id, lock, holder, CASE WHEN action = 'release' THEN CASE WHEN holder IS NULL THEN 'missing' ELSE 'success' END
           WHEN holder IS NULL THEN 'success' WHEN holder = dup THEN 'duplicate' ELSE 'busy' END AS route FROM h"""


def hold_requests(events: DataFrame) -> DataFrame:
    """Purchases and errors release, other events hold one of three locks per user."""
    return events.select(
        "event_id",
        "user_id",
        (F.get_json_object("props", "$.k").cast("int") % 3).alias("slot"),
        F.when(F.col("event_type").isin("purchase", "error"), "release").otherwise("hold").alias("action"),
        F.concat(F.lit("d"), (F.col("value") > 20).cast("int").cast("string")).alias("dup"),
    )


@register("hold_release", HOLD_SQL)
def hold_release(spark, sf_dir):
    rows = hold_requests(table(spark, sf_dir, "events"))
    return state.hold_release(rows, "user_id", "slot", "action", "event_id", duplicate="dup").select("event_id", "lock", "holder", "route")


SEQUENCE_SQL = """
    SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 1000 + 5 * n WHEN 'FURNITURE' THEN -7 + 5 * n ELSE 100 + 5 * (n - 1) END AS sequence_value
    FROM (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer)"""


def sequence_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("MACHINERY", 1000), ("FURNITURE", -7), ("UNUSED", 3)], batches.SEQUENCES)


@register("assign_sequence", SEQUENCE_SQL)
def assign_sequence(spark, sf_dir):
    rows = sequence.assign_sequence(
        table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", state=sequence_state(spark), start=100, increment=5
    )
    return rows.select("c_custkey", "sequence_value")


@register(
    "sequence_after",
    """
    SELECT c_mktsegment AS seq, CASE c_mktsegment WHEN 'MACHINERY' THEN 1000 + 5 * count(*) WHEN 'FURNITURE' THEN -7 + 5 * count(*) ELSE 95 + 5 * count(*) END AS value
    FROM customer GROUP BY c_mktsegment UNION ALL SELECT 'UNUSED', 3""",
)
def sequence_after(spark, sf_dir):
    return sequence.sequence_after(table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", state=sequence_state(spark), start=100, increment=5)


@register("assign_sequence_global", "SELECT o_orderkey, 10 + 3 * (row_number() OVER (ORDER BY o_orderkey) - 1) AS sequence_value FROM orders")
def assign_sequence_global(spark, sf_dir):
    rows = sequence.assign_sequence(table(spark, sf_dir, "orders").select("o_orderkey"), None, "o_orderkey", start=10, increment=3)
    return rows.select("o_orderkey", "sequence_value")


@register(
    "number_fragments",
    "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS frag_index, count(*) OVER (PARTITION BY user_id) AS frag_count FROM events",
)
def number_fragments(spark, sf_dir):
    rows = sequence.number_fragments(table(spark, sf_dir, "events").select("event_id", "user_id"), ["user_id"], "event_id")
    return rows.select("event_id", "frag_index", "frag_count")


# --------------------------------------------------------------------------- files and streams


@register("read_files", "SELECT doc_id, n_chars, md5(text) AS digest, 'part' AS filename FROM documents")
def read_files(spark, sf_dir):
    """Documents are written out as compressed files of bounded size and read back whole."""
    folder = scratch_path(spark, "files")
    documents = table(spark, sf_dir, "documents")
    lines = documents.select(F.to_json(F.struct("doc_id", "n_chars", "text")).alias("value"))
    lines.write.option("maxRecordsPerFile", 200).option("compression", "gzip").text(folder)
    found = files.read_files(spark, folder, regex=r"part-.*\.txt\.gz")
    # every line ends with a line break, so the last piece is empty
    line = F.explode(F.split(F.regexp_replace("content", r"\n$", ""), "\n")).alias("line")
    rows = found.select(F.regexp_extract("filename", r"^(part)-.*\.txt$", 1).alias("filename"), line)
    parsed = F.from_json("line", "doc_id bigint, n_chars bigint, text string")
    return rows.select("filename", parsed.alias("d")).select("d.doc_id", "d.n_chars", F.md5("d.text").alias("digest"), "filename")


FORCED_SQL = "SELECT doc_id, n_chars, md5(text) AS digest, codec FROM documents, (VALUES ('gzip'), ('bzip2'), ('deflate'), ('lz4'), ('snappy'), ('none')) t(codec)"


@register("read_files_forced", FORCED_SQL)
def read_files_forced(spark, sf_dir):
    """Documents are written as files of six formats, whose names end in nothing that tells, and read by a given one."""
    documents = table(spark, sf_dir, "documents")
    lines = documents.select(F.to_json(F.struct("doc_id", "n_chars", "text")).alias("value"))
    parts = []
    for codec, ending in (("gzip", "gz"), ("bzip2", "bz2"), ("deflate", "deflate"), ("lz4", "lz4"), ("snappy", "snappy"), ("none", "txt")):
        folder = scratch_path(spark, codec)
        lines.write.option("maxRecordsPerFile", 200).option("compression", codec).text(folder)
        files.rename_files(spark, folder, f".{ending}", ".data")
        found = files.read_files(spark, folder, regex=r"part-.*\.data", compression=codec)
        line = F.explode(F.split(F.regexp_replace("content", r"\n$", ""), "\n")).alias("line")
        parsed = found.where("route = 'success'").select(line).select(F.from_json("line", "doc_id bigint, n_chars bigint, text string").alias("d"))
        parts.append(parsed.select("d.doc_id", "d.n_chars", F.md5("d.text").alias("digest"), F.lit(codec).alias("codec")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _in_three(rows: DataFrame, part: Column, step: batches.Step, label: str, **options) -> str:
    """Let the rows arrive in three parts (``part`` is 0, 1 or 2), each in a run of the stream that goes on from the one before."""
    spark = rows.sparkSession
    folder = scratch_path(spark, label)
    for n in range(3):
        rows.where(part == n).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        batches.run_stateful(stream, step, f"{folder}/state", f"{folder}/out", f"{folder}/checkpoint", **options).awaitTermination()
    return folder


def _thirds(rows: DataFrame, column: str) -> Column:
    """The third a row lies in, by an order column."""
    low, high = rows.approxQuantile(column, [1 / 3, 2 / 3], 0.01)
    return F.when(F.col(column) <= low, 0).when(F.col(column) <= high, 1).otherwise(2)


@register("stream_check_state", _state_sql("max(event_type)"))
def stream_check_state(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("user_id", text("user_id"))
    folder = _in_three(events, _thirds(events, "event_id"), batches.check_state_step("user_id", "event_type", "event_id"), "check-state")
    return spark.read.parquet(f"{folder}/out").select("event_id", "previous_state", "route")


#: Three parts of the events' time; a user's state ends where the user is idle for longer than half a day between two parts.
PART_BOUNDS = ("2024-01-11", "2024-01-21")
STREAM_TTL_SQL = f"""
    WITH e AS (SELECT event_id, user_id, event_type, ts,
                      CASE WHEN ts < TIMESTAMP '{PART_BOUNDS[0]}' THEN 0 WHEN ts < TIMESTAMP '{PART_BOUNDS[1]}' THEN 1 ELSE 2 END AS part FROM events),
    b AS (SELECT user_id, part, min(ts) AS first, max(ts) AS last FROM e GROUP BY user_id, part),
    g AS (SELECT *, coalesce(lag(last) OVER (PARTITION BY user_id ORDER BY part) + INTERVAL 12 HOUR < first, false) AS idle FROM b),
    s AS (SELECT user_id, part, sum(idle::INTEGER) OVER (PARTITION BY user_id ORDER BY part) AS life FROM g),
    r AS (SELECT e.*, s.life, lag(event_type) OVER (PARTITION BY e.user_id, s.life ORDER BY e.part, event_id) AS previous_state
          FROM e JOIN s ON s.user_id = e.user_id AND s.part = e.part)
    SELECT event_id, previous_state, CASE WHEN previous_state IS NULL THEN 'initial' WHEN event_type < previous_state THEN 'less'
                                          WHEN event_type > previous_state THEN 'greater' ELSE 'equal' END AS route FROM r"""


@register("stream_check_state_ttl", STREAM_TTL_SQL)
def stream_check_state_ttl(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("user_id", text("user_id"))
    step = batches.check_state_step("user_id", "event_type", "event_id", replace_when="Not Equal To")
    low, high = (F.lit(b).cast("timestamp") for b in PART_BOUNDS)
    part = F.when(F.col("ts") < low, 0).when(F.col("ts") < high, 1).otherwise(2)
    folder = _in_three(events, part, step, "check-state-ttl", time="ts", ttl=12 * 3600)
    return spark.read.parquet(f"{folder}/out").select("event_id", "previous_state", "route")


@register("stream_hold_release", HOLD_SQL)
def stream_hold_release(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    step = batches.hold_release_step("user_id", "slot", "action", "event_id", duplicate="dup")
    folder = _in_three(hold_requests(events), _thirds(events, "event_id"), step, "hold-release")
    return spark.read.parquet(f"{folder}/out").select("event_id", "lock", "holder", "route")


@register("stream_sequence", SEQUENCE_SQL)
def stream_sequence(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    step = batches.sequence_step("c_mktsegment", "c_custkey", start=100, increment=5)
    folder = _in_three(customer, _thirds(customer, "c_custkey"), step, "sequence", initial=sequence_state(spark))
    return spark.read.parquet(f"{folder}/out").select("c_custkey", "sequence_value")


@register("stream_apply_changes", CDC_APPLY_SQL)
def stream_apply_changes(spark, sf_dir):
    """The changes arrive out of order: a third of them, whatever their places, in every micro-batch."""
    base = customer_base(spark, sf_dir)
    step = batches.apply_changes_step(base.schema, ["c_custkey"], case="Lower")
    folder = _in_three(_event_changes(table(spark, sf_dir, "events")), F.pmod(F.xxhash64("content"), F.lit(3)), step, "apply-changes", initial=base)
    return batches.read_changed(spark, step, f"{folder}/state", base.schema, ["c_custkey"])
