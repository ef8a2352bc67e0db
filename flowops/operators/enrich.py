"""Config-driven enrichment: templates, lookups, defaults and type conversion.

The config has the sections ``extract-to-attributes`` and ``extract-to-json``. An entry is a
template or ``{"value": template, "type": kind, "default": any, "to-type": name}``. Kinds:

* ``CACHE`` / ``CACHE_KEY``: the value is a key of the key/value table ``kv``;
* ``HBASE`` / ``HBASE_SCAN`` / ``HBASE_FILTER``: the value is a row-key filter on the cells of
  ``"hbase-table"``: ``RowFilter(=, 'binary:<key>')`` or ``PrefixFilter('<prefix>')``, or both
  on the same text (then the key decides); the result is the last cell of the matching row;
* ``SQL``: the value is a query, ``${name}`` being a column; the result is its first column in
  the row that is first by the result columns ``"order-by"``.

Every lookup becomes one left join with a lookup side of one row per key.

``enrich`` takes one config for all records and makes a column of every attribute. ``enrich_rows``
takes a config from each record: entries become rows, every kind of lookup is one join for
all entries of all records, and the results are gathered by record again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maps import materialise
from ..functions.template import quoted, template, template_text
from ..functions.values import TYPE_NAMES, convert, convert_failed
from ..routes import FAILURE, REASON, ROUTE, SUCCESS, with_route
from ..session import cut_lineage, spread
from ..sources.sql import lateral_first, sql_scalar_content
from .cells import lookup_cells, scan

#: Different configs of a table that are read apart from its records, at most.
MAX_CONFIGS = 10_000

TO_ATTRIBUTES = "extract-to-attributes"
TO_JSON = "extract-to-json"

# The lookup kinds of an entry.
CACHE_KINDS = ("CACHE", "CACHE_KEY")
CELL_KINDS = ("HBASE", "HBASE_SCAN", "HBASE_FILTER")

# The two row filters a cell lookup understands.
_ROW_FILTER = re.compile(r"RowFilter\s*\(\s*=\s*,\s*'binary:(?P<key>[^']*)'\s*\)")
_PREFIX_FILTER = re.compile(r"PrefixFilter\s*\(\s*'(?P<prefix>[^']*)'\s*\)")


class _Plan:
    """The frame while columns are added, and the conditions that send a row to failure."""

    def __init__(self, df: DataFrame, kv: DataFrame | None, cells: DataFrame | None):
        self.frame = df
        self.names = df.columns
        self.kv = kv
        self.cells = cells
        self.failures: list[tuple[Column, Any]] = []
        self.added: list[str] = []
        self._seen: dict[tuple, str] = {}

    def add(self, column: Column) -> str:
        name = f"__e{len(self.added)}"
        self.frame = self.frame.withColumn(name, column)
        self.added.append(name)
        return name

    def once(self, identity: tuple, build) -> str:
        """Entries that look up the same key in the same table share one join."""
        if identity not in self._seen:
            self._seen[identity] = build()
        return self._seen[identity]

    def cache(self, key_text: str) -> str:
        def build() -> str:
            if self.kv is None:
                raise ValueError("a CACHE entry needs the kv table")
            key = self.add(template(key_text, self.names))
            found = f"{key}_v"
            # one row per key, so that a key the table has twice fails its records and doubles none
            lookup = self.kv.groupBy(F.col("key").alias("__key")).agg(F.min("value").alias(found), F.count(F.lit(1)).alias("__rows"))
            self.frame = self.frame.join(lookup, F.nullif(F.col(key), F.lit("")) == F.col("__key"), "left").drop("__key")
            self.added.append(found)
            several = self.add(F.col("__rows") > 1)
            self.frame = self.frame.drop("__rows")
            self.failures.append((F.col(several), F.concat(F.lit("more than one row for the key "), F.col(key))))
            return found

        return self.once(("kv", key_text), build)

    def cell(self, table: str, filter_text: str) -> str:
        def build() -> str:
            if self.cells is None:
                raise ValueError("a cell lookup needs the cells table")
            exact, prefix = _ROW_FILTER.search(filter_text), _PREFIX_FILTER.search(filter_text)
            if exact:
                wanted, by_prefix = exact.group("key"), False
                if prefix and prefix.group("prefix") != wanted:
                    raise ValueError(f"a key filter with another prefix is not supported: {filter_text}")
            elif prefix:
                wanted, by_prefix = prefix.group("prefix"), True
            else:
                raise ValueError(f"row filter not understood: {filter_text}")
            key = self.add(template(wanted, self.names))
            found = f"{key}_v"
            self.frame = lookup_cells(self.frame, scan(self.cells, table), key, prefix=by_prefix, output=found)
            why = self.add(F.col(REASON))
            self.frame = self.frame.drop(ROUTE, REASON)
            self.failures.append((F.col(why).isNotNull(), F.concat(F.lit(f"{table}: "), F.col(why))))
            self.added.append(found)
            return found

        return self.once(("cells", table, filter_text), build)

    def query(self, sql: str, order_by: str | list[str] | None) -> str:
        def build() -> str:
            found = f"__e{len(self.added)}"
            joined = lateral_first(self.frame, sql, order_by)
            self.frame = joined.withColumn(found, F.col("__first").cast("string")).drop("__first", "__hit")
            self.added.append(found)
            return found

        return self.once(("sql", sql, str(order_by)), build)


def _entry(plan: _Plan, key: str, entry: Any) -> Column:
    """The value of one entry; also notes when it cannot be converted."""
    if entry is None:
        return F.lit(None).cast("string")
    if not isinstance(entry, Mapping):
        return template(entry if isinstance(entry, str) else json.dumps(entry), plan.names)
    default, to_type = entry.get("default"), entry.get("to-type")
    text = entry.get("value")
    if text is None or text == "":
        found = F.lit(None).cast("string")
    else:
        text = text if isinstance(text, str) else json.dumps(text)
        kind = entry.get("type", "")
        if kind in CACHE_KINDS:
            found = F.col(plan.cache(text))
        elif kind in CELL_KINDS:
            if "hbase-table" not in entry:
                raise ValueError(f"hbase-table argument missing for {key}")
            found = F.col(plan.cell(entry["hbase-table"], text))
        elif kind == "SQL":
            found = F.col(plan.query(text, entry.get("order-by")))
        else:
            found = template(text, plan.names)
    found = F.nullif(found, F.lit(""))
    if to_type is None and isinstance(default, (bool, int, float)):
        # an untyped default keeps its own JSON type, a found value stays text
        return F.coalesce(found.cast("variant"), F.parse_json(F.lit(json.dumps(default))))
    fallback = None if default is None else default if isinstance(default, str) else json.dumps(default)
    chosen = F.coalesce(found, F.lit(fallback).cast("string"))
    if to_type is None:
        return chosen
    held = F.col(plan.add(chosen))
    plan.failures.append((convert_failed(held, to_type), F.concat(F.lit(f"{key}: not a {to_type}: "), held)))
    return convert(held, to_type)


def enrich(
    df: DataFrame,
    config: str | Mapping[str, Any],
    *,
    kv: DataFrame | None = None,
    cells: DataFrame | None = None,
    content: str = "content",
) -> DataFrame:
    """Add the configured attributes as text columns and the JSON section as ``content``.

    A value that cannot be converted, a key that ``kv`` has more than once, and a cell filter that
    matches several rows, send the record to ``failure``. Later sections see the columns of
    the record, not those of the section before.
    """
    config = json.loads(config) if isinstance(config, str) else config
    plan = _Plan(df, kv, cells)
    attributes = {k: _entry(plan, k, v) for k, v in (config.get(TO_ATTRIBUTES) or {}).items()}
    fields = {k: _entry(plan, k, v) for k, v in (config.get(TO_JSON) or {}).items()}
    rows = with_route(plan.frame, plan.failures)
    failed = F.col(ROUTE) == FAILURE
    outputs = {k: F.when(~failed, v.cast("string")) for k, v in attributes.items()}
    if TO_JSON in config:
        document = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}) if fields else F.lit("{}")
        old = F.col(quoted(content)) if content in df.columns else F.lit(None).cast("string")
        outputs[content] = F.when(failed, old).otherwise(document)
    keep = [F.col(quoted(c)) for c in df.columns if c not in outputs]
    return rows.select(*keep, *[v.alias(k) for k, v in outputs.items()], ROUTE, REASON)


# ----------------------------------------------------------------------- a config in every record


def _member(entry: Column, name: str) -> Column:
    return F.try_variant_get(entry, f"$['{name}']", "variant")


def _plain_text(value: Column) -> Column:
    """Text of a JSON value: a string as it is, anything else as JSON; null where there is none."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).when(kind != "VOID", F.to_json(value))


def _entry_rows(configs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per entry of a config (``__config``): what it is, its text, and what it falls back to; with the columns ``keep``."""
    sections = F.array(*[F.struct(F.lit(k).alias("section"), F.try_variant_get(F.col("__config"), f"$['{name}']", "map<string,variant>").alias("entries")) for k, name in enumerate((TO_ATTRIBUTES, TO_JSON))])
    rows = configs.select(*keep, F.explode(sections).alias("s"))
    rows = rows.select(*keep, F.col("s.section").alias("section"), F.explode("s.entries").alias("name", "entry"))
    mapping = F.schema_of_variant("entry").startswith("OBJECT")
    member = lambda name: F.when(mapping, _member(F.col("entry"), name))
    default = member("default")
    shape = F.schema_of_variant(default)
    # an untyped default keeps its own JSON type, a found value stays text
    typed = shape.isin("BOOLEAN", "BIGINT", "DOUBLE") | shape.startswith("DECIMAL")
    text = F.when(mapping, _plain_text(member("value"))).otherwise(_plain_text(F.col("entry")))
    kind = F.coalesce(_plain_text(member("type")), F.lit(""))
    kind = F.when(kind.isin(*CACHE_KINDS), "cache").when(kind.isin(*CELL_KINDS), "cell").when(kind == "SQL", "sql").otherwise("text")
    return rows.select(
        *keep,
        "section",
        "name",
        mapping.alias("mapping"),
        F.when(F.coalesce(text, F.lit("")) == "", "none").otherwise(kind).alias("kind"),
        text.alias("text"),
        _plain_text(member("hbase-table")).alias("cell_table"),
        _plain_text(member("to-type")).alias("to_type"),
        _plain_text(default).alias("default"),
        F.when(F.coalesce(typed, F.lit(False)), default).alias("typed_default"),
    )


def _found(entries: DataFrame, kv: DataFrame | None, cells: DataFrame | None, max_shapes: int | None) -> DataFrame:
    """All entries with ``found`` and ``why`` (null unless the lookup failed). Lookups keep the entry's columns, so nothing is joined to them again."""
    keys = entries.columns
    none = F.lit(None).cast("string")
    parts = [entries.where("kind in ('none', 'text')").select(*keys, none.alias("found"), none.alias("why"))]

    asked = entries.where("kind = 'cache'").withColumn("__asked", F.nullif("text", F.lit("")))
    if kv is None:
        parts.append(asked.select(*keys, none.alias("found"), F.lit("a CACHE entry needs the kv table").alias("why")))
    else:
        lookup = kv.groupBy(F.col("key").alias("__key")).agg(F.min("value").alias("found"), (F.count(F.lit(1)) > 1).alias("__many"))
        joined = asked.join(lookup, F.col("__asked") == F.col("__key"), "left")
        parts.append(joined.select(*keys, "found", F.when(F.col("__many"), F.concat(F.lit("more than one row for the key "), F.col("__asked"))).alias("why")))

    asked = entries.where("kind = 'cell'")
    exact, prefix = (F.regexp_extract_all("text", F.lit(p.pattern.replace("?P<key>", "").replace("?P<prefix>", "")), F.lit(1)) for p in (_ROW_FILTER, _PREFIX_FILTER))
    asked = asked.withColumns({"__exact": F.get(exact, 0), "__prefix": F.get(prefix, 0)})
    wrong = (
        F.when(F.col("cell_table").isNull(), F.concat(F.lit("hbase-table argument missing for "), F.col("name")))
        .when(F.col("__exact").isNull() & F.col("__prefix").isNull(), F.concat(F.lit("row filter not understood: "), F.col("text")))
        .when(F.col("__prefix") != F.col("__exact"), F.concat(F.lit("a key filter with another prefix is not supported: "), F.col("text")))
    )
    asked = asked.withColumn("__wrong", F.lit("a cell lookup needs the cells table") if cells is None else wrong)
    parts.append(asked.where("__wrong is not null").select(*keys, none.alias("found"), F.col("__wrong").alias("why")))
    if cells is not None:
        # table and row key together are one key, so all tables are looked up at once
        whole = cells.withColumn("row_key", F.concat("table", F.lit("\x01"), "row_key"))
        asked = asked.where("__wrong is null")
        for by_prefix, test in ((False, F.col("__exact").isNotNull()), (True, F.col("__exact").isNull())):
            own = asked.where(test).select(*keys, F.concat("cell_table", F.lit("\x01"), F.coalesce("__exact", "__prefix")).alias("__row"))
            hits = lookup_cells(own, whole, "__row", prefix=by_prefix, output="found")
            parts.append(hits.select(*keys, "found", F.concat("cell_table", F.lit(": "), REASON).alias("why")))

    # a query may take a bare name for a column of its record, so the entry's own are out of its sight
    place = ["__rid", "section", "name"]
    rest = [c for c in keys if c not in place]
    asked = entries.where("kind = 'sql'").select(*place, F.struct(*rest).alias("__entry"), F.col("text").alias("__sql"))
    told = sql_scalar_content(asked, "__sql", "found", max_shapes=max_shapes)
    parts.append(told.select(*place, *[F.col(f"__entry.{c}").alias(c) for c in rest], "found", F.when(F.col(ROUTE) == FAILURE, F.coalesce(REASON, F.lit("the query failed"))).alias("why")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _as_variant(value: Column, to_type: Column) -> Column:
    """Text as a value of the named type; null where it is none."""
    typed = F.when(to_type.isNull() | ~to_type.isin(*TYPE_NAMES), value.cast("variant"))
    for name in TYPE_NAMES:
        typed = typed.when(to_type == name, convert(value, name).cast("variant"))
    return typed


def enrich_rows(
    df: DataFrame,
    config: str = "content",
    *,
    kv: DataFrame | None = None,
    cells: DataFrame | None = None,
    content: str = "content",
    attributes: str = "attributes",
    max_shapes: int | None = None,
) -> DataFrame:
    """:func:`enrich` with a config from every record, the JSON text in the column ``config``.

    The attributes are a map, since names differ from record to record; records whose config has
    the JSON section get it as ``content``. A text that is no JSON object, a filter that is not
    understood, and a query that Spark cannot analyse, send the record to ``failure`` as well. Queries that differ in
    literals only share a plan (:func:`~flowops.sources.sql.sql_rows_content`), and all of them run; the text after
    filling in must name what it reads, and an ``order-by`` is not taken.
    """
    names = df.columns
    given = F.col(quoted(config)).cast("string")
    # written, so that a record keeps its number
    records = cut_lineage(spread(df).withColumns({"__rid": F.monotonically_increasing_id(), "__given": given}), "records")
    values = F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*[F.col(quoted(c)).cast("string") for c in names])).alias("__values")
    parsed = F.try_parse_json("__given").alias("__config")
    # whether a config is an object, and has the JSON section
    flags = [F.schema_of_variant("__config").startswith("OBJECT").alias("__object"), F.try_variant_get("__config", f"$['{TO_JSON}']", "map<string,variant>").isNotNull().alias("__has_json")]
    if records.select(F.xxhash64("__given")).distinct().limit(MAX_CONFIGS + 1).count() <= MAX_CONFIGS:
        # few texts: each is read once, for all its records
        configs = cut_lineage(records.select("__given").where("__given is not null").distinct().select("__given", parsed), "configs")
        asked = cut_lineage(_entry_rows(configs, ["__given"]), "config-entries")
        entries = records.select("__rid", "__given", values).join(F.broadcast(asked), "__given").drop("__given")
        records = records.join(F.broadcast(configs.select("__given", *flags)), "__given", "left")
    else:
        entries = _entry_rows(records.select("__rid", values, parsed), ["__rid", "__values"])
        records = materialise(records, {"__config": parsed}).select("*", *flags).drop("__config")
    entries = cut_lineage(entries.withColumn("text", template_text(F.col("text"), F.col("__values"))).drop("__values"), "entries")
    joined = _found(entries, kv, cells, max_shapes)
    keys = ["__rid", "section", "name"]
    looked = F.nullif(F.when(F.col("kind") == "none", F.lit(None).cast("string")).when(F.col("kind") == "text", F.col("text")).otherwise(F.col("found")), F.lit(""))
    chosen = F.coalesce(looked, F.col("default"))
    failed = F.col("to_type").isNotNull() & chosen.isNotNull() & _as_variant(chosen, F.col("to_type")).isNull()
    plain = F.when(F.col("kind") == "none", F.when(F.col("text").isNotNull(), F.col("text"))).otherwise(F.col("text"))
    value = (
        F.when(~F.col("mapping"), plain.cast("variant"))
        .when(F.col("to_type").isNull() & F.col("typed_default").isNotNull(), F.coalesce(looked.cast("variant"), F.col("typed_default")))
        .otherwise(_as_variant(chosen, F.col("to_type")))
    )
    why = F.coalesce("why", F.when(failed, F.concat(F.col("name"), F.lit(": not a "), F.col("to_type"), F.lit(": "), chosen)))
    told = joined.select(*keys, value.alias("value"), why.alias("why"))
    pair = lambda section, v: F.collect_list(F.when(F.col("section") == section, F.struct(F.col("name").alias("k"), v.alias("v"))))
    gathered = told.groupBy(F.col("__rid").alias("__of")).agg(
        F.min(F.when(F.col("why").isNotNull(), F.struct("section", "name", "why"))).alias("__why"),
        pair(0, F.col("value").cast("string")).alias("__attributes"),
        pair(1, F.to_json("value")).alias("__json"),
    )
    rows = records.join(gathered, F.col("__rid") == F.col("__of"), "left")
    reason = F.when(~F.coalesce("__object", F.lit(False)), "the config is not a JSON object").otherwise(F.col("__why.why"))
    route = F.when(reason.isNull(), SUCCESS).otherwise(FAILURE)
    none = F.array().cast("array<struct<k:string,v:string>>")
    made = F.map_from_entries(F.coalesce(F.array_sort("__attributes"), none))
    fields = F.array_sort(F.coalesce("__json", none))
    document = F.concat(F.lit("{"), F.array_join(F.transform(fields, lambda e: F.concat(_json_text(e["k"]), F.lit(":"), F.coalesce(e["v"], F.lit("null")))), ","), F.lit("}"))
    old = F.col(quoted(content)).cast("string") if content in names else F.lit(None).cast("string")
    outputs = {
        content: F.when((route == SUCCESS) & F.col("__has_json"), document).otherwise(old),
        attributes: F.when(route == SUCCESS, made),
    }
    keep = [F.col(quoted(c)) for c in names if c not in outputs]
    return rows.select(*keep, *[v.alias(k) for k, v in outputs.items()], route.alias(ROUTE), reason.alias(REASON))


def _json_text(text: Column) -> Column:
    """A JSON string."""
    return F.to_json(text.cast("variant"))
