"""One query per operator over its whole table; SQL equivalents where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lm
from .conversations import damaged, report
from .decontaminate import decontaminate
from .jaccard import jaccard_components
from .langid import identify, learn
from .linededup import line_dedup
from .packing import pack, token_pieces
from .periodic import periodic_runs, repeated_tail
from .quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, SYMBOLS, quality, stop_words
from .sharding import GROUP_SHARE, shard
from .suffixes import repeated_passages
from .toxicity import toxicity
from .urlfilter import UrlRule, filter_urls

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


#: Words of a text, in SQL.
SQL_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# ------------------------------------------------------------------------------------- sharding

SHARDS = 8


@register(
    "op1_sharding",
    f"""
    WITH RECURSIVE
    poly(i, k, c) AS (
        SELECT i, 0, i::BIGINT FROM range(256) t(i)
        UNION ALL
        SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM poly WHERE k = 8),
    d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h,
                 coalesce(md5(text), '') AS m, coalesce(doc_id::VARCHAR, '') AS i FROM documents),
    sums AS (
        SELECT d.*, sum(size) OVER () AS total, max(size) OVER () AS largest,
               coalesce(sum(size) OVER (ORDER BY m, i, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
               row_number() OVER (ORDER BY m, i, size) AS rn FROM d),
    grouped AS (SELECT *, min(pos) OVER (PARTITION BY m) AS group_at, sum(size) OVER (PARTITION BY m) AS group_bytes FROM sums),
    placed AS (
        SELECT *, least({SHARDS - 1}, floor((CASE WHEN group_bytes <= greatest(total / {SHARDS} / {GROUP_SHARE}, largest) THEN group_at + group_bytes / 2
                                             ELSE pos + size / 2 END) * {SHARDS} / total))::INTEGER AS shard FROM grouped)
    SELECT doc_id, size::BIGINT AS size,
           xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(0, length(h) // 2), lambda x: ('0x' || substr(h, 2 * x + 1, 2))::BIGINT)),
               lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
           'bytes' AS law, shard, (rn - min(rn) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM placed, crc""",
)
def op1_sharding(spark, sf_dir):
    placed = shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# --------------------------------------------------------------------------------------- quality


def _sql_rules() -> str:
    checks = []
    for rule in RULES:
        if rule.least is not None:
            checks.append(f"{rule.count} >= {rule.least} * {rule.of}")
        if rule.most is not None:
            checks.append(f"{rule.count} <= {rule.most} * {rule.of}")
    return " AND ".join(checks)


@register(
    "op3_quality",
    rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, text, {SQL_WORDS.format("text")} AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
    g AS (SELECT doc_id, i, md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
    twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
    c AS (SELECT w.doc_id, len(w) AS n_words, length(list_aggregate(list_append(w, ''), 'string_agg', '')) AS word_chars,
                 length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
                 len(list_filter(w, lambda x: x IN ({", ".join(repr(x) for x in stop_words())}))) AS n_stop_words,
                 CASE WHEN 4 * strlen(text) <= 5 * length(text) THEN len(w) ELSE 0 END AS n_latin_words,
                 len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                 len(list_filter(lines, lambda x: regexp_matches(x, '\.\.\. *$'))) AS n_ellipsis_lines,
                 coalesce(r.n, 0) AS n_repeat_words
          FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
    b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {_sql_rules()} AS kept FROM b""",
)
def op3_quality(spark, sf_dir):
    judged = quality(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# --------------------------------------------------------------------------------- Jaccard join


@register(
    "op4_jaccard",
    rf"""
    WITH RECURSIVE
    w AS (SELECT doc_id, {SQL_WORDS.format(SQL_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + least(4, len(w)) - 1], ' ')) AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM w)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
    sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT sym.b, r.c FROM r JOIN sym ON sym.a = r.doc_id)
    SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
    FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
)
def op4_jaccard(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


# ------------------------------------------------------------------------------------------ urls

URL_RULES = [
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
]
_SQL_URL_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)


@register(
    "op6_url_filter",
    rf"""
    WITH rules(h, p, v) AS (VALUES {_SQL_URL_RULES}),
    u AS (SELECT page_id, {SQL_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    f AS (SELECT page_id, h || p AS rule, v FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
          QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) = 1)
    SELECT u.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN f ON f.page_id = u.page_id""",
)
def op6_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


# ------------------------------------------------------------------------------------ line dedup


@register(
    "op8_line_dedup",
    rf"""
    WITH
    t AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM t),
    o AS (SELECT doc_id, pos, {SQL_WORDS.format("line")} AS w FROM l),
    d AS (SELECT w, len(w) AS n, min((doc_id, pos)) AS first FROM o WHERE len(w) > 0 GROUP BY w),
    h AS (SELECT *, unnest([n, n - 1]) AS m FROM d WHERE n >= 8),
    k AS (SELECT *, unnest([md5(array_to_string(w[1:m // 2], ' ')) || 'f', md5(array_to_string(w[n - (m - m // 2) + 1:n], ' ')) || 'l']) AS k FROM h),
    p AS (SELECT DISTINCT a.w AS w, b.w AS v, b.first AS first FROM k a JOIN k b ON a.m = b.m AND a.k = b.k AND b.first < a.first AND abs(a.n - b.n) <= 1),
    near AS (
        SELECT w, min(first) AS first FROM p
        WHERE CASE WHEN len(w) = len(v) THEN len(list_filter(range(1, len(w) + 1), lambda i: w[i] <> v[i])) <= 1
                   WHEN len(w) > len(v) THEN len(list_filter(range(1, len(w) + 1), lambda i: list_concat(w[1:i - 1], w[i + 1:]) = v)) > 0
                   ELSE len(list_filter(range(1, len(v) + 1), lambda i: list_concat(v[1:i - 1], v[i + 1:]) = w)) > 0 END
        GROUP BY w),
    e AS (SELECT d.w, coalesce(near.first, d.first) AS earliest FROM d LEFT JOIN near ON near.w = d.w),
    gone AS (SELECT doc_id, pos FROM o JOIN e ON o.w = e.w WHERE (doc_id, pos) > earliest)
    SELECT l.doc_id, count(*) AS n_lines, count(gone.pos) AS n_dropped,
           md5(coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL), '')) AS text_md5
    FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos GROUP BY l.doc_id""",
)
def op8_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents"), [F.col("doc_id")]).select("doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("text_md5"))


# --------------------------------------------------------------------------------------- packing

CAPACITY = 2048


@register("op9_packing")
def op9_packing(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = token_pieces(table(spark, sf_dir, "documents"), tokenizer, CAPACITY)
    return pack(pieces, CAPACITY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# ------------------------------------------------------------------------------- decontamination

_SQL_NORMAL_WORDS = "list_filter(regexp_split_to_array(" + SQL_LOWER + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


@register(
    "op10_decontamination",
    rf"""
    WITH
    items AS (SELECT DISTINCT item_id::VARCHAR AS item, {_SQL_NORMAL_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
    windows AS (SELECT DISTINCT item, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
                FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT k FROM windows),
    t AS (SELECT doc_id, {_SQL_NORMAL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    g AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM t, sizes)),
    m AS (SELECT doc_id, i, g.k, item FROM g JOIN windows ON g.g = windows.g AND g.k = windows.k),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
    it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM m GROUP BY doc_id)
    SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM t LEFT JOIN hit ON hit.doc_id = t.doc_id LEFT JOIN it ON it.doc_id = t.doc_id""",
)
def op10_decontamination(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")

# ----------------------------------------------------------------------------------- language id


@register("op5_language_id")
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = learn(docs.where(~held_out))
    return identify(docs, model, [F.col("doc_id"), held_out.alias("held_out")]).select("doc_id", "held_out", "lang_pred", "score")

# ------------------------------------------------------------------------------------ LM scoring


@register("op7_lm_scoring")
def op7_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = lm.learn(docs.where(~held_out))
    return lm.score_texts(docs, model, [F.col("doc_id"), held_out.alias("held_out")])

# ------------------------------------------------------------------------------ repeated passages


@register(
    "op2_repeated_passages",
    rf"""
    WITH
    w AS (SELECT doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
    r AS (SELECT g FROM g GROUP BY g HAVING min(doc_id) <> max(doc_id)),
    p AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM r)),
    b AS (SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS fresh FROM p),
    n AS (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM b)
    SELECT doc_id, (min(i) - 1)::BIGINT AS start, (max(i) - min(i) + 50)::BIGINT AS n_words FROM n GROUP BY doc_id, k""",
)
def op2_repeated_passages(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


# -------------------------------------------------------------------------------------- toxicity


@register("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    def held_out(key):
        return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    scored = toxicity(docs, labels, [F.col("doc_id"), held_out("doc_id").alias("held_out")])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# --------------------------------------------------------------------------------- conversations

#: CRC-32 of a short text, given as hexadecimal digits, in SQL; needs the table ``crc``.
SQL_CRC_TABLE = """
    poly(i, k, c) AS (
        SELECT i, 0, i::BIGINT FROM range(256) t(i)
        UNION ALL
        SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM poly WHERE k = 8)"""
SQL_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(0, length({0}) // 2), lambda x: ('0x' || substr({0}, 2 * x + 1, 2))::BIGINT)),
               lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1])), 4294967295)"""


def _sql_way(way: str, cost: str, letter: str, line: str = "''") -> str:
    """A way to a state with one more edit. A way is one text: its cost, its edits, a mark, the
    repaired lines; so the least text is the cheapest way, and of equal ones that of the least edits."""
    more = f"lpad((left({way}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || split_part(substr({way}, 10), chr(1), 1) || '{letter}' || chr(1) || split_part(substr({way}, 10), chr(1), 2) || {line}"
    return f"CASE WHEN {way} IS NOT NULL THEN {more} END"


def _sql_next() -> str:
    """The ways to each state (n: nothing yet, s, u, a) behind row r, from those before it."""

    def keep(way: str, initial: str) -> str:
        return f"CASE WHEN NOT r.gone AND r.initial = '{initial}' THEN {_sql_way(way, 'r.late', 'K', 'r.role || chr(58) || r.text || chr(2)')} END"

    def rerole(way: str, role: str) -> str:
        return f"CASE WHEN NOT r.gone THEN {_sql_way(way, '3 + r.late', 'R', f"'{role}:' || r.text || chr(2)")} END"

    into_user = ", ".join([keep(w, "u") for w in "nsa"] + [rerole(w, "user") for w in "nsa"])
    deleted = {w: _sql_way(w, "4", "D") for w in "nsua"}
    return f"{deleted['n']} AS n, least({deleted['s']}, {keep('n', 's')}) AS s, least({deleted['u']}, {into_user}) AS u, least({deleted['a']}, {keep('u', 'a')}, {rerole('u', 'assistant')}) AS a"


def _sql_insert(source: str) -> str:
    """The same ways, where up to two rows may have been inserted last."""
    user = ", ".join(["u", *(_sql_way(w, "3", "I", "'user:' || chr(2)") for w in "nsa")])
    assistant = f"a, {_sql_way('u', '3', 'I', "'assistant:' || chr(2)")}"
    for _ in range(2):
        source = f"(SELECT conv_id, i, n, s, least({user}) AS u, least({assistant}) AS a FROM {source})"
    return source


_SQL_FIRST_WAYS = _sql_insert("(SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' || chr(1) AS n, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM r)")
_SQL_NEXT_WAYS = _sql_insert(f"(SELECT r.conv_id, r.i, {_sql_next()} FROM way w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)")


@register(
    "op12_conversations",
    rf"""
    WITH RECURSIVE {SQL_CRC_TABLE},
    c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
    k AS (SELECT conv_id, turn, role, text, {SQL_CRC.format("h")} % 20 AS kind FROM c, crc),
    d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || length(text) || ':' || text)) AS i FROM d),
    f AS (SELECT *, regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
                 left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
    r AS (SELECT conv_id, i, turn, role, text, initial, last = '' AS blank, last <> '' AND seen AS duplicate,
                 last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') AS truncated, last = '' OR seen AS gone,
                 CASE WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS late,
                 before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS illegal FROM f),
    way(conv_id, i, n, s, u, a) AS (SELECT * FROM {_SQL_FIRST_WAYS} UNION ALL SELECT * FROM {_SQL_NEXT_WAYS}),
    done AS (SELECT conv_id, least(n, a) AS best FROM way QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
    t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INTEGER) AS blank,
                 sum(duplicate::INTEGER) AS duplicate, sum(truncated::INTEGER) AS truncated, sum(illegal::INTEGER) AS illegal FROM r GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost,
           coalesce(split_part(substr(best, 10), chr(1), 1), '') AS audit,
           sha256(coalesce(replace(regexp_replace(split_part(substr(best, 10), chr(1), 2), chr(2) || '$', ''), chr(2), chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) e
    LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM e.conv_id""",
)
def op12_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return report(damaged(rows), rows)


# --------------------------------------------------------------------------------- periodic runs


@register(
    "op13_periodic",
    rf"""
    WITH RECURSIVE {SQL_CRC_TABLE},
    d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w, hex(encode(doc_id::VARCHAR)) AS h FROM documents),
    g AS (SELECT r, doc_id, w, len(w) AS n, {SQL_CRC.format("h")} AS h FROM d, crc),
    a AS (SELECT *, (h // 10) % greatest(n, 1) AS a FROM g),
    p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
    x AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM p),
    o AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS w FROM x),
    e AS (SELECT l.r, l.i, m.i - l.i AS q FROM o l JOIN o m ON l.r = m.r AND l.w = m.w AND m.i > l.i AND m.i - l.i <= l.n // 4),
    s AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e),
    m AS (SELECT r, min(i) AS start, count(*) + q AS length, q FROM s GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
    run AS (SELECT r, start, length, min(q) AS period FROM m GROUP BY r, start, length),
    best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) = 1),
    t AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM run GROUP BY r),
    gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
    z AS (SELECT o.r, string_agg(w, ' ' ORDER BY o.i) AS text FROM o LEFT JOIN gone ON gone.r = o.r AND gone.i = o.i WHERE gone.i IS NULL GROUP BY o.r)
    SELECT x.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
           (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(z.text, '')) AS collapsed_sha256
    FROM x LEFT JOIN t ON t.r = x.r LEFT JOIN best ON best.r = x.r LEFT JOIN z ON z.r = x.r""",
)
def op13_periodic(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", repeated_tail(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs, [F.col("doc_id")])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
