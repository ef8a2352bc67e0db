"""Line deduplication by a deletion-neighbourhood join.

Lines are compared as sequences of words (runs of anything but ASCII white space), so spacing does
not matter. Two lines are copies if they are equal, or, if both have ``min_words`` words or more, if one word is
replaced, missing or added: between shorter lines such a word is too much of the line. Lines without words are left alone. An occurrence of a line goes if a copy occurs earlier,
whether or not that copy goes too; earlier means by id (null last), then by text, then by position.

1. Lines are hashed; equal ones fold to one with its earliest occurrence.
2. Copies that are not equal share the words before or after the middle of the shorter one, so only
   lines of ``min_words`` or more that share such a half with a different line go on.
3. Those emit every variant with one word deleted as a hashed key, and themselves. Lines that lose
   the same position and then are equal, or that equal another one's variant, are copies; the
   earliest of each key is an aggregate, so no pairs within a group are made.
4. The word edit distance to the earliest copy is verified.

Null text has no lines and stays null; empty text has one empty line. Rows equal in id and text are
one document: they keep and lose the same lines. Empty tables give empty results. Other columns are
only carried, in a struct, if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage, spread
from .joins import marked, stored, thinned

MIN_WORDS = 8
_SPACE = r"[\x20\x09-\x0D]+"


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, _SPACE), "")


def _half_keys(words: Column, n: Column) -> list[Column]:
    """Hashes of the first and second half, for this length and for the next shorter one."""
    keys = []
    for short in (n, n - 1):
        half = F.floor(short / 2).cast("int")
        rest = short - half
        keys += [F.xxhash64(F.slice(words, 1, half), short, F.lit("first")), F.xxhash64(F.slice(words, n - rest + 1, rest), short, F.lit("last"))]
    return keys


def _within_one(a: Column, b: Column) -> Column:
    """Whether two arrays of words differ by one replaced, missing or added word at most."""

    def same(x: Column, y: Column) -> Column:  # words before the first difference
        equal = F.zip_with(x, y, lambda u, v: u.eqNullSafe(v))
        at = F.array_position(equal, False)
        return F.when(at == 0, F.size(equal)).otherwise(at - 1)

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (same(a, b) + same(F.reverse(a), F.reverse(b)) >= longer - 1)


def _earliest(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """``line``, ``earliest``: for lines with an earlier copy that is not equal, that copy's place.

    ``lines`` (``line``, ``first``, ``keys``), one row per distinct line; ``texts``: the documents.
    """
    halves = lines.select("line", F.explode("keys").alias("key"))
    shared = halves.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b")
    # what is stored first leaves Spark free to split a key that holds many lines
    shared = stored(shared.select("key"), "shared")
    company = thinned(halves, F.col("key"), shared, "shared-bits").join(shared, "key", "left_semi").select("line").distinct()
    company = stored(company, "company")
    company = cut_lineage(thinned(lines, F.col("line"), company, "company-bits").join(company, "line", "left_semi").select("line", "first"), "company")
    # their words, read once more from where they occur first
    wanted = stored(company.groupBy("first.id", "first.hash").agg(F.collect_list(F.struct("first.at", "line")).alias("wanted")), "wanted", 5_000)
    some = thinned(texts, F.col("hash"), wanted.select("hash"), "wanted-bits")
    found = some.join(wanted, some["id"].eqNullSafe(wanted["id"]) & (some["hash"] == wanted["hash"]))
    found = found.select(F.split("text", "\n").alias("all"), F.explode("wanted").alias("x")).select("x.line", _words(F.get("all", F.col("x.at"))).alias("words"))
    found = cut_lineage(found.dropDuplicates(["line"]), "lines")

    # order-dependent hashes of a line without its i-th word: words before it keep their place, those behind move up
    each = found.select("line", F.size("words").alias("n"), F.posexplode("words").alias("i", "word"))
    each = each.select("line", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved"))
    whole = Window.partitionBy("line")
    before = whole.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    upto = whole.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    none = F.lit(0).cast("long")
    each = each.select(
        "line",
        "n",
        "i",
        F.coalesce(F.bit_xor("here").over(before), none).alias("front"),
        F.bit_xor("moved").over(upto).alias("moved_upto"),
        F.bit_xor("moved").over(whole).alias("moved_all"),
        F.bit_xor("here").over(whole).alias("full"),
    )
    rest = F.col("front").bitwiseXOR(F.col("moved_all").bitwiseXOR(F.col("moved_upto")))
    variants = each.select(
        "line",
        F.explode(
            F.array(
                F.struct(F.xxhash64(F.lit("replaced"), "n", "i", rest).alias("key"), F.lit(0).alias("role")),
                F.struct(F.xxhash64(F.lit("whole"), F.col("n") - 1, rest).alias("key"), F.lit(1).alias("role")),
                F.struct(F.when(F.col("i") == 0, F.xxhash64(F.lit("whole"), "n", "full")).alias("key"), F.lit(2).alias("role")),
            )
        ).alias("v"),
    ).select("line", "v.key", "v.role")
    variants = cut_lineage(variants.where("key is not null"), "variants")
    equal = variants.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("key")
    equal = stored(equal, "equal-keys")
    variants = thinned(variants, F.col("key"), equal, "equal-bits").join(equal, "key", "left_semi")
    place = company.select("line", F.struct("first.no_id", "first.id", "first.hash", "first.at", "line").alias("place"))
    variants = cut_lineage(variants.join(place, "line"), "equal")
    groups = variants.groupBy("key").agg(*[F.min(F.when(F.col("role") == r, F.col("place"))).alias(f"p{r}") for r in range(3)])
    near = variants.join(stored(groups, "groups"), "key")
    other = F.when(F.col("role") == 0, F.col("p0")).when(F.col("role") == 1, F.col("p2")).otherwise(F.col("p1"))
    near = near.select("line", "place", other.alias("other")).where("other < place")
    near = near.groupBy("line").agg(F.min("other").alias("other"))
    mine, theirs = found.select("line", "words"), found.select(F.col("line").alias("other_line"), F.col("words").alias("other_words"))
    near = near.join(mine, "line").join(theirs, F.col("other.line") == F.col("other_line"))
    near = near.where(_within_one(F.col("words"), F.col("other_words")))
    return near.select("line", F.struct("other.no_id", "other.id", "other.hash", "other.at").alias("earliest"))


def line_dedup(docs: DataFrame, keep: list[Column], id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``keep`` (expressions over ``docs``) and, for every row, ``n_lines``, ``n_dropped``, ``dropped`` (positions) and ``text`` without the lines dropped."""
    text = F.col(text_col)
    rows = spread(docs.select(F.struct(*keep).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")))
    texts = rows.select("id", "hash", "text").where("text is not null")
    lines = texts.select("id", "hash", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    words = F.explode(F.array(_words(F.col("line")))).alias("words")  # a generator, so that it is computed once
    lines = lines.select("id", "hash", "at", words).withColumn("n", F.size("words")).where("n > 0")
    occurrence = F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "at").alias("place")
    # short lines have no halves
    halves = F.when(F.col("n") >= min_words, F.array(*_half_keys(F.col("words"), F.col("n"))))
    lines = cut_lineage(lines.select(occurrence, F.xxhash64("words").alias("line"), halves.alias("keys")), "occurrences")

    half = lambda k: F.get("keys", k).alias("abcd"[k])
    distinct = lines.groupBy("line", F.when(F.col("keys").isNotNull(), F.struct(*[half(k) for k in range(4)])).alias("k")).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    distinct = cut_lineage(distinct.select("line", "first", "last", F.when(F.col("k").isNotNull(), F.array("k.a", "k.b", "k.c", "k.d")).alias("keys")), "distinct-lines")
    near = cut_lineage(_earliest(distinct.where("keys is not null"), texts), "near")
    first = distinct.join(near, "line", "left")
    first = stored(first.where("earliest is not null or first < last").select("line", F.coalesce("earliest", "first").alias("earliest")), "first")
    gone = lines.join(first, "line").where("place > earliest").select("place.id", "place.hash", "place.at").distinct()
    gone = stored(gone.groupBy("id", "hash").agg(F.sort_array(F.collect_list("at")).alias("dropped")), "dropped", 5_000)
    # documents that lose nothing stay where they are
    told = marked(rows, F.col("hash"), gone.select("hash"), "dropped-bits")
    some = told.where("__marked").drop("__marked")
    some = some.join(gone, some["id"].eqNullSafe(gone["id"]) & (some["hash"] == gone["hash"]), "left").select("row", "text", "dropped")
    joined = some.unionByName(told.where("not __marked").select("row", "text", F.lit(None).cast("array<int>").alias("dropped")))
    all_lines = F.split("text", "\n")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), dropped)
    rest = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n"))
    return joined.select("row.*", F.coalesce(F.when(F.col("text").isNotNull(), F.size(all_lines)), F.lit(0)).cast("long").alias("n_lines"), F.size(dropped).cast("long").alias("n_dropped"), dropped.alias("dropped"), rest.alias(text_col))
