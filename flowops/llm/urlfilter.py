"""URL rules by Bloom filter cascades: exact membership without joins.

A rule is a host and the beginning of a path. A url can only match keys made of the last labels of
its host and the first characters of its path, in the few shapes that the rules have. Level 1 of a
cascade encodes the listed keys; level 2 the keys of the whole corpus that pass level 1 without
being listed; level 3 the listed keys that pass level 2; and so on until none is left. For every
key of the corpus the first level that refuses it decides, so the filter is exact on it.

A null url, or one without ``://``, has an empty host and path and matches no rule. Of several
fitting rules the longest text wins (then the longer host, then the larger text); of equal rules
with different verdicts, ``block``. Each repeated row has its own result; empty tables of urls give
empty results, and without rules every verdict is the default. Other columns are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Cells of a level for each of its keys, and hashes of a key.
CELLS_PER_KEY = 10
HASHES = 4
#: A level is a constant of the plan; listings beyond this many cells are refused.
MAX_CELLS = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def key(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


class Cascade:
    """Alternating levels of listed keys and false positives."""

    def __init__(self) -> None:
        self.levels: list[bytes] = []

    def _positions(self, key: Column, level: int, cells: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(cells)).cast("int") for j in range(HASHES)]

    def passes(self, key: Column, level: int) -> Column:
        """Whether one level contains the key."""
        cells = self.levels[level]
        constant = F.lit(bytearray(cells))
        found = F.lit(True)
        for at in self._positions(key, level, len(cells)):
            found = found & (F.substring(constant, at + 1, F.lit(1)) == F.lit(bytearray(b"\x01")))
        return found

    def contains(self, key: Column) -> Column:
        """Whether the key is listed; exact for keys of the universe."""
        verdict = F.lit(len(self.levels) % 2 == 1)  # passes all levels
        for level in reversed(range(len(self.levels))):
            verdict = F.when(self.passes(key, level), verdict).otherwise(F.lit(level % 2 == 1))
        return verdict

    def _encode(self, keys: DataFrame, count: int) -> None:
        cells = max(64, CELLS_PER_KEY * count)
        if cells > MAX_CELLS:
            raise ValueError(f"{count} keys need more than {MAX_CELLS} cells")
        level = len(self.levels)
        marks = bytearray(cells)
        # no more marks than cells
        for row in keys.select(F.explode(F.array(*self._positions(F.col("key"), level, cells))).alias("at")).distinct().toLocalIterator():
            marks[row["at"]] = 1
        self.levels.append(bytes(marks))

    @classmethod
    def build(cls, listed: DataFrame, universe: DataFrame) -> Cascade:
        """``listed`` and ``universe`` have distinct ``key`` columns; all keys asked for later are in ``universe``."""
        out = cls()
        inside, outside = listed, universe
        count = inside.count()
        while count:
            out._encode(inside, count)
            passed = outside.where(out.passes(F.col("key"), len(out.levels) - 1))
            if len(out.levels) == 1:  # of the keys that pass, those that are listed are no false positives
                both = passed.select("key", F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(True).alias("listed")))
                passed = both.groupBy("key").agg(F.max("listed").alias("listed")).where("not listed").select("key")
            inside, outside = cut_lineage(passed, "false-positives"), inside
            count = inside.count()
        return out


def _rows(spark: SparkSession, keys: list[str]) -> DataFrame:
    """Keys as rows of a plan's constant; no Python worker reads them."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(keys)), "array<string>")).alias("key"))


def _shape_key(host: Column, path: Column, labels: int, length: int) -> Column:
    """The url's key of a shape, null if it is too short for it."""
    long_enough = (host != "") & (F.size(F.split(host, "\\.")) >= labels) & (F.length(path) >= length)
    return F.when(long_enough, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)))


def filter_urls(pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``host``, ``path``, ``rule`` (its key), ``verdict``."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    candidates = [F.struct(F.length(k).alias("length"), F.lit(n).alias("labels"), k.alias("key")) for n, m in shapes for k in [_shape_key(F.col("host"), F.col("path"), n, m)]]
    cascades = {}
    if shapes:
        universe = cut_lineage(urls.select(F.explode(F.array(*candidates)["key"]).alias("key")).where("key is not null").distinct(), "keys")
        blocked = {r.key for r in rules if r.verdict == "block"}
        for verdict in ("allow", "block"):
            keys = blocked if verdict == "block" else {r.key for r in rules} - blocked
            if keys:
                cascades[verdict] = Cascade.build(_rows(spark, sorted(keys)), universe)

    def judged(x: Column) -> Column:
        verdict = F.lit(None).cast("string")
        for name, cascade in cascades.items():
            verdict = F.when(cascade.contains(x["key"]), F.lit(name)).otherwise(verdict)
        return F.struct(x["length"].alias("length"), x["labels"].alias("labels"), x["key"].alias("key"), verdict.alias("verdict"))

    if cascades:
        fitting = F.filter(F.transform(F.filter(F.array(*candidates), lambda x: x["key"].isNotNull()), judged), lambda x: x["verdict"].isNotNull())
        urls = urls.withColumn("best", F.array_max(fitting))
    else:
        urls = urls.withColumn("best", F.lit(None).cast("struct<length:int,labels:int,key:string,verdict:string>"))
    return urls.select(F.col("id").alias(id_col), "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
