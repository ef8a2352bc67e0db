"""Stored tables in hash buckets: a change reads and rewrites only the buckets of its keys.

A version of the table is a manifest, a small file that names for every bucket the version that
wrote it. Writing version ``n`` adds files below ``data/v=n`` and then the manifest, so readers see
a version whole or not at all, and a write that is repeated after a failure gives the same version.
Buckets that a change does not touch keep their files. One writer at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, scratch_scope

BUCKET = "flowops_bucket"


@dataclass(frozen=True)
class Manifest:
    """``buckets``: how many there are; ``files``: the version that wrote each bucket that has rows; ``notes`` of the writer."""

    buckets: int
    files: dict[int, int] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class BucketTable:
    """A table below ``folder``; ``keys`` are columns of ``schema`` and decide the bucket of a row."""

    folder: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def _manifest_path(self, version: int) -> str:
        return self._path(f"manifest/{version}.json")

    def latest(self, spark: SparkSession) -> int | None:
        """The last version written; null if there is none."""
        found = [int(m[1]) for name in _names(spark, self._path("manifest")) if (m := re.fullmatch(r"(-?\d+)\.json", name))]
        return max(found, default=None)

    def manifest(self, spark: SparkSession, version: int | None) -> Manifest:
        """What a version consists of; without a version, an empty table."""
        if version is None:
            return Manifest(self.buckets)
        text = _get(spark, self._manifest_path(version))
        if text is None:
            raise ValueError(f"{self.folder} has no version {version}")
        found = json.loads(text)
        if found["buckets"] != self.buckets:
            raise ValueError(f"{self.folder} has {found['buckets']} buckets, not {self.buckets}")
        return Manifest(found["buckets"], {int(k): v for k, v in found["files"].items()}, found["notes"])

    def bucket_of(self, keys: Sequence[Column]) -> Column:
        """The bucket of a key, whose parts are converted to the types the table has."""
        typed = [k.cast(self.schema[name].dataType) for k, name in zip(keys, self.keys, strict=True)]
        return F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame, keys: Sequence[Column]) -> list[int]:
        """The buckets that the rows' keys lie in; as many numbers as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket_of(keys).alias(BUCKET)).distinct().collect())

    def read(self, spark: SparkSession, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version, the latest if none is named, from the buckets ``only`` lists or from all."""
        version = self.latest(spark) if version is None else version
        return self.read_manifest(spark, self.manifest(spark, version), only)

    def read_manifest(self, spark: SparkSession, manifest: Manifest, only: Sequence[int] | None = None) -> DataFrame:
        chosen = manifest.files if only is None else {b: manifest.files[b] for b in only if b in manifest.files}
        paths = [self._path(f"data/v={version}/{BUCKET}={bucket}") for bucket, version in sorted(chosen.items())]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, version: int, before: int | None = None, only: Sequence[int] | None = None, notes: dict | None = None) -> None:
        """Write ``rows`` as the buckets ``only`` lists, or as all; the others stay as in version ``before``."""
        spark = rows.sparkSession
        kept = {} if only is None else {b: v for b, v in self.manifest(spark, before).files.items() if b not in set(only)}
        path = self._path(f"data/v={version}")
        placed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        placed = placed.withColumn(BUCKET, self.bucket_of([F.col(f"`{k}`") for k in self.keys])).repartition(BUCKET)
        placed.write.partitionBy(BUCKET).mode("overwrite").parquet(path)
        made = {int(m[1]): version for name in _names(spark, path) if (m := re.fullmatch(rf"{BUCKET}=(\d+)", name))}
        _put(spark, self._manifest_path(version), json.dumps({"buckets": self.buckets, "files": kept | made, "notes": notes or {}}))

    def forget(self, spark: SparkSession, version: int, after: int) -> None:
        """Delete a version, and those of its files that version ``after`` does not use."""
        if _get(spark, self._manifest_path(version)) is None:
            return
        used = self.manifest(spark, after).files
        for bucket, wrote in self.manifest(spark, version).files.items():
            if used.get(bucket) != wrote:
                delete_path(spark, self._path(f"data/v={wrote}/{BUCKET}={bucket}"))
        delete_path(spark, self._manifest_path(version))


def change_stored(stored: BucketTable, requests: DataFrame, keys: Sequence[str], operation: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Apply ``operation(table, requests) -> table`` to the buckets of the requests' keys; returns the new version.

    The operation sees only rows of those buckets, so it must change no row but those of the
    requested keys, as the key/value operations and :func:`~flowops.operators.cdc.apply_changes` do.
    """
    spark = requests.sparkSession
    before = stored.latest(spark)
    only = stored.touched(requests, [F.col(f"`{k}`") for k in keys])
    version = 0 if before is None else before + 1
    with scratch_scope(spark):
        after = operation(stored.read_manifest(spark, stored.manifest(spark, before), only), requests)
        stored.write(after, version, before, only)
    return version


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    place, system = _place(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def _get(spark: SparkSession, path: str) -> str | None:
    place, system = _place(spark, path)
    if not system.exists(place):
        return None
    file = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    finally:
        file.close()


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears whole."""
    place, system = _place(spark, path)
    draft, _ = _place(spark, f"{path}.draft")
    file = system.create(draft, True)
    file.write(bytearray(text.encode()))
    file.close()
    system.delete(place, False)
    system.rename(draft, place)
