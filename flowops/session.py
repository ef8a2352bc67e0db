"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import pathlib
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # one template syntax only: "${x}" in SQL text belongs to the operators
    "spark.sql.variable.substitute": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that can be changed on a running session."""
    for key, value in DEFAULT_CONF.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Needed where it is not installed there: Python workers then find it wherever the job started.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="flowops-code-")) / "flowops.zip"
    with zipfile.ZipFile(path, "w") as file:
        for module in sorted(package.rglob("*.py")):
            file.write(module, module.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent (local tests).
    """
    global _own_dir
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        path = _own_dir = _own_dir or tempfile.mkdtemp(prefix="flowops-")
    return path.rstrip("/")


_scopes = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/flowops/{label}-{uuid.uuid4().hex}"
    for made in getattr(_scopes, "open", []):
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what the operators wrote to the shared folder inside the block.

    Results that have not been written or collected by the end of the block are lost with it.
    """
    _scopes.open = [*getattr(_scopes, "open", []), made := []]
    try:
        yield
    finally:
        _scopes.open.pop()
        for path in made:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    """Delete a file or folder in any file system Spark knows; false if there was none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, recursive))


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, ending its lineage.

    A written table, unlike a local checkpoint, outlives the executors.
    """
    return _saved(df, scratch_path(df.sparkSession, label))


def _saved(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A side is broadcast only if it has been measured to stay below both.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_FILE_BYTES = 64 * 1024 * 1024


def measured(df: DataFrame, label: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Compute ``df`` once, and tell how to join with something as long as it.

    Returns the saved frame and a function for the side of a join that has at most as many rows:
    it marks that side for broadcast if the saved frame is small, else it leaves it alone, and
    Spark shuffles both sides.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    saved = _saved(df, path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    small = size <= MAX_BROADCAST_FILE_BYTES and saved.count() <= MAX_BROADCAST_ROWS
    return saved, F.broadcast if small else lambda side: side


def spread(df: DataFrame) -> DataFrame:
    """Give costly per-row work at least one task per core.

    A small file is one split, whatever its rows cost. Inputs with enough splits, as any large
    table has, are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
