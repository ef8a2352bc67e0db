"""One directory level of files, one row per file."""

from __future__ import annotations

import bz2
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.maps import materialise
from ..routes import FAILURE, REASON, ROUTE, SUCCESS
from ..session import delete_path

COMMS_FAILURE = "comms.failure"

# Compression settings, and the extensions that "automatic" understands.
COMPRESSIONS = ("automatic", "none", "gzip", "bzip2", "deflate", "lz4", "snappy", "zstd")
EXTENSIONS = {".gz": "gzip", ".bz2": "bzip2", ".deflate": "deflate", ".lz4": "lz4", ".snappy": "snappy", ".zst": "zstd"}

# Zlib window settings of the formats.
_WBITS = {"gzip": 31, "deflate": 15}

# How the formats' own frames begin.
_FRAMES = {"lz4": b"\x04\x22\x4d\x18", "snappy": b"\xff\x06\x00\x00sNaPpY"}


def missing_directory(spark: SparkSession, directory: str) -> str | None:
    """The reason a directory cannot be read, null if it exists."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return None if exists else "dir_does_not_exist"


def _chosen(name: Column, regex: str | None, ignore_dotted: bool) -> Column:
    chosen = F.lit(True)
    if ignore_dotted:
        chosen = ~name.startswith(".")
    if regex is not None:
        chosen = chosen & name.rlike(f"^(?:{regex})$")
    return chosen


def decompress(data: bytes, codec: str) -> bytes:
    """The bytes of a whole file; ``lz4`` and ``snappy`` are Hadoop's block format or the formats' own frames."""
    if codec == "none":
        return data
    if codec == "bzip2":
        return bz2.decompress(data)
    if codec in _WBITS:
        return _members(data, _WBITS[codec])
    if codec == "zstd" or data.startswith(_FRAMES[codec]):
        if codec == "snappy":
            return _snappy_frames(data)
        with pa.CompressedInputStream(pa.BufferReader(data), codec) as stream:
            return stream.read()
    return _blocks(data, codec)


def _blocks(data: bytes, codec: str) -> bytes:
    """Blocks of (bytes in the block, then chunks of it: compressed bytes, chunk)."""
    raw = pa.Codec("snappy")
    out, at = [], 0
    while at < len(data):
        left = struct.unpack_from(">I", data, at)[0]
        at += 4
        while left > 0:
            size = struct.unpack_from(">I", data, at)[0]
            chunk = data[at + 4 : at + 4 + size]
            if len(chunk) < size:
                raise ValueError("the file ends within a block")
            at += 4 + size
            out.append(raw.decompress(chunk, decompressed_size=_snappy_size(chunk), asbytes=True) if codec == "snappy" else _lz4_chunk(chunk))
            left -= len(out[-1])
        if left < 0:
            raise ValueError("a block is longer than it says")
    return b"".join(out)


def _snappy_size(chunk: bytes) -> int:
    """The length that a raw chunk begins with, seven bits a byte."""
    size = 0
    for k, byte in enumerate(chunk[:5]):
        size |= (byte & 0x7F) << 7 * k
        if byte < 0x80:
            return size
    raise ValueError("no length in front of a chunk")


# A frame whose blocks stand alone, of 4 MB at most, without sums or sizes.
_LZ4_FRAME = b"\x04\x22\x4d\x18\x60\x70\x73"


def _lz4_chunk(chunk: bytes) -> bytes:
    """A raw chunk, read as the block of a frame: that needs no size, which only a walk over all its sequences tells."""
    framed = _LZ4_FRAME + struct.pack("<I", len(chunk)) + chunk + bytes(4)
    try:
        with pa.CompressedInputStream(pa.BufferReader(framed), "lz4") as stream:
            return stream.read()
    except (OSError, pa.ArrowException):  # more than 4 MB, or no such chunk
        return pa.Codec("lz4_raw").decompress(chunk, decompressed_size=_lz4_size(chunk), asbytes=True)


def _lz4_size(chunk: bytes) -> int:
    """Bytes that a raw chunk expands to, counted over its sequences of literals and matches."""
    size = at = 0

    def counted(n: int, at: int) -> tuple[int, int]:
        if n == 15:
            while chunk[at] == 255:
                n, at = n + 255, at + 1
            n, at = n + chunk[at], at + 1
        return n, at

    while at < len(chunk):
        token = chunk[at]
        literals, at = counted(token >> 4, at + 1)
        size, at = size + literals, at + literals
        if at >= len(chunk):  # the last sequence has no match
            break
        match, at = counted(token & 15, at + 2)
        size += match + 4
    return size


def _snappy_frames(data: bytes) -> bytes:
    """The framing format: chunks of a kind, three bytes of length, and a checksum before the data."""
    raw, out, at = pa.Codec("snappy"), [], 0
    while at < len(data):
        kind, size = data[at], int.from_bytes(data[at + 1 : at + 4], "little")
        body = data[at + 4 : at + 4 + size]
        at += 4 + size
        if kind == 0:
            out.append(raw.decompress(body[4:], decompressed_size=_snappy_size(body[4:]), asbytes=True))
        elif kind == 1:
            out.append(body[4:])
        elif kind < 0x80:
            raise ValueError(f"unknown frame {kind}")
    return b"".join(out)


_READ = "struct<content: string, problem: string>"
_PA_READ = pa.struct([("content", pa.string()), ("problem", pa.string())])


def _opened(data: bytes, codec: str) -> dict:
    try:
        return {"content": decompress(data, codec).decode("utf-8", "replace"), "problem": None}
    except (OSError, ValueError, EOFError, zlib.error, struct.error, IndexError, pa.ArrowException) as error:
        return {"content": None, "problem": f"not {codec}: {error}"}


def _inflate(codec: str):
    def inflate(batch: pa.Array) -> pa.Array:
        return pa.array([_opened(data, codec) for data in batch.to_pylist()], _PA_READ)

    return F.arrow_udf(inflate, _READ)


def _skipped(spark: SparkSession, directory: str) -> list[tuple[str, str]]:
    """(URI, name) of the files of a directory that Spark's readers never list."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    place = Path(directory)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    # a call for every file of a large folder takes the driver longer than reading it takes the tasks
    plain = not re.search(r"[\\*?{}\[\]^]", directory)
    found = (system.globStatus(Path(place, "{[._]*,*._COPYING_}")) if plain else system.listStatus(place)) or []
    files = [(s.getPath().toString(), s.getPath().getName()) for s in found if s.isFile()]
    return [(uri, n) for uri, n in files if n.startswith(".") or (n.startswith("_") and "=" not in n) or n.endswith("._COPYING_")]


def _read_skipped(spark: SparkSession, files: list[tuple[str, str]], compression: str) -> DataFrame:
    """``content``, ``problem``, ``name``: files opened in tasks, a few each, by the store their URI names."""
    listed = spark.createDataFrame(files, "uri string, name string")
    listed = listed.repartition(min(len(files), 10 * spark.sparkContext.defaultParallelism))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, name in zip(*(c.to_pylist() for c in batch.columns)):
                codec = next((c for e, c in EXTENSIONS.items() if name.endswith(e)), "none") if compression == "automatic" else compression
                try:
                    store, path = fs.FileSystem.from_uri(uri)
                    with store.open_input_stream(path, compression=None) as stream:
                        opened = _opened(stream.read(), codec)
                except (OSError, pa.ArrowException) as error:
                    opened = {"content": None, "problem": str(error)}
                yield pa.RecordBatch.from_pylist([{**opened, "name": name}], pa.schema([*_PA_READ, ("name", pa.string())]))

    return listed.mapInArrow(read, "content string, problem string, name string")


def _members(data: bytes, wbits: int) -> bytes:
    """All members of a compressed file, one after another."""
    out = []
    while data:
        member = zlib.decompressobj(wbits)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def _bare(name: Column, compression: str) -> Column:
    """The file name without the extension of the format it was read as."""
    endings = [e for e, c in EXTENSIONS.items() if compression in ("automatic", c)]
    return F.regexp_replace(name, f"({'|'.join(e.replace('.', chr(92) + '.') for e in endings)})$", "") if endings else name


def _rows(files: DataFrame, name: Column, content: Column, problem: Column, directory: str, compression: str) -> DataFrame:
    route = F.when(problem.isNull(), SUCCESS).otherwise(FAILURE)
    return files.select(content.alias("content"), F.lit(directory).alias("path"), _bare(name, compression).alias("filename"), route.alias(ROUTE), problem.alias(REASON))


def read_files(
    spark: SparkSession,
    directory: str,
    *,
    regex: str | None = None,
    ignore_dotted: bool = True,
    compression: str = "automatic",
) -> DataFrame:
    """Files directly in ``directory`` as (content, path, filename, route, reason).

    A directory that does not exist is one row with route ``comms.failure``. ``regex`` has to match the whole file name. ``automatic`` decompresses by extension and drops
    the extension from ``filename``; ``none`` keeps the bytes; the others decompress every file
    as that format, and a file that is not of it is a ``failure``. Names that Spark's readers skip (``_x`` and, unless
    ``ignore_dotted``, ``.x``) are listed as well; these files are opened by the store that their URI names
    (local, ``hdfs``, ``s3``, ``gs``), and where that cannot be reached the row is a ``failure``.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}, not {compression!r}")
    why = missing_directory(spark, directory)
    if why:
        return spark.createDataFrame(
            [(None, directory, None, COMMS_FAILURE, why)], f"content string, path string, filename string, {ROUTE} string, {REASON} string"
        )
    none = F.lit(None).cast("string")
    # metadata predicates choose the files before any of them is opened
    name = F.col("_metadata.file_name")
    if compression == "automatic":
        files = spark.read.text(directory, wholetext=True).where(_chosen(name, regex, ignore_dotted))
        rows = _rows(files, name, F.col("value"), none, directory, compression)
    else:
        files = spark.read.format("binaryFile").load(directory).where(_chosen(name, regex, ignore_dotted))
        if compression == "none":
            rows = _rows(files, name, F.col("content").cast("string"), none, directory, compression)
        else:
            read = materialise(files.select(name.alias("name"), "content"), {"__read": _inflate(compression)(F.col("content"))})
            rows = _rows(read, F.col("name"), F.col("__read.content"), F.col("__read.problem"), directory, compression)
    skipped = _skipped(spark, directory)
    if skipped:
        chosen = _read_skipped(spark, skipped, compression).where(_chosen(F.col("name"), regex, ignore_dotted))
        rows = rows.unionByName(_rows(chosen, F.col("name"), F.col("content"), F.col("problem"), directory, compression))
    return rows


def stream_files(
    spark: SparkSession,
    directory: str,
    *,
    regex: str | None = None,
    ignore_dotted: bool = True,
    keep_source: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """:func:`read_files` for files as they arrive.

    Without ``keep_source`` files are deleted once a later batch has committed, so a failed
    batch still finds them.
    """
    reader = spark.readStream.format("text").option("wholetext", "true")
    if not keep_source:
        reader = reader.option("cleanSource", "delete")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    name = F.col("_metadata.file_name")
    files = reader.load(directory).where(_chosen(name, regex, ignore_dotted))
    return _rows(files, name, F.col("value"), F.lit(None).cast("string"), directory, "automatic")


def rename_files(spark: SparkSession, directory: str, ending: str, other: str) -> int:
    """Give the files of a directory whose names end so another ending; returns how many there were."""
    Path = spark._jvm.org.apache.hadoop.fs.Path  # looked up once: every step of the name is a call
    place = Path(directory)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(status) -> bool:
        path = status.getPath()
        name = path.getName()
        return name.endswith(ending) and status.isFile() and system.rename(path, Path(place, name[: -len(ending)] + other))

    # the calls for each file go side by side
    with ThreadPoolExecutor(16) as pool:
        return sum(pool.map(rename, system.listStatus(place)))


def delete_files(spark: SparkSession, directory: str, names: Iterable[str]) -> int:
    """Delete the named files of a directory, after the rows read from them are safe."""
    return sum(delete_path(spark, f"{directory.rstrip('/')}/{name}", recursive=False) for name in names)
