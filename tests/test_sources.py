"""Files and streams; a stream gives what the batch operator gives."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from flowops.operators.sequence import assign_sequence
from flowops.operators.state import check_state, hold_release
from flowops.sources.files import delete_files, missing_directory, read_files, stream_files
from flowops.streaming import batches as B


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.txt.gz").write_bytes(gzip.compress(b"zip") + gzip.compress(b"ped"))
    (tmp_path / ".h.txt").write_text("dot")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_text("deep")
    return str(tmp_path)


def test_read_files(spark, folder):
    got = {r["filename"]: (r["content"], r["path"]) for r in read_files(spark, folder).collect()}
    assert got == {"a.txt": ("one\ntwo", folder), "b.txt": ("zipped", folder)}
    assert [r["filename"] for r in read_files(spark, folder, regex=r"a\.t.t").collect()] == ["a.txt"]
    assert read_files(spark, folder, regex="a").count() == 0
    assert {r["filename"]: r["content"] for r in read_files(spark, folder, ignore_dotted=False).collect()} == {"a.txt": "one\ntwo", "b.txt": "zipped", ".h.txt": "dot"}
    raw = {r["filename"] for r in read_files(spark, folder, compression="none").collect()}
    assert raw == {"a.txt", "b.txt.gz"}
    zipped = read_files(spark, folder, regex=".*gz", compression="gzip").first()
    assert (zipped["filename"], zipped["content"]) == ("b.txt", "zipped")
    assert missing_directory(spark, folder + "/no") == "dir_does_not_exist"
    missing = read_files(spark, folder + "/no").first()
    assert (missing["route"], missing["reason"], missing["content"]) == ("comms.failure", "dir_does_not_exist", None)
    with pytest.raises(ValueError):
        read_files(spark, folder, compression="rar")
    assert delete_files(spark, folder, ["a.txt", "zz"]) == 1
    assert read_files(spark, folder).count() == 1


def test_stream_files(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    query = (
        stream_files(spark, folder, regex=r".*\.txt(\.gz)?", files_per_batch=1)
        .writeStream.format("parquet").option("checkpointLocation", str(out / "cp")).option("path", str(out / "rows"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r["filename"]: r["content"] for r in spark.read.parquet(str(out / "rows")).collect()}
    assert got == {"a.txt": "one\ntwo", "b.txt": "zipped"}


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """Six files in order of arrival; one key has a third of all rows."""
    source = tmp_path_factory.mktemp("arrivals")
    rnd = random.Random(8)
    rows = []
    for i in range(240):
        key = "hot" if rnd.random() < 0.33 else f"k{rnd.randrange(6)}"
        rows.append({"id": i, "topic": "t", "k": key, "v": rnd.choice(["1", "2", "10", "", None, "b"]), "action": rnd.choice(["hold", "hold", "release", "zz"])})
    for n in range(3):
        part = rows[n * 80:(n + 1) * 80]
        rnd.shuffle(part)
        path = source / f"f{n}.json"
        path.write_text("\n".join(json.dumps(r) for r in part))
        import os
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    schema = "id long, topic string, k string, v string, action string"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    return stream, spark.read.schema(schema).json(str(source))


def result_of(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_batch_streams(spark, arrivals, tmp_path):
    stream, rows = arrivals
    cases = [
        ("c", B.check_state_step("k", "v", "id", replace_when="Not Equal To", max_rows=5), check_state(rows, "k", "v", "id", replace_when="Not Equal To"), ("previous_state", "route")),
        ("h", B.hold_release_step("topic", "k", "action", "id", duplicate="v", max_rows=5), hold_release(rows, "topic", "k", "action", "id", duplicate="v"), ("holder", "route")),
        ("s", B.sequence_step("k", "id", start=7, increment=-2, max_rows=5), assign_sequence(rows, "k", "id", start=7, increment=-2), ("sequence_value",)),
    ]
    for name, step, want, columns in cases:
        state, out, checkpoint = (str(tmp_path / f"{name}{x}") for x in ("state", "out", "cp"))
        B.run_stateful(stream(), step, state, out, checkpoint, buckets=4).awaitTermination()
        got = spark.read.parquet(out)
        assert got.select("batch").distinct().count() == 3
        assert result_of(got, *columns) == result_of(want, *columns)


def test_change_stream(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    changes = [
        {"table": "S.T", "op_type": "I", "pos": "1", "after": {"id": 1, "x": "a"}},
        {"table": "S.T", "op_type": "U", "pos": "2", "before": {"id": 1}, "after": {"x": "b"}},
        {"table": "S.T", "op_type": "I", "pos": "3", "after": {"id": 2, "x": "c"}},
        {"table": "S.T", "op_type": "D", "pos": "4", "before": {"id": 9}},
    ]
    for n, change in enumerate(changes):
        (source / f"f{n}.txt").write_text(json.dumps(change))
        import os
        os.utime(source / f"f{n}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    base = spark.createDataFrame([(9, "z"), (8, "y")], "id long, x string")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source)).withColumnRenamed("value", "content")
    step = B.apply_changes_step(base.schema, ["id"])
    B.run_stateful(stream, step, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "cp"), initial=base).awaitTermination()
    got = B.read_changed(spark, step, str(tmp_path / "state"), base.schema, ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (2, "c"), (8, "y")]


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    rows = [{"id": i, "k": f"k{i % 3}", "v": str(i * 7 % 10)} for i in range(60)]
    schema = "id long, k string, v string"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
        B.run_stateful(stream, B.check_state_step("k", "v", "id"), *(str(tmp_path / n) for n in ("state", "out", "cp"))).awaitTermination()

    import os
    for n in range(3):
        (source / f"f{n}.json").write_text("\n".join(json.dumps(r) for r in rows[n * 20:(n + 1) * 20]))
        os.utime(source / f"f{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
        run()
    want = check_state(spark.createDataFrame([(r["id"], r["k"], r["v"]) for r in rows], schema), "k", "v", "id")
    got = result_of(spark.read.parquet(str(tmp_path / "out")), "previous_state", "route")
    assert got == result_of(want, "previous_state", "route")
    # only the versions a repeated batch could need are kept
    assert sorted(p.name for p in (tmp_path / "state" / "manifest").glob("*.json")) == ["1.json", "2.json"]


def _batches_of(tmp_path, spark, parts, schema, step, **options):
    """Run a stream over one file per part; the folder of its state and output."""
    source = tmp_path / "in"
    source.mkdir()
    for n, part in enumerate(parts):
        (source / f"f{n}.json").write_text("\n".join(json.dumps(r) for r in part))
        stream = spark.readStream.schema(schema).json(str(source))
        B.run_stateful(stream, step, *(str(tmp_path / x) for x in ("state", "out", "cp")), **options).awaitTermination()
        yield n


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    step = B.check_state_step("k", "v", "id")
    parts = [[{"id": i, "k": f"k{i}", "v": "5"} for i in range(60)], [{"id": 100, "k": "k3", "v": "7"}], [{"id": 200, "k": "k3", "v": "6"}, {"id": 201, "k": "new", "v": "1"}]]
    files = {}
    for n in _batches_of(tmp_path, spark, parts, "id long, k string, v string", step, buckets=16):
        table = B.state_table(step, str(tmp_path / "state"), 16)
        rows = table.read(spark).withColumn("file", F.input_file_name()).collect()
        files[n] = {r["key"]: r["file"] for r in rows}
    moved = {k for k in files[0] if files[1][k] != files[0][k]}
    own = {r["k"]: r["b"] for r in spark.createDataFrame([(f"k{i}",) for i in range(60)], "k string").select("k", table.bucket_of([F.col("k")]).alias("b")).collect()}
    assert moved == {k for k in own if own[k] == own["k3"]} and len(moved) < 20
    assert sum(files[2][k] != files[1][k] for k in files[1]) < 30
    assert {r["key"]: r["value"] for r in B.read_state(spark, step, str(tmp_path / "state"), buckets=16).collect()} == {**{f"k{i}": "5" for i in range(60)}, "k3": "7", "new": "1"}


def test_a_repeated_batch_gives_the_same_version(spark, tmp_path):
    step = B.sequence_step("k", "id")
    parts = [[{"id": 10 * n + i, "k": f"k{i % 3}"} for i in range(10)] for n in range(3)]
    for n in _batches_of(tmp_path, spark, parts, "id long, k string", step, buckets=4):
        if n == 1:
            # the last batch did its work, but the checkpoint does not know: it is run again
            (tmp_path / "cp" / "commits" / "1").unlink()
            (tmp_path / "cp" / "commits" / ".1.crc").unlink(missing_ok=True)
    rows = spark.createDataFrame([(r["id"], r["k"]) for p in parts for r in p], "id long, k string")
    assert result_of(spark.read.parquet(str(tmp_path / "out")), "sequence_value") == result_of(assign_sequence(rows, "k", "id"), "sequence_value")


def test_late_changes_have_the_effect_they_had_in_time(spark, tmp_path):
    from flowops.operators.cdc import apply_changes, parse_trail

    rnd = random.Random(6)
    changes = []
    for pos in range(400):
        key = rnd.randrange(12)
        op = rnd.choice("IUUUD")
        change = {"table": "S.T", "op_type": op, "pos": str(pos)}
        if op != "I":
            change["before"] = {"id": key}
        if op != "D":
            change["after"] = {k: rnd.choice([None, f"{k}{pos}"]) for k in ("x", "y") if rnd.random() < 0.6} | ({"id": key} if op == "I" else {})
        changes.append(json.dumps(change))
    changes.append("no trail object")
    base = spark.createDataFrame([(k, "base", None) for k in range(0, 12, 2)] + [(99, "same", "row")], "id long, x string, y string")
    trail = parse_trail(spark.createDataFrame([(c,) for c in changes], "content string"))
    want = sorted(map(tuple, apply_changes(base, trail, ["id"]).collect()))
    rnd.shuffle(changes)
    step = B.apply_changes_step(base.schema, ["id"])
    parts = [[{"content": c} for c in changes[n::4]] for n in range(4)]
    for _ in _batches_of(tmp_path, spark, parts, "content string", step, initial=base, buckets=5):
        pass
    got = B.read_changed(spark, step, str(tmp_path / "state"), base.schema, ["id"], buckets=5)
    assert sorted(map(tuple, got.collect())) == want
    routes = {r["route"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("route").count().collect()}
    assert routes["failure"] == 1 and sum(routes.values()) == 401


def test_idle_state_expires(spark, tmp_path):
    day = lambda d, h=0: f"2024-01-{d:02d}T{h:02d}:00:00Z"
    parts = [
        [{"id": 1, "k": "a", "v": "5", "t": day(1)}, {"id": 2, "k": "b", "v": "5", "t": day(1)}, {"id": 3, "k": "a", "v": "4", "t": day(1, 6)}, {"id": 9, "k": None, "v": "1", "t": None}],
        [{"id": 4, "k": "a", "v": "3", "t": day(2, 5)}, {"id": 5, "k": "b", "v": "3", "t": day(2, 1)}],
        [{"id": 6, "k": "a", "v": "2", "t": day(2, 23)}, {"id": 7, "k": "b", "v": "9", "t": day(9)}, {"id": 8, "k": "b", "v": "8", "t": day(20)}],
        [{"id": 10, "k": "c", "v": "1", "t": day(21)}],
    ]
    step = B.check_state_step("k", "v", "id", replace_when="Not Equal To")
    for _ in _batches_of(tmp_path, spark, parts, "id long, k string, v string, t timestamp", step, buckets=1, time="t", ttl=86400):
        pass
    got = result_of(spark.read.parquet(str(tmp_path / "out")), "previous_state", "route")
    # b's state of day 1 is idle for 25 hours at its row of day 2; a's never for a day; rows of one batch are never parted
    assert got == {1: (None, "initial"), 2: (None, "initial"), 3: ("5", "less"), 4: ("4", "less"), 5: (None, "initial"), 6: ("3", "less"), 7: (None, "initial"), 8: ("9", "less"), 9: (None, "initial"), 10: (None, "initial")}
    # what was idle for a day at the latest time of earlier batches is dropped
    left = B.read_state(spark, step, str(tmp_path / "state"), buckets=1, ttl=86400).select("key").collect()
    assert {r["key"] for r in left} == {None, "b", "c"}


def test_stored_tables_change_by_bucket(spark, tmp_path):
    from flowops.operators.kv import kv_put, kv_put_if_absent, kv_remove
    from flowops.sources.buckets import BucketTable, change_stored

    stored = BucketTable(str(tmp_path / "kv"), B.KEY_VALUE, ("key",), 8)
    first = spark.createDataFrame([(f"k{i}", str(i), i) for i in range(50)], "key string, value string, n int")
    assert change_stored(stored, first, ["key"], lambda t, r: kv_put(t, r, "n")) == 0
    files = lambda version: {r["key"]: r["file"] for r in stored.read(spark, version).withColumn("file", F.input_file_name()).collect()}
    assert change_stored(stored, first.where("key = 'k7'").withColumn("value", F.lit("new")), ["key"], lambda t, r: kv_put(t, r, "n")) == 1
    before, after = files(0), files(1)
    assert 0 < sum(before[k] != after[k] for k in before) < 25
    change_stored(stored, spark.createDataFrame([("k7",), ("none",)], "key string"), ["key"], kv_remove)
    change_stored(stored, spark.createDataFrame([("k8", "no", 1), ("k7", "again", 2)], "key string, value string, n int"), ["key"], lambda t, r: kv_put_if_absent(t, r, "n"))
    got = {r["key"]: r["value"] for r in stored.read(spark).collect()}
    assert got == {f"k{i}": str(i) for i in range(50)} | {"k7": "again"}
    assert {r["key"]: r["value"] for r in stored.read(spark, 1).collect()}["k7"] == "new"
    stored.forget(spark, 0, 1)
    assert stored.latest(spark) == 3 and stored.read(spark, 1).count() == 50
    with pytest.raises(ValueError):
        stored.read(spark, 0)
    with pytest.raises(ValueError):
        BucketTable(stored.folder, B.KEY_VALUE, ("key",), 9).read(spark)


def test_scratch_scope(spark):
    import pathlib

    from flowops.session import cut_lineage, scratch_scope, shared_dir

    folder = pathlib.Path(shared_dir(spark)) / "flowops"
    with scratch_scope(spark):
        kept = cut_lineage(spark.range(5), "scope-test")
        assert kept.count() == 5 and list(folder.glob("scope-test-*"))
    assert not list(folder.glob("scope-test-*"))


def _hadoop_blocks(data, codec, chunk, chunks):
    """Hadoop's block format: blocks of ``chunks`` chunks of ``chunk`` bytes."""
    import struct

    import pyarrow as pa

    raw, out = pa.Codec({"lz4": "lz4_raw"}.get(codec, codec)), b""
    for at in range(0, len(data), chunk * chunks):
        block = data[at : at + chunk * chunks]
        out += struct.pack(">I", len(block))
        for k in range(0, len(block), chunk):
            packed = raw.compress(block[k : k + chunk], asbytes=True)
            out += struct.pack(">I", len(packed)) + packed
    return out


@pytest.mark.parametrize("chunk,chunks", [(1 << 18, 1), (1000, 3), (7, 2)])
def test_block_formats(chunk, chunks):
    from flowops.sources.files import decompress

    rnd = random.Random(chunk)
    texts = [b"", b"x", b"abc" * 5000, rnd.randbytes(5000), b"".join(rnd.choice([b"spark ", b"text ", b"\x00" * 40]) for _ in range(4000))]
    for text in texts:
        for codec in ("lz4", "snappy"):
            assert decompress(_hadoop_blocks(text, codec, chunk, chunks), codec) == text


def test_forced_formats_and_names_that_spark_skips(spark, tmp_path):
    import bz2
    import zlib

    import pyarrow as pa
    import zstandard

    text = "Ünïcode\n" * 3000
    data = text.encode()
    frame = b"\xff\x06\x00\x00sNaPpY" + (lambda body: b"\x00" + (len(body) + 4).to_bytes(3, "little") + b"\0\0\0\0" + body)(pa.Codec("snappy").compress(data, asbytes=True))
    packed = {
        "gzip": [gzip.compress(data)], "bzip2": [bz2.compress(data)], "deflate": [zlib.compress(data)],
        "lz4": [_hadoop_blocks(data, "lz4", 5000, 2), pa.Codec("lz4").compress(data, asbytes=True)],
        "snappy": [_hadoop_blocks(data, "snappy", 5000, 2), frame], "zstd": [zstandard.ZstdCompressor().compress(data)],
    }
    for codec, files in packed.items():
        folder = tmp_path / codec
        folder.mkdir()
        for k, content in enumerate(files):
            for name in (f"a{k}.any", f"_b{k}", f".c{k}"):
                (folder / name).write_bytes(content)
        (folder / "bad").write_bytes(b"\x00\x00\x00\x09 no file of any format")
        got = {r["filename"]: (r["content"], r["route"]) for r in read_files(spark, str(folder), compression=codec, ignore_dotted=False).collect()}
        assert got.pop("bad") == (None, "failure")
        assert got == {f"{p}{k}{e}": (text, "success") for k in range(len(files)) for p, e in (("a", ".any"), ("_b", ""), (".c", ""))}
    (tmp_path / "auto").mkdir()
    for name, content in (("_x.gz", packed["gzip"][0]), ("y.txt", data), ("_z.snappy", packed["snappy"][0]), (".w", data)):
        (tmp_path / "auto" / name).write_bytes(content)
    got = {r["filename"]: r["content"] for r in read_files(spark, str(tmp_path / "auto")).collect()}
    assert got == {"_x": text, "y.txt": text, "_z": text}
    assert [r["filename"] for r in read_files(spark, str(tmp_path / "auto"), regex="_x.*").collect()] == ["_x"]


def test_lz4_chunks_need_no_walk(monkeypatch):
    """The size of a raw chunk is only looked for where no frame can hold it."""
    import struct

    import pyarrow as pa

    from flowops.sources import files as sources

    def blocks(*parts):
        packed = [pa.Codec("lz4_raw").compress(p, asbytes=True) for p in parts]
        return b"".join(struct.pack(">II", len(p), len(c)) + c for p, c in zip(parts, packed, strict=True))

    large = b"abcdefg" * 700_000
    assert sources.decompress(blocks(large, b"x"), "lz4") == large + b"x"

    def walk(chunk):
        raise AssertionError("walked")

    monkeypatch.setattr(sources, "_lz4_size", walk)
    assert sources.decompress(blocks(b"one " * 9000, b"2" * 262144, b"three"), "lz4") == b"one " * 9000 + b"2" * 262144 + b"three"
