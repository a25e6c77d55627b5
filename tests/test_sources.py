"""Sources, sinks and streaming."""

import gzip
import io
import json
import struct
import tarfile
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.sources import archives, sinks, text
from tidemark.streaming import incremental


def test_jsonl_skips_blank_and_bad_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "t": "x"}\n\n{bad\n{"id": 2}\n')
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(b'{"id": 3, "t": "z"}\n'))
    got = text.read_jsonl(spark, str(tmp_path), "id int, t string")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x"), (2, None), (3, "z")]


def test_truncated_gzip_keeps_what_was_read(spark, tmp_path):
    lines = "".join(json.dumps({"id": i, "t": f"{i * 7919 % 10007}"}) + "\n" for i in range(50_000)).encode()
    packed = gzip.compress(lines)
    whole = packed[: len(packed) // 2]
    (tmp_path / "a.jsonl.gz").write_bytes(whole)
    there = zlib.decompressobj(zlib.MAX_WBITS | 16).decompress(whole).count(b"\n")
    got = text.read_salvaged(spark, str(tmp_path), "id int, t string")
    assert there > 20_000 and [r.id for r in got.orderBy("id").collect()] == list(range(there))
    broken = bytearray(packed)
    broken[-8:-4] = b"0000"  # a wrong checksum
    (tmp_path / "a.jsonl.gz").write_bytes(bytes(broken))
    assert text.read_salvaged(spark, str(tmp_path), "id int").count() >= 49_000


def test_strict_jsonl_raises(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"window_id": 1}\n{"window_id": null}\n')
    with pytest.raises(Exception, match="missing or malformed window_id"):
        text.read_jsonl_strict(spark, str(tmp_path), "window_id int", ("window_id",)).collect()


def test_json_documents_and_capped_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2, "s": "}{"},\n {"id": 3}]')
    assert text.read_json_documents(spark, str(tmp_path), "id int").count() == 3
    got = archives.capped_json(spark, str(tmp_path), 40).collect()
    assert [json.loads(r.record)["id"] for r in got] == [1, 2] and 0 < got[0].share < 1
    assert archives.capped_json(spark, str(tmp_path), 1 << 20).count() == 3


def test_strict_jsonl_refuses_other_types_and_empty_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"window_id": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|window_id"):
        text.read_jsonl_strict(spark, str(tmp_path), "window_id int", ("window_id",)).collect()
    (tmp_path / "b.jsonl").write_text("")
    with pytest.raises(ValueError, match="empty file"):
        text.read_jsonl_strict(spark, str(tmp_path), "window_id int")
    with pytest.raises(ValueError, match="total"):
        text.partition_of(F.lit(1), 3, "contiguous")
    got = text.peek(spark.createDataFrame([('{"a": 1, "b": "<seed2_3>"}',), ("plain",)], "t string"), 5, "t").collect()
    assert [(r.has_tokens, r["keys"]) for r in got] == [(True, ["a", "b"]), (False, None)]


def test_members_of_a_packed_tar(spark, tmp_path):
    (tmp_path / "a.tar.gz").write_bytes(tar_bytes({f"{i}.txt": b"x" * 1000 for i in range(50)}))
    assert archives.tar_members(spark, str(tmp_path), ".txt").count() == 50


def test_posts(spark, tmp_path):
    (tmp_path / "p.xml").write_text('<posts><row Id="1" PostTypeId="1" Title="Q" Body="b"/><row Id="2" PostTypeId="2" ParentId="1" Body="a"/><row Id="3" PostTypeId="2" ParentId="9" Body="x"/></posts>')
    got = text.answers_with_questions(text.read_posts(spark, str(tmp_path))).collect()
    assert [(r.Id, r.question, r.answer) for r in got] == [(2, "Q", "a")]


def test_partitioning_and_fps(spark):
    d = spark.range(10)
    assert [r[0] for r in d.select(text.partition_of(F.col("id"), 3, "contiguous", 10)).collect()] == [0] * 4 + [1] * 4 + [2] * 2
    assert [r[0] for r in d.select(text.partition_of(F.col("id"), 3, "modulo")).collect()] == [i % 3 for i in range(10)]
    f = spark.createDataFrame([(0.0,), (241.0,), (29.97,)], "f double")
    assert [r[0] for r in f.select(text.valid_fps(F.col("f"))).collect()] == [None, None, 29.97]


def tar_bytes(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_tar_opens_one_level(spark, tmp_path):
    inner = tar_bytes({"c.jsonl": b"3", "d.tar": tar_bytes({"e.jsonl": b"4"})})
    (tmp_path / "a.tar.gz").write_bytes(tar_bytes({"a.jsonl": b"1", "b.txt": b"2", "in.tar.gz": inner}))
    got = archives.tar_members(spark, str(tmp_path), ".jsonl").collect()
    assert sorted((r.member, bytes(r.content)) for r in got) == [("a.jsonl", b"1"), ("in.tar.gz!c.jsonl", b"3")]
    recs = spark.createDataFrame([("a", "a.jsonl"), ("a", "none")], "shard string, media string")
    m = archives.tar_members(spark, str(tmp_path), "a.jsonl").withColumn("path", F.lit("/x/a.wds"))
    assert archives.webdataset_pairs(recs, m).filter("content is not null").count() == 1


def test_zip_and_npy(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("run/001/f1.json", "{}")
        z.writestr("other.txt", "")
    got = archives.zip_members(spark, f"{tmp_path}/z.zip", r"^(\w+)/(\d+)/").collect()
    assert [(r.category, r.seq_id) for r in got] == [("run", "001")]
    np.save(tmp_path / "a.npy", np.arange(6, dtype=np.float32).reshape(2, 3))
    rows = archives.npy_arrays(spark, str(tmp_path)).orderBy("row").collect()
    assert [(r.row, r.shape, r["values"]) for r in rows] == [(0, [2, 3], [0, 1, 2]), (1, [2, 3], [3, 4, 5])]
    np.save(tmp_path / "a.npy", np.asfortranarray(np.arange(12).reshape(4, 3)))
    assert [r["values"] for r in archives.npy_arrays(spark, str(tmp_path)).orderBy("row").collect()] == np.arange(12).reshape(4, 3).tolist()
    np.save(tmp_path / "a.npy", np.arange(6, dtype=np.float32).reshape(2, 3))
    r = archives.npy_shapes(spark, str(tmp_path)).first()
    assert r.shape == [2, 3] and r.kind == "float32"


def field(number, body):
    return bytes([number << 3 | 2]) + varint(len(body)) + body


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def test_tfrecords(spark, tmp_path):
    ints = field(3, field(1, varint(300) + varint((1 << 64) - 1)))
    strings = field(1, field(1, b"abc"))
    floats = field(2, field(1, struct.pack("<2f", 1.5, 2.0)))
    entry = lambda name, body: field(1, field(1, name) + field(2, body))
    example = field(1, entry(b"n", ints) + entry(b"s", strings)) + field(2, entry(b"l", field(1, floats) + field(1, strings)))
    record = struct.pack("<Q", len(example)) + b"0000" + example + b"0000"  # checksums are not looked at
    (tmp_path / "a.tfrecord").write_bytes(record + record[:-20])
    got = {(r.record, r.list, r.name): (r.kind, r["values"]) for r in archives.sequence_examples(spark, str(tmp_path)).collect()}
    assert got == {(0, -1, "n"): ("int64", ["300", "-1"]), (0, -1, "s"): ("bytes", ["abc"]), (0, 0, "l"): ("float", ["1.5", "2.0"]), (0, 1, "l"): ("bytes", ["abc"])}


def test_messages_without_a_schema(spark, tmp_path):
    body = field(1, b"hello world") + field(2, field(3, b"\xff\xfe") + bytes([4 << 3, 7])) + bytes([5 << 3 | 5]) + b"abcd" + bytes([4 << 3, 9, 4 << 3, 8])
    assert archives.walk(body) == {"1": ["hello world"], "2": [{"3": ["fffe"], "4": [7]}], "5": ["abcd"], "4": [9, 8]}
    assert archives.walk(body, most_depth=1)["2"] == [(field(3, b"\xff\xfe") + bytes([4 << 3, 7])).hex()]
    assert archives.message([(1, b"hello world"), (4, -1)]) == field(1, b"hello world") + bytes([4 << 3]) + varint((1 << 64) - 1)
    (tmp_path / "a.tfrecord").write_bytes(struct.pack("<Q", len(body)) + b"0000" + body + b"0000")
    r = archives.message_trees(archives.read(spark, "tfrecord", str(tmp_path))).selectExpr("variant_get(tree, '$[\\'2\\'][0][\\'4\\'][0]', 'int') AS x").first()
    assert r.x == 7


def test_named_shards_and_ranks(spark, tmp_path):
    d = spark.range(100).withColumn("name", F.concat(F.lit("x_rank_"), F.col("id") % 3, F.lit(".jsonl")))
    sinks.write_named_shards(d, f"{tmp_path}/n", "train", 4, "id")
    assert sorted(p.name for p in (tmp_path / "n").iterdir() if not p.name.startswith(".")) == [f"train-{i:05d}-of-00004.jsonl.gz" for i in range(4)]
    assert spark.read.json(f"{tmp_path}/n").count() == 100
    sinks.write_per_rank(d, f"{tmp_path}/r", "name")
    assert {(r["rank"], r["count"]) for r in spark.read.json(f"{tmp_path}/r").groupBy("rank").count().collect()} == {(0, 34), (1, 33), (2, 33)}


def test_sinks(spark, tmp_path):
    d = spark.range(100).withColumn("v", F.col("id") % 3)
    sinks.write_parquet_shards(d, f"{tmp_path}/p", 4)
    sinks.check_shards(spark, f"{tmp_path}/p", 4)
    with pytest.raises(ValueError, match="4 of 5"):
        sinks.check_shards(spark, f"{tmp_path}/p", 5)
    sinks.write_jsonl(d, f"{tmp_path}/j", shards=2)
    assert spark.read.json(f"{tmp_path}/j").count() == 100
    sinks.write_row_shards(d, f"{tmp_path}/r", "id", 30)
    assert {(r.shard, r["count"]) for r in spark.read.json(f"{tmp_path}/r").groupBy("shard").count().collect()} == {(0, 30), (1, 30), (2, 30), (3, 10)}
    assert sinks.write_jsonl_if_any(d, f"{tmp_path}/some") and spark.read.json(f"{tmp_path}/some").count() == 100
    assert not sinks.write_jsonl_if_any(d.limit(0), f"{tmp_path}/none") and not (tmp_path / "none").exists()
    assert sinks.shard_name("train", 3, 20) == "train-00003-of-00020.jsonl.gz"
    out = sinks.replace_columns(d, spark.createDataFrame([(1, 24.0)], "id bigint, fps double"), "id", {"fps": 30.0})
    assert {r.fps for r in out.filter("id < 3").collect()} == {24.0, 30.0}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", "a" if i % 2 else "b", float(i)) for i in range(30)]
    d = spark.createDataFrame(rows, "event_id int, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    d.filter("event_id < 20").write.parquet(f"{tmp_path}/in")
    stream = lambda: incremental.stream_parquet(spark, f"{tmp_path}/in", 1)
    incremental.run_available(incremental.windowed_counts(stream()), f"{tmp_path}/complete", f"{tmp_path}/c1", mode="complete")
    last = max((tmp_path / "complete").glob("batch=*"), key=lambda p: int(p.name.split("=")[1]))
    key = lambda df: sorted(tuple(r) for r in df.select("start", "event_type", "n", "total").collect())
    assert key(spark.read.parquet(str(last))) == key(incremental.windowed_counts(d.filter("event_id < 20")))
    for part in ("event_id < 0", "event_id >= 20"):
        d.filter(part).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.run_available(stream(), f"{tmp_path}/out", f"{tmp_path}/c2")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 30


def test_presence_windows_stream(spark, tmp_path):
    rows = [("a", i, not (i < 4), f"2024-01-01 00:00:{i:02d}") for i in range(16)]
    d = spark.createDataFrame(rows, "track string, f bigint, present boolean, seen_at string").withColumn("seen_at", F.col("seen_at").cast("timestamp"))
    assert [tuple(r) for r in incremental.presence_windows(d, 8).collect()] == [("a", 8, 0)]
    d.write.parquet(f"{tmp_path}/in")
    incremental.run_available(incremental.presence_windows(incremental.stream_parquet(spark, f"{tmp_path}/in"), 8), f"{tmp_path}/out", f"{tmp_path}/c")
    assert [r.window_id for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [8]


def test_presence_windows_cross_midnight_and_batches(spark, tmp_path):
    start = 1704067199.0  # one second before midnight
    rows = [("a", i, True, start + i * 0.25) for i in range(16)] + [("b", 0, True, start)] + [("c", i, i > 3, start + 400 + i) for i in range(8)]
    d = spark.createDataFrame(rows, "track string, f bigint, present boolean, at double").withColumn("seen_at", F.timestamp_seconds("at")).drop("at")
    key = lambda df: sorted((r.track, r.window_id, r.absent) for r in df.collect())
    assert key(incremental.presence_windows(d, 8)) == [("a", 0, 0), ("a", 8, 0)]
    stream = lambda **how: incremental.presence_windows(incremental.stream_parquet(spark, f"{tmp_path}/in", 1), 8, lateness="1 second", **how)
    for part in ("f < 5 and track <> 'c'", "f >= 5 and track <> 'c'", "track = 'c'"):
        d.filter(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.run_available(stream(), f"{tmp_path}/out", f"{tmp_path}/c")
    assert key(spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out")) == [("a", 0, 0), ("a", 8, 0)]
    with pytest.raises(Exception, match="window 0 of b has 1 of 8 frames"):
        incremental.run_available(stream(unresolved="raise"), f"{tmp_path}/out2", f"{tmp_path}/c2")
        spark.createDataFrame([("z", 0, True, start + 9000)], "track string, f bigint, present boolean, at double").withColumn("seen_at", F.timestamp_seconds("at")).drop("at").write.mode("append").parquet(f"{tmp_path}/in")
        incremental.run_available(stream(unresolved="raise"), f"{tmp_path}/out2", f"{tmp_path}/c2")
