"""Streams: windows in order, and a sink whose manifest names every shard once."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import incremental, manifest, ordered

START = 1704067199.0  # a second before midnight


def frames(spark, rows):
    d = spark.createDataFrame(rows, "track string, f bigint, value double, present boolean, at double")
    return d.withColumn("seen_at", F.timestamp_seconds("at")).drop("at")


def batches(spark, folder, parts):
    for part in parts:
        frames(spark, part).coalesce(1).write.mode("append").parquet(folder)


def plain(rows, width, stride, most_absent):
    by = {}
    for t, f, v, p, _ in rows:
        by.setdefault(t, {}).setdefault(f, (v, p))
    out = []
    for t, held in by.items():
        for s in range(0, max(held) + 1, stride):
            w = [held.get(f) for f in range(s, s + width)]
            if None not in w and sum(not p for _, p in w) <= most_absent:
                out.append((t, s, [v for v, _ in w], sum(not p for _, p in w)))
    return sorted(out)


def collected(spark, out):
    return sorted((r.track, r.window_id, list(r.states), r.absent) for r in spark.read.option("recursiveFileLookup", "true").parquet(out).collect())


@pytest.mark.parametrize("width, stride", [(8, 8), (4, 2)])
def test_frames_in_no_order_give_the_windows_of_a_batch(spark, tmp_path, width, stride):
    draw = random.Random(width)
    rows = [(t, f, float(f * 10 + k), draw.random() > 0.3, START + f * 0.5) for k, t in enumerate("ab") for f in range(45 + k)]
    rows += [("a", 3, -1.0, True, START + 30)]  # a repeated frame
    late = sorted(rows[:-1], key=lambda r: draw.random())
    batches(spark, f"{tmp_path}/in", [late[:30], late[30:60], [*late[60:], rows[-1]]])
    for _ in range(2):
        stream = ordered.ordered_windows(incremental.stream_parquet(spark, f"{tmp_path}/in", 1), width, stride, lateness="1 hour")
        incremental.run_available(stream, f"{tmp_path}/out", f"{tmp_path}/c")
    assert collected(spark, f"{tmp_path}/out") == plain(rows[:-1], width, stride, 3)


def test_a_window_without_a_frame_holds_up_the_next_until_the_watermark(spark, tmp_path):
    rows = [("a", f, float(f), True, START + f) for f in range(24) if f != 5]
    stream = lambda **how: ordered.ordered_windows(incremental.stream_parquet(spark, f"{tmp_path}/in", 1), 8, lateness="1 second", **how)
    batches(spark, f"{tmp_path}/in", [rows])
    incremental.run_available(stream(), f"{tmp_path}/held", f"{tmp_path}/c0")
    later = [("z", 0, 0.0, True, START + 9000)]
    batches(spark, f"{tmp_path}/in", [later, [("z", 1, 0.0, True, START + 9001)]])
    incremental.run_available(stream(), f"{tmp_path}/out", f"{tmp_path}/c1")
    assert [r[1] for r in collected(spark, f"{tmp_path}/out")] == [8, 16]
    with pytest.raises(Exception, match="window 0 of a has 7 of 8 frames"):
        incremental.run_available(stream(unresolved="raise"), f"{tmp_path}/out2", f"{tmp_path}/c2")


def test_frames_that_no_window_needs_go():
    class State:
        def __init__(self):
            self.rows, self.value = [], None

        get = lambda self: iter(self.rows) if self.value is None else self.value
        put = lambda self, rows: setattr(self, "rows", rows)
        clear = lambda self: setattr(self, "rows", [])
        exists = lambda self: self.value is not None
        update = lambda self, v: setattr(self, "value", v)

    w = ordered._Windows(4, 4, 3, "drop")
    w.frames, w.pending = State(), State()
    held = {f: (float(f), True) for f in range(10)}
    found, start = w._whole(("t",), held, 0)
    assert [r[1] for r in found] == [0, 4] and start == 8
    w._store(held, start, 0)
    assert [r[0] for r in w.frames.rows] == [8, 9]


def test_a_rerun_after_a_lost_commit_repeats_nothing(spark, tmp_path):
    d = spark.range(200).withColumn("v", F.concat(F.lit("é"), "id"))
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c"
    run = lambda: manifest.run_to_manifest(incremental.stream_parquet(spark, source, 1), out, state)
    for part in ("id < 50", "id >= 50 and id < 120"):
        d.filter(part).repartition(2).write.mode("append").parquet(source)
    run()
    # the sink knows of the last epoch, the checkpoint does not: as if killed in between
    last = max((tmp_path / "c" / "commits").iterdir(), key=lambda p: (p.name.isdigit(), int(p.name) if p.name.isdigit() else -1))
    before = sorted(p.name for p in (tmp_path / "out").glob("shard-*"))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert sorted(p.name for p in (tmp_path / "out").glob("shard-*")) == before
    # killed before the manifest: files are there, but count for nothing until the epoch is run again
    entry = max((tmp_path / "out" / "_manifest").glob("epoch-*.jsonl"))
    entry.unlink()
    assert manifest.read_shards(spark, out, "id bigint, v string").count() < 120
    for p in (last, last.parent / f".{last.name}.crc"):
        p.unlink(missing_ok=True)
    run()
    d.filter("id >= 120").repartition(2).write.mode("append").parquet(source)
    run()
    rows = manifest.read_shards(spark, out, "id bigint, v string").collect()
    assert sorted((r.id, r.v) for r in rows) == [(i, f"é{i}") for i in range(200)]
    listed = manifest.read_manifest(spark, out).collect()
    assert len({r.shard for r in listed}) == len(listed) and sum(r["rows"] for r in listed) == 200
    assert sorted(r.shard + ".done" for r in listed) == sorted(p.name for p in (tmp_path / "out" / "_done").glob("*.done"))
    assert list((tmp_path / "out" / "_temporary").glob("*")) == []


def test_a_failing_epoch_leaves_no_shards(spark, tmp_path):
    spark.range(20).write.parquet(f"{tmp_path}/in")
    bad = incremental.stream_parquet(spark, f"{tmp_path}/in").withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("string")))
    with pytest.raises(Exception, match="stop"):
        manifest.run_to_manifest(bad, f"{tmp_path}/out", f"{tmp_path}/c")
    assert list((tmp_path / "out").glob("shard-*")) == []
    shutil.rmtree(tmp_path / "c")


def kept_rows(spark, state):
    """Rows of a stream's last state."""
    return spark.read.format("statestore").load(state).count()


def test_presence_windows_share_the_state_of_a_bucket(spark, tmp_path):
    big = 2**60 + 1
    rows = [(t, f, 0.0, f > 1, START + f) for t in [*range(big, big + 60), None] for f in range(8)] + [(big, 8, 0.0, True, START)]
    typed = lambda part: frames(spark, [(None if t is None else str(t), *x) for t, *x in part]).withColumn("track", F.col("track").cast("bigint")).coalesce(1)
    for n, part in enumerate(([r for r in rows if r[1] in (0, 3, 8)], [r for r in rows if r[1] in (1, 2, 4, 5, 6, 7)])):
        typed(part).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.presence_windows(incremental.stream_parquet(spark, f"{tmp_path}/in", 1), 8, lateness="1 hour", buckets=2)
        incremental.run_available(stream, f"{tmp_path}/out", f"{tmp_path}/c")
        assert kept_rows(spark, f"{tmp_path}/c") == (2, 1)[n]  # 62 windows were pending, then one
    got = sorted((r.track or 0, r.window_id, r.absent) for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out").collect())
    assert got == sorted((t or 0, 0, 2) for t in [*range(big, big + 60), None])


def test_ordered_tracks_share_a_bucket_and_fall_due_each_for_itself(spark, tmp_path):
    whole = [(t, f, float(f), True, START + 1014.5) for t in "abcdefgh" for f in range(16)]
    lacking = [(t, f, float(f), True, START + at + f) for t, at in (("x", 0), ("y", 100), ("z", 1000)) for f in range(16) if f != 5]
    stream = lambda: ordered.ordered_windows(incremental.stream_parquet(spark, f"{tmp_path}/in", 1), 8, lateness="1 second", buckets=1)
    for part in (whole[::2] + lacking, whole[1::2]):  # the watermark comes to 1014 seconds: x and y are overdue, z is not
        batches(spark, f"{tmp_path}/in", [part])
        incremental.run_available(stream(), f"{tmp_path}/out", f"{tmp_path}/c")
    got = [(r[0], r[1]) for r in collected(spark, f"{tmp_path}/out")]
    assert [g for g in got if g[0] in "abcdefgh"] == [(t, s) for t in "abcdefgh" for s in (0, 8)]
    assert [g for g in got if g[0] in "xyz"] == [("x", 8), ("y", 8)]
