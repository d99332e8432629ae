"""Streams give what the batch operators give."""

import random

import pytest
from pyspark.sql import functions as F

from epiframe.operators.control import stuck_actions
from epiframe.schema import named
from epiframe.sources.logs import stream_train_log
from epiframe.plans.record import frames_from_steps
from epiframe.streaming.record import stream_frames
from epiframe.streaming.metrics import stream_metrics
from epiframe.streaming.sinks import append_to, drain, stream_parquet
from epiframe.streaming.stuck import stream_stuck_actions


@pytest.mark.parametrize("warn,chunk", [(2, 8), (3, 4096), (5, 6)])
def test_stuck_actions_over_many_batches(spark, tmp_path, warn, chunk):
    """Frames arrive in order in ten files, one per micro-batch; runs and chunks cross them."""
    rng = random.Random(warn)
    rows = []
    for e in range(3):
        a = []
        while len(a) < 60:
            a += [rng.randrange(2)] * rng.randrange(1, 2 * warn + 3)
        rows += [(e, i, [float(v)]) for i, v in enumerate(a[:60])]
    schema = "episode_index long, frame_index long, action array<double>"
    frames = spark.createDataFrame(rows, schema)
    for b in range(10):
        frames.where((F.col("frame_index") >= 6 * b) & (F.col("frame_index") < 6 * b + 6)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = drain(stream_stuck_actions(live, warn_steps=warn, chunk=chunk), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r["episode_index"], r["frame_index"]) for r in out.collect())
    want = sorted((r["episode_index"], r["frame_index"]) for r in stuck_actions(frames, warn_steps=warn, chunk=chunk).collect())
    assert got == want and got


def test_metrics_of_a_growing_log(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "1.log").write_text("INFO epoch done\npc_success=0.73  # step=1\n")
    run = lambda: drain(stream_metrics(stream_train_log(spark, str(log), "*.log")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r["name"], r["value"], r["step"]) for r in run().collect()) == [("pc_success", 0.73, 1)]
    (log / "2.log").write_text("recon_loss=1e-5\nx=0.5.\n")
    (log / "skip.txt").write_text("a=1\n")
    assert sorted((r["name"], r["value"], r["step"]) for r in run().collect()) == [("pc_success", 0.73, 1), ("recon_loss", 1e-5, None)]


def test_batch_and_stream_share_the_parser(spark):
    lines = spark.createDataFrame([("act", "eval/pc_success=0.5  # step=3"), ("act", "loss=2")], "target_arch string, line string")
    assert [tuple(r) for r in stream_metrics(lines, F.col("target_arch")).collect()] == [("act", "pc_success", 0.5, 3)]


def test_ingest_resumes_without_repeating(spark, tmp_path):
    schema = "id long"
    spark.range(5).write.parquet(str(tmp_path / "in"))
    for extra in (0, 3):
        if extra:
            spark.range(100, 100 + extra).write.mode("append").parquet(str(tmp_path / "in"))
        query = append_to(stream_parquet(spark, str(tmp_path / "in"), spark.range(1).schema, "*.parquet"), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema(schema).parquet(str(tmp_path / "out")).count() == 8


def test_state_of_finished_episodes_is_dropped(spark, make_frames, tmp_path):
    """Three episodes, two of which end: only the open one is remembered."""
    frames = make_frames({e: [[float(i // 5), 0.0] for i in range(40)] for e in range(3)})
    ended = (F.col("frame_index") == 39) & (F.col("episode_index") < 2)
    rows = frames.select("episode_index", "frame_index", "action", ended.alias("done"))
    for half in (0, 1):
        part = rows.where(F.floor(F.col("frame_index") / 20) == half).coalesce(1).sortWithinPartitions("episode_index", "frame_index")
        part.write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    hits = stream_stuck_actions(live, warn_steps=4, chunk=16, done="done")
    query = append_to(hits, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    batches = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(batches) >= 2 and max(batches) >= 3
    assert batches[-1] == 1
    got = sorted((r["episode_index"], r["frame_index"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r["episode_index"], r["frame_index"]) for r in stuck_actions(frames, warn_steps=4, chunk=16).collect())
    assert got == want and got


STEP = "stream_id long, seq long, reset_obs array<double>, next_obs array<double>, action array<double>, terminated boolean, truncated boolean, `cam.left` binary"


def test_live_recording_is_batch_recording(spark, tmp_path):
    """Micro-batches end inside episodes, and the query starts anew between them; some steps come twice."""
    rng = random.Random(3)
    rows = []
    for stream in range(4):
        for i in range(60):
            vector = lambda k: [float(1000 * stream + i), float(k)] if rng.random() < 0.95 else None  # noqa: B023, E731
            rows.append((stream, 3 * i, vector(0), vector(1), vector(2), rng.random() < 0.1, rng.choice([None, False, rng.random() < 0.05]), bytearray([stream, i])))
    steps = spark.createDataFrame(rows, STEP)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for b in range(5):
        now = [r for r in rows if 12 * b <= r[1] // 3 < 12 * (b + 1)] + [r for r in rows if r[1] // 3 == 12 * b - 2]
        spark.createDataFrame([*now, (0, None, None, None, None, True, True, None)], STEP).repartition(2).write.mode("append").parquet(source)
        live = stream_parquet(spark, source, steps.schema)
        got = drain(stream_frames(live, images=["cam.left"], max_steps=None), out, str(tmp_path / "cp"))
    want = frames_from_steps(steps, images=["cam.left"], keep_seq=True)
    closed = steps.where(F.coalesce("terminated", F.lit(False)) | F.coalesce("truncated", F.lit(False))).groupBy("stream_id").agg(F.max("seq").alias("last"))
    want = want.join(closed, "stream_id").where("seq <= last").drop("last")
    found = got.select(*[named(c) for c in want.columns]).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, want.collect()))
    assert len({(r["stream_id"], r["seq"]) for r in found}) == len(found) > 100


def test_live_episodes_end_by_length(spark, tmp_path):
    rows = [(7, i, [0.0], [float(i)], [1.0], False, False, None) for i in range(25)]
    spark.createDataFrame(rows, STEP).write.parquet(str(tmp_path / "in"))
    live = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], STEP).schema)
    got = drain(stream_frames(live, max_steps=10), str(tmp_path / "out"), str(tmp_path / "cp")).collect()
    assert sorted((r["episode_index"], r["frame_index"], r["observation.state"]) for r in got) == [(e, i, [0.0 if i == 0 else 10.0 * e + i - 1]) for e in range(2) for i in range(10)]


def test_a_null_action_does_not_end_the_stream(spark, tmp_path):
    """Nulls and vectors of another length are a change, in the stream as in the batch."""
    actions = [[1.0]] * 4 + [None, None, None] + [[1.0]] * 3 + [[1.0, 2.0]] * 4 + [[1.0]] * 2 + [[None]] * 4
    rows = [(0, i, a) for i, a in enumerate(actions)]
    schema = "episode_index long, frame_index long, action array<double>"
    frames = spark.createDataFrame(rows, schema)
    for b in range(5):
        frames.where((F.col("frame_index") >= 4 * b) & (F.col("frame_index") < 4 * b + 4)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = drain(stream_stuck_actions(live, warn_steps=3), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = stuck_actions(frames, warn_steps=3)
    assert sorted(r["frame_index"] for r in got.collect()) == sorted(r["frame_index"] for r in want.collect()) == [3, 13]


@pytest.mark.parametrize("buckets", [1, 3])
def test_many_streams_share_a_bucket(spark, tmp_path, buckets):
    """Episodes of streams in one bucket close at different steps, across batches, one of them of a null stream."""
    schema = "stream_id long, seq long, reset_obs array<double>, next_obs array<double>, action array<double>, terminated boolean, truncated boolean"
    names, rows = [None, 2**60 + 1, 2**60 + 2, 5], []
    for k, s in enumerate(names):
        rows += [(s, i, [-1.0], [float(10 * k + i)], [float(k)], (i + 1) % (k + 2) == 0, False) for i in range(9)]
    for part in range(3):
        spark.createDataFrame([r for r in rows if r[1] // 3 == part], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        got = drain(stream_frames(live, max_steps=None, buckets=buckets), str(tmp_path / "out"), str(tmp_path / "cp"))
    found = {(r["stream_id"], r["seq"]): (r["episode_index"], r["frame_index"], r["observation.state"][0]) for r in got.collect()}
    want = {}
    for k, s in enumerate(names):
        for i in range(9 // (k + 2) * (k + 2)):
            want[s, i] = (i // (k + 2), i % (k + 2), -1.0 if i % (k + 2) == 0 else float(10 * k + i - 1))
    assert found == want and got.count() == len(want)
