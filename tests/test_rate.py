"""Late frames and silent episodes on a stream."""

import random

from pyspark.sql import functions as F

from epiframe.operators.control import rate_audit
from epiframe.streaming.rate import stream_rate
from epiframe.streaming.sinks import drain, stream_parquet

SCHEMA = "episode_index long, frame_index long, ts timestamp, done boolean"


def feed(spark, tmp_path, parts, **options):
    for rows in parts:
        df = spark.createDataFrame(rows, "episode_index long, frame_index long, us long, done boolean").withColumn("ts", F.timestamp_micros("us"))
        df.select("episode_index", "frame_index", "ts", "done").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
        got = drain(stream_rate(live, **options), str(tmp_path / "out"), str(tmp_path / "cp"))
    return sorted(map(tuple, got.collect()), key=repr)


def test_an_episode_that_falls_silent_is_reported_without_its_next_frame(spark, tmp_path):
    second = 1_000_000
    frames = lambda e, start, n, done=False: [(e, i, start + i * 33_000, done and i == n - 1) for i in range(n)]
    # 0 stops after ten frames, 1 ends there as it should, 2 goes on for ten seconds, 0 comes back when 2 is through
    parts = [
        [*frames(0, second, 10), *frames(1, second, 10, True), *frames(2, second, 10)],
        [(2, i, second + i * 33_000, False) for i in range(10, 300)],
        [(0, 10, 12 * second, False), (0, 9, 12 * second, False), (0, None, 12 * second, False), (0, 11, None, False)],
    ]
    got = feed(spark, tmp_path, parts, done="done")
    assert got == [(0, 10, "late", 12 * second - (second + 9 * 33_000)), (0, 9, "silent", None)]


def test_late_frames_are_those_of_the_batch(spark, tmp_path):
    rng = random.Random(5)
    rows, now = [], {e: 10**6 for e in range(4)}
    for i in range(120):
        for e in now:
            now[e] += rng.choice([20_000, 33_000, 33_334, 34_000, 90_000])
            rows.append((e, i, now[e], False))
    rows.sort(key=lambda r: r[2])
    got = feed(spark, tmp_path, [rows[k : k + 120] for k in range(0, 480, 120)], patience_s=60.0)
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, us long, done boolean").withColumn("ts", F.timestamp_micros("us"))
    want = {r["episode_index"]: (r["n_overruns"], r["max_gap_us"]) for r in rate_audit(frames).collect()}
    assert {r[2] for r in got} == {"late"}
    for e, (n, most) in want.items():
        gaps = [r[3] for r in got if r[0] == e]
        assert (len(gaps), max(gaps)) == (n, most)


def test_many_episodes_share_a_bucket(spark, tmp_path):
    """Keys of all kinds, null among them, in one bucket: its state and its one timer tell them apart across batches."""
    second, big = 1_000_000, 2**60 + 1
    names = [(None, 1), (big, 1), (big + 2, 1), (big, 2)]
    schema = "a long, b int, frame_index long, ts timestamp"
    for part in range(3):
        # the last key has frames in the first part alone, another is late within the second
        rows = [(a, b, 3 * part + i, second * (1 + 5 * part) + 33_000 * i + (50_000 if part == 1 and i == 2 and b == 1 and a == big else 0)) for a, b in names for i in range(3) if b == 1 or part == 0]
        df = spark.createDataFrame(rows, "a long, b int, frame_index long, us long").withColumn("ts", F.timestamp_micros("us"))
        df.drop("us").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        got = drain(stream_rate(live, keys=["a", "b"], patience_s=20.0 if part < 2 else 0.5, delay="0 seconds", buckets=1), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert got.dtypes[:2] == [("a", "bigint"), ("b", "int")]
    late = {(r["a"], r["b"], r["frame_index"], r["gap_us"]) for r in got.where("kind = 'late'").collect()}
    gap = 5 * second - 66_000
    want = {(a, 1, 3 * part, gap) for a, b in names if b == 1 for part in (1, 2)} - {(big, 1, 6, gap)}
    assert late == want | {(big, 1, 5, 83_000), (big, 1, 6, gap - 50_000)}
