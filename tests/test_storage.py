"""Frame tables, windows, logs and snapshots on disk."""

import os

import pytest
from pyspark.sql import functions as F

from epiframe.functions.ids import dataset_id, recording_id
from epiframe.operators.tables import select_rows
from epiframe.operators.windows import sliding_windows
from epiframe.operators.ordered import row_width
from epiframe.plans.convert import convert_to_windows
from epiframe.plans.record import frames_from_steps, record_dataset
from epiframe.schema import FRAME_SCHEMA
from epiframe.sources import snapshot
from epiframe.sources.frames import DatasetNotFound, ShapeMismatch, check_shapes, read_frames, write_dataset_meta, write_frames
from epiframe.sources.logs import read_train_log, write_metric_lines
from epiframe.sources.windows import read_windows


def frames(spark, lengths):
    rows = [(e, i, i / 30, [float(i)] * 12, [float(i % 5)] * 6, bytearray([i % 256] * 12), bytearray([e] * 12)) for e, n in lengths.items() for i in range(n)]
    return spark.createDataFrame(rows, FRAME_SCHEMA)


def test_frames_round_trip(spark, tmp_path):
    path = str(tmp_path / "data")
    df = frames(spark, {3: 20, 1: 30})
    write_frames(df, path)
    back = read_frames(spark, path)
    assert back.schema.names == FRAME_SCHEMA.names
    assert back.exceptAll(df).count() == 0 and back.count() == 50
    with pytest.raises(DatasetNotFound, match="dataset not found"):
        read_frames(spark, str(tmp_path / "none"))


def test_a_long_episode_fills_several_files(spark, tmp_path):
    path = str(tmp_path / "data")
    narrow = frames(spark, {0: 900, 1: 10, 2: 90}).drop("observation.images.wrist", "observation.images.overhead")
    write_frames(narrow.repartition(7), path, part_bytes=100 * row_width(narrow.schema))
    stored = read_frames(spark, path, schema=None)
    assert stored.count() == 1000 and stored.columns == narrow.columns
    per_file = stored.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("frame_index").alias("i")).orderBy("f").collect()
    assert [r["n"] for r in per_file] == [100] * 10
    assert [r["i"] for r in per_file] == [100 * i for i in range(9)] + [0]


def test_side_tables(spark, tmp_path):
    path = str(tmp_path / "data")
    write_dataset_meta(frames(spark, {0: 31, 1: 10}), path, {"action": 6, "observation.state": 12}, 30)
    info = spark.read.parquet(f"{path}/info").first()
    assert (info["total_episodes"], info["total_frames"], info["fps"]) == (2, 41, 30.0)
    assert spark.read.parquet(f"{path}/stats").count() == 18
    lengths = {r["episode_index"]: (r["length"], r["duration_s"]) for r in spark.read.parquet(f"{path}/episodes").collect()}
    assert lengths == {0: (31, 1.0), 1: (10, pytest.approx(0.3))}


def test_read_windows_prefers_stored_ones(spark, tmp_path):
    path = str(tmp_path / "data")
    with pytest.raises(FileNotFoundError, match="neither complete windows nor frames"):
        read_windows(spark, path)
    df = frames(spark, {0: 40, 1: 12})
    write_frames(df, path)
    assert {r[0] for r in read_windows(spark, path).select(F.size("steps")).collect()} == {12}
    sliding_windows(df).write.parquet(f"{path}/windows")
    assert {r[0] for r in read_windows(spark, path).select(F.size("steps")).collect()} == {16}


def test_conversion_happens_once(spark, tmp_path):
    out = str(tmp_path / "out")
    df = frames(spark, {0: 40}).withColumn("observation.images.wrist", F.unhex(F.repeat(F.lit("0A"), 8 * 8 * 3)))
    shapes = {"observation.images.wrist": (8, 8, 3)}
    first = convert_to_windows(df, out, 6, shapes, (4, 4))
    assert first.count() == 4
    step = first.first()["steps"][0]
    assert len(step["observation.images.wrist"]) == 48 and len(step["action"]) == 6
    stamp = {f: os.stat(f"{out}/windows/{f}").st_mtime_ns for f in os.listdir(f"{out}/windows")}
    assert convert_to_windows(df, out, 6, shapes, (4, 4)).count() == 4
    assert {f: os.stat(f"{out}/windows/{f}").st_mtime_ns for f in os.listdir(f"{out}/windows")} == stamp
    assert convert_to_windows(first, str(tmp_path / "other"), 6) is first
    assert not os.path.exists(tmp_path / "other")


def test_failed_conversion_raises(spark, tmp_path):
    broken = frames(spark, {0: 40}).withColumn("action", F.raise_error(F.lit("no action")).cast("array<float>"))
    with pytest.raises(Exception, match="no action"):
        convert_to_windows(broken, str(tmp_path / "out"), 6)


def test_log_line_numbers(spark, tmp_path):
    for name, n in (("a.log", 5000), ("b.log", 3)):
        (tmp_path / name).write_text("".join(f"loss={i}.5  # step={i}\n" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        raw = read_train_log(spark, str(tmp_path), numbered=False)
        assert raw.where(F.col("file").endswith("a.log")).select("block_start").distinct().count() > 3
        lines = read_train_log(spark, str(tmp_path))
        assert lines.count() == 5003
        assert lines.where(F.regexp_extract("line", r"step=(\d+)", 1).cast("long") != F.col("line_no")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_metric_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.5, 1), ("b", 1e-5, None)], "n string, v double, s long")
    write_metric_lines(df, str(tmp_path / "m"), F.col("n"), F.col("v"), F.col("s"), prefix="x")
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "m")).collect()) == ["x_a=0.5  # step=1", "x_b=1e-05"]


class Counted:
    """A table that counts how often its rows are computed."""

    def __init__(self, spark, n):
        self.acc = spark.sparkContext.accumulator(0)
        acc = self.acc

        def touch(batches):
            for pdf in batches:
                acc.add(len(pdf))
                yield pdf

        self.df = spark.range(n).select(F.col("id").alias("row_index"), (F.col("id") * 2).alias("x")).mapInPandas(touch, "row_index long, x long")


def key(spark, n, inputs="i", selection=""):
    return snapshot.snapshot_signature(spark, "fixture/rows", "/data", n, ["b", "a"], inputs, selection)


def test_snapshot_is_computed_once(spark, tmp_path):
    base = str(tmp_path / "snap")
    counted = Counted(spark, 6)
    k = key(spark, 6)
    first = sorted(map(tuple, snapshot.materialize(counted.df, base, k).collect()))
    seen = counted.acc.value
    assert sorted(map(tuple, snapshot.materialize(counted.df, base, k).collect())) == first
    assert counted.acc.value == seen == 6
    snapshot.materialize(counted.df, base, k, refresh=True)
    assert counted.acc.value == 12


def test_another_signature_is_another_snapshot(spark, tmp_path):
    base = str(tmp_path / "snap")
    for n in (4, 8):
        assert snapshot.materialize(Counted(spark, n).df, base, key(spark, n)).count() == n
    assert len(os.listdir(base)) == 2
    assert len({key(spark, 4), key(spark, 4, "j"), key(spark, 4, "i", "0,2"), key(spark, 5)}) == 4
    assert key(spark, 4) == snapshot.snapshot_signature(spark, "fixture/rows", "/data", 4, ["a", "b"], "i")


def test_no_directory_no_snapshot(spark, tmp_path):
    counted = Counted(spark, 3)
    assert snapshot.materialize(counted.df, None, "k") is counted.df
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("part", ["data", "manifest"])
def test_damaged_snapshot_is_rebuilt(spark, tmp_path, part):
    base = str(tmp_path / "snap")
    k = key(spark, 6)
    snapshot.materialize(Counted(spark, 6).df, base, k)
    folder = f"{snapshot.current(spark, f'{base}/{k}')}/{part}"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"not parquet")
        if name.endswith(".crc"):
            os.remove(f"{folder}/{name}")
    counted = Counted(spark, 6)
    assert snapshot.materialize(counted.df, base, k).count() == 6
    assert counted.acc.value == 6
    assert snapshot.materialize(Counted(spark, 6).df, base, k).count() == 6


def test_readers_of_an_older_snapshot_finish(spark, tmp_path):
    base, k = str(tmp_path / "snap"), key(spark, 6)
    old = snapshot.materialize(Counted(spark, 6).df, base, k)
    new = snapshot.materialize(Counted(spark, 6).df.withColumn("x", F.lit(-1).cast("long")), base, k, refresh=True)
    assert {r["x"] for r in new.collect()} == {-1} and sorted(r["x"] for r in old.collect()) == [0, 2, 4, 6, 8, 10]
    assert {r["x"] for r in snapshot.load(spark, f"{base}/{k}", k).collect()} == {-1}
    assert len(snapshot.drop_old_versions(spark, base, k)) == 1
    assert {r["x"] for r in snapshot.load(spark, f"{base}/{k}", k).collect()} == {-1}


def test_a_crash_leaves_the_old_snapshot(spark, tmp_path, monkeypatch):
    base, k = str(tmp_path / "snap"), key(spark, 6)
    snapshot.materialize(Counted(spark, 6).df, base, k)
    broken = spark.range(6).select(F.col("id").alias("row_index"), F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).cast("long").alias("x"))
    with pytest.raises(Exception, match="lost"):
        snapshot.materialize(broken, base, k, refresh=True)
    monkeypatch.setattr(snapshot, "publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        snapshot.materialize(spark.range(3).toDF("row_index"), base, k, refresh=True)
    assert sorted(r["x"] for r in snapshot.load(spark, f"{base}/{k}", k).collect()) == [0, 2, 4, 6, 8, 10]


def test_only_new_files_are_computed(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "snap")
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    def transform(df):
        return df.select("_digest", (F.col("id") * 10).alias("x")).mapInPandas(touch, "_digest string, x long").where("x != 30")

    def add(a, b):
        spark.range(a, b).coalesce(1).write.mode("append").parquet(str(source))

    def run(**more):
        before = seen.value
        rows = snapshot.materialize_files(spark, str(source), transform, base, "k", **more)
        return rows, sorted(r["x"] for r in rows.collect()), seen.value - before

    add(0, 5)
    add(3, 4)  # nothing is left of it
    old, rows, computed = run()
    assert (rows, computed) == ([0, 10, 20, 40], 6) and old.columns == ["x"]
    assert run()[1:] == ([0, 10, 20, 40], 0)
    add(100, 102)
    assert run()[1:] == ([0, 10, 20, 40, 1000, 1010], 2)
    assert sorted(r["x"] for r in old.collect()) == [0, 10, 20, 40]
    gone = [f for f in source.iterdir() if f.suffix == ".parquet" and spark.read.parquet(str(f)).count() == 5]
    gone[0].unlink()
    assert run()[1:] == ([1000, 1010], 0)
    assert run(refresh=True)[1:] == ([1000, 1010], 3)
    assert len(snapshot.drop_old_versions(spark, base, "k")) == 3 and run()[1:] == ([1000, 1010], 0)


def test_fingerprint_sees_changes(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t"))
    first = snapshot.input_fingerprint(spark, str(tmp_path / "t"))
    assert snapshot.input_fingerprint(spark, str(tmp_path / "t")) == first
    spark.range(3).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    assert snapshot.input_fingerprint(spark, str(tmp_path / "t")) != first


@pytest.mark.parametrize(
    "path,local,want",
    [
        ("/data/org/name", True, "org/name"), ("/data/org/name/", True, "org/name"), ("name", True, "name"), ("hub/name", False, "hub/name"),
        ("a/b/c", False, "a/b/c"), ("", True, "<dataset>"), (None, False, "<dataset>"),
    ],
)
def test_dataset_id(spark, path, local, want):
    assert spark.range(1).select(dataset_id(F.lit(path).cast("string"), F.lit(local))).first()[0] == want


def test_recording_id(spark):
    assert spark.range(1).select(recording_id(F.lit("Robot-Pick-v0"))).first()[0] == "local/robot_pick_v0_dr"


def test_recording_from_steps(spark):
    rows = [("s", i, [9.0], [float(i)], [float(i)], 1.0, i in (2, 5), False) for i in range(8)]
    steps = spark.createDataFrame(rows, "stream_id string, seq long, reset_obs array<double>, next_obs array<double>, action array<double>, reward double, terminated boolean, truncated boolean")
    out = frames_from_steps(steps).orderBy("episode_index", "frame_index")
    assert "reward" not in out.columns
    assert [(r["episode_index"], r["frame_index"], r["observation.state"][0]) for r in out.collect()] == [
        (0, 0, 9.0), (0, 1, 0.0), (0, 2, 1.0), (1, 0, 9.0), (1, 1, 3.0), (1, 2, 4.0), (2, 0, 9.0), (2, 1, 6.0),
    ]


def test_subset_of_a_table(spark):
    df = spark.range(8).withColumnRenamed("id", "row_index")
    assert select_rows(df, [0, 2, 4]).count() == 3


def test_a_recording_is_one_dataset(spark, tmp_path):
    rows = [(s, i, [9.0], [float(i)], [float(i)], i in (2, 5), False) for s in ("x", "y") for i in range(8)]
    steps = spark.createDataFrame(rows, "stream_id string, seq long, reset_obs array<double>, next_obs array<double>, action array<double>, terminated boolean, truncated boolean")
    stored = record_dataset(steps, str(tmp_path / "d"), {"action": 1, "observation.state": 1})
    lengths = {r[0]: r[1] for r in stored.groupBy("episode_index").count().collect()}
    assert lengths == {0: 3, 1: 3, 2: 2, 3: 3, 4: 3, 5: 2}
    assert spark.read.parquet(str(tmp_path / "d/info")).first()["total_episodes"] == 6


def test_shapes_are_checked(spark):
    df = frames(spark, {0: 3}).drop("observation.images.wrist", "observation.images.overhead")
    assert check_shapes(df) is df
    shorter = df.withMetadata("action", {"shape": [7]})
    with pytest.raises(ShapeMismatch, match="action: 3 rows without 7 values"):
        check_shapes(shorter)
