"""Batches on disk: every window once per epoch, whole batches in a file, images moved once."""

import os

import pytest
from pyspark.sql import functions as F

from epiframe.operators.chunked import GapError, dense_lengths
from epiframe.operators.ordered import row_width
from epiframe.operators.sampling import epoch_batches
from epiframe.operators.windows import window_starts
from epiframe.sources import batches

LENGTHS = {0: 40, 1: 15, 2: 16, 5: 200, 7: 63}


def frames(spark, lengths=LENGTHS):
    rows = [(e, i, [float(e), float(i)], bytearray([e, i % 256, 7])) for e, n in lengths.items() for i in range(n)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, action array<double>, `cam.left` binary").repartition(6)


@pytest.mark.parametrize("batch_size,epochs,files", [(4, 2, 3), (7, 1, 1), (1000, 3, 1), (1, 1, 5)])
def test_files_hold_the_batches_of_every_epoch(spark, tmp_path, batch_size, epochs, files):
    df, path = frames(spark), str(tmp_path / "b")
    starts = window_starts(df)
    n = starts.count()
    width = row_width(df.schema) * 16 * batch_size
    batches.write_batches(df, path, batch_size, epochs, part_bytes=width * max(1, -(-n // batch_size) // files))
    want = {(r["epoch"], r["batch_id"], r["slot"], r["episode_index"], r["start"]) for r in epoch_batches(starts, batch_size, epochs).collect()}
    rows = batches.read_batches(spark, path).collect()
    assert {(r["epoch"], r["batch_id"], r["slot"], r["episode_index"], r["start"]) for r in rows} == want
    assert len(rows) == 16 * n * epochs and len({(r["epoch"], r["batch_id"], r["slot"], r["frame_index"]) for r in rows}) == len(rows)
    assert all(r["start"] <= r["frame_index"] < r["start"] + 16 and r["action"] == [r["episode_index"], r["frame_index"]] and bytes(r["cam.left"]) == bytes([r["episode_index"], r["frame_index"] % 256, 7]) for r in rows)
    for epoch in range(epochs):
        folders = batches.shard_files(spark, path, epoch)
        assert files == 1 or len(folders) >= files
        held = []
        for folder in folders:
            # one file, in order, of whole batches
            assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1
            part = spark.read.parquet(folder).coalesce(1).collect()
            assert [(r["batch_id"], r["slot"], r["frame_index"]) for r in part] == sorted((r["batch_id"], r["slot"], r["frame_index"]) for r in part)
            held.append({r["batch_id"] for r in part})
        assert len(set().union(*held)) == sum(map(len, held)) == -(-n // batch_size)
        got = list(batches.iterate_batches(spark, path, epoch, ["action", "cam.left"]))
        assert [len(b["action"]) for b in got] == [batch_size] * (n // batch_size) + [n % batch_size] * (n % batch_size > 0)
        assert {len(w) for b in got for w in b["cam.left"]} == {16}
    one = batches.read_batches(spark, path, 0, 0)
    assert len(one.inputFiles()) >= 1 and {r["batch_id"] for r in one.collect()} == {0}


def test_images_are_shuffled_once(spark):
    df = frames(spark)
    rows = batches.routed(df, dense_lengths(df), 8, 2, 42).repartitionById(4, F.col("shard"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    physical = rows._jdf.queryExecution().sparkPlan().toString()
    assert "cam.left" in plan and "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical


def test_batches_of_little(spark, tmp_path):
    with pytest.raises(batches.BatchesNotFound):
        batches.read_batches(spark, str(tmp_path / "none"))
    batches.write_batches(frames(spark, {0: 3}), str(tmp_path / "few"), 4)
    assert batches.batch_manifest(spark, str(tmp_path / "few"))["n_windows"] == 0
    assert batches.read_batches(spark, str(tmp_path / "few"), 0).collect() == []
    assert list(batches.iterate_batches(spark, str(tmp_path / "few"), 0, ["action"])) == []
    gap = frames(spark).where("frame_index != 5")
    with pytest.raises(GapError):
        batches.write_batches(gap, str(tmp_path / "gap"), 4)
    with pytest.raises(ValueError):
        batches.write_batches(frames(spark), str(tmp_path / "x"), 0)
    with pytest.raises(ValueError, match="epochs at a time"):
        batches.write_batches(frames(spark), str(tmp_path / "x"), 4, epochs=100)
