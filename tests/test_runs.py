"""The run table that a stream keeps."""

import random

import pytest

from epiframe.operators.tables import attach_primary_metric, best_metric, last_metric
from epiframe.storage import published
from epiframe.streaming import runs as live
from epiframe.streaming.sinks import stream_parquet

SCHEMA = "run_id long, line_no long, name string, value double"


@pytest.fixture
def runs(spark):
    return spark.createDataFrame([(i, ["act", "dreamerv3"][i % 2]) for i in range(6)], "run_id long, target_arch string")


@pytest.fixture
def lines():
    rng = random.Random(2)
    return [(rng.randrange(5), i, rng.choice(["pc_success", "recon_loss"]), rng.random() - 0.5) for i in range(200)]


def batch_of(spark, runs, rows):
    """What the operators on whole tables say: run, last, best."""
    metrics = spark.createDataFrame(rows, SCHEMA)
    primary = metrics.join(attach_primary_metric(runs).selectExpr("run_id", "metric AS name"), ["run_id", "name"])
    best = best_metric(attach_primary_metric(runs), primary).select("run_id", "best")
    return sorted(map(tuple, last_metric(runs, metrics).select("run_id", "value").join(best, "run_id").collect()))


def report(spark, runs, path):
    return sorted(map(tuple, live.run_report(runs, live.read_runs(spark, path)).select("run_id", "value", "best").collect()))


def test_a_stream_says_what_the_batch_says(spark, runs, lines, tmp_path):
    path = str(tmp_path / "runs")
    for part in range(4):
        rows = lines[50 * part : 50 * (part + 1)]
        spark.createDataFrame([*rows, (None, 1, "pc_success", 9.0), (0, 10**6, "pc_success", None), (0, 10**6, None, 9.0)], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        metrics = stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
        live.stream_runs(metrics, path, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        assert report(spark, runs, path) == batch_of(spark, runs, lines[: 50 * (part + 1)])


def test_a_batch_delivered_again_changes_nothing(spark, runs, lines, tmp_path):
    path = str(tmp_path / "runs")
    halves = [spark.createDataFrame(lines[:100], SCHEMA), spark.createDataFrame(lines[100:], SCHEMA)]
    assert live.update_runs(halves[0], 0, path) and live.update_runs(halves[1], 1, path)
    pointer, counts = published(spark, f"{path}/{live.POINTER}"), live.read_runs(spark, path).agg({"n": "sum"}).first()[0]
    assert counts == 200
    assert not live.update_runs(halves[1], 1, path) and not live.update_runs(halves[0], 0, path)
    assert published(spark, f"{path}/{live.POINTER}") == pointer
    assert report(spark, runs, path) == batch_of(spark, runs, lines)


def test_a_crash_before_the_pointer_moves_leaves_the_old_table(spark, runs, lines, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    halves = [spark.createDataFrame(lines[:100], SCHEMA), spark.createDataFrame(lines[100:], SCHEMA)]
    live.update_runs(halves[0], 0, path)
    open_table = live.read_runs(spark, path)
    with monkeypatch.context() as m:
        m.setattr(live, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            live.update_runs(halves[1], 1, path)
    assert report(spark, runs, path) == batch_of(spark, runs, lines[:100])
    assert live.update_runs(halves[1], 1, path)
    assert report(spark, runs, path) == batch_of(spark, runs, lines)
    # a reader of the old version finishes
    assert open_table.agg({"n": "sum"}).first()[0] == 100


def test_two_streams_keep_their_own_ledgers(spark, runs, lines, tmp_path):
    path = str(tmp_path / "runs")
    assert live.run_report(runs, live.read_runs(spark, path)).count() == 6
    for name, rows in (("a", lines[:100]), ("b", lines[100:])):
        assert live.update_runs(spark.createDataFrame(rows, SCHEMA), 0, path, stream=name)
    assert report(spark, runs, path) == batch_of(spark, runs, lines)
