"""One result whatever the size constants: null keys, gaps, strides, broken values; and what must be refused."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiframe.functions import images
from epiframe.operators import control, episodes, quality, sampling, windows
from epiframe.operators.chunked import GapError, join_by_chunk
from epiframe.operators.ordered import index_in_group
from epiframe.plans.cached import cache_frames, open_cache
from epiframe.plans.quality_filter import quality_filter
from epiframe.plans.record import record_dataset
from epiframe.schema import OVERHEAD, WRIST
from epiframe.sources.frames import SchemaMismatch, read_frames, write_frames
from epiframe.sources.windows import read_windows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_order_values_are_numbered_at_any_size(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", None), ("b", 1.0), (None, 2.0), (None, None), ("a", float("nan"))], "g string, x double")
    whole, cut = (rows_of(index_in_group(df, ["g"], [F.col("x")], F.col("x"), "i", n)) for n in (100, 1))
    assert repr(whole) == repr(cut) and len(cut) == 6


def test_join_by_chunk_is_the_same_both_ways(spark):
    rows = spark.createDataFrame([(0, 0), (0, 9000), (0, None), (None, 1), (1, 5)], "episode_index long, frame_index long")
    keyed = spark.createDataFrame([(0, 1), (None, 2)], "episode_index long, x int")
    for how in ("inner", "left_semi", "left_anti"):
        near, far = (rows_of(join_by_chunk(rows, keyed, how=how, chunk=16, keyed_rows=2, broadcast_keys=n)) for n in (10, 0))
        assert near == far


def test_frames_without_an_episode_or_with_gaps_are_refused(spark, tmp_path):
    kinds = "episode_index long, frame_index long, x int"
    for bad in ([(None, 0, 1)], [(0, 0, 1), (0, 2, 1)], [(0, 1, 1)], [(0, 0, 1), (0, 0, 1)], [(0, 0, 1), (0, None, 1)]):
        with pytest.raises(GapError):
            write_frames(spark.createDataFrame(bad, kinds), str(tmp_path / "f"))


@pytest.mark.parametrize("chunk", [16, 4096])
def test_gaps_are_refused_at_any_chunk_size(make_frames, chunk):
    broken = make_frames({0: [[float(i)] for i in range(40)], 1: [[1.0]] * 5}).where("episode_index = 1 or frame_index != 16")
    for run in (
        lambda: windows.transitions(broken, chunk=chunk), lambda: control.stuck_actions(broken, warn_steps=3, chunk=chunk),
        lambda: windows.sliding_windows(broken, size=4, stride=2, chunk=chunk), lambda: quality.step_speed(broken, 1, chunk=chunk),
        lambda: episodes.align_obs_action(broken.withColumns({"reset_obs": F.col("action"), "next_obs": F.col("action")}), chunk=chunk),
    ):
        with pytest.raises(Exception, match="has a gap or repeats"):
            run().collect()


def test_rate_audit_spans_dropped_frames(make_frames):
    ts = F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, frame_index)")
    frames = make_frames({0: [[0.0]] * 40}).where("frame_index not in (15, 16, 17)").withColumn("ts", ts)
    found = {rows_of(control.rate_audit(frames, chunk=c))[0][1:] for c in (4, 16, 4096)}
    assert found == {(36, 36, 4_000_000)}


@pytest.mark.parametrize("stride,least", [(4, 0), (8, 16), (4, 24)])
def test_caps_agree(make_frames, stride, least):
    frames = make_frames({e: [[float(i)] for i in range(60)] for e in range(5)})
    w = windows.sliding_windows(frames, stride=stride).where(F.col("start") >= least)
    for n in (1, 20, 40, 1000):
        top, numbered = (rows_of(sampling.cap_windows(w, n, top_keys=k).select("episode_index", "start")) for k in (10_000, 0))
        assert top == numbered and len(top) == min(n, w.count())


def test_starts_are_those_of_the_windows(make_frames):
    frames = make_frames({e: [[0.0]] * n for e, n in {0: 40, 1: 15, 2: 16, 3: 1}.items()})
    want = rows_of(windows.sliding_windows(frames).select("episode_index", "start"))
    assert rows_of(windows.window_starts(frames)) == want
    plan = sampling.epoch_batches(windows.window_starts(frames), 4)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_spectra_use_the_first_dimensions(make_frames):
    rng = np.random.default_rng(1)
    frames = make_frames({0: rng.normal(size=(50, 2)), 1: rng.normal(size=(40, 2))})
    whole, split = (dict(rows_of(quality.sal(frames, 1, whole_episode=n))) for n in (100, 10))
    assert whole == pytest.approx(split)
    with pytest.raises(Exception, match="fewer values"):
        quality.sal(frames, 3).collect()


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_a_broken_value_costs_its_episode_alone(make_frames, bad):
    rng = np.random.default_rng(2)
    data = {e: rng.normal(size=(60, 2)) for e in range(10)}
    clean = make_frames(data)
    value = F.lit(bad).cast("double")
    hit = (F.col("episode_index") == 4) & (F.col("frame_index") == 7)
    broken = clean.withColumn("action", F.when(hit, F.array(value, F.lit(0.0))).otherwise(F.col("action")))
    for n in (1000, 10):
        assert np.isnan(dict(rows_of(quality.sal(broken, 2, whole_episode=n)))[4])
    scores = dict(rows_of(quality.ted(broken, 2)))
    assert np.isnan(scores.pop(4)) and all(np.isfinite(v) for v in scores.values())
    kept, report = quality_filter(broken, 2)
    others, _ = quality_filter(clean.where("episode_index != 4"), 2)
    assert report.first()["removed"] == 10 - len({r["episode_index"] for r in kept.collect()})
    assert 4 not in {r["episode_index"] for r in kept.collect()} and len({r["episode_index"] for r in others.collect()}) >= 7
    scaled = episodes.normalize_actions(broken, 2).collect()
    assert sum(r["action"][0] is None or not np.isfinite(r["action"][0]) for r in scaled) == 1
    stats = episodes.feature_stats(broken, {"action": 2}).collect()
    assert [r["count"] for r in stats] == [599, 600] and stats[0]["non_finite"] == (bad is not None)


def test_mse_counts_what_it_compares(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 3.0]), (None, [1.0, 1.0]), ([None, 1.0], [5.0, 2.0])], "p array<double>, t array<double>")
    assert tuple(windows.transition_mse(df, "p", "t").first()) == (1.0, 3)
    with pytest.raises(Exception, match="unequal length"):
        windows.transition_mse(spark.createDataFrame([([1.0], [1.0, 2.0])], df.schema), "p", "t").collect()


def test_image_sizes_are_checked(spark):
    df = spark.createDataFrame([(bytearray(6),), (bytearray(18),), (None,)], "image binary")
    for moved in (images.resize_bytes(F.col("image"), 2, 2, 3, 1, 1), images.hwc_to_chw_bytes(F.col("image"), 2, 2, 3)):
        with pytest.raises(Exception, match="images without 12 bytes"):
            df.select(moved).collect()
    with pytest.raises(Exception, match="only normalised float"):
        spark.createDataFrame([([7, 8],)], "image array<int>").select(images.quantize_u8("image")).collect()


def recorded_steps(spark, images_=True):
    rows = [("s", 10**15 + 33_333 * i, [9.0] * 12, [float(i)] * 12, [float(i)] * 6, i in (2, 5), False, bytearray([i, 7, 0, 0]), bytearray([0] * 4)) for i in range(8)]
    return spark.createDataFrame(rows, f"stream_id string, seq long, reset_obs array<double>, next_obs array<double>, action array<double>, terminated boolean, truncated boolean, `{WRIST}` binary, `{OVERHEAD}` binary")


def test_whole_frames_are_recorded(spark, tmp_path):
    path = str(tmp_path / "d")
    record_dataset(recorded_steps(spark), path, {"action": 6}, images=[WRIST, OVERHEAD])
    back = read_frames(spark, path).orderBy("episode_index", "frame_index").collect()
    assert [bytes(r[WRIST]) for r in back] == [bytes([i, 7, 0, 0]) for i in range(8)]
    assert [r["observation.state"][0] for r in back] == [9.0, 0.0, 1.0, 9.0, 3.0, 4.0, 9.0, 6.0]
    narrow = str(tmp_path / "n")
    record_dataset(recorded_steps(spark).drop(WRIST, OVERHEAD), narrow, {"action": 6})
    with pytest.raises(SchemaMismatch, match=WRIST):
        read_frames(spark, narrow)


def test_images_reach_a_policy_whole(spark):
    df = spark.createDataFrame([(0, 0, bytearray([5, 0, 0, 0]))], "episode_index long, frame_index long, cam binary")
    shaped = df.withMetadata("cam", {"shape": [2, 2, 1]})
    load = lambda: lambda obs: np.array([[*obs["cam"].shape[1:], obs["cam"].sum()]], float) if obs["cam"].ndim == 4 else np.array([[obs["cam"].shape[1], 0, 0, 0]], float)
    assert control.score_policy(shaped, load, ["cam"], out_dim=4).first()["action"] == [2.0, 2.0, 1.0, 5.0]
    assert control.score_policy(df, load, ["cam"], out_dim=4).first()["action"] == [4.0, 0.0, 0.0, 0.0]
    with pytest.raises(Exception, match="images without"):
        control.score_policy(df.withMetadata("cam", {"shape": [3]}), load, ["cam"], out_dim=4).collect()


def test_cached_frames(spark, tmp_path):
    values = [float(i % 200) / 255 for i in range(1500)]
    df = spark.createDataFrame([(i, values, [i] * 1200, [0.5]) for i in range(4)], "row_index long, front_rgb array<float>, side_image array<int>, state array<double>")
    where = str(tmp_path / "cache")
    first = cache_frames(df, where, "a/b", "data")
    assert (sorted(first.image_keys), first.compress_keys) == (["front_rgb", "side_image"], ["front_rgb"])
    again = cache_frames(df, where, "a/b", "data")
    assert again.signature == first.signature == cache_frames(df, where, "a/b", str(Path("data").resolve())).signature
    back = again.frames().orderBy("row_index").collect()
    assert max(abs(a - b) for a, b in zip(back[0]["front_rgb"], values)) <= 1 / 255 + 1e-6 and back[3]["side_image"][0] == 3
    assert open_cache(spark, where, "none") is None
    with pytest.raises(MemoryError):
        cache_frames(df, str(tmp_path / "small"), "a/b", "data", max_gb=1e-6)


def test_images_are_packed_once(spark, tmp_path, monkeypatch):
    """The budget is known without packing, and the declared shape stays."""
    from epiframe.functions import images
    from epiframe.plans import cached

    df = spark.createDataFrame([(i, [i / 10] * 1500) for i in range(4)], "row_index long, front_rgb array<float>").withMetadata("front_rgb", {"shape": [20, 25, 3]})
    packed, names = images.quantize_normalized(df, ["front_rgb"])
    assert names == ["front_rgb"] and packed.schema["front_rgb"].metadata == {"shape": [20, 25, 3]}
    asked = []
    monkeypatch.setattr(cached, "check_budget", lambda rows, *a, f=cached.check_budget: asked.append((rows, f(rows, *a))))
    assert cached.cache_frames(df, str(tmp_path / "c"), "a/b", "data").packed.count() == 4
    (rows, total), = asked
    assert total == 4 * 1500 and "quantize" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert images.normalized_columns(df.withColumn("x", F.array(F.lit(3.0))).withColumn("y", F.array(F.lit(3))), ["front_rgb", "x", "y"]) == ["front_rgb"]


def test_rows_are_picked_where_they_are_read(spark, tmp_path):
    from epiframe.operators.tables import select_rows

    spark.range(1000).selectExpr("id AS row_index", "repeat('x', 100) AS `cam.left`").repartition(8).write.parquet(str(tmp_path / "t"))
    picked = select_rows(spark.read.parquet(str(tmp_path / "t")), [999, 3, 3])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [(r["pos"], r["row_index"]) for r in picked.collect()] == [(0, 999), (1, 3), (2, 3)]


def test_gaps_in_the_head_are_refused(spark, make_frames):
    from epiframe.operators.chunked import GapError
    from epiframe.operators.windows import head_truncate

    frames = make_frames({0: [[float(i)] for i in range(19)], 1: [[float(i)] for i in range(30)]})
    assert {len(r["steps"]) for r in head_truncate(frames).collect()} == {16}
    with pytest.raises(GapError):
        head_truncate(frames.where("not (episode_index = 0 and frame_index = 3)")).collect()
    twice = frames.withColumn("frame_index", F.expr("if(episode_index = 1 and frame_index = 4, 3L, frame_index)"))
    with pytest.raises(Exception, match="gap or repeats in the head"):
        head_truncate(twice).collect()
    assert head_truncate(frames.where("false")).count() == 0


def test_one_far_step_does_not_gather_the_others(spark, monkeypatch):
    monkeypatch.setattr(episodes, "CHUNK_STEPS", 50)
    rng = random.Random(5)
    rows = [(s, scale * i, rng.random() < 0.1) for s, scale in ((0, 1), (1, 10**6), (None, 3)) for i in range(400)] + [(0, 10**15, False), (1, -5, True)]
    df = spark.createDataFrame(rows, "stream_id long, seq long, done boolean")
    cuts = {r["stream_id"]: len(r["_cuts"]) for r in episodes._stream_cuts(df, ["stream_id"], "seq").collect()}
    assert all(6 <= n <= 9 for n in cuts.values())
    got = {(r["stream_id"], r["seq"]): (r["episode_index"], r["frame_index"]) for r in episodes.assign_episode_ids(df).collect()}
    for stream in (0, 1, None):
        episode = frame = 0
        for _, seq, done in sorted(r for r in rows if r[0] == stream and r[1] is not None):
            assert got[stream, seq] == (episode, frame)
            episode, frame = (episode + 1, 0) if done else (episode, frame + 1)


def test_absent_observations_are_zeros(spark):
    df = spark.createDataFrame([(0, 0, [1.0, 2.0], bytearray([1, 2, 3, 4])), (0, 1, None, None)], "episode_index long, frame_index long, state array<double>, cam binary").coalesce(1)
    shaped = df.withMetadata("cam", {"shape": [2, 2, 1]}).withMetadata("state", {"shape": [2]})
    load = lambda: lambda obs: np.column_stack([obs["state"].sum(1), obs["cam"].reshape(len(obs["cam"]), -1).sum(1)]).astype(float)
    for rows in (shaped, df):
        assert sorted(r["action"] for r in control.score_policy(rows, load, ["state", "cam"], out_dim=2).collect()) == [[0.0, 0.0], [3.0, 10.0]]
    assert [r["action"] for r in control.score_policy(shaped.where("frame_index = 1"), load, ["state", "cam"], out_dim=2).collect()] == [[0.0, 0.0]]
    with pytest.raises(Exception, match="only nulls"):
        control.score_policy(df.where("frame_index = 1"), load, ["state", "cam"], out_dim=2).collect()


def test_unfinished_windows_are_not_read(spark, make_frames, tmp_path):
    from epiframe.plans.convert import convert_to_windows

    frames = make_frames({0: [[float(i)] for i in range(40)]})
    out = str(tmp_path / "o")
    convert_to_windows(frames, out, 1)
    (tmp_path / "o/windows/_SUCCESS").rename(tmp_path / "o/windows/.crashed")
    with pytest.raises(FileNotFoundError):
        read_windows(spark, out)
    assert convert_to_windows(frames, out, 1).count() == 4 and read_windows(spark, out).count() == 4


def test_operators_run_from_another_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.executorEnv.PYTHONPATH", "").getOrCreate()
from epiframe.operators.quality import sal
frames = spark.range(60).select(F.lit(0).alias("episode_index"), F.col("id").alias("frame_index"), F.array(F.sin("id"), F.cos("id")).alias("action"))
print("score", sal(frames, 2).first()["sal"] < 0)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300, env={**__import__("os").environ, "PYTHONPATH": "", "SPARK_SCALA_VERSION": "2.13"})
    assert "score True" in done.stdout, done.stderr[-2000:]
