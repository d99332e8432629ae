"""Chunked operators against brute force, with chunks far smaller than the episodes."""

import random

import pytest
from pyspark.sql import functions as F

from epiframe.operators import control, episodes, sampling, windows
from epiframe.operators.chunked import join_by_chunk, with_halo


def actions(n, seed=0, kinds=3):
    rng = random.Random(seed)
    return [[rng.randrange(kinds), rng.random() < 0.9] for _ in range(n)]


def test_window_counts_by_length(make_frames):
    lengths = {0: 5, 1: 15, 2: 16, 3: 17, 4: 24, 5: 32}
    w = windows.sliding_windows(make_frames({e: actions(n) for e, n in lengths.items()}))
    found = {r["episode_index"]: r["count"] for r in w.groupBy("episode_index").count().collect()}
    assert found == {2: 1, 3: 1, 4: 2, 5: 3}


@pytest.mark.parametrize("size,stride,chunk", [(16, 8, 16), (16, 8, 64), (5, 2, 8), (3, 7, 14), (4, 4, 4), (16, 8, 1024), (6, 1, 6)])
def test_windows_across_chunks(make_frames, size, stride, chunk):
    lengths = {7: 203, 8: size, 9: size - 1, 10: 1}
    data = {e: actions(n, e) for e, n in lengths.items()}
    w = windows.sliding_windows(make_frames(data), size, stride, chunk=chunk)
    got = sorted((r["episode_index"], r["start"], [(s["frame_index"], list(s["action"])) for s in r["steps"]]) for r in w.collect())
    want = sorted(
        (e, start, [(i, [float(v) for v in a[i]]) for i in range(start, start + size)])
        for e, a in data.items()
        for start in range(0, len(a) - size + 1, stride)
    )
    assert got == want


def test_head_windows_share_the_shortest_length(make_frames):
    lengths = {0: 5, 1: 15, 2: 16, 3: 17, 4: 24, 5: 32}
    w = windows.head_truncate(make_frames({e: actions(n) for e, n in lengths.items()}))
    assert sorted((r["episode_index"], len(r["steps"])) for r in w.collect()) == [(e, 5) for e in lengths]
    w = windows.head_truncate(make_frames({e: actions(n + 20) for e, n in lengths.items()}))
    assert {len(r["steps"]) for r in w.collect()} == {16}


@pytest.mark.parametrize("top_keys", [0, 1000])
def test_cap_windows(make_frames, top_keys):
    w = windows.sliding_windows(make_frames({0: actions(40), 1: actions(40)}))
    assert [(r["episode_index"], r["start"]) for r in sampling.cap_windows(w, 5, top_keys=top_keys).orderBy("episode_index", "start").collect()] == [
        (0, 0), (0, 8), (0, 16), (0, 24), (1, 0),
    ]
    assert sampling.cap_windows(w, None).count() == 8
    assert sampling.cap_windows(w, 100, top_keys=top_keys).count() == 8


def test_check_windows(make_frames):
    w = windows.sliding_windows(make_frames({0: actions(40)}))
    assert windows.check_windows(w) == {"B": 4, "T": 16, "A": 2}
    ragged = w.withColumn("steps", F.when(F.col("start") == 8, F.slice("steps", 1, 3)).otherwise(F.col("steps")))
    with pytest.raises(ValueError):
        windows.check_windows(ragged)


def test_transitions_stay_inside_episodes(make_frames):
    data = {0: actions(25, 1), 1: actions(1), 2: actions(8, 2)}
    t = windows.transitions(make_frames(data), chunk=4)
    got = sorted((r["episode_index"], r["frame_index"], list(r["next_state"])) for r in t.collect())
    want = sorted((e, i, [float(v) + 100 for v in a[i + 1]]) for e, a in data.items() for i in range(len(a) - 1))
    assert got == want


def stuck_reference(data, n):
    hits = []
    for e, a in data.items():
        repeats = 0
        for i in range(1, len(a)):
            repeats = repeats + 1 if a[i] == a[i - 1] else 0
            if repeats == n:
                hits.append((e, i))
    return sorted(hits)


@pytest.mark.parametrize("warn,chunk", [(1, 2), (2, 4), (3, 5), (30, 31), (4, 4096)])
def test_stuck_actions_across_chunks(make_frames, warn, chunk):
    rng = random.Random(warn)
    data = {}
    for e in range(4):
        a = []
        while len(a) < 220:
            a += [[rng.randrange(3)]] * rng.randrange(1, 2 * warn + 4)
        data[e] = a
    got = control.stuck_actions(make_frames(data), warn_steps=warn, chunk=chunk)
    assert sorted((r["episode_index"], r["frame_index"]) for r in got.collect()) == stuck_reference(data, warn)


def test_stuck_needs_thirty_one_equal_frames(make_frames):
    frames = make_frames({0: [[1.0]] * 30, 1: [[1.0]] * 31, 2: [[1.0]] * 90})
    assert sorted((r[0], r[1]) for r in control.stuck_actions(frames).collect()) == [(1, 30), (2, 30)]


def test_nan_is_never_stuck_but_counted(make_frames):
    frames = make_frames({0: [[float("nan")]] * 40, 1: [[1.0]] * 5})
    assert control.stuck_actions(frames).count() == 0
    assert {r[0]: r[1] for r in control.nan_actions(frames).collect()} == {0: 40, 1: 0}


def test_small_changes_count_as_equal(make_frames):
    frames = make_frames({0: [[i * 0.00009] for i in range(4)], 1: [[i * 0.0002] for i in range(4)]})
    assert [(r[0], r[1]) for r in control.stuck_actions(frames, warn_steps=3).collect()] == [(0, 3)]


@pytest.mark.parametrize("chunk", [1, 3, 8, 1 << 16])
def test_episode_ids_across_chunks(spark, chunk):
    rng = random.Random(chunk)
    steps, want = [], []
    for stream in ("a", "b", "c"):
        episode = frame = 0
        seq = rng.randrange(5)
        for _ in range(60):
            done = rng.random() < 0.1
            steps.append((stream, seq, done))
            want.append((stream, seq, episode, frame))
            episode, frame = (episode + 1, 0) if done else (episode, frame + 1)
            seq += rng.randrange(1, 4)
    df = spark.createDataFrame(steps, "stream_id string, seq long, done boolean").repartition(7)
    got = episodes.assign_episode_ids(df, chunk=chunk)
    assert sorted((r["stream_id"], r["seq"], r["episode_index"], r["frame_index"]) for r in got.collect()) == sorted(want)


def test_alignment_uses_the_observation_before_the_action(spark):
    steps = spark.createDataFrame(
        [(0, i, [-1.0], [float(i)], [10.0 * i]) for i in range(9)],
        "episode_index long, frame_index long, reset_obs array<double>, next_obs array<double>, action array<double>",
    )
    got = episodes.align_obs_action(steps, chunk=2).orderBy("frame_index").collect()
    assert [r["observation"][0] for r in got] == [-1.0, 0, 1, 2, 3, 4, 5, 6, 7]


def test_minimum_length_is_inclusive(make_frames):
    frames = make_frames({0: actions(49), 1: actions(50), 2: actions(51)})
    assert {r[0] for r in episodes.filter_min_length(frames).select("episode_index").distinct().collect()} == {1, 2}


def test_flags_count_from_one(spark):
    steps = spark.createDataFrame([(0, i, i == 1, False) for i in range(4)], "episode_index long, frame_index long, terminated boolean, truncated boolean")
    rows = episodes.episode_flags(steps, max_steps=3).orderBy("frame_index").collect()
    assert [(r["step_count"], r["truncated"], r["done"]) for r in rows] == [(1, False, False), (2, False, True), (3, True, True), (4, True, True)]


def test_constant_dimension_normalises_to_zero(make_frames):
    out = episodes.normalize_actions(make_frames({0: [[1, 5], [3, 5], [2, 5]]}), 2)
    assert sorted(tuple(r["action"]) for r in out.collect()) == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_replay_ends_every_window(make_frames):
    w = windows.sliding_windows(make_frames({0: actions(24)}))
    r = windows.replay_steps(w).collect()
    assert len(r) == 32 and sum(x["terminated"] for x in r) == 2 and all(x["t"] == 15 for x in r if x["terminated"])


def test_halo_larger_than_chunk_is_refused(make_frames):
    with pytest.raises(ValueError):
        with_halo(make_frames({0: actions(3)}), chunk=4, before=5)


def test_no_group_exceeds_the_chunk_when_one_episode_is_hot(make_frames):
    """One episode holds most rows; groups stay bounded and joins spread it."""
    frames = make_frames({0: actions(900), **{e: actions(10, e) for e in range(1, 31)}})
    sizes = with_halo(frames, chunk=64, before=3).groupBy("episode_index", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 64 + 3
    lengths = episodes.episode_lengths(frames)
    joined = join_by_chunk(frames, lengths, chunk=64)
    assert joined.count() == 1200 and joined.where("frame_index >= length").count() == 0
    for limit in (0, 31):  # beyond the broadcast size, and within it
        for how, n in (("left_semi", 900), ("left_anti", 300), ("inner", 900)):
            long = lengths.where("length > 10")
            assert join_by_chunk(frames, long, chunk=64, how=how, keyed_rows=1, broadcast_keys=limit).count() == n


def test_action_limit(make_frames):
    frames = make_frames({0: [[1.0, 2.0]]}).withColumn("state", F.array(F.lit(10.0), F.lit(3.0)))
    row = control.relative_target_check(frames, 5.0).first()
    assert row["n_over"] == 1 and list(row["clipped"]) == [5.0, 2.0]


def test_random_actions_do_not_depend_on_partitioning(make_frames):
    frames = make_frames({0: actions(20), 1: actions(20)})
    draws = [
        sorted((r["episode_index"], r["frame_index"], tuple(r["action"])) for r in control.random_actions(frames.repartition(n)).collect())
        for n in (1, 4, 17)
    ]
    assert draws[0] == draws[1] == draws[2]
    values = [v for r in draws[0] for v in r[2]]
    assert all(-1 <= v < 1 for v in values) and len(set(values)) == len(values)


def test_policy_shape_is_checked(make_frames):
    frames = make_frames({0: actions(3)})
    good = control.score_policy(frames, lambda: lambda obs: obs["state"] * 2, ["state"], out_dim=2)
    assert good.count() == 3
    with pytest.raises(Exception, match="policy returned shape"):
        control.score_policy(frames, lambda: lambda obs: obs["state"], ["state"], out_dim=3).collect()
    assert len(control.score_policy(frames, None, ["state"]).first()["action"]) == 6
