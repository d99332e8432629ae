"""Scores against numpy, the split spectrum against the whole one, and the filter."""

import numpy as np
import pyarrow as pa
import pytest

from epiframe.operators import quality
from epiframe.operators.quality import sal, ted
from epiframe.plans.quality_filter import filter_dataset, judge_episodes, quality_filter
from epiframe.sources.frames import DatasetNotFound, read_frames, write_frames
from epiframe.storage import exists


def sal_reference(actions, fps=30.0):
    a = np.asarray(actions, dtype=float)
    speed = np.linalg.norm(np.diff(a, axis=0), axis=1)
    if len(speed) < 2 or speed.sum() == 0:
        return 0.0
    m = 2 ** (int(np.ceil(np.log2(len(speed)))) + 4)
    mag = np.abs(np.fft.fft(speed, m))
    mag = (mag / mag.max())[: int(10 * m / fps) + 1]
    last = np.flatnonzero(mag >= 0.05)[-1]
    if last == 0:
        return 0.0
    return -np.sqrt((1 / last) ** 2 + np.diff(mag[: last + 1]) ** 2).sum()


@pytest.fixture(scope="module")
def episodes():
    rng = np.random.default_rng(5)
    smooth = np.stack([np.sin(np.linspace(0, np.pi, 80)), np.cos(np.linspace(0, np.pi, 80))], axis=1)
    out = {e: (smooth + rng.normal(0, 0.01, smooth.shape)).tolist() for e in range(12)}
    out[20] = np.stack([np.linspace(0, 1, 60)] * 2, axis=1).tolist()  # straight line
    out[21] = [[0.5, 0.5]] * 60  # no motion
    out[22] = (smooth + rng.normal(0, 0.4, smooth.shape)).tolist()  # jittery
    out[23] = smooth[:49].tolist()
    out[24] = smooth[:50].tolist()
    out[25] = (smooth + 5).tolist()  # outlier
    out[26] = [[0.0, 1.0], [1.0, 1.0]]
    out[27] = [[0.0, 1.0]]
    return out


def test_sal(make_frames, episodes):
    got = {r["episode_index"]: r["sal"] for r in sal(make_frames(episodes), 2).collect()}
    assert got == {e: pytest.approx(sal_reference(a), abs=1e-9) for e, a in episodes.items()}
    assert got[22] < got[0] and got[21] == 0 and got[27] == 0


@pytest.mark.parametrize("limit,cell", [(10, 1 << 20), (10, 1), (55, 1 << 9), (70, 1 << 6)])
def test_split_spectrum_equals_whole(make_frames, episodes, limit, cell):
    rng = np.random.default_rng(1)
    longer = {**episodes, 30: rng.normal(size=(700, 2)).tolist(), 31: [[1.0, 1.0]] * 300}
    got = {r["episode_index"]: r["sal"] for r in sal(make_frames(longer), 2, whole_episode=limit, cell=cell).collect()}
    assert got == {e: pytest.approx(sal_reference(a), abs=1e-9) for e, a in longer.items()}


def ted_reference(episodes):
    out = {}
    for e, a in episodes.items():
        frames = []
        for i, x in enumerate(a):
            cohort = np.array([b[i] for b in episodes.values() if len(b) > i])
            mu, sd = cohort.mean(axis=0), cohort.std(axis=0)
            z = np.where(sd > 0, (np.array(x) - mu) / np.where(sd > 0, sd, 1), 0)
            frames.append(np.sqrt((z**2).mean()))
        out[e] = np.mean(frames)
    return out


@pytest.mark.parametrize("broadcast_rows,per_salt", [(0, 3), (30, 1), (70, 1 << 16), (1000, 1 << 16)])
def test_ted(make_frames, episodes, broadcast_rows, per_salt):
    scores = ted(make_frames(episodes), 2, broadcast_rows=broadcast_rows, episodes_per_salt=per_salt)
    got = {r["episode_index"]: r["ted"] for r in scores.collect()}
    assert got == {e: pytest.approx(v, abs=1e-9) for e, v in ted_reference(episodes).items()}
    assert max(got, key=got.get) in (25, 26, 27)


@pytest.mark.parametrize("rows_per_class", [2, 1 << 20])
def test_filter_steps(make_frames, episodes, rows_per_class):
    judged = {r["episode_index"]: r for r in judge_episodes(make_frames(episodes), 2, rows_per_class=rows_per_class).collect()}
    assert set(judged) == {e for e, a in episodes.items() if len(a) >= 50}
    bad = {e: r["badness"] for e, r in judged.items()}
    cut = np.quantile(list(bad.values()), 0.8)
    assert {e for e, r in judged.items() if r["kept"]} == {e for e in bad if bad[e] <= cut + 1e-12 and judged[e]["ted"] <= 2.0}
    n = len(judged)
    for e, r in judged.items():
        smoother = sum(round(o["sal"], 9) > round(r["sal"], 9) for o in judged.values())
        closer = sum(round(o["ted"], 9) < round(r["ted"], 9) for o in judged.values())
        assert r["badness"] == pytest.approx((smoother + closer) / (2 * (n - 1)))


def test_percent_truncates_and_zero_removes_none(make_frames, episodes):
    frames = make_frames(episodes)
    for fraction in (0.0, 0.009):
        assert judge_episodes(frames, 2, sal_threshold=fraction, ted_threshold=1e9).where("NOT kept").count() == 0
    assert judge_episodes(frames, 2, sal_threshold=0.29, ted_threshold=1e9, strategy="sal").where("NOT kept").count() > 0
    with pytest.raises(ValueError):
        judge_episodes(frames, 2, strategy="other")


def test_report_counts_short_episodes_as_removed(make_frames, episodes):
    kept, report = quality_filter(make_frames(episodes), 2)
    row = report.first()
    assert row["kept"] + row["removed"] == len(episodes)
    assert kept.select("episode_index").distinct().count() == row["kept"]


def test_filter_a_stored_dataset(spark, make_frames, episodes, tmp_path):
    path = str(tmp_path / "data")
    write_frames(make_frames(episodes), path)
    dry = filter_dataset(spark, path, 2, dry_run=True)
    assert dry.dry_run and not exists(spark, f"{path}_filtered")
    wet = filter_dataset(spark, path, 2)
    assert (wet.kept, wet.removed) == (dry.kept, dry.removed)
    stored = read_frames(spark, f"{path}_filtered", schema=None)
    assert stored.select("episode_index").distinct().count() == wet.kept
    for dry_run in (False, True):
        with pytest.raises(DatasetNotFound) as caught:
            filter_dataset(spark, str(tmp_path / "none"), 2, dry_run=dry_run)
        assert caught.value.suggestions


def test_no_episode_long_enough(make_frames):
    kept, report = quality_filter(make_frames({0: [[1, 2]] * 3}), 2)
    assert kept.count() == 0 and tuple(report.first()) == (0, 1)


def test_hot_episode_does_not_change_scores(make_frames, episodes):
    """One episode with most of the rows takes the split path; the others keep their scores."""
    hot = {**episodes, 99: np.random.default_rng(9).normal(size=(2000, 2)).tolist()}
    scores = {r["episode_index"]: r["sal"] for r in sal(make_frames(hot), 2, whole_episode=512).collect()}
    assert scores[99] == pytest.approx(sal_reference(hot[99]), abs=1e-9)
    assert scores[0] == pytest.approx(sal_reference(hot[0]), abs=1e-9)


def test_scores_of_a_batch_take_bounded_memory():
    """What 20,000 episodes need beyond their own values is no more than 2,000 need."""
    import tracemalloc

    rng = np.random.default_rng(4)
    score, peaks = quality._sal_udf(2, 30.0).func, []
    some = [rng.normal(size=2 * 60).tolist() for _ in range(2000)]
    for times in (1, 10):
        batch = pa.array(some * times, pa.list_(pa.float64()))
        tracemalloc.start()
        found = score(batch).to_numpy()
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
        assert len(found) == 2000 * times and np.allclose(found, np.tile(found[:2000], times), rtol=1e-12)
    assert peaks[0] < 40 and peaks[1] < peaks[0] + 5, peaks
