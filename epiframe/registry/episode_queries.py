"""Queries on frames, episodes, windows and scores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.operators import control, episodes, quality, sampling, windows
from epiframe.plans.quality_filter import judge_episodes, quality_filter
from epiframe.plans.record import frames_from_steps
from epiframe.registry import views
from epiframe.sources.batches import read_batches, write_batches
from epiframe.storage import scratch_dir

DIMS = 2
STEP_COLUMNS = ("action", "state", "event_id")


def _vector(column: str, prefix: str, n: int = DIMS, decimals: int = 6):
    return [F.round(F.col(column)[i].cast("double"), decimals).alias(f"{prefix}{i}") for i in range(n)]


def _all_windows(spark, sf):
    return windows.sliding_windows(views.frames(spark, sf), columns=STEP_COLUMNS)


def _window_facts(w: DataFrame) -> DataFrame:
    ids = F.transform("steps", lambda s: s["event_id"])
    total = F.aggregate("steps", F.lit(0.0), lambda acc, s: acc + s["action"][0])
    return w.select(
        "episode_index", "start", F.size("steps").cast("long").alias("n_steps"),
        F.element_at(ids, 1).alias("first_event"), F.element_at(ids, -1).alias("last_event"),
        F.round(total, 4).alias("sum_value"),
    )


def windows_per_episode(spark: SparkSession, sf: str) -> DataFrame:
    kept = episodes.filter_min_length(views.frames(spark, sf), 50)
    w = windows.sliding_windows(kept, columns=("event_id",))
    return w.groupBy("episode_index").agg(F.count("*").alias("n_windows"), F.max("start").alias("last_start"))


def episode_summary(spark, sf):
    out = episodes.episode_summary(episodes.add_timestamp(views.frames(spark, sf)))
    return out.withColumn("duration_s", F.round("duration_s", 5))


def filter_min_length(spark, sf):
    return episodes.filter_min_length(views.frames(spark, sf)).select("episode_index", "frame_index", "event_id")


def sliding_windows(spark, sf):
    return _window_facts(_all_windows(spark, sf))


def head_truncate(spark, sf):
    return _window_facts(windows.head_truncate(views.frames(spark, sf), columns=STEP_COLUMNS))


def cap_windows(spark, sf):
    return _window_facts(sampling.cap_windows(_all_windows(spark, sf), 100))


def _late_windows(spark, sf):
    """Windows cut four frames apart, without the early ones."""
    w = windows.sliding_windows(views.frames(spark, sf), stride=4, columns=STEP_COLUMNS)
    return w.where("start >= 16")


def cap_windows_filtered(spark, sf):
    """The cap found by window number rather than by a top-n."""
    return _window_facts(sampling.cap_windows(_late_windows(spark, sf), 100, top_keys=10))


def number_windows_stride4(spark, sf):
    return sampling.number_windows(_late_windows(spark, sf)).select("window_id", "episode_index", "start")


def _broken_frames(spark, sf):
    """Frames with a NaN action wherever the event's id is a multiple of 997."""
    value = F.when(F.col("event_id") % 997 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return views.frames(spark, sf).withColumn("action", F.array(value, F.length("event_type").cast("double")))


def quality_filter_nan(spark, sf):
    """One broken value costs its own episode, no other."""
    kept, _ = quality_filter(_broken_frames(spark, sf), DIMS, ted_threshold=1.0)
    return kept.select("episode_index", "frame_index", "event_id")


def normalize_actions_nan(spark, sf):
    n = episodes.normalize_actions(_broken_frames(spark, sf), DIMS)
    a0 = F.col("action")[0].cast("double")
    return n.select("episode_index", "frame_index", F.isnan(a0).alias("broken"), F.round(F.when(~F.isnan(a0), a0), 5).alias("a0"))


def feature_stats_nan(spark, sf):
    return feature_stats(spark, sf, _broken_frames(spark, sf))


def window_shapes(spark, sf):
    out = windows.window_shapes(_all_windows(spark, sf))
    return out.select(*[F.col(c).cast("long").alias(c) for c in out.columns])


def transitions(spark, sf):
    t = windows.transitions(views.frames(spark, sf))
    return t.select("episode_index", "frame_index", *_vector("state", "s"), *_vector("action", "a"), *_vector("next_state", "n"))


def window_transitions(spark, sf):
    t = windows.window_transitions(_all_windows(spark, sf))
    return t.select(
        "episode_index", "start", F.col("t").cast("long").alias("t"),
        *_vector("state", "s"), *_vector("action", "a"), *_vector("next_state", "n"),
    )


def transition_mse(spark, sf):
    t = windows.transitions(views.frames(spark, sf))
    return windows.transition_mse(t, "state", "next_state").withColumn("mse", F.round("mse", 4))


def replay_steps(spark, sf):
    r = windows.replay_steps(_all_windows(spark, sf))
    return r.select(
        "episode_index", "start", F.col("t").cast("long").alias("t"), *_vector("state", "s"), "reward", "terminated", "truncated"
    )


def normalize_actions(spark, sf):
    n = episodes.normalize_actions(views.frames(spark, sf), DIMS)
    return n.select("episode_index", "frame_index", *_vector("action", "a", decimals=5))


def feature_stats(spark, sf, frames=None):
    s = episodes.feature_stats(frames or views.frames(spark, sf), {"action": DIMS, "state": DIMS})
    rounded = [F.round(c, 5).alias(c) for c in ("min", "max", "mean", "std")]
    return s.select("feature", F.col("dim").cast("long").alias("dim"), "count", *rounded, "non_finite")


def add_timestamp(spark, sf):
    t = episodes.add_timestamp(views.frames(spark, sf))
    return t.select("episode_index", "frame_index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"))


def episode_flags(spark, sf):
    flagged = views.frames(spark, sf).withColumns(
        {"terminated": F.col("event_type") == "error", "truncated": F.col("event_type") == "purchase"}
    )
    out = episodes.episode_flags(flagged, max_steps=60)
    return out.select("episode_index", "frame_index", "step_count", "terminated", "truncated", "done")


def assign_episode_ids(spark, sf):
    s = views.steps(spark, sf)
    out = episodes.assign_episode_ids(s, done=F.col("terminated") | F.col("truncated"))
    return out.select("stream_id", "seq", "episode_index", "frame_index")


def align_obs_action(spark, sf):
    indexed = views.frames(spark, sf).select(
        "episode_index", "frame_index", "action",
        F.array(F.lit(-1.0)).alias("reset_obs"), F.array("value").alias("next_obs"),
    )
    out = episodes.align_obs_action(indexed)
    return out.select("episode_index", "frame_index", *_vector("observation", "o", 1), *_vector("action", "a"))


def recorded_frames(spark, sf):
    f = frames_from_steps(views.steps(spark, sf))
    return f.select(
        "stream_id", "episode_index", "frame_index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"),
        *_vector("`observation.state`", "s", 1, 3), *_vector("action", "a", 1),
    )


def recorded_images(spark, sf):
    """Vectors as streams of steps, each with an image that ends in zero bytes; nothing of it is lost."""
    pixels = F.concat(views.pixels(spark, sf), F.unhex(F.lit("0000")))
    steps = views.table(spark, sf, "embeddings").select(
        F.col("label").alias("stream_id"), F.col("vec_id").alias("seq"), F.slice("embedding", 1, 1).alias("reset_obs"),
        F.slice("embedding", 2, 1).alias("next_obs"), F.slice("embedding", 3, 2).alias("action"),
        (F.col("vec_id") % 13 == 0).alias("terminated"), F.lit(False).alias("truncated"),
        pixels.alias("observation.images.wrist"),
    )
    f = frames_from_steps(steps, images=["observation.images.wrist"])
    return f.select("stream_id", "episode_index", "frame_index", F.hex("`observation.images.wrist`").alias("pixels"))


def rate_audit_dropped(spark, sf):
    """Frames that were never recorded leave gaps, which is what the audit is for."""
    return control.rate_audit(views.frames(spark, sf).where("event_id % 7 != 0"), chunk=16)


def score_policy_images(spark, sf):
    """Images of 4 x 8 x 2 bytes, the last of them 0, reach the policy whole and in shape."""
    shown = views.table(spark, sf, "embeddings").select(
        F.col("label").alias("episode_index"), F.col("vec_id").alias("frame_index"),
        F.concat(F.substring(views.pixels(spark, sf), 1, 62), F.unhex(F.lit("0100"))).alias("wrist", metadata={"shape": [4, 8, 2]}),
    )

    def load():
        import numpy as np

        return lambda obs: np.stack([obs["wrist"].astype(float).sum((1, 2, 3)), obs["wrist"][:, 3, 7, 0].astype(float), np.full(len(obs["wrist"]), float(obs["wrist"][0].size))], 1)

    out = control.score_policy(shown, load, ["wrist"], out_dim=3)
    return out.select("episode_index", "frame_index", *_vector("action", "a", 3, 1))


def rate_audit(spark, sf):
    return control.rate_audit(views.frames(spark, sf))


def stuck_frames(spark, sf):
    """Frames whose action is the kind of event."""
    kind = F.array(F.length("event_type").cast("double"), F.ascii("event_type").cast("double"))
    return views.frames(spark, sf).withColumn("action", kind)


def stuck_actions(spark, sf):
    out = control.stuck_actions(stuck_frames(spark, sf), warn_steps=2)
    return out.select("episode_index", "frame_index", "repeat_count", *_vector("action", "a"))


def nan_actions(spark, sf):
    broken = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return control.nan_actions(views.frames(spark, sf).withColumn("action", F.array(broken)))


def relative_target_check(spark, sf):
    out = control.relative_target_check(views.frames(spark, sf))
    return out.select("episode_index", "frame_index", F.col("n_over").cast("long").alias("n_over"), *_vector("clipped", "c"))


def random_actions(spark, sf):
    out = control.random_actions(views.frames(spark, sf), dim=DIMS, seed=7)
    return out.select("episode_index", "frame_index", *_vector("action", "a"))


def score_policy(spark, sf):
    def load():
        import numpy as np

        weights = np.array([[0.5, -1.0, 0.25], [2.0, 1.0, 0.0]])
        return lambda obs: obs["state"] @ weights + 1.0

    out = control.score_policy(views.frames(spark, sf), load, ["state"], out_dim=3)
    return out.select("episode_index", "frame_index", *_vector("action", "a", 3, 4))


def map_rows(spark, sf):
    narrow = views.frames(spark, sf).select("episode_index", "frame_index", "value")
    out = control.map_rows(
        narrow, lambda pdf: pdf.assign(value=pdf["value"] * 2 + pdf["frame_index"]), "episode_index long, frame_index long, value double"
    )
    return out.withColumn("value", F.round("value", 4))


def sal(spark, sf):
    return quality.sal(views.frames(spark, sf), DIMS).withColumn("sal", F.round("sal", 5))


def ted(spark, sf):
    return quality.ted(views.frames(spark, sf), DIMS).withColumn("ted", F.round("ted", 5))


def episode_quality(spark, sf):
    judged = judge_episodes(views.frames(spark, sf), DIMS, ted_threshold=1.0)
    return judged.select(
        "episode_index", "length", F.round("sal", 5).alias("sal"), F.round("ted", 5).alias("ted"),
        F.round("badness", 8).alias("badness"), "kept",
    )


def quality_filter_frames(spark, sf):
    kept, _ = quality_filter(views.frames(spark, sf), DIMS, ted_threshold=1.0)
    return kept.select("episode_index", "frame_index", "event_id")


def quality_filter_report(spark, sf):
    _, report = quality_filter(views.frames(spark, sf), DIMS)
    return report


def number_windows(spark, sf):
    return sampling.number_windows(_all_windows(spark, sf)).select("window_id", "episode_index", "start")


def _starts(spark, sf):
    return windows.window_starts(views.frames(spark, sf))


def epoch_batches(spark, sf):
    return sampling.epoch_batches(_starts(spark, sf), batch_size=32, epochs=2, seed=42)


def stored_order_batches(spark, sf):
    return sampling.epoch_batches(_starts(spark, sf), batch_size=32, epochs=2, shuffle=False)


def batch_payload(spark, sf):
    """The batches of two epochs as they are read back from their files."""
    path = scratch_dir(spark)
    write_batches(views.frames(spark, sf), path, 32, 2, 42, ["action", "event_id"])
    rows = read_batches(spark, path)
    first, last = F.min_by("event_id", "frame_index"), F.max_by("event_id", "frame_index")
    facts = [F.count("*").alias("n_steps"), first.alias("first_event"), last.alias("last_event"), F.round(F.sum(F.col("action")[0]), 4).alias("sum_value")]
    return rows.groupBy("epoch", "batch_id", "slot", "episode_index", "start").agg(*facts)


def sample_windows(spark, sf):
    draws = sampling.sample_windows(_starts(spark, sf), views.table(spark, sf, "events").count(), seed=5)
    return draws.select("draw", "window_id", "episode_index", "start")


QUERIES = {
    f.__name__: f
    for f in (
        windows_per_episode, episode_summary, filter_min_length, sliding_windows, head_truncate, cap_windows,
        window_shapes, transitions, window_transitions, transition_mse, replay_steps, normalize_actions,
        feature_stats, add_timestamp, episode_flags, assign_episode_ids, align_obs_action, recorded_frames,
        rate_audit, stuck_actions, nan_actions, relative_target_check, random_actions, score_policy, map_rows,
        sal, ted, episode_quality, quality_filter_frames, quality_filter_report, number_windows, epoch_batches,
        stored_order_batches, batch_payload, sample_windows, cap_windows_filtered, number_windows_stride4, quality_filter_nan,
        normalize_actions_nan, feature_stats_nan, recorded_images, rate_audit_dropped, score_policy_images,
    )
}
