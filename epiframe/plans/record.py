"""From a log of environment steps to a frame table."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.operators.chunked import dense_lengths, join_null_safe
from epiframe.operators.episodes import add_timestamp, align_obs_action, assign_episode_ids
from epiframe.operators.tables import renumber_episodes
from epiframe.schema import FPS, STATE, named
from epiframe.sources.frames import read_frames, write_dataset_meta, write_frames
from epiframe.storage import scratch_dir, written


def frames_from_steps(
    steps: DataFrame, stream: Sequence[str] = ("stream_id",), seq: str = "seq", fps: float = FPS,
    images: Sequence[str] = (), keep_seq: bool = False,
) -> DataFrame:
    """Cut step logs into episodes, pair observations with actions and add timestamps.

    Input columns: the stream, seq, reset_obs, next_obs, action, terminated, truncated, and the
    ``images``, which were seen before the action. The reward is not recorded. Episodes are
    numbered on the narrow columns; images are joined last, by (stream, seq), which is then unique.
    """
    done = F.col("terminated") | F.col("truncated")
    narrow = steps.drop(*images)
    numbered = assign_episode_ids(narrow, stream, seq, done)
    aligned = align_obs_action(numbered, [*stream, "episode_index"], "frame_index", out=STATE)
    kept = [named(STATE).cast("array<float>").alias(STATE), F.col("action").cast("array<float>").alias("action")]
    frames = add_timestamp(aligned, fps).select(*stream, seq, "episode_index", "frame_index", "timestamp", *kept)
    if images:
        frames = join_null_safe(frames, steps.select(*stream, seq, *[named(c) for c in images]), [*stream, seq])
    return frames if keep_seq else frames.drop(seq)


def record_dataset(
    steps: DataFrame,
    path: str,
    dims: Mapping[str, int],
    stream: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    fps: float = FPS,
    images: Sequence[str] = (),
) -> DataFrame:
    """Write the episodes of all streams as one dataset, numbered densely, with its side tables.

    The numbering is done once, on narrow columns, and kept; images are joined as the frames are written.
    """
    spark = steps.sparkSession
    narrow = frames_from_steps(steps.drop(*images), stream, seq, fps, keep_seq=True)
    numbered = renumber_episodes(narrow, [*stream, "episode_index"], out="_number")
    stored = written(numbered.withColumn("episode_index", F.col("_number")).drop("_number"), scratch_dir(spark))
    lengths = dense_lengths(stored)
    if images:
        stored = join_null_safe(stored, steps.select(*stream, seq, *[named(c) for c in images]), [*stream, seq])
    write_frames(stored.drop(*stream, seq), path, lengths=lengths)
    dataset = read_frames(spark, path, schema=None)
    write_dataset_meta(dataset, path, dims, fps)
    return dataset
