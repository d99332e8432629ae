"""Episode-level operators: lengths, statistics, flags, and episodes cut from step logs."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epiframe.operators.chunked import BROADCAST_KEYS, CHUNK, chunk_of, chunk_window, drop_halo, join_by_chunk, join_null_safe, refuse_gaps, with_halo
from epiframe.operators.ordered import row_width
from epiframe.schema import EPISODE, FPS, POSITION, named
from epiframe.storage import pin

# Defaults of the episode filters.
MIN_EPISODE_LENGTH = 50
MAX_EPISODE_STEPS = 600
#: Steps of a stream in one chunk, and bytes of a step beyond its order that are not sorted.
CHUNK_STEPS, WIDE_STEP = 1 << 16, 4096
#: Chunks of a stream at most.
STREAM_CUTS = 1000


def episode_lengths(frames: DataFrame, keys: Sequence[str] = EPISODE) -> DataFrame:
    return frames.groupBy(*keys).agg(F.count("*").alias("length"))


def episode_summary(frames: DataFrame, keys: Sequence[str] = EPISODE, pos: str = POSITION) -> DataFrame:
    """One row per episode: length, first and last position, duration in seconds."""
    return frames.groupBy(*keys).agg(
        F.count("*").alias("length"),
        F.min(pos).alias("first_frame"),
        F.max(pos).alias("last_frame"),
        F.max("timestamp").cast("double").alias("duration_s"),
    )


def filter_min_length(
    frames: DataFrame, min_length: int = MIN_EPISODE_LENGTH, keys: Sequence[str] = EPISODE, pos: str = POSITION
) -> DataFrame:
    """Drop the episodes with fewer than ``min_length`` frames.

    Lengths come from a scan of the keys and are counted first: while they can be
    broadcast, the frames, images included, are filtered where they are read.
    """
    long_enough = pin(episode_lengths(frames, keys)).where(F.col("length") >= min_length)
    return join_by_chunk(frames, long_enough, keys, pos, how="left_semi", keyed_rows=long_enough.count())


def feature_stats(frames: DataFrame, dims: Mapping[str, int]) -> DataFrame:
    """Count, min, max, mean and population deviation per feature dimension, over its finite values.

    NaN and infinite values are counted apart (``non_finite``), nulls not at all. The dimensions are named, so this is one hash aggregate in one pass: nothing is
    exploded and only one row per task is shuffled.
    """
    aggs, rows = [], []
    for feature, n in dims.items():
        for i in range(n):
            value = named(feature)[i].cast("double")
            x = F.when(_finite(value), value)
            p = f"_{len(rows)}"
            aggs += [
                F.count(x).alias(f"{p}n"), F.min(x).alias(f"{p}lo"), F.max(x).alias(f"{p}hi"),
                F.avg(x).alias(f"{p}mu"), F.stddev_pop(x).alias(f"{p}sd"),
                F.count_if(~_finite(value)).alias(f"{p}bad"),
            ]
            rows.append(
                F.struct(
                    F.lit(feature).alias("feature"), F.lit(i).alias("dim"), F.col(f"{p}n").alias("count"),
                    F.col(f"{p}lo").alias("min"), F.col(f"{p}hi").alias("max"),
                    F.col(f"{p}mu").alias("mean"), F.col(f"{p}sd").alias("std"),
                    F.col(f"{p}bad").alias("non_finite"),
                )
            )
    return frames.agg(*aggs).select(F.inline(F.array(*rows)))


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def normalize_actions(frames: DataFrame, dims: int, action: str = "action", bounds: DataFrame | None = None) -> DataFrame:
    """Scale every action dimension to [-1, 1] by its range; a constant dimension becomes 0.

    The method is ours. ``bounds`` is a one-row table (low array, high array); by
    default it is taken from the finite values of the frames and enters the plan as a
    scalar subquery. A value that is not finite stays as it is.
    """
    a = named(action)
    if bounds is None:
        values = [F.when(_finite(a[i].cast("double")), a[i].cast("double")) for i in range(dims)]
        bounds = frames.agg(
            F.array(*[F.min(v) for v in values]).alias("low"), F.array(*[F.max(v) for v in values]).alias("high")
        )
    limits = bounds.select(F.struct("low", "high")).scalar()
    held = frames.withColumn("_limits", limits)
    low, high = F.col("_limits.low"), F.col("_limits.high")
    scaled = [
        F.when(high[i] > low[i], 2 * (a[i].cast("double") - low[i]) / (high[i] - low[i]) - 1)
        .when(a[i].isNull() | ~_finite(a[i].cast("double")), a[i].cast("double"))
        .otherwise(F.lit(0.0))
        for i in range(dims)
    ]
    return held.withColumn(action, F.array(*scaled).cast("array<float>")).drop("_limits")


def episode_flags(steps: DataFrame, max_steps: int = MAX_EPISODE_STEPS, pos: str = POSITION) -> DataFrame:
    """Truncation by step count, and done as either flag; the step count starts at 1."""
    count = F.col(pos) + 1
    truncated = F.col("truncated") | (count >= max_steps)
    return steps.withColumns(
        {"step_count": count, "truncated": truncated, "done": F.col("terminated") | truncated}
    )


def add_timestamp(frames: DataFrame, fps: float = FPS, pos: str = POSITION, out: str = "timestamp") -> DataFrame:
    """Seconds since the start of the episode (frame index over frame rate is ours)."""
    return frames.withColumn(out, (F.col(pos) / F.lit(float(fps))).cast("float"))


def align_obs_action(
    steps: DataFrame,
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    reset_obs: str = "reset_obs",
    next_obs: str = "next_obs",
    out: str = "observation",
    chunk: int = CHUNK,
) -> DataFrame:
    """Pair every action with the observation seen before it.

    The first step of an episode takes the reset observation; the observation after
    the last step is not used.
    """
    placed = refuse_gaps(with_halo(steps, keys, pos, chunk, before=1), keys, pos)
    seen = F.lag(named(next_obs)).over(chunk_window(keys, pos))
    seen = F.when(F.col(pos) == 0, named(reset_obs)).otherwise(seen)
    return drop_halo(placed.withColumn(out, seen)).drop(reset_obs, next_obs)


def _stream_cuts(steps: DataFrame, stream: Sequence[str], seq: str) -> DataFrame:
    """One row per stream: the values of ``seq`` that cut it into chunks of about ``CHUNK_STEPS`` steps, or a thousandth if that is more."""
    grid = F.percentile_approx(F.col(seq).cast("double"), [i / STREAM_CUTS for i in range(1, STREAM_CUTS)], 10 * STREAM_CUTS)
    every = F.greatest(F.lit(1), F.floor(F.lit(STREAM_CUTS * CHUNK_STEPS) / F.col("_n")))
    cuts = F.array_distinct(F.filter("_grid", lambda _, i: (i + 1) % F.col("_every") == 0))
    found = steps.groupBy(*stream).agg(F.count("*").alias("_n"), grid.alias("_grid"))
    return found.withColumn("_every", every).select(*stream, cuts.alias("_cuts"))


def assign_episode_ids(
    steps: DataFrame,
    stream: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    done: Column | str = "done",
    chunk: int | None = None,
) -> DataFrame:
    """Number the episodes of each stream and the frames of each episode.

    A new episode starts after every done row. ``seq`` increases within a stream.
    Chunks of ``seq`` are numbered on their own; a table with one row per chunk
    carries the counts forward, so a long stream never passes through one task. A stream of more than
    ``CHUNK_STEPS`` steps is cut at its own approximate quantiles, whatever its unit and however far a single ``seq`` is from
    the others; ``chunk`` sets a width instead. Only the
    stream, ``seq`` and the flag are sorted: of wide steps (images) the rest is joined
    back, by (stream, seq), which is then unique; a step without ``seq`` is an error.
    """
    done = F.col(done) if isinstance(done, str) else done
    flagged = steps.withColumn("_done", F.coalesce(done, F.lit(False)))
    others = [c for c in steps.columns if c not in (*stream, seq)]
    wide = row_width(steps.select(*[named(c) for c in others]).schema) > WIDE_STEP if others else False
    if wide:
        flagged = flagged.select(*stream, seq, "_done")
    if chunk is None:
        cuts = pin(_stream_cuts(steps, stream, seq))
        flagged = join_null_safe(flagged, cuts, list(stream), small=cuts.count() <= BROADCAST_KEYS)
        at = F.size(F.filter("_cuts", lambda c: c <= F.col(seq).cast("double"))).cast("long")
    else:
        at = chunk_of(seq, chunk)
    place = F.when(F.col(seq).isNull(), F.raise_error(F.lit(f"{seq} is null")).cast("long")).otherwise(at)
    placed = flagged.withColumn("_chunk", place)
    inside = W.partitionBy(*stream, "_chunk").orderBy(seq)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = placed.withColumn("_i", F.row_number().over(inside) - 1).withColumns(
        {
            "_ended": F.coalesce(F.sum(F.col("_done").cast("long")).over(before), F.lit(0)),
            "_last_end": F.max(F.when(F.col("_done"), F.col("_i"))).over(before),
        }
    )
    totals = local.groupBy(*stream, "_chunk").agg(
        F.count("*").alias("_n"),
        F.sum(F.col("_done").cast("long")).alias("_ends"),
        F.max(F.when(F.col("_done"), F.col("_i"))).alias("_end"),
    )
    earlier = W.partitionBy(*stream).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        totals.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_episodes", F.coalesce(F.sum("_ends").over(earlier), F.lit(0)))
        .withColumn("_end_at", F.max(F.col("_base") + F.col("_end")).over(earlier))
        .select(*stream, "_chunk", "_base", "_episodes", "_end_at")
    )
    joined = join_null_safe(local, carried, [*stream, "_chunk"])
    position = F.col("_base") + F.col("_i")
    last_end = F.coalesce(F.col("_base") + F.col("_last_end"), F.col("_end_at"), F.lit(-1))
    kept = [*stream, seq] if wide else steps.columns
    numbered = joined.select(
        *[named(c) for c in kept],
        (F.col("_episodes") + F.col("_ended")).cast("long").alias("episode_index"),
        (position - last_end - 1).cast("long").alias("frame_index"),
    )
    if not wide:
        return numbered
    both = join_null_safe(steps, numbered, [*stream, seq])
    return both.select(*[named(c) for c in steps.columns], "episode_index", "frame_index")
