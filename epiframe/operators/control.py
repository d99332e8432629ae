"""Checks on action streams: stuck actions, over-limit targets, timing."""

from collections.abc import Callable, Sequence
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from epiframe.functions.randomness import random_vector
from epiframe.operators.chunked import CHUNK, chunk_of, chunk_window, drop_halo, refuse_gaps, with_halo
from epiframe.schema import EPISODE, POSITION, named

# Defaults of the control loop.
STUCK_EPS = 1e-4
STUCK_STEPS = 30
MAX_RELATIVE_TARGET = 5.0
RATE_HZ = 30.0
ACTION_DIM = 6
ACTION_LOW, ACTION_HIGH = -1.0, 1.0


def same_action(a: Column, b: Column, eps: float) -> Column:
    """Whether all values differ by less than ``eps``; a NaN never counts as equal."""
    close = F.zip_with(a, b, lambda x, y: F.abs(x - y) < eps)
    return F.coalesce(F.forall(close, lambda c: c), F.lit(False))


def stuck_actions(
    frames: DataFrame,
    eps: float = STUCK_EPS,
    warn_steps: int = STUCK_STEPS,
    action: str = "action",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int = CHUNK,
) -> DataFrame:
    """The frame at which an action has repeated exactly ``warn_steps`` times, once per run.

    That is: the last ``warn_steps`` steps all repeat their predecessor and the step before
    them does not. Only ``warn_steps + 1`` earlier rows matter, so chunks with a halo
    replace a running count over the episode.
    """
    placed = with_halo(frames.select(*keys, pos, named(action)), keys, pos, max(chunk, warn_steps + 1), before=warn_steps + 1)
    w = chunk_window(keys, pos)
    placed = refuse_gaps(placed, keys, pos)
    same = placed.withColumn("_same", same_action(named(action), F.lag(named(action)).over(w), eps))
    repeats = F.sum(F.col("_same").cast("int")).over(w.rowsBetween(1 - warn_steps, 0))
    longer = F.coalesce(F.lag("_same", warn_steps).over(w), F.lit(False))
    flagged = same.withColumns({"_repeats": repeats, "_longer": longer})
    hits = flagged.where((F.col("_repeats") == warn_steps) & ~F.col("_longer"))
    return drop_halo(hits).select(*keys, pos, F.lit(warn_steps).cast("long").alias("repeat_count"), named(action))


def nan_actions(frames: DataFrame, action: str = "action", keys: Sequence[str] = EPISODE) -> DataFrame:
    """Frames per episode whose action holds a NaN, which the stuck check never reports."""
    bad = F.exists(named(action), lambda x: F.isnan(x.cast("double")))
    return frames.groupBy(*keys).agg(F.count_if(bad).alias("nan_frames"))


def relative_target_check(
    frames: DataFrame, max_delta: float = MAX_RELATIVE_TARGET, action: str = "action", state: str = "state"
) -> DataFrame:
    """Add the number of joints asked to move too far and the action clipped to the limit."""
    a, s = named(action), named(state)
    over = F.zip_with(a, s, lambda x, y: F.abs(x - y) > max_delta)
    clipped = F.zip_with(a, s, lambda x, y: F.greatest(y - max_delta, F.least(y + max_delta, x)))
    return frames.withColumns({"n_over": F.size(F.filter(over, lambda c: c)), "clipped": clipped})


def interval_micros(later: Column, earlier: Column) -> Column:
    """Microseconds between two timestamps; unlike a cast, free of the session time zone."""
    gap = later - earlier
    whole = (F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)) * 60 + F.extract(F.lit("MINUTE"), gap)
    return whole.cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("long")


def rate_audit(
    frames: DataFrame,
    rate_hz: float = RATE_HZ,
    ts: str = "ts",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int = CHUNK,
) -> DataFrame:
    """Per episode: number of gaps, gaps longer than one period, and the longest, in microseconds.

    A gap is the time between a frame and the one before it that was recorded, however many
    were dropped in between. Gaps between chunks come from the first and last time of each.
    """
    period = 1e6 / rate_hz
    placed = frames.select(*keys, pos, ts).withColumn("_chunk", chunk_of(pos, chunk))
    gap = interval_micros(F.col(ts), F.lag(ts).over(chunk_window(keys, pos)))
    inside = placed.withColumn("gap_us", gap).groupBy(*keys, "_chunk").agg(
        F.count("gap_us").alias("_n"), F.count_if(F.col("gap_us") > period).alias("_over"), F.max("gap_us").alias("_most"),
        F.min_by(ts, pos).alias("_first"), F.max_by(ts, pos).alias("_last"),
    )
    before = F.lag("_last").over(W.partitionBy(*keys).orderBy("_chunk"))
    chunks = inside.withColumn("_edge", interval_micros(F.col("_first"), before))
    return chunks.groupBy(*keys).agg(
        (F.sum("_n") + F.count("_edge")).alias("n_gaps"),
        (F.sum("_over") + F.count_if(F.col("_edge") > period)).alias("n_overruns"),
        F.greatest(F.max("_most"), F.max("_edge")).alias("max_gap_us"),
    )


def random_actions(
    frames: DataFrame,
    low: float = ACTION_LOW,
    high: float = ACTION_HIGH,
    dim: int = ACTION_DIM,
    seed: int = 42,
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    out: str = "action",
) -> DataFrame:
    """Uniform actions that depend on (seed, episode, frame, dimension) only."""
    return frames.withColumn(out, random_vector(seed, dim, low, high, *[F.col(k) for k in keys], F.col(pos)))


def score_policy(
    frames: DataFrame,
    load_policy: Callable[[], Callable[[dict], np.ndarray]] | None,
    observations: Sequence[str],
    out_dim: int = ACTION_DIM,
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    out: str = "action",
    seed: int = 42,
) -> DataFrame:
    """Run a policy over recorded frames; random actions when there is none.

    ``load_policy`` is called once per task and returns a function from a dict of
    stacked observations to one action row per frame. Only the keys and the named
    observations travel to Python. Bytes are images: the policy gets them as unsigned bytes
    in the shape that the column declares, flat if it declares none; a row of another size is an error. A null
    observation is zeros of the declared shape, or else of the shape of the batch's first; a batch without either is an error.
    """
    if load_policy is None:
        return random_actions(frames, dim=out_dim, seed=seed, keys=keys, pos=pos, out=out).select(*keys, pos, out)
    narrow = frames.select(*keys, pos, *[named(c) for c in observations])
    kept = [narrow.schema[c] for c in (*keys, pos)]
    shapes = {c: (narrow.schema[c].metadata or {}).get("shape") for c in observations}
    binary = {c for c in observations if isinstance(narrow.schema[c].dataType, T.BinaryType)}
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def stacked(c: str, values: pd.Series) -> np.ndarray:
        absent = values.isna()
        if absent.any() and pd.api.types.is_numeric_dtype(values):
            return values.fillna(0).to_numpy()
        if absent.any():
            there = values[~absent]
            if not shapes[c] and there.empty:
                raise ValueError(f"{c}: only nulls, and no shape declared")
            size = prod(shapes[c]) if shapes[c] else len(there.iloc[0])
            zeros = bytes(size) if c in binary else np.zeros(size, np.asarray(there.iloc[0]).dtype if len(there) else np.float64)
            values = [zeros if gone else v for v, gone in zip(values, absent)]
        if c not in binary:
            return np.stack([np.asarray(v) for v in values])
        rows = [np.frombuffer(v, np.uint8) for v in values]
        if any(len(r) != (prod(shapes[c]) if shapes[c] else len(rows[0])) for r in rows):
            raise ValueError(f"{c}: images without {shapes[c] or 'one'} size")
        return np.stack([r.reshape(shapes[c]) if shapes[c] else r for r in rows])

    def run(batches):
        policy = load_policy()
        for pdf in batches:
            if len(pdf) == 0:
                continue
            obs = {c: stacked(c, pdf[c]) for c in observations}
            actions = np.asarray(policy(obs), dtype=np.float64)
            if actions.shape != (len(pdf), out_dim):
                raise ValueError(f"policy returned shape {actions.shape}, expected {(len(pdf), out_dim)}")
            yield pdf[[*keys, pos]].assign(**{out: list(actions)})

    return narrow.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Apply a function to batches of rows, wherever they are."""

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)
