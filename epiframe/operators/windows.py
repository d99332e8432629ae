"""Fixed-size windows over frames, and what is read from them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.operators.chunked import CHUNK, chunk_window, dense_lengths, drop_halo, refuse_gaps, with_halo
from epiframe.operators.ordered import row_width
from epiframe.schema import EPISODE, POSITION, named

# Window length, distance between starts, and head-window length.
WINDOW_SIZE = 16
STRIDE = 8


#: Bytes that the array of one chunk should hold, and the most rows in it.
CHUNK_BYTES, CHUNK_ROWS = 32 << 20, 1024


def window_starts(
    frames: DataFrame, size: int = WINDOW_SIZE, stride: int = STRIDE, keys: Sequence[str] = EPISODE, pos: str = POSITION
) -> DataFrame:
    """Keys and ``start`` of every full window, from the episode lengths alone."""
    lengths = dense_lengths(frames, keys, pos)
    last = F.col("length") - size
    starts = F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(stride).cast("long")))
    return lengths.where(last >= 0).select(*keys, starts.alias("start"))


def sliding_windows(
    frames: DataFrame,
    size: int = WINDOW_SIZE,
    stride: int = STRIDE,
    columns: Sequence[str] = ("action",),
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int | None = None,
) -> DataFrame:
    """Full windows starting at 0, stride, 2 * stride, ... of every episode.

    Returns the keys, ``start`` and ``steps`` (array of structs in order). Each frame is
    shuffled once, plus the few rows that windows reach past the end of their chunk;
    windows are slices of the chunk's array. A chunk has fewer rows the wider they are.
    The query fails where positions have a gap.
    """
    narrow = frames.select(*keys, pos, *[named(c) for c in columns])
    if chunk is None:
        chunk = min(CHUNK_ROWS, CHUNK_BYTES // row_width(narrow.schema))
    chunk = max(stride, size, chunk - chunk % stride)
    chunk += -chunk % stride
    placed = with_halo(narrow, keys, pos, chunk, before=1, after=max(size - stride, 0))
    begin = F.col("_chunk") * chunk
    step = F.struct(F.col(pos), *[named(c) for c in columns])
    own = F.coalesce(F.col(pos) >= begin, F.lit(True))
    gathered = placed.groupBy(*keys, "_chunk").agg(
        F.sort_array(F.collect_list(F.when(own, step))).alias("_steps"), F.count_if(~own).alias("_before")
    )
    count = F.size("_steps")
    first, end = F.col("_steps")[0][pos], F.element_at("_steps", -1)[pos]
    whole = (first == begin) & (end - first + 1 == count) & (F.col("_before") == F.when(F.col("_chunk") > 0, 1).otherwise(0))
    message = F.concat(F.lit(f"{pos} has a gap or repeats after "), F.coalesce(begin.cast("string"), F.lit("null")))
    fails = F.raise_error(message).cast("boolean")
    last = F.least(count - size, F.lit(chunk - stride))
    starts = (
        gathered.where(count > 0)
        .where(F.when(F.coalesce(whole, F.lit(False)), True).otherwise(fails))
        .where(count >= size)
        .withColumn("_at", F.explode(F.sequence(F.lit(0), last, F.lit(stride))))
        .withColumn("start", begin + F.col("_at"))
    )
    return starts.select(*keys, "start", F.slice("_steps", F.col("_at") + 1, size).alias("steps"))


def head_truncate(
    frames: DataFrame,
    cap: int = WINDOW_SIZE,
    columns: Sequence[str] = ("action",),
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
) -> DataFrame:
    """One window per episode: its first min(shortest episode, cap) frames.

    A scan of the keys gives the lengths; the constant bound on the position then reaches the scan of the steps, so
    only the head of each episode is read. A gap, a repeat or a null position is an error.
    """
    common = dense_lengths(frames, keys, pos).agg(F.min(F.least("length", F.lit(cap)))).first()[0] or 0
    step = F.struct(F.col(pos), *[named(c) for c in columns])
    head = frames.where(F.col(pos) < common).groupBy(*keys).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    # a repeat may make up for a gap in the length
    whole = F.transform("steps", lambda s: s[pos].cast("long")) == F.sequence(F.lit(0).cast("long"), F.lit(max(common - 1, 0)).cast("long"))
    message = F.raise_error(F.lit(f"{pos} has a gap or repeats in the head of an episode")).cast("boolean")
    return head.where(F.when(whole, True).otherwise(message)).select(*keys, F.lit(0).cast("long").alias("start"), "steps")


def window_shapes(windows: DataFrame, action: str = "action") -> DataFrame:
    """One row: number of windows, shortest and longest length, fewest and most action values."""
    widths = F.transform("steps", lambda s: F.size(s[action]))
    return windows.agg(
        F.count("*").alias("n_windows"),
        F.min(F.size("steps")).alias("min_len"),
        F.max(F.size("steps")).alias("max_len"),
        F.min(F.array_min(widths)).alias("min_action_dim"),
        F.max(F.array_max(widths)).alias("max_action_dim"),
    )


def check_windows(windows: DataFrame, action: str = "action") -> dict:
    """The common shape (B, T, A); raises when windows differ in shape."""
    row = window_shapes(windows, action).first()
    if row["min_len"] != row["max_len"] or row["min_action_dim"] != row["max_action_dim"]:
        raise ValueError(f"windows differ in shape: {row.asDict()}")
    return {"B": row["n_windows"], "T": row["max_len"], "A": row["max_action_dim"]}


def transitions(
    frames: DataFrame,
    state: str = "state",
    action: str = "action",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int = CHUNK,
) -> DataFrame:
    """(state, action, next state) for every frame that has a successor in its episode.

    A null next state is kept as null. The query fails where positions have a gap.
    """
    placed = with_halo(frames.select(*keys, pos, named(state), named(action)), keys, pos, chunk, before=1, after=1)
    w = chunk_window(keys, pos)
    follows = refuse_gaps(placed, keys, pos).withColumns({"next_state": F.lead(named(state)).over(w), "_next": F.lead(pos).over(w)})
    return drop_halo(follows).where(F.col("_next").isNotNull()).drop("_next")


def window_transitions(windows: DataFrame, state: str = "state", action: str = "action") -> DataFrame:
    """Transitions inside each window, row by row: no shuffle."""
    steps = F.col("steps")
    n = F.size(steps)
    pairs = F.zip_with(
        F.slice(steps, 1, n - 1),
        F.slice(steps, 2, n - 1),
        lambda a, b: F.struct(a[state].alias("state"), a[action].alias("action"), b[state].alias("next_state")),
    )
    others = [c for c in windows.columns if c != "steps"]
    return windows.where(n > 1).select(*others, F.posexplode(pairs).alias("t", "_p")).select(*others, "t", "_p.*")


def transition_mse(df: DataFrame, pred: str, target: str) -> DataFrame:
    """Mean squared error over all compared values, as one row ``mse``, ``n_values``.

    Rows without a prediction or a target are not compared, nor are single null values;
    vectors of unequal length are an error.
    """
    p, t = named(pred), named(target)
    squares = F.zip_with(p, t, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    unequal = F.raise_error(F.concat_ws(" ", F.lit("vectors of unequal length:"), F.size(p), F.size(t))).cast("array<double>")
    compared = F.filter(F.when(F.size(p) == F.size(t), squares).otherwise(unequal), lambda x: x.isNotNull())
    rows = df.where(p.isNotNull() & t.isNotNull()).select(compared.alias("_e"))
    error = F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x)
    n = F.coalesce(F.sum(F.size("_e")), F.lit(0))
    return rows.agg((F.sum(error) / F.nullif(n, F.lit(0))).alias("mse"), n.alias("n_values"))


def replay_steps(windows: DataFrame, image: str | None = None, action: str = "action") -> DataFrame:
    """One row per step of every window, as a replay environment would return it.

    The state is the action recorded at the step, the reward is 0, the last step of
    a window terminates it and none is truncated.
    """
    others = [c for c in windows.columns if c != "steps"]
    last = F.size("steps") - 1
    opened = windows.select(*others, last.alias("_last"), F.posexplode("steps").alias("t", "_s"))
    shown = [F.col("_s")[image].alias("rgb")] if image else []
    return opened.select(
        *others,
        "t",
        *shown,
        F.col("_s")[action].alias("state"),
        F.lit(0.0).alias("reward"),
        (F.col("t") >= F.col("_last")).alias("terminated"),
        F.lit(False).alias("truncated"),
    )
