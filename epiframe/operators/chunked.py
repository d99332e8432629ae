"""Position-chunked windows: neighbours within an episode without one task per episode.

``frame_index`` is dense within an episode, so an episode can be cut into chunks
of a fixed number of positions. A window function that looks a bounded distance
back or ahead only needs its own chunk plus a few rows copied from the chunks
next to it (the halo). Group size is then bounded by the chunk, however long an
episode is, and the shuffle grows by ``halo / chunk`` only.

A table with a gap, a repeated or a missing position is refused with an error rather than
answered by chunks: ``dense_lengths`` looks at the lengths, ``refuse_gaps`` at neighbours.

Keys that are null: joins by key match nothing, whichever way they run.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epiframe.schema import EPISODE, POSITION, named
from epiframe.storage import pin

CHUNK = 4096
#: Most rows of a one-row-per-key table that are broadcast.
BROADCAST_KEYS = 1_000_000


def chunk_of(pos: str, chunk: int = CHUNK) -> Column:
    return F.floor(F.col(pos) / F.lit(chunk))


class GapError(ValueError):
    """Positions within an episode that are not 0, 1, 2, ..."""


def dense_lengths(frames: DataFrame, keys: Sequence[str] = EPISODE, pos: str = POSITION) -> DataFrame:
    """Length per key, pinned; raises unless the positions of every key run from 0 without gap or null."""
    found = pin(
        frames.groupBy(*keys).agg(
            F.count("*").alias("length"), F.count(pos).alias("_n"), F.min(pos).alias("_lo"), F.max(pos).alias("_hi")
        )
    )
    sparse = (F.col("_n") != F.col("length")) | (F.col("_lo") != 0) | (F.col("_hi") != F.col("length") - 1)
    wrong = found.where(F.coalesce(sparse, F.lit(True))).limit(3).collect()
    if wrong:
        raise GapError(f"{pos} does not run from 0 without gaps in " + "; ".join(str([r[k] for k in keys]) for r in wrong))
    return found.select(*keys, "length")


def refuse_gaps(placed: DataFrame, keys: Sequence[str] = EPISODE, pos: str = POSITION) -> DataFrame:
    """The rows of ``with_halo(before >= 1)``; the query fails at a row whose predecessor is not the position before."""
    back = F.lag(pos).over(chunk_window(keys, pos))
    p = F.col(pos)
    wrong = ~F.col("_halo") & (p.isNull() | (p < 0) | ~back.eqNullSafe(F.when(p > 0, p - 1)))
    message = F.concat(F.lit(f"{pos} has a gap or repeats before "), F.coalesce(p.cast("string"), F.lit("null")))
    kept = F.when(F.col("_wrong"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return placed.withColumn("_wrong", wrong).where(kept).drop("_wrong")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on keys that may be null; ``small`` if ``right`` is of a checked size."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matches = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    on = matches[0]
    for m in matches[1:]:
        on = on & m
    return left.join(F.broadcast(renamed) if small else renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def with_halo(
    df: DataFrame,
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int = CHUNK,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add ``_chunk`` and ``_halo``; copy edge rows into the neighbouring chunks.

    Every chunk sees the ``before`` rows ahead of its first position and the
    ``after`` rows past its last one, marked ``_halo = true``.
    """
    if max(before, after) > chunk:
        raise ValueError(f"a halo of {max(before, after)} rows does not fit chunks of {chunk}")
    home = chunk_of(pos, chunk)
    offset = F.pmod(F.col(pos), F.lit(chunk))

    def place(chunk_id: Column, halo: bool) -> Column:
        return F.struct(chunk_id.alias("_chunk"), F.lit(halo).alias("_halo"))

    places = [place(home, False)]
    if before:
        places.append(F.when(offset >= chunk - before, place(home + 1, True)))
    if after:
        places.append(F.when((offset < after) & (home > 0), place(home - 1, True)))
    if len(places) == 1:
        return df.withColumns({"_chunk": home, "_halo": F.lit(False)})
    placed = df.withColumn("_place", F.explode(F.array_compact(F.array(*places))))
    return placed.select(*[named(c) for c in df.columns], "_place._chunk", "_place._halo")


def chunk_window(keys: Sequence[str] = EPISODE, pos: str = POSITION):
    return W.partitionBy(*keys, "_chunk").orderBy(pos)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_halo")).drop("_chunk", "_halo")


def join_by_chunk(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int = CHUNK,
    how: str = "inner",
    keyed_rows: int | None = None,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Join rows to a one-row-per-key table without gathering a key in one task.

    The row of a key is repeated once per chunk of positions that it has, and the join
    runs on (key, chunk). A caller that has counted ``keyed`` passes its size, and a
    table small enough is broadcast instead, with the same result.
    """
    if keyed_rows is not None and keyed_rows <= broadcast_keys:
        small = keyed.select(*keys) if how in ("left_semi", "left_anti") else keyed
        return rows.join(F.broadcast(small), list(keys), how)
    # a null position is a chunk of its own
    placed = rows.withColumn("_chunk", F.coalesce(chunk_of(pos, chunk), F.lit(-1)))
    spread = placed.select(*keys, "_chunk").distinct().join(keyed, list(keys))
    if how in ("left_semi", "left_anti"):
        spread = spread.select(*keys, "_chunk")
    return placed.join(spread, [*keys, "_chunk"], how).drop("_chunk")
