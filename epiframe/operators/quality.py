"""Episode quality scores. Both definitions are ours; nothing published fixes them here.

SAL is the spectral arc length of the speed profile (Balasubramanian et al., 2012 and
2015): more negative is less smooth. TED is the mean distance of an episode from the
cohort at the same frame index, in cohort standard deviations: larger is worse.

An episode with a null, NaN or infinite action value cannot be scored: both its scores are
NaN, and such values do not enter the cohort. Of actions with more values than ``dims`` the
first count; an action with fewer is an error.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiframe.operators.chunked import CHUNK, chunk_window, drop_halo, join_by_chunk, refuse_gaps, with_halo
from epiframe.operators.episodes import episode_lengths
from epiframe.schema import EPISODE, FPS, POSITION, named
from epiframe.storage import pin

# Parameters of the spectral arc length as published.
CUTOFF_HZ = 10.0
AMPLITUDE_FLOOR = 0.05
PAD_LEVEL = 4

#: Longest episode whose spectrum is computed in one piece; longer ones are split.
WHOLE_EPISODE = 1 << 15
#: Action values that are looked at together, and values of the spectra computed together; one episode may have more.
PIECE_VALUES, SPECTRUM_VALUES = 1 << 18, 1 << 18
#: Values in a block of a split spectrum.
SPLIT_VALUES = 1 << 20
#: Most rows of the cohort table that are broadcast.
BROADCAST_ROWS = 100_000
#: Episodes per salt of a frame index that is too long to broadcast.
EPISODES_PER_SALT = 1 << 16


def vector(action: str, dims: int) -> Column:
    """The first ``dims`` values as doubles, NaN for null; an error where there are fewer."""
    a = named(action)
    short = F.raise_error(F.concat(F.lit(f"{action} has fewer values than {dims}: "), F.size(a).cast("string"))).cast("array<double>")
    values = F.transform(F.slice(a, 1, dims), lambda x: F.coalesce(x.cast("double"), F.lit(float("nan"))))
    missing = F.array(*[F.lit(float("nan"))] * dims)
    return F.when(a.isNull(), missing).when(F.size(a) < dims, short).otherwise(values)


def finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def _padded(n) -> np.ndarray:
    return 2 ** (np.ceil(np.log2(n)).astype(np.int64) + PAD_LEVEL)


def _arc_length(magnitude: np.ndarray) -> np.ndarray:
    """Arc length per row of spectra that start at 0 Hz and are scaled to 1 there."""
    bins = magnitude.shape[1]
    last = bins - 1 - np.argmax((magnitude >= AMPLITUDE_FLOOR)[:, ::-1], axis=1)
    step = np.diff(magnitude, axis=1)
    inside = np.arange(1, bins)[None, :] <= last[:, None]
    span = 1.0 / np.maximum(last, 1)[:, None]
    return -np.where(inside, np.sqrt(span**2 + step**2), 0.0).sum(axis=1)


def _sal_udf(dims: int, fps: float):
    @F.arrow_udf(T.DoubleType())
    def sal_of(actions: pa.Array) -> pa.Array:
        # an Arrow batch is bounded by its episodes, a piece by its values
        part = np.cumsum(actions.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) // PIECE_VALUES
        bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(actions)]
        return pa.concat_arrays([scored(actions.slice(a, b - a)) for a, b in zip(bounds, bounds[1:])])

    def scored(actions: pa.Array) -> pa.Array:
        sizes = actions.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) // dims
        points = actions.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        ends = np.cumsum(sizes)
        moves = np.zeros(len(points))
        moves[:-1] = np.linalg.norm(np.diff(points, axis=0), axis=1)
        out = np.zeros(len(sizes))
        whole = np.isfinite(points).all(axis=1)
        broken = np.bincount(np.repeat(np.arange(len(sizes)), sizes), ~whole, minlength=len(sizes)) > 0
        counts = np.where(broken, 0, sizes - 1)
        padded = np.where(counts >= 2, _padded(np.maximum(counts, 2)), 0)
        for m in np.unique(padded[padded > 0]):
            for rows in np.array_split(np.flatnonzero(padded == m), max(1, int((padded == m).sum() * m) // SPECTRUM_VALUES)):
                if len(rows) == 0:
                    continue
                width = counts[rows].max()
                speed = np.zeros((len(rows), width))
                for i, r in enumerate(rows):
                    begin = ends[r] - sizes[r]
                    speed[i, : counts[r]] = moves[begin : begin + counts[r]]
                total = speed.sum(axis=1)
                spectrum = np.abs(np.fft.rfft(speed, m, axis=1)[:, : int(CUTOFF_HZ * m / fps) + 1])
                moving = total > 0
                scaled = spectrum[moving] / total[moving, None]
                out[rows[moving]] = _arc_length(scaled)
        out[broken] = np.nan
        return pa.array(out)

    return sal_of


def _sal_whole(frames: DataFrame, dims: int, action: str, keys: Sequence[str], pos: str, fps: float) -> DataFrame:
    """One row per episode, scored in Arrow batches; for episodes of bounded length."""
    step = F.struct(F.col(pos).alias("i"), vector(action, dims).alias("a"))
    gathered = frames.groupBy(*keys).agg(F.sort_array(F.collect_list(step)).alias("_steps"))
    flat = F.flatten(F.transform("_steps", lambda s: s["a"]))
    return gathered.select(*keys, _sal_udf(dims, fps)(flat).alias("sal"))


def step_speed(
    frames: DataFrame, dims: int, action: str = "action", keys: Sequence[str] = EPISODE, pos: str = POSITION,
    chunk: int = CHUNK,
) -> DataFrame:
    """Distance from each frame's action to the next one in its episode."""
    narrow = frames.select(*keys, pos, vector(action, dims).alias(action))
    placed = refuse_gaps(with_halo(narrow, keys, pos, chunk, before=1, after=1), keys, pos)
    follows = placed.withColumn("_next", F.lead(named(action)).over(chunk_window(keys, pos)))
    moved = drop_halo(follows).where(F.col("_next").isNotNull())
    squares = [F.pow(F.col("_next")[i] - named(action)[i], F.lit(2.0)) for i in range(dims)]
    return moved.select(*keys, pos, F.sqrt(sum(squares[1:], squares[0])).alias("speed"))


def _sal_split(speeds: DataFrame, keys: Sequence[str], pos: str, fps: float, cell: int) -> DataFrame:
    """Spectral arc length of very long episodes, with no episode in one task.

    The transform of length m = p * q is done in two rounds of short transforms
    (Cooley-Tukey). The first takes samples q apart, the second one output residue
    each; both work on blocks of about ``cell`` values, which are also the rows that
    are shuffled. A block of residues carries the one before it, so that steps
    between neighbouring frequencies stay inside a row.
    """
    totals = speeds.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum("speed").alias("_total"))
    bits = F.ceil(F.log2(F.col("_n"))).cast("int") + PAD_LEVEL
    totals = totals.withColumn("_m", F.pow(F.lit(2.0), bits).cast("long"))
    totals = totals.withColumn("_q", F.pow(F.lit(2.0), F.floor(bits / 2)).cast("long"))
    totals = pin(totals.withColumn("_last", F.floor(F.lit(CUTOFF_HZ) * F.col("_m") / F.lit(float(fps)))))
    episodes = totals.count()
    moving = totals.where((F.col("_n") >= 2) & (F.col("_total") > 0) & finite(F.col("_total")))
    sized = join_by_chunk(speeds, moving, keys, pos, keyed_rows=episodes)
    together = F.greatest(F.lit(1), F.least(F.col("_q"), F.floor(F.lit(cell) * F.col("_q") / F.col("_m"))))
    grouped = sized.withColumn("_part", F.floor(F.pmod(F.col(pos), F.col("_q")) / together))

    names = list(keys)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in speeds.select(*keys).schema.fields)
    carried = {"_q": "long", "_m": "long", "_last": "long", "_total": "double"}

    def sizes(first: pd.Series) -> tuple[int, int, int, int]:
        q, m = int(first["_q"]), int(first["_m"])
        p = m // q
        return p, q, max(1, min(q, cell // p)), max(1, min(p, cell // q))

    def strided(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        p, q, depth, width = sizes(first)
        r0 = int(first["_part"]) * depth
        at = pdf[pos].to_numpy()
        samples = np.zeros((depth, p))
        samples[at % q - r0, at // q] = pdf["speed"].to_numpy()
        turns = np.outer(r0 + np.arange(depth), np.arange(p)) % (p * q)
        found = np.fft.fft(samples, axis=1) * np.exp(-2j * np.pi * turns / (p * q))
        blocks = range(p // width)
        pieces = [found[:, np.arange(b * width - 1, (b + 1) * width) % p].reshape(-1) for b in blocks]
        out = pd.DataFrame({"_block": list(blocks), "_part": int(first["_part"])})
        out["_re"], out["_im"] = [z.real for z in pieces], [z.imag for z in pieces]
        return out.assign(**{c: first[c] for c in (*names, *carried)})

    def residues(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        p, q, depth, width = sizes(first)
        block, last = int(first["_block"]), int(first["_last"])
        values = np.zeros((q, width + 1), dtype=complex)
        for part, re, im in zip(pdf["_part"], pdf["_re"], pdf["_im"]):
            values[part * depth : (part + 1) * depth] = (np.asarray(re) + 1j * np.asarray(im)).reshape(depth, -1)
        magnitude = np.abs(np.fft.fft(values, axis=0)) / float(first["_total"])
        if block == 0:  # the residue before 0 is the last one of the previous round
            magnitude[:, 0] = np.concatenate([[np.nan], magnitude[:-1, 0]])
        starts = p * np.arange(q) + block * width
        magnitude, starts = magnitude[starts <= last], starts[starts <= last]
        k = starts[:, None] + np.arange(width)
        above = np.where((magnitude[:, 1:] >= AMPLITUDE_FLOOR) & (k <= last), k, -1).max(axis=1, initial=-1)
        out = pd.DataFrame({"_k": starts, "_edge": above})
        out["_mags"] = list(magnitude)
        return out.assign(**{c: first[c] for c in names})

    carry = ", ".join(f"{c} {t}" for c, t in carried.items())
    half = grouped.groupBy(*keys, "_part").applyInPandas(
        strided, f"_block long, _part long, _re array<double>, _im array<double>, {kinds}, {carry}"
    )
    spectrum = half.groupBy(*keys, "_block").applyInPandas(residues, f"_k long, _edge long, _mags array<double>, {kinds}")
    spectrum = pin(spectrum)
    edges = spectrum.groupBy(*keys).agg(F.max("_edge").alias("_cut"))
    inside = join_by_chunk(spectrum, edges, keys, "_k", keyed_rows=episodes).where(F.col("_k") <= F.col("_cut"))
    lengths = inside.groupBy(*keys).agg((-F.sum(_run_length("_mags", "_k", "_cut"))).alias("sal"))
    score = F.when(finite(F.col("_total")), F.coalesce("sal", F.lit(0.0))).otherwise(F.lit(float("nan")))
    return totals.select(*keys, "_total").join(lengths, list(keys), "left").select(*keys, score.alias("sal"))


@F.arrow_udf(T.DoubleType())
def _run_length(magnitudes: pa.Array, start: pa.Array, cut: pa.Array) -> pa.Array:
    """Arc length of runs of neighbouring frequencies; the first value precedes ``start``."""
    lengths = magnitudes.value_lengths().to_numpy(zero_copy_only=False)
    values = magnitudes.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    cuts = cut.to_numpy(zero_copy_only=False)[row]
    k = start.to_numpy(zero_copy_only=False)[row] + place - 1
    step = np.diff(values, prepend=np.nan)
    used = (place >= 1) & (k >= 1) & (k <= cuts)
    arcs = np.sqrt((1.0 / np.maximum(cuts, 1)) ** 2 + np.where(used, step, 0.0) ** 2)
    return pa.array(np.bincount(row, np.where(used, arcs, 0.0), minlength=len(lengths)))


def sal(
    frames: DataFrame,
    dims: int,
    action: str = "action",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    fps: float = FPS,
    whole_episode: int = WHOLE_EPISODE,
    longest: int | None = None,
    cell: int = SPLIT_VALUES,
) -> DataFrame:
    """Spectral arc length per episode; 0 for fewer than two steps or no motion.

    ``longest`` is the length of the longest episode, if known; otherwise the frames
    are searched for a position beyond ``whole_episode``.
    """
    narrow = frames.select(*keys, pos, named(action))
    if longest is None:
        longest = 0 if narrow.where(F.col(pos) >= whole_episode).isEmpty() else whole_episode + 1
    if longest <= whole_episode:
        return _sal_whole(narrow, dims, action, keys, pos, fps)
    sized = join_by_chunk(narrow, episode_lengths(narrow, keys), keys, pos)
    short = sized.where(F.col("length") <= whole_episode).drop("length")
    long = sized.where(F.col("length") > whole_episode).drop("length")
    split = _sal_split(step_speed(long, dims, action, keys, pos), keys, pos, fps, cell)
    return _sal_whole(short, dims, action, keys, pos, fps).unionByName(split)


def _cohort(frames: DataFrame, dims: int, action: str, pos: str) -> DataFrame:
    values = [F.when(finite(v), v) for v in (named(action)[i] for i in range(dims))]
    return frames.groupBy(pos).agg(
        F.count("*").alias("_episodes"),
        F.array(*[F.avg(v) for v in values]).alias("_mu"),
        F.array(*[F.stddev_pop(v) for v in values]).alias("_sd"),
    )


def ted(
    frames: DataFrame,
    dims: int,
    action: str = "action",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    broadcast_rows: int = BROADCAST_ROWS,
    episodes_per_salt: int = EPISODES_PER_SALT,
) -> DataFrame:
    """Mean over an episode's frames of the root mean squared z-score against the cohort.

    The cohort table has one row per frame index. Its first ``broadcast_rows`` rows are
    broadcast: they are shared by the most episodes. Rows beyond, if any, are joined
    on the frame index, salted as the most shared of them requires. The rows are counted.
    """
    narrow = frames.select(*keys, pos, vector(action, dims).alias(action))
    cohort = _cohort(narrow, dims, action, pos)
    cohort = pin(cohort)
    if cohort.count() <= broadcast_rows:
        joined = narrow.join(F.broadcast(cohort), pos)
    else:
        far = F.col(pos) >= broadcast_rows
        shared = cohort.where(far).agg(F.max("_episodes")).first()[0]
        salts = -(-shared // episodes_per_salt)
        tail = cohort.where(far).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")
        near = narrow.where(~far).join(F.broadcast(cohort.where(~far)), pos)
        joined = near.unionByName(narrow.where(far).withColumn("_salt", salt).join(tail, [pos, "_salt"]).drop("_salt"))
    score = _deviation(named(action), F.col("_mu"), F.col("_sd"), dims)
    return joined.groupBy(*keys).agg(F.avg(score).alias("ted"))


def _deviation(action: Column, mean: Column, spread: Column, dims: int) -> Column:
    def squared(i: int) -> Column:
        z = (action[i] - mean[i]) / spread[i]
        usual = F.when(spread[i] > 0, z * z).otherwise(F.lit(0.0))
        return F.when(finite(action[i]), usual).otherwise(F.lit(float("nan")))

    squares = [squared(i) for i in range(dims)]
    return F.sqrt(sum(squares[1:], squares[0]) / dims)
