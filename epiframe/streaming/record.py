"""Recording while the environment runs: step logs become frames as their episodes close."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from epiframe.operators.episodes import MAX_EPISODE_STEPS
from epiframe.schema import FPS, STATE, named
from epiframe.streaming.buckets import BUCKETS, as_before, bucketed, numbered, text_keys
from epiframe.streaming.stuck import STATE_STORE


def _plain(value):
    """A cell as the state store takes it."""
    if value is None or value is pd.NA or (isinstance(value, float) and np.isnan(value)):
        return None
    return value.tolist() if isinstance(value, np.ndarray) else value


class _Recorder(StatefulProcessor):
    """A bucket of streams of steps: of each the number of its open episode, the observation seen last, and the frames held back."""

    def __init__(self, stream: Sequence[str], seq: str, held: T.StructType, columns: Sequence[str], max_steps: int | None):
        self.names, self.seq, self.held, self.columns, self.max_steps = list(stream), seq, held, list(columns), max_steps

    def init(self, handle: StatefulProcessorHandle) -> None:
        keys = text_keys([f"k{i}" for i in range(len(self.names))])
        seen = [*keys, *(T.StructField(n, T.LongType()) for n in ("episode", "frame", "seq")), self.held["observation"]]
        self.at = handle.getValueState("at", T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in seen]))
        self.open = handle.getListState("open", T.StructType([*keys, *self.held.fields]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch[batch[self.seq].notna()].reset_index(drop=True)
        state = self.at.get()
        width = len(self.names)
        states = list(zip(*state[width:])) if state else []
        known = list(zip(*state[:width])) if state else []
        owner, keys = numbered(known, batch, self.names)
        states += [(0, 0, None, None)] * (len(keys) - len(states))
        seqs = batch[self.seq].to_numpy(np.int64)
        order = np.lexsort((np.arange(len(owner)), seqs, owner))
        cells = {c: batch[c].to_numpy(object) for c in ("reset_obs", "next_obs", *self.columns)}
        done = batch["done_flag"].to_numpy(bool)
        # per stream that goes on the frames of its closed episodes and of the open one
        closed, now = {}, {}
        for i in order.tolist():
            who = owner[i]
            episode, frame, last, seen = states[who]
            if last is not None and seqs[i] <= last:
                continue
            seen = _plain(cells["reset_obs"][i]) if frame == 0 else seen
            own = now.setdefault(who, [])
            own.append((episode, frame, int(seqs[i]), seen, *(_plain(cells[c][i]) for c in self.columns)))
            seen, frame = _plain(cells["next_obs"][i]), frame + 1
            if done[i] or (self.max_steps is not None and frame >= self.max_steps):
                closed.setdefault(who, []).extend(own)
                now[who] = []
                episode, frame, seen = episode + 1, 0, None
            states[who] = (episode, frame, int(seqs[i]), seen)
        if not now:
            return
        out = [(*keys[who], *row) for who, own in closed.items() for row in own]
        added = [(*keys[who], *row) for who, own in now.items() for row in own]
        # frames of the open episodes that closed now, and those that stay
        ending = {keys[who] for who in closed if who < len(known)}
        if ending:
            held = [tuple(r) for r in self.open.get()]
            stay = [r for r in held if r[:width] not in ending]
            out = [r for r in held if r[:width] in ending] + out
            if len(stay) < len(held):
                self.open.clear()
                added = stay + added
        if added:
            self.open.appendList(added)
        self.at.update((*(list(k) for k in zip(*keys)), *(list(x) for x in zip(*states))))
        if out:
            yield pd.DataFrame(out, columns=[*self.names, *self.held.names])

    def close(self) -> None:
        pass


def stream_frames(
    steps: DataFrame,
    stream: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    fps: float = FPS,
    images: Sequence[str] = (),
    max_steps: int | None = MAX_EPISODE_STEPS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``frames_from_steps`` on a stream: the frames of every episode, when it closes.

    An episode closes at a step that is terminated or truncated, and at its ``max_steps``-th step (never by length
    with None). Episodes of a stream are numbered from 0, and each action is paired with the observation
    before it, across micro-batches and restarts. Steps of a stream arrive in the order of ``seq``; one that is not
    beyond the last, or has no ``seq``, is left out, so a source that repeats itself does no harm. A stream's state
    is its open episode; streams are kept in ``buckets``, so that many of them cost no call of their own. Sets the session's state store to RocksDB, which this needs.
    """
    spark = steps.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    done = F.coalesce(F.col("terminated"), F.lit(False)) | F.coalesce(F.col("truncated"), F.lit(False))
    renamed = {c: f"image_{n}" for n, c in enumerate(images)}
    narrow = steps.select(*stream, F.col(seq).cast("long").alias(seq), "reset_obs", "next_obs", "action", done.alias("done_flag"), *[named(c).alias(x) for c, x in renamed.items()])
    kept = ["action", *renamed.values()]
    fields = [T.StructField(n, T.LongType()) for n in ("episode_index", "frame_index", "seq_no")]
    held = T.StructType([*fields, T.StructField("observation", narrow.schema["reset_obs"].dataType), *[T.StructField(c, narrow.schema[c].dataType) for c in kept]])
    frames = bucketed(narrow, stream, buckets).groupBy("bucket_id").transformWithStateInPandas(
        statefulProcessor=_Recorder(stream, seq, held, kept, max_steps),
        outputStructType=T.StructType([*text_keys(stream), *held.fields]),
        outputMode="Append",
        timeMode="None",
    )
    timestamp = (F.col("frame_index") / F.lit(float(fps))).cast("float").alias("timestamp")
    vectors = [F.col("observation").cast("array<float>").alias(STATE), F.col("action").cast("array<float>").alias("action")]
    return frames.select(*as_before(narrow, stream), F.col("seq_no").alias(seq), "episode_index", "frame_index", timestamp, *vectors, *[F.col(x).alias(c) for c, x in renamed.items()])
