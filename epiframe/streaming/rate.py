"""The recording rate while frames arrive: late frames, and episodes that fall silent."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from epiframe.operators.control import RATE_HZ
from epiframe.schema import EPISODE, POSITION
from epiframe.streaming.buckets import BUCKETS, as_before, bucketed, numbered, text_keys
from epiframe.streaming.stuck import STATE_STORE

#: Where no frame is waited for.
NOT_DUE = np.iinfo(np.int64).min


class _Watch(StatefulProcessor):
    """The last frames of a bucket of episodes, and the timer of the one that is due first."""

    def __init__(self, keys: Sequence[str], pos: str, period_us: float, patience_us: int):
        self.names, self.pos, self.period_us, self.patience_us = list(keys), pos, period_us, patience_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in text_keys([f"k{i}" for i in range(len(self.names))])]
        lists += [T.StructField(n, T.ArrayType(T.LongType())) for n in ("pos", "us", "due")]
        self.seen = handle.getValueState("seen", T.StructType([*lists, T.StructField("timer", T.LongType())]))

    def _rows(self, keys: list[tuple], frames, kind: str, gaps) -> pd.DataFrame:
        out = pd.DataFrame({self.pos: pd.array(frames, "Int64"), "kind": kind, "gap_us": pd.array(gaps, "Int64")})
        for place, name in enumerate(self.names):
            out.insert(place, name, pd.Series([k[place] for k in keys], dtype=object))
        return out

    def _state(self) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray, int | None]:
        state = self.seen.get()
        if not state:
            return [], *(np.zeros(0, np.int64) for _ in range(3)), None
        *keys, pos, us, due, timer = state
        return list(zip(*keys)), *(np.array(x, np.int64) for x in (pos, us, due)), timer

    def _keep(self, keys: list[tuple], pos: np.ndarray, us: np.ndarray, due: np.ndarray, timer: int | None) -> None:
        """Store the state, and wait for the first episode that is due; ``timer`` is what is waited for now."""
        waiting = due[due != NOT_DUE]
        first = int(waiting.min()) if len(waiting) else None
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first is not None and timer != first:
            self.handle.registerTimer(first)
        if keys:
            self.seen.update((*(list(k) for k in zip(*keys)), pos.tolist(), us.tolist(), due.tolist(), first))
        else:
            self.seen.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        known, pos, us, due, timer = self._state()
        owner, keys = numbered(known, batch, self.names)
        fresh = len(keys) - len(known)
        old = np.arange(len(keys)) < len(known)
        pos, us, due = (np.concatenate([x, np.full(fresh, NOT_DUE)]) for x in (pos, us, due))
        frames, times, over = batch[self.pos].to_numpy(np.int64), batch["at_us"].to_numpy(np.int64), batch["over_flag"].to_numpy(bool)
        # the first of frames that come twice; those that are not beyond the last one are known
        order = np.lexsort((np.arange(len(owner)), frames, owner))
        order = order[~old[owner[order]] | (frames[order] > pos[owner[order]])]
        at, frame = owner[order], frames[order]
        order = order[np.append(True, (at[1:] != at[:-1]) | (frame[1:] != frame[:-1]))[: len(order)]]
        if not len(order):
            return
        at, frame, time, over = owner[order], frames[order], times[order], over[order]
        head = np.append(True, at[1:] != at[:-1])
        before = np.append(time[:1], time[:-1])
        before[head] = np.where(old[at[head]], us[at[head]], time[head])
        gaps = time - before
        tail = np.append(head[1:], True)
        pos[at[tail]], us[at[tail]] = frame[tail], time[tail]
        due[at[tail]] = -(-(time[tail] + self.patience_us) // 1000)
        left = np.ones(len(keys), bool)
        left[at[tail]] = ~over[tail]
        self._keep([k for k, x in zip(keys, left) if x], pos[left], us[left], due[left], timer)
        late = gaps > self.period_us
        if late.any():
            yield self._rows([keys[i] for i in at[late]], frame[late], "late", gaps[late])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        keys, pos, us, due, timer = self._state()
        silent = (due != NOT_DUE) & (due <= max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))
        due = np.where(silent, NOT_DUE, due)
        self._keep(keys, pos, us, due, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)
        if silent.any():
            yield self._rows([k for k, x in zip(keys, silent) if x], pos[silent], "silent", [None] * int(silent.sum()))

    def close(self) -> None:
        pass


def stream_rate(
    frames: DataFrame,
    rate_hz: float = RATE_HZ,
    patience_s: float = 1.0,
    delay: str = "1 second",
    ts: str = "ts",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    done: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``rate_audit`` on a stream: a row for every overrun as it happens: keys, ``pos``, kind and gap_us.

    A frame that comes more than a period after the one before it is ``late``, with the gap. An episode whose next frame has
    not come ``patience_s`` after its last one, by the time stamps of all episodes less ``delay``, is ``silent``: its last
    frame is given, once, and no gap; if the frame does come, it is late as well. An episode that ends by the column ``done`` is waited
    for no longer. Frames of an episode arrive in order; repeats are left out, and frames without a time, position or
    more than ``delay`` behind the newest of all. The state of an episode is its last frame;
    episodes are kept in ``buckets``, so that many short ones cost no call of their own. ``ts`` is a timestamp with
    a time zone, which watermarks need. Sets the session's state store to RocksDB, as timers need.
    """
    spark = frames.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    over = F.lit(False) if done is None else F.coalesce(F.col(done), F.lit(False))
    narrow = frames.select(*keys, F.col(pos).cast("long").alias(pos), F.col(ts).alias("at_ts"), F.unix_micros(ts).alias("at_us"), over.alias("over_flag"))
    narrow = narrow.where(F.col("at_ts").isNotNull() & F.col(pos).isNotNull()).withWatermark("at_ts", delay)
    fields = [T.StructField(pos, T.LongType()), T.StructField("kind", T.StringType()), T.StructField("gap_us", T.LongType())]
    found = bucketed(narrow, keys, buckets).groupBy("bucket_id").transformWithStateInPandas(
        statefulProcessor=_Watch(keys, pos, 1e6 / rate_hz, round(patience_s * 1e6)),
        outputStructType=T.StructType([*text_keys(keys), *fields]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(*as_before(narrow, keys), pos, "kind", "gap_us")
