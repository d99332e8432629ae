"""Stuck-action detection on a live frame stream."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from epiframe.operators.chunked import CHUNK, with_halo
from epiframe.operators.control import STUCK_EPS, STUCK_STEPS
from epiframe.schema import EPISODE, POSITION, named

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _RepeatCounter(StatefulProcessor):
    """Last action and repeat count of one chunk of one episode."""

    def __init__(
        self, keys: Sequence[str], pos: str, action: str, eps: float, warn_steps: int, chunk: int, done: str | None, ttl_s: int | None
    ):
        self.done, self.ttl_ms = done, 1000 * ttl_s if ttl_s else None
        self.names = list(keys)
        self.pos, self.action = pos, action
        self.eps, self.warn_steps, self.chunk = eps, warn_steps, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "last array<double>, repeats long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.pos)
        state = self.seen.get()
        repeats = state[1] if state else 0
        cells = [None if a is None else np.asarray(a, dtype=np.float64) for a in [state[0] if state else None, *batch[self.action]]]
        # a null, and a vector of another length than the one before, equals nothing
        width = max((len(a) for a in cells if a is not None), default=0)
        actions = np.full((len(cells), width), np.nan)
        sizes = np.array([-1 if a is None else len(a) for a in cells])
        for place, a in enumerate(cells):
            if a is not None:
                actions[place, : len(a)] = a
        near = np.abs(np.diff(actions, axis=0)) < self.eps
        beyond = np.arange(width) >= sizes[1:, None]
        same = (near | beyond).all(axis=1) & (sizes[1:] == sizes[:-1]) & (sizes[1:] >= 0)
        # a run starts behind the last row that differs; the first one goes on from the state
        place = np.arange(len(batch))
        start = np.maximum.accumulate(np.where(same, -1, place))
        counts = np.where(start < 0, repeats + place + 1, place - start)
        over = self.done is not None and batch[self.done].fillna(False).any()
        if over or batch[self.pos].max() >= (key[-1] + 1) * self.chunk - 1:
            self.seen.clear()
        else:
            self.seen.update((None if cells[-1] is None else cells[-1].tolist(), int(counts[-1])))
        hits = batch[(counts == self.warn_steps) & ~batch["from_neighbour"].to_numpy(dtype=bool)]
        yield hits[[*self.names, self.pos]].assign(repeat_count=self.warn_steps, **{self.action: hits[self.action]})

    def close(self) -> None:
        pass


def stream_stuck_actions(
    frames: DataFrame,
    eps: float = STUCK_EPS,
    warn_steps: int = STUCK_STEPS,
    action: str = "action",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    chunk: int = CHUNK,
    done: str | None = None,
    ttl_s: int | None = None,
) -> DataFrame:
    """``stuck_actions`` on a stream whose frames arrive in order.

    State is kept per (episode, chunk): the halo brings each chunk up to date, so a
    long episode is spread over tasks. A chunk's state is dropped when its last frame has passed,
    when a row of it has the flag ``done`` set, and, if given, ``ttl_s`` seconds after its latest
    row; with one of the two, finished episodes leave nothing behind. (A time to live needs
    processing time, with which Spark keeps starting empty batches under a trigger that
    should end by itself.) Sets the session's state store to RocksDB, which this needs.
    """
    spark = frames.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    flag = [F.coalesce(named(done), F.lit(False)).alias("done_flag")] if done else []
    narrow = frames.select(*keys, pos, named(action).cast("array<double>").alias(action), *flag)
    size = max(chunk, warn_steps + 1)
    # Names that start with an underscore do not reach the state processor.
    placed = with_halo(narrow, keys, pos, size, before=warn_steps + 1).withColumnsRenamed(
        {"_chunk": "chunk_id", "_halo": "from_neighbour"}
    )
    out = T.StructType(
        [
            *[narrow.schema[k] for k in (*keys, pos)],
            T.StructField("repeat_count", T.LongType()),
            T.StructField(action, T.ArrayType(T.DoubleType())),
        ]
    )
    return placed.groupBy(*keys, "chunk_id").transformWithStateInPandas(
        statefulProcessor=_RepeatCounter(keys, pos, action, eps, warn_steps, size, "done_flag" if done else None, ttl_s),
        outputStructType=out,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_s else "None",
    )
