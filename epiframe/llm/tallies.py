"""Corpus-wide counts of what batches of documents hold: windows, words, n-grams.

Documents are dealt to batches by hash. A batch sends each of its distinct keys once, with
its count, to the shard of the key's hash; the shards sum, and tell every batch the totals of
its keys. A key that a third of the documents hold is one entry per batch, so none is hot, and
texts stay where they are: all steps of an operator read the same exchange of documents.

A key is a 64-bit hash within a batch and 96 bits across batches. Keys travel as sorted
arrays, one row per batch and shard; work and shuffle are linear in the distinct keys of the batches.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.words import ODD, chained, mixed

#: Text bytes of a batch, and words per shard, on average.
BATCH_BYTES, SHARD_WORDS = 6_000_000, 2_000_000
REQUEST = "batch long, shard long, keys binary, checks binary, counts binary"
ANSWER = "batch long, shard long, totals binary, first binary"


@dataclass
class Dealt:
    """Documents with a column ``batch``, and how many batches and shards there are."""

    docs: DataFrame
    batches: int
    shards: int


def deal(docs: DataFrame, batch_bytes: int = BATCH_BYTES, shard_words: int = SHARD_WORDS) -> Dealt:
    """``docs`` (with doc_id and text) in batches of about ``batch_bytes`` of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches, shards = max(1, -(-size // batch_bytes)), max(1, -(-size // (6 * shard_words)))
    return Dealt(docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))).repartition(batches, "batch"), batches, shards)


@dataclass
class Words:
    """The words of some texts: the distinct ones, and for every word its number in them and its row."""

    distinct: pa.Array
    number: np.ndarray
    row: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the distinct words."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct.cast(pa.binary()).to_pylist()), np.uint64, len(self.distinct))


def words(texts: pa.ChunkedArray | pa.Array) -> Words:
    """Texts cut at space and tab to carriage return."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    # offsets of 32 bits would not do for gigabytes
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    coded = cut.flatten().dictionary_encode()
    row, number = pc.list_parent_indices(cut).to_numpy(zero_copy_only=False).astype(np.int64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # blanks at either end leave empty words
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    kept = number != empty
    return Words(coded.dictionary, number[kept], row[kept])


def doubled(x: np.ndarray, length: int, join) -> np.ndarray:
    """``join`` folded over every ``length`` consecutive entries, in steps that double."""
    out, have, power, size = None, 0, x, 1
    while True:
        if length & size:
            out, have = (power, size) if out is None else (join(out[: max(0, len(power) - have)], power[have : have + len(out)]), have + size)
        size *= 2
        if size > length:
            return out
        power = join(power[: max(0, len(power) - size // 2)], power[size // 2 :])


def second(keys: np.ndarray) -> np.ndarray:
    """Other hashes of words, to chain apart from the first."""
    return mixed(keys * ODD[1] + ODD[2])


def check(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return chained(y, x)


def bytewise(values: np.ndarray) -> bytes:
    """All first bytes first: the high ones of small values shrink to nothing in the shuffle."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def whole(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def requests(batch: int, shards: int, keys: np.ndarray, checks: np.ndarray | None = None, counts: np.ndarray | None = None) -> pa.Table:
    """What a batch asks: its distinct ``keys``, each with a 32-bit check and how often it is there."""
    keys, first, inverse, number = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    if counts is not None:
        number = np.bincount(inverse.ravel(), counts, len(keys)).astype(np.int64)
    checks = np.zeros(len(keys), np.uint32) if checks is None else checks[first].astype(np.uint32)
    there, start = np.unique((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), return_index=True)
    ends = [*start[1:].tolist(), len(keys)]
    parts = list(zip(start.tolist(), ends))
    columns = {
        "batch": pa.array([batch] * len(there), pa.int64()), "shard": pa.array(there.astype(np.int64)),
        "keys": pa.array([bytewise(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()),
        "checks": pa.array([checks[a:b].tobytes() for a, b in parts], pa.binary()),
        "counts": pa.array([bytewise(number[a:b].astype(np.int64)) for a, b in parts], pa.binary()),
    }
    return pa.table(columns)


def _answer(least: int):
    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch")
        keys = [np.cumsum(whole(k, np.uint64), dtype=np.uint64) for k in table["keys"].to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        key = np.concatenate(keys)
        checks = np.concatenate([np.frombuffer(c, np.uint32) for c in table["checks"].to_pylist()])
        counts = np.concatenate([whole(c, np.int64) for c in table["counts"].to_pylist()])
        order = np.lexsort((checks, key))
        key, checks = key[order], checks[order]
        fresh = np.append(True, (key[1:] != key[:-1]) | (checks[1:] != checks[:-1]))
        sums = np.add.reduceat(counts[order], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        totals, first = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        totals[order], first[order] = np.where(sums >= least, sums, 0), fresh & (sums >= least)
        out = [np.split(x, ends[:-1]) for x in (totals, first)]
        return pa.table({
            "batch": table["batch"], "shard": table["shard"], "totals": pa.array([bytewise(x) for x in out[0]], pa.binary()),
            "first": pa.array([np.packbits(x).tobytes() for x in out[1]], pa.binary()),
        })

    return answer


def answers(asked: DataFrame, least: int) -> DataFrame:
    """The totals of the keys that ``requests`` asked for, back to their batches; 0 below ``least``.

    Of the batches that hold a key, one is told that it is the first.
    """
    return asked.groupBy("shard").applyInArrow(_answer(least), ANSWER)


@dataclass
class Totals:
    """Answers to a batch: its keys in order, their totals, and of which it is the first batch."""

    keys: np.ndarray
    totals: np.ndarray
    first: np.ndarray

    def place(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, keys)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The totals of keys that were asked for."""
        return self.totals[self.place(keys)] if len(self.keys) else np.zeros(len(keys), np.int64)


def told(table: pa.Table, keys: np.ndarray) -> Totals:
    """The answers to a batch that asked for ``keys``."""
    table = table.sort_by("shard")
    totals = np.concatenate([*(whole(t, np.int64) for t in table["totals"].to_pylist()), np.zeros(0, np.int64)])
    sizes = [len(t) // 8 for t in table["totals"].to_pylist()]
    first = np.concatenate([*(np.unpackbits(np.frombuffer(f, np.uint8), count=n) for f, n in zip(table["first"].to_pylist(), sizes)), np.zeros(0, np.uint8)])
    return Totals(np.unique(keys), totals, first.astype(bool))
