"""Shuffled training batches as files: what a trainer reads, in the order in which it reads it.

``epoch_batches`` says which window is in which batch. Here the steps of the windows follow: a frame's place is
known before it moves, so images are shuffled once, straight into the file of their batch.

* Windows are ordered by the hash of (seed, epoch, key), as in ``epoch_batches``. A shard is a run of whole batches of
  about ``part_bytes``. A narrow job over the keys finds the window that each shard begins with.
* A frame's windows follow from its position and the length of its episode, their hashes from their keys. The leading
  digits of a hash name a bucket, and a table of the buckets (bounded in number) says which shards begin
  in it; so every row knows its shard where it is read.
* Rows go to their shard by number, are sorted there by window and position, and written as one file, batch by batch. The
  place in the file gives batch and slot. The manifest comes last.
"""

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from epiframe.functions.randomness import hash_int
from epiframe.operators.chunked import BROADCAST_KEYS, dense_lengths, join_by_chunk
from epiframe.operators.ordered import PART_BYTES, row_width
from epiframe.operators.sampling import BUCKET_DIGITS, HASH_DIGITS, epoch_batches
from epiframe.operators.windows import STRIDE, WINDOW_SIZE
from epiframe.schema import EPISODE, POSITION, named
from epiframe.storage import is_complete, pin

BUCKETS = 16**BUCKET_DIGITS
#: The part of ``monotonically_increasing_id`` that counts rows within a partition.
ROW_BITS = 33


class BatchesNotFound(FileNotFoundError):
    """A folder without finished batches."""


def _starts_of(lengths: DataFrame, size: int, stride: int, keys: Sequence[str]) -> DataFrame:
    last = F.col("length") - size
    starts = F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(stride).cast("long")))
    return lengths.where(last >= 0).select(*keys, starts.alias("start"))


def _bucket(hashed) -> F.Column:
    return F.floor(hashed / F.lit(16 ** (HASH_DIGITS - BUCKET_DIGITS)))


def _routes(starts: DataFrame, per_shard: int, epochs: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """One row per epoch and bucket: the shards that begin in buckets before, and the windows that shards here begin with."""
    window = [*keys, "start"]
    heads = epoch_batches(starts, per_shard, epochs, seed, keys=window).where("slot = 0 and batch_id > 0")
    hashed = hash_int(seed, F.col("epoch"), *[F.col(k) for k in window], digits=HASH_DIGITS)
    heads = heads.withColumn("_h", hashed).withColumn("_bucket", _bucket(F.col("_h")))
    marks = heads.groupBy("epoch", "_bucket").agg(F.sort_array(F.collect_list(F.struct("_h", *window))).alias("_heads"))
    every = starts.sparkSession.range(BUCKETS).select(F.col("id").alias("_bucket")).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    before = W.partitionBy("epoch").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    n = F.coalesce(F.size("_heads"), F.lit(0))
    return every.join(marks, ["epoch", "_bucket"], "left").withColumn("_before", F.coalesce(F.sum(F.greatest(n, F.lit(0))).over(before), F.lit(0)))


def routed(
    frames: DataFrame, lengths: DataFrame, per_shard: int, epochs: int, seed: int, size: int = WINDOW_SIZE, stride: int = STRIDE,
    keys: Sequence[str] = EPISODE, pos: str = POSITION,
) -> DataFrame:
    """Every frame once for every window and epoch it is in, with ``epoch``, ``start``, the window's hash and its shard.

    Nothing wide is shuffled while the episode lengths and the buckets can be broadcast; beyond that the lengths
    are joined by (episode, chunk).
    """
    if epochs * BUCKETS > BROADCAST_KEYS:
        raise ValueError(f"at most {BROADCAST_KEYS // BUCKETS} epochs at a time")
    window = [*keys, "start"]
    routes = pin(_routes(_starts_of(lengths, size, stride, keys), per_shard, epochs, seed, keys))
    held = join_by_chunk(frames, lengths, keys, pos, keyed_rows=lengths.count())
    p = F.col(pos)
    first = F.greatest(F.ceil((p - (size - 1)) / F.lit(stride)), F.lit(0)) * stride
    last = F.least(F.floor(p / F.lit(stride)) * stride, F.floor((F.col("length") - size) / F.lit(stride)) * stride)
    fits = (F.col("length") >= size) & (first <= last)
    spread = held.where(fits).withColumn("start", F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(stride).cast("long")))).drop("length")
    spread = spread.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    spread = spread.withColumn("_h", hash_int(seed, F.col("epoch"), *[F.col(k) for k in window], digits=HASH_DIGITS)).withColumn("_bucket", _bucket(F.col("_h")))
    me = F.struct("_h", *window)
    begun = F.coalesce(F.size(F.filter("_heads", lambda head: head <= me)), F.lit(0))
    return spread.join(F.broadcast(routes), ["epoch", "_bucket"]).withColumn("shard", (F.col("_before") + F.greatest(begun, F.lit(0))).cast("int")).drop("_bucket", "_heads", "_before")


def write_batches(
    frames: DataFrame,
    path: str,
    batch_size: int,
    epochs: int = 1,
    seed: int = 42,
    columns: Sequence[str] | None = None,
    size: int = WINDOW_SIZE,
    stride: int = STRIDE,
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    part_bytes: int = PART_BYTES,
) -> None:
    """Write the steps of all full windows as the batches of ``epoch_batches``; the last partial batch is kept.

    A file holds whole batches: one row per step, in the order of batch, slot and position, with ``columns`` (all by
    default). An episode with a gap is an error.
    """
    if batch_size < 1 or epochs < 1:
        raise ValueError("batch_size and epochs must be 1 or more")
    names = [c for c in (columns or frames.columns) if c not in (*keys, pos)]
    narrow = frames.select(*keys, pos, *[named(c) for c in names])
    lengths = dense_lengths(frames, keys, pos)
    windows = _starts_of(lengths, size, stride, keys).count()
    per_shard = max(1, part_bytes // (row_width(narrow.schema) * size * batch_size)) * batch_size
    shards = max(1, -(-windows // per_shard))
    rows = routed(narrow, lengths, per_shard, epochs, seed, size, stride, keys, pos)
    order = ["epoch", "shard", "_h", *keys, "start", pos]
    placed = rows.repartitionById(epochs * shards, (F.col("epoch") * shards + F.col("shard")).cast("int")).sortWithinPartitions(*order)
    # a partition is a shard, in order, and a window has ``size`` rows in it
    row = F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1)
    place = F.floor(row / F.lit(size)) + F.col("shard").cast("long") * per_shard
    placed = placed.withColumn("_place", place)
    out = placed.select(
        "epoch", "shard", F.floor(F.col("_place") / F.lit(batch_size)).alias("batch_id"), F.pmod("_place", F.lit(batch_size)).cast("long").alias("slot"),
        *keys, "start", pos, *[named(c) for c in names],
    )
    base = path.rstrip("/")
    out.write.partitionBy("epoch", "shard").parquet(f"{base}/batches")
    facts = {"n_windows": windows, "batch_size": batch_size, "per_shard": per_shard, "shards": shards, "epochs": epochs, "size": size, "seed": seed}
    noted = [F.lit(v).cast("long").alias(k) for k, v in facts.items()]
    frames.sparkSession.range(1).select(*noted, F.lit(out.schema.json()).alias("schema")).write.parquet(f"{base}/manifest")


def batch_manifest(spark: SparkSession, path: str) -> dict:
    """What ``write_batches`` noted: windows, batch size, windows per shard, shards and epochs."""
    base = path.rstrip("/")
    if not is_complete(spark, f"{base}/manifest"):
        raise BatchesNotFound(f"no finished batches at {path}")
    return spark.read.parquet(f"{base}/manifest").first().asDict()


def read_batches(spark: SparkSession, path: str, epoch: int | None = None, batch_id: int | None = None) -> DataFrame:
    """The steps of all batches, of an epoch's, or of one batch, which reads the one file that holds it."""
    facts = batch_manifest(spark, path)
    rows = spark.read.schema(T.StructType.fromJson(json.loads(facts["schema"]))).parquet(f"{path.rstrip('/')}/batches")
    if epoch is not None:
        rows = rows.where(F.col("epoch") == epoch)
    if batch_id is not None:
        rows = rows.where((F.col("shard") == batch_id * facts["batch_size"] // facts["per_shard"]) & (F.col("batch_id") == batch_id))
    return rows


def shard_files(spark: SparkSession, path: str, epoch: int) -> list[str]:
    """The folders of an epoch's shards, in order: each can be read alone, by any reader of Parquet."""
    facts = batch_manifest(spark, path)
    return [f"{path.rstrip('/')}/batches/epoch={epoch}/shard={n}" for n in range(facts["shards"] if facts["n_windows"] else 0)]


def iterate_batches(spark: SparkSession, path: str, epoch: int, columns: Sequence[str], pos: str = POSITION) -> Iterator[dict[str, list]]:
    """The batches of an epoch one by one: per column a list of windows, each a list of its steps' values.

    Files are read one at a time, row group by row group; the process that calls holds one batch and what Spark fetches ahead.
    """
    for folder in shard_files(spark, path, epoch):
        rows = spark.read.parquet(folder).select("batch_id", "slot", pos, *[named(c) for c in columns]).sortWithinPartitions("batch_id", "slot", pos)
        held: dict[str, list] | None = None
        at = None
        for row in rows.coalesce(1).toLocalIterator(prefetchPartitions=False):
            if at is None or row["batch_id"] != at[0]:
                if held is not None:
                    yield held
                held, at = {c: [] for c in columns}, None
            if at is None or row["slot"] != at[1]:
                for c in columns:
                    held[c].append([])
            for c in columns:
                held[c][-1].append(row[c])
            at = (row["batch_id"], row["slot"])
        if held is not None:
            yield held
