"""Reproducible order, shuffled batches and draws over windows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epiframe.functions.randomness import hash_int
from epiframe.operators.chunked import join_null_safe
from epiframe.operators.ordered import PART_BYTES, arrange, classes_of, dense_index, row_width
from epiframe.schema import EPISODE

HASH_DIGITS = 15
#: An index up to so many times the number of rows says where rows belong.
DENSE = 2
#: Most windows that are found by a top-n rather than by number.
TOP_KEYS = 100_000
#: Leading hex digits of the shuffle key that name a bucket: 65536 buckets.
BUCKET_DIGITS = 4


def restore_order(df: DataFrame, index: str = "row_index", part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows in their original order, whatever order they were produced in.

    An index that is nearly dense from 0 says where a row belongs; only the index is read to find its end. A
    sparse one, or one with negative or null values (which come first), is cut at its approximate quantiles, also found on the
    index alone: the number of partitions follows the number of rows.
    """
    rows, low, last = df.agg(F.count("*"), F.min(F.coalesce(F.col(index), F.lit(-1))), F.max(index)).first()
    if not rows or (low >= 0 and last < DENSE * rows):
        return arrange(df, index, 0 if last is None else last + 1, [index], part_bytes)
    per_part = max(1, part_bytes // row_width(df.schema))
    classes = classes_of(df.select(F.col(index).alias("_index")), "_index", rows, per_part)
    # bucketing wants one plain column; class -1 is that of nulls
    placed = classes.assign(df.withColumn("_index", F.col(index).cast("double"))).withColumn("_part", (F.col("_class") + 1).cast("int"))
    return placed.repartitionById(2 * len(classes.cuts) + 3, "_part").drop("_index", "_class", "_part").sortWithinPartitions(index)


def number_windows(windows: DataFrame, key: str = "episode_index", out: str = "window_id") -> DataFrame:
    """Dense number of the windows that are there, in stored order (episode, start).

    Windows may have been cut with any stride and filtered since. Only their keys are
    sorted and numbered; the numbers are joined back.
    """
    return join_null_safe(windows, dense_index(windows.select(key, "start"), [key, "start"], out), [key, "start"])


def cap_windows(windows: DataFrame, n: int | None, key: str = "episode_index", top_keys: int = TOP_KEYS) -> DataFrame:
    """The first ``n`` windows in stored order; all of them when n is None.

    A small n is found by a top-n on the keys alone, a larger one by the window number;
    neither moves step arrays through one task.
    """
    if n is None:
        return windows
    narrow = windows.select(key, "start")
    if n > top_keys:
        first = dense_index(narrow, [key, "start"], "_number").where(F.col("_number") < n).drop("_number")
    else:
        first = narrow.orderBy(key, "start").limit(n)
    return join_null_safe(windows, first, [key, "start"], "left_semi", small=n <= top_keys)


def epoch_batches(
    windows: DataFrame,
    batch_size: int,
    epochs: int = 1,
    seed: int = 42,
    shuffle: bool = True,
    keys: Sequence[str] = (*EPISODE, "start"),
) -> DataFrame:
    """Assign every window to one batch per epoch; the last partial batch is kept.

    Each epoch orders the windows by a hash of (seed, epoch, key): a new permutation
    that does not depend on partitioning. The hash is uniform, so its leading digits
    make even buckets; a bucket's offset plus the place inside it is the position.
    Only keys are needed: pass ``window_starts`` rather than windows with their steps.
    """
    narrow = windows.select(*keys)
    if not shuffle:
        numbered = dense_index(narrow, keys, "_position")
        spread = numbered.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        return _batched(spread, F.col("_position"), batch_size, keys)
    spread = narrow.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    hashed = spread.withColumn("_h", hash_int(seed, F.col("epoch"), *[F.col(k) for k in keys], digits=HASH_DIGITS))
    hashed = hashed.withColumn("_bucket", F.floor(F.col("_h") / F.lit(16 ** (HASH_DIGITS - BUCKET_DIGITS))))
    lower = W.partitionBy("epoch").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("epoch", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("epoch", "_bucket", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(W.partitionBy("epoch", "_bucket").orderBy("_h", *keys)) - 1
    placed = hashed.withColumn("_inside", inside).join(offsets, ["epoch", "_bucket"])
    return _batched(placed, F.col("_before") + F.col("_inside"), batch_size, keys)


def _batched(df: DataFrame, position: Column, batch_size: int, keys: Sequence[str]) -> DataFrame:
    return df.select(
        "epoch",
        F.floor(position / F.lit(batch_size)).alias("batch_id"),
        F.pmod(position, F.lit(batch_size)).cast("long").alias("slot"),
        *keys,
    )


def sample_windows(windows: DataFrame, n: int, seed: int = 42, key: str = "episode_index") -> DataFrame:
    """``n`` uniform draws with replacement; ``draw`` numbers them.

    A draw is a hash of (seed, draw) modulo the number of windows, joined on the dense
    window number: both sides of the join are spread evenly, and steps come last.
    """
    numbered = dense_index(windows.select(key, "start"), [key, "start"], "window_id")
    total = numbered.count()
    draws = windows.sparkSession.range(n if total else 0).withColumnRenamed("id", "draw")
    drawn = F.pmod(hash_int(seed, F.col("draw"), digits=HASH_DIGITS), F.lit(max(total, 1)))
    picked = draws.withColumn("window_id", drawn).join(numbered, "window_id")
    return join_null_safe(windows, picked, [key, "start"]) if len(windows.columns) > 2 else picked
