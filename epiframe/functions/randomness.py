"""Reproducible pseudo-random values that depend on the row's key only.

``rand()`` depends on how rows are partitioned; a hash of (seed, key) does not,
so a recomputed task or another cluster size gives the same draw.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8
RANGE = 16**HEX_DIGITS


def hash_int(seed: int, *key: Column, digits: int = HEX_DIGITS) -> Column:
    """Uniform integer in ``[0, 16**digits)``; at most 15 digits fit a long."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def hash_uniform(seed: int, *key: Column) -> Column:
    """Uniform double in ``[0, 1)``."""
    return hash_int(seed, *key) / F.lit(float(RANGE))


def random_vector(seed: int, dim: int, low: float, high: float, *key: Column) -> Column:
    """``dim`` independent uniform values in ``[low, high)``."""
    draws = [hash_uniform(seed, *key, F.lit(i)) * (high - low) + low for i in range(dim)]
    return F.array(*draws)
