"""Many keys in one state: the state processor is called, and its store asked, once a bucket and batch, not once a key."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets that keys are dealt to. A query that is started anew on its checkpoint needs the number it began with.
BUCKETS = 2048


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with its keys as text (null stays null, long integers stay whole in pandas) and the column ``bucket_id``."""
    return df.withColumn("bucket_id", F.pmod(F.xxhash64(*keys), F.lit(buckets))).withColumns({k: F.col(k).cast("string") for k in keys})


def text_keys(keys: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(k, T.StringType()) for k in keys]


def as_before(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys of ``df`` with their own types, from their texts."""
    return [F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys]


def numbered(known: list[tuple], rows: pd.DataFrame, keys: Sequence[str]) -> tuple[np.ndarray, list[tuple]]:
    """For every row the number of its key: its place in ``known``, new keys behind; and all keys."""
    place = {key: i for i, key in enumerate(known)}
    codes, firsts = np.zeros(len(rows), np.int64), None
    for k in keys:
        own, _ = pd.factorize(rows[k], use_na_sentinel=False)
        codes = codes * (own.max() + 1 if len(own) else 1) + own
    codes, firsts = pd.factorize(codes)[0], np.flatnonzero(~pd.Series(codes).duplicated())
    found = rows.iloc[firsts]
    new = [tuple(None if pd.isna(x) else x for x in key) for key in zip(*(found[k] for k in keys))]
    of = np.array([place.setdefault(key, len(place)) for key in new], np.int64)
    return of[codes], list(place)
