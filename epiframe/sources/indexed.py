"""Tables from which rows are picked by index: only files and row groups that may hold them are read."""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.operators.ordered import PART_BYTES
from epiframe.operators.sampling import restore_order
from epiframe.operators.tables import BROADCAST_INDICES, select_rows
from epiframe.schema import named
from epiframe.storage import exists

#: Indices that are compared with the statistics of row groups one by one; more are compared as one range a file.
LISTED = 200
RANGES = "file string, low long, high long, n long"


def write_indexed(df: DataFrame, path: str, index: str = "row_index", part_bytes: int = PART_BYTES, mode: str = "errorifexists") -> None:
    """Write ``df`` in the order of its index below ``path``, and the range of indices in each file beside it.

    With ``mode="append"`` the new files get ranges of their own, which may overlap with those of older ones.
    """
    base = path.rstrip("/")
    restore_order(df, index, part_bytes).write.mode(mode).parquet(f"{base}/rows")
    add_ranges(df.sparkSession, base, index, anew=mode == "overwrite")


def add_ranges(spark: SparkSession, path: str, index: str = "row_index", anew: bool = False) -> None:
    """Write the ranges of files that have none yet, such as files that another job appended."""
    base = path.rstrip("/")
    rows = spark.read.parquet(f"{base}/rows")
    known = [] if anew else [r["file"] for r in _ranges(spark, base).select("file").collect()]
    files = sorted(set(rows.inputFiles()) - set(known))
    if not files:
        return
    # the index column of the new files alone is read
    new = spark.read.schema(rows.schema).parquet(*files).groupBy(F.input_file_name().alias("file"))
    found = new.agg(F.min(index).cast("long").alias("low"), F.max(index).cast("long").alias("high"), F.count("*").alias("n"))
    found.coalesce(1).write.mode("overwrite" if anew else "append").parquet(f"{base}/ranges")


def _ranges(spark: SparkSession, base: str) -> DataFrame:
    """The ranges of the files; one that was written twice counts once."""
    if not exists(spark, f"{base}/ranges"):
        return spark.createDataFrame([], RANGES)
    return spark.read.schema(RANGES).parquet(f"{base}/ranges").dropDuplicates(["file"])


def read_indexed(spark: SparkSession, path: str, indices: Iterable[int] | DataFrame, index: str = "row_index") -> DataFrame:
    """``select_rows`` of a table written by ``write_indexed``: the listed rows in list order, duplicates kept.

    Only files whose range holds a wanted index are opened, and files without a range, so rows that were appended
    without one are found too. Within a file, row groups are passed over by their statistics. ``indices`` is a list of at
    most ``BROADCAST_INDICES`` or a table (pos, index); an index without a row is an error.
    """
    base = path.rstrip("/")
    if not isinstance(indices, DataFrame):
        indices = [int(i) for i in indices]
        if len(indices) > BROADCAST_INDICES:
            raise ValueError(f"more than {BROADCAST_INDICES} indices: pass a table (pos, {index})")
        wanted = spark.createDataFrame([(i,) for i in set(indices)], f"`{index}` long")
    else:
        wanted = indices.select(index).distinct()
    rows = spark.read.parquet(f"{base}/rows")
    files = _files_with(rows, _ranges(spark, base), wanted, index)
    if not files:
        return select_rows(rows.where(F.lit(False)), indices, index)
    found = spark.read.schema(rows.schema).parquet(*files)
    if isinstance(indices, list):
        distinct = sorted(set(indices))
        if len(distinct) <= LISTED:
            found = found.where(named(index).isin(distinct))
        else:
            found = found.where(named(index).between(distinct[0], distinct[-1]))
    else:
        low, high = indices.agg(F.min(index), F.max(index)).first()
        found = found.where(named(index).between(low, high))
    return select_rows(found, indices, index)


def _files_with(rows: DataFrame, ranges: DataFrame, wanted: DataFrame, index: str) -> list[str]:
    """Files that may hold a wanted index; their names are all that reaches the driver, as in any scan.

    The bounds of all ranges, sorted, cut the indices into sections. Tasks look up the sections of their indices, and a file is
    opened if one of the sections it spans was met. Bounds number twice the files, which the driver lists anyway.
    """
    known = ranges.collect()
    without = set(rows.inputFiles()) - {r["file"] for r in known}
    held = [r for r in known if r["low"] is not None]
    if not held:
        return sorted(without)
    bounds = np.unique([b for r in held for b in (r["low"], r["high"] + 1)])
    shared = rows.sparkSession.sparkContext.broadcast(bounds)

    def sections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = np.searchsorted(shared.value, pdf["v"].to_numpy(), side="right") - 1
            yield pd.DataFrame({"s": np.unique(at).astype(np.int64)})

    values = wanted.select(named(index).cast("long").alias("v")).where("v IS NOT NULL")
    met = np.sort([r["s"] for r in values.mapInPandas(sections, "s long").distinct().collect()])
    lows, ends = (np.searchsorted(bounds, [f(r) for r in held]) for f in (lambda r: r["low"], lambda r: r["high"] + 1))
    opened = np.searchsorted(met, lows) < np.searchsorted(met, ends)
    return sorted(without | {r["file"] for r, hit in zip(held, opened) if hit})
