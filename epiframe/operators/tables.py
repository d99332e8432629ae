"""Row selection, merging of sources, and run-level metric tables."""

from collections.abc import Iterable, Sequence
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from epiframe.functions.images import row_bytes
from epiframe.functions.metrics import PRIMARY_METRICS
from epiframe.operators.chunked import join_by_chunk, join_null_safe
from epiframe.operators.episodes import episode_lengths
from epiframe.operators.ordered import ROWS_PER_CLASS, arrange, dense_index, running_total
from epiframe.operators.sampling import restore_order
from epiframe.schema import POSITION, VALUE_BYTES, named
from epiframe.storage import pin

#: Longest index list that is taken from the driver.
BROADCAST_INDICES = 1_000_000
# Log interval and cache ceiling (10^9 bytes per gigabyte).
LOG_EVERY = 50
CACHE_GB = 8.0
RECORDED_SOURCE = "dr"


def select_rows(df: DataFrame, indices: Iterable[int] | DataFrame | None, index: str = "row_index") -> DataFrame:
    """The listed rows in list order, duplicates kept; all rows when ``indices`` is None.

    ``indices`` is a table (pos, row_index) or a list of at most ``BROADCAST_INDICES``. An index without a row is an
    error, found by the index column alone. Up to ``BROADCAST_INDICES`` wanted rows are broadcast, so the
    table is filtered where it is read and no row that is not wanted moves.
    """

    def found(wanted: DataFrame, n: int, rows: int) -> DataFrame:
        small = F.broadcast(wanted) if rows <= BROADCAST_INDICES else wanted
        missing = small.join(df.select(index).join(F.broadcast(wanted.select(index)) if rows <= BROADCAST_INDICES else wanted.select(index), index, "left_semi"), index, "left_anti")
        first = missing.agg(F.count("*"), F.min(index)).first()
        if first[0]:
            raise LookupError(f"no row has {index} {'null' if first[1] is None else first[1]}")
        return arrange(df.join(small, index).select("pos", *[named(c) for c in df.columns]), "pos", n, ["pos"])

    if indices is None:
        return restore_order(df, index)
    if isinstance(indices, DataFrame):
        last, n = indices.agg(F.max("pos"), F.count("*")).first()
        return found(indices.select("pos", index), 0 if last is None else last + 1, n)
    indices = list(indices)
    if len(indices) > BROADCAST_INDICES:
        raise ValueError(f"more than {BROADCAST_INDICES} indices: pass a table (pos, {index})")
    listed = [(pos, int(i)) for pos, i in enumerate(indices)]
    wanted = df.sparkSession.createDataFrame(listed, f"pos long, {index} long")
    return found(wanted, len(listed), len(listed))


def merge_sources(sources: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union of datasets by column name, with the source in a column.

    Episodes are then keyed by (source, episode_index).
    """
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    merged = tagged[0]
    for df in tagged[1:]:
        merged = merged.unionByName(df)
    return merged


def episode_numbers(
    frames: DataFrame, keys: Sequence[str] = ("source", "episode_index"), out: str = "merged_index"
) -> DataFrame:
    """Dense numbers of all episodes in the order of their keys (the numbering is ours).

    One row per episode: the keys, ``length`` and the number.
    """
    return dense_index(episode_lengths(frames, keys), keys, out)


def renumber_episodes(
    frames: DataFrame,
    keys: Sequence[str] = ("source", "episode_index"),
    pos: str = POSITION,
    out: str = "merged_index",
) -> DataFrame:
    """Add the dense episode number to every frame of a merged table."""
    numbers = episode_numbers(frames, keys, out)
    joined = join_by_chunk(frames, numbers, keys, pos, keyed_rows=numbers.count())
    return joined.drop("length")


def thin_log(
    metrics: DataFrame, every: int = LOG_EVERY, total: int | None = None, step: str = "step", run: str = "run_id"
) -> DataFrame:
    """Keep the first step, every n-th one and the last of every run; ``total`` is the last step, if known."""
    s = F.col(step)
    regular = (s == 1) | (F.pmod(s, F.lit(every)) == 0)
    if total is not None:
        return metrics.where(regular | (s == total))
    ends = metrics.groupBy(run).agg(F.max(step).alias("_end"))
    return join_null_safe(metrics, ends, [run]).where(regular | (s == F.col("_end"))).drop("_end")


def attach_primary_metric(runs: DataFrame, arch: str = "target_arch") -> DataFrame:
    """Add the primary metric and its better direction; an unknown target is an error."""
    table = runs.sparkSession.createDataFrame(
        [(m[0], m[1], m[3]) for m in PRIMARY_METRICS], f"{arch} string, metric string, direction string"
    )
    joined = runs.join(F.broadcast(table), arch, "left")
    unknown = F.raise_error(F.concat(F.lit("unknown target: "), F.col(arch))).cast("string")
    return joined.withColumn("metric", F.coalesce("metric", unknown))


def last_metric(
    runs: DataFrame, metrics: DataFrame, run: str = "run_id", order: str | Sequence[str] = "line_no", arch: str = "target_arch"
) -> DataFrame:
    """The last primary metric of every run, 0 when it has none (the default is ours).

    Other metrics of the run do not count. ``order`` may be several columns, such as file and line.
    """
    keys = [order] if isinstance(order, str) else list(order)
    wanted = attach_primary_metric(runs, arch).select(run, F.col("metric").alias("name")).distinct()
    primary = metrics.join(wanted, [run, "name"], "left_semi")
    last = primary.groupBy(run).agg(F.max_by("value", F.struct(*keys)).alias("value"))
    return runs.join(last, run, "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def best_metric(runs: DataFrame, metrics: DataFrame, run: str = "run_id") -> DataFrame:
    """The best primary metric of every run: smallest loss, largest success rate."""
    bounds = metrics.groupBy(run).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    best = F.when(F.col("direction") == "max", F.col("_hi")).otherwise(F.col("_lo"))
    return runs.join(bounds, run, "left").withColumn("best", best).drop("_lo", "_hi")


def _declared_bytes(df: DataFrame, packed: Sequence[str] = ()) -> Column:
    """Bytes of a row: by schema for columns that declare their shape, measured for the others; a byte a value in ``packed`` ones."""
    fixed, measured, values = 0, [], F.lit(0).cast("long")
    for f in df.schema.fields:
        shape = (f.metadata or {}).get("shape")
        value = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if shape and isinstance(f.dataType, T.ArrayType | T.BinaryType) and type(value) in VALUE_BYTES:
            fixed += prod(shape) * (1 if f.name in packed else VALUE_BYTES[type(value)])
        elif f.name in packed:
            values = values + F.greatest(F.coalesce(F.size(named(f.name)), F.lit(0)), F.lit(0)).cast("long")
        else:
            measured.append(f.name)
    return row_bytes(df.select(*[named(c) for c in measured])) + values + F.lit(fixed).cast("long")


def size_budget(
    df: DataFrame, max_gb: float = CACHE_GB, index: str = "row_index", chunk: int = 1 << 16,
    rows_per_class: int = ROWS_PER_CLASS, packed: Sequence[str] = (),
) -> DataFrame:
    """One row: rows, bytes, the ceiling, and the first sample (from 1) that exceeds it.

    Bytes are summed per chunk of the index; the running total over chunks names the
    one chunk that crosses the ceiling, and only its rows are added up one by one. Columns
    that declare a shape are not read. Array columns in ``packed`` count a byte a value, as they would when packed.
    """
    limit = int(max_gb * 1e9)
    sized = df.select(F.col(index), _declared_bytes(df, packed).alias("_bytes")).withColumn("_chunk", F.floor(F.col(index) / F.lit(chunk)))
    chunks = pin(sized.groupBy("_chunk").agg(F.count("*").alias("_n"), F.sum("_bytes").alias("_bytes")))
    n_chunks = chunks.count()
    running = running_total(chunks, "_chunk", "_bytes", "_bytes_before", n_chunks, rows_per_class)
    running = running_total(running, "_chunk", "_n", "_rows_before", n_chunks, rows_per_class)
    crossing = (F.col("_bytes_before") <= limit) & (F.col("_bytes_before") + F.col("_bytes") > limit)
    start = F.struct("_chunk", "_bytes_before", "_rows_before")
    total = running.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total_bytes"),
        F.min(F.when(crossing, start)).alias("_hit"),
    )
    inside = W.partitionBy("_chunk").orderBy(index).rowsBetween(W.unboundedPreceding, 0)
    hit = running.where(crossing).agg(F.min("_chunk")).scalar()
    steps = sized.where(F.col("_chunk") == hit).select(
        F.row_number().over(W.partitionBy("_chunk").orderBy(index)).alias("_at"),
        F.sum("_bytes").over(inside).alias("_sum"),
    )
    base = running.where(crossing).agg(F.min("_bytes_before")).scalar()
    first = steps.where(F.col("_sum") + base > limit).agg(F.min(F.struct("_at", "_sum")).alias("_f"))
    return total.withColumn("_f", first.scalar()).select(
        "n_rows",
        "total_bytes",
        F.lit(limit).cast("long").alias("limit_bytes"),
        (F.col("total_bytes") > limit).alias("over_budget"),
        (F.col("_hit._rows_before") + F.col("_f._at")).alias("first_over_sample"),
        (F.col("_hit._bytes_before") + F.col("_f._sum")).alias("bytes_at_sample"),
    )


def check_budget(df: DataFrame, max_gb: float = CACHE_GB, index: str = "row_index", packed: Sequence[str] = ()) -> int:
    """Total bytes of the table, its ``packed`` columns at a byte a value; raises when they exceed the ceiling."""
    row = size_budget(df, max_gb, index, packed=packed).first()
    if row["over_budget"]:
        raise MemoryError(
            f"{row['limit_bytes'] / 1e9:.1f} GB ceiling exceeded at sample "
            f"{row['first_over_sample']} of {row['n_rows']} ({row['bytes_at_sample']} bytes)"
        )
    return row["total_bytes"]


def distinct_metrics(metrics: DataFrame, keys: Sequence[str] = ("run_id", "step", "name"), order: str = "line_no") -> DataFrame:
    """One row per (run, step, name): logs repeat a metric when it is emitted again, and the last value counts.

    The last is that of the largest ``order``; of tables without that column, the largest value.
    """
    others = [c for c in metrics.columns if c not in keys]
    last = [named(order)] if order in metrics.columns else []
    row = F.struct(*last, *[named(c).alias(c) for c in sorted(others, key=lambda c: c != "value")])
    best = metrics.groupBy(*keys).agg(F.max_by(F.struct(*[named(c) for c in others]), row).alias("_row")) if others else metrics.select(*keys).distinct()
    return best.select(*[F.col("_row")[c].alias(c) if c in others else named(c) for c in metrics.columns])
