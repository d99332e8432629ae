"""Reading and writing frame tables and their side tables."""

from collections.abc import Mapping
from math import prod

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiframe.functions.images import image_stats
from epiframe.operators.chunked import BROADCAST_KEYS, GapError, dense_lengths
from epiframe.operators.episodes import episode_summary, feature_stats
from epiframe.operators.ordered import PART_BYTES, arrange, running_total
from epiframe.schema import FRAME_SCHEMA, named
from epiframe.storage import exists


class ShapeMismatch(ValueError):
    """Vectors or images whose length is not the one their column declares."""


class SchemaMismatch(ValueError):
    """Columns that were asked for and are not stored."""


class DatasetNotFound(FileNotFoundError):
    """A dataset folder that is not there, with what to try next."""

    def __init__(self, path: str):
        self.suggestions = ["check the dataset path", "record the dataset first"]
        super().__init__(f"dataset not found: {path} ({'; '.join(self.suggestions)})")


def read_frames(spark: SparkSession, path: str, schema: T.StructType | None = FRAME_SCHEMA) -> DataFrame:
    """The frame table of a dataset folder; ``schema=None`` takes the stored one.

    Columns of ``schema`` that are not stored, or stored with another type, are an error. Stored ones beyond it are not read.
    """
    frames = f"{path.rstrip('/')}/frames"
    if not exists(spark, frames):
        raise DatasetNotFound(path)
    stored = spark.read.parquet(frames)
    if schema is None:
        return stored
    kinds = {f.name: f.dataType for f in stored.schema.fields}
    wrong = [f.name for f in schema.fields if f.name not in kinds or kinds[f.name].simpleString() != f.dataType.simpleString()]
    if wrong:
        raise SchemaMismatch(f"{path} does not hold {', '.join(wrong)} as asked for; pass a schema without them, or None")
    return spark.read.schema(schema).parquet(frames)


def shape_report(frames: DataFrame) -> DataFrame:
    """One row per column that declares a shape: expected number of values, rows, and rows that differ."""
    rows = []
    for f in frames.schema.fields:
        shape = (f.metadata or {}).get("shape")
        if not shape:
            continue
        values = F.octet_length(named(f.name)) if isinstance(f.dataType, T.BinaryType) else F.size(named(f.name))
        expected = prod(shape)
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(expected).cast("long").alias("expected"),
                F.count(named(f.name)).alias("n_rows"),
                F.count_if(named(f.name).isNotNull() & (values != expected)).alias("n_wrong"),
            )
        )
    if not rows:
        raise ValueError("no column declares a shape")
    return frames.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def check_shapes(frames: DataFrame) -> DataFrame:
    """The frames, if every vector and image has its declared length."""
    wrong = shape_report(frames).where("n_wrong > 0").collect()
    if wrong:
        raise ShapeMismatch("; ".join(f"{r['column_name']}: {r['n_wrong']} rows without {r['expected']} values" for r in wrong))
    return frames


def write_frames(
    df: DataFrame, path: str, mode: str = "errorifexists", part_bytes: int = PART_BYTES, lengths: DataFrame | None = None
) -> None:
    """Write frames sorted by episode and position, in files of about ``part_bytes`` before encoding.

    Files are cut by the frame's place in the whole table, so a long episode fills
    several of them, and row-group statistics let readers skip to an episode or a
    position. The place follows from the episode lengths, which a narrow scan gives.
    With too many episodes to broadcast their offsets, Spark samples the key instead.
    Frames without an episode or whose positions have a gap are an error.
    """
    order = ["episode_index", "frame_index"]
    lengths = dense_lengths(df) if lengths is None else lengths
    if not lengths.where("episode_index is null").isEmpty():
        raise GapError("frames without an episode_index")
    episodes, total = lengths.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    if episodes <= BROADCAST_KEYS:
        offsets = running_total(lengths, "episode_index", "length", "_offset", episodes).drop("length")
        placed = df.join(F.broadcast(offsets), "episode_index")
        placed = placed.withColumn("_position", F.col("_offset") + F.col("frame_index")).drop("_offset")
        ordered = arrange(placed, "_position", total, order, part_bytes).select(*[named(c) for c in df.columns])
    else:
        ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode(mode).parquet(f"{path.rstrip('/')}/frames")


def write_dataset_meta(frames: DataFrame, path: str, dims: Mapping[str, int], fps: float, mode: str = "overwrite") -> None:
    """Write the side tables of a finished dataset: episodes, stats and info, and image_stats if byte columns declare an image's shape."""
    base = path.rstrip("/")
    spark = frames.sparkSession
    episode_summary(frames).write.mode(mode).parquet(f"{base}/episodes")
    feature_stats(frames, dims).coalesce(1).write.mode(mode).parquet(f"{base}/stats")
    images = [f.name for f in frames.schema.fields if isinstance(f.dataType, T.BinaryType) and len((f.metadata or {}).get("shape") or []) == 3]
    if images:
        image_stats(frames, images).coalesce(1).write.mode(mode).parquet(f"{base}/image_stats")
    episodes = spark.read.parquet(f"{base}/episodes")
    info = episodes.selectExpr(
        "count(*) AS total_episodes", "coalesce(sum(length), 0) AS total_frames", f"double({fps}) AS fps"
    )
    info.coalesce(1).write.mode(mode).parquet(f"{base}/info")


def persist_frames(df: DataFrame) -> DataFrame:
    """Keep decoded frames for several epochs: in memory while they fit, else on disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
