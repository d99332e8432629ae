"""Cached reading: decoded frames are packed, checked against a ceiling, stored, and unpacked as they are read."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from epiframe.functions.images import dequantize_u8, detect_image_columns, quantize_normalized
from epiframe.operators.tables import CACHE_GB, check_budget
from epiframe.schema import named
from epiframe.sources.snapshot import current, input_fingerprint, load, materialize, read_manifest, snapshot_signature


@dataclass
class CachedFrames:
    """A stored table and what a reader must know of it."""

    packed: DataFrame
    image_keys: list[str]
    compress_keys: list[str]
    signature: str

    def frames(self) -> DataFrame:
        """The table with packed images as floats again."""
        return self.packed.withColumns({c: dequantize_u8(named(c)).alias(c) for c in self.compress_keys})


def cache_frames(
    df: DataFrame,
    directory: str,
    repo_id: str,
    root: str,
    inputs: str | Sequence[str] | None = None,
    max_gb: float = CACHE_GB,
    index: str = "row_index",
    refresh: bool = False,
) -> CachedFrames:
    """Detect images, pack the normalised float ones as bytes, check the size, and store the table once.

    The snapshot is keyed by repository, absolute root, number of rows, image columns and the
    input files; its manifest names the image columns and the packed ones, so a second call reads
    neither pixels nor their statistics. Bytes and integers are stored as they are.
    """
    spark = df.sparkSession
    images = detect_image_columns(df)
    prints = input_fingerprint(spark, list([inputs] if isinstance(inputs, str) else inputs)) if inputs else ""
    key = snapshot_signature(spark, repo_id, root, df.count(), images, prints, ",".join(df.columns))
    if not refresh and current(spark, f"{directory.rstrip('/')}/{key}"):
        stored = open_cache(spark, directory, key)
        if stored is not None:
            return stored
    packed, compressed = quantize_normalized(df, images)
    # sizes are known before anything is packed
    check_budget(df, max_gb, index, compressed)
    data = materialize(packed, directory, key, refresh, {"image_keys": images, "compress_keys": compressed})
    return CachedFrames(data, images, compressed, key)


def open_cache(spark: SparkSession, directory: str, key: str) -> CachedFrames | None:
    """A stored table by its signature, or None where it is missing or damaged."""
    data = load(spark, f"{directory.rstrip('/')}/{key}", key)
    if data is None:
        return None
    manifest = read_manifest(spark, directory, key)
    if "compress_keys" not in manifest:
        return None
    return CachedFrames(data, list(manifest["image_keys"]), list(manifest["compress_keys"]), key)
