"""Conversion of frames into stored windows, for training world models."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from epiframe.functions.images import resize_bytes
from epiframe.operators.episodes import normalize_actions
from epiframe.operators.windows import STRIDE, WINDOW_SIZE, sliding_windows
from epiframe.schema import EPISODE, named
from epiframe.storage import is_complete

# Image size per training target.
IMAGE_SIZES = {"dreamerv3": (64, 64), "le_world_model": (96, 96)}


def resize_frames(frames: DataFrame, shapes: Mapping[str, Sequence[int]], size: tuple[int, int]) -> DataFrame:
    """Resize every image column named in ``shapes`` (column: height, width, channels)."""
    resized = {c: resize_bytes(named(c), *shape, *size) for c, shape in shapes.items()}
    return frames.withColumns(resized)


def convert_to_windows(
    frames: DataFrame,
    out: str,
    dims: int,
    shapes: Mapping[str, Sequence[int]] | None = None,
    image_size: tuple[int, int] = IMAGE_SIZES["dreamerv3"],
    size: int = WINDOW_SIZE,
    stride: int = STRIDE,
    normalize: bool = True,
    keys: Sequence[str] = EPISODE,
) -> DataFrame:
    """Write windows under ``out/windows`` unless they are there, and read them back.

    Images shrink before the only shuffle. A table that already holds windows is
    returned as it is.
    """
    if "steps" in frames.columns:
        return frames
    spark = frames.sparkSession
    target = f"{out.rstrip('/')}/windows"
    if not is_complete(spark, target):
        shapes = shapes or {}
        prepared = normalize_actions(frames, dims) if normalize else frames
        prepared = resize_frames(prepared, shapes, image_size)
        windows = sliding_windows(prepared, size, stride, ["action", *shapes], keys)
        # what a crashed conversion left is replaced
        windows.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
