"""Image columns: raw bytes in Arrow batches, or float arrays as expressions.

Images are either ``array<float>`` (normalised) or ``binary`` (one byte per value).
The byte conversions work on whole Arrow batches: numpy sees one flat buffer per
batch, and no Python code runs per row.
"""

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from epiframe.schema import VALUE_BYTES, named

# Fixed values of the quantisation rule and of image detection.
U8_MAX = 255.0
NORMALIZED_MAX = 1.5
MIN_IMAGE_VALUES = 1024
IMAGE_CHANNELS = 3
IMAGE_WORDS = ("image", "rgb")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of an Arrow list column; null rows have length 0."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row lengths of an Arrow binary column; null rows have length 0."""
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return values[offsets[0] : offsets[-1]], np.diff(offsets)


def _binary(values: np.ndarray, lengths: np.ndarray, nulls: pa.Array) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    packed = pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())]
    )
    if not nulls.null_count:
        return packed
    return pa.compute.if_else(nulls.is_null(), pa.scalar(None, pa.binary()), packed)


def _check_lengths(lengths: np.ndarray, images: pa.Array, expected: int) -> None:
    """Every image that is there must have its declared size: a batch is one buffer."""
    there = images.is_valid().to_numpy(zero_copy_only=False)
    wrong = np.flatnonzero(there & (lengths != expected))
    if len(wrong):
        raise ValueError(f"{len(wrong)} images without {expected} bytes, the first has {lengths[wrong[0]]}")


@F.arrow_udf(T.BinaryType())
def quantize_u8(image: pa.Array) -> pa.Array:
    """Normalised float image to one byte per value: scale, clamp, drop the fraction; integers are an error."""
    if not pa.types.is_floating(image.type.value_type):
        raise ValueError("only normalised float images are quantised")
    values, lengths = _lists(image)
    scaled = values.astype(np.float32, copy=False) * np.float32(U8_MAX)
    return _binary(np.clip(scaled, 0, U8_MAX).astype(np.uint8), lengths, image)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def dequantize_u8(image: pa.Array) -> pa.Array:
    """Bytes back to floats in [0, 1]; off by less than 1/255 from the original."""
    values, lengths = _bytes_of(image)
    floats = values.astype(np.float32) / np.float32(U8_MAX)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    unpacked = pa.ListArray.from_arrays(ends, pa.array(floats))
    if not image.null_count:
        return unpacked
    return pa.compute.if_else(image.is_null(), pa.scalar(None, unpacked.type), unpacked)


def quantize_array(image: Column) -> Column:
    """``quantize_u8`` for small arrays, as ``array<int>`` without leaving the JVM."""
    top, low = F.lit(U8_MAX).cast("float"), F.lit(0.0).cast("float")
    return F.transform(
        image, lambda x: F.floor(F.greatest(low, F.least(top, x.cast("float") * top))).cast("int")
    )


def dequantize_array(image: Column) -> Column:
    return F.transform(image, lambda x: (x.cast("float") / F.lit(U8_MAX).cast("float")).cast("float"))


def hwc_to_chw(image: Column, h: int, w: int, c: int, scale: bool = False) -> Column:
    """Reorder an array image to channel-first when it has 1 or 3 channels; divide by 255 on request."""
    if scale:
        image = dequantize_array(image)
    if c not in (1, 3):
        return image
    area = h * w
    order = F.sequence(F.lit(0), F.lit(area * c - 1))
    return F.transform(
        order, lambda i: F.element_at(image, ((i / F.lit(area)).cast("int") + F.lit(c) * (i % F.lit(area)) + 1).cast("int"))
    )


def hwc_to_chw_bytes(image: Column, h: int, w: int, c: int) -> Column:
    """Reorder byte images to channel-first; every row of the column has the same shape."""

    @F.arrow_udf(T.BinaryType())
    def reorder(batch: pa.Array) -> pa.Array:
        values, lengths = _bytes_of(batch)
        _check_lengths(lengths, batch, h * w * c)
        moved = values.reshape(-1, h, w, c).transpose(0, 3, 1, 2)
        return _binary(moved.reshape(-1), lengths, batch)

    return reorder(image)


def resize_bytes(image: Column, h: int, w: int, c: int, out_h: int, out_w: int) -> Column:
    """Nearest-neighbour resize of height-width-channel bytes (the interpolation is ours).

    Target pixel (i, j) takes source pixel (i * h // out_h, j * w // out_w).
    """
    rows = np.arange(out_h) * h // out_h
    cols = np.arange(out_w) * w // out_w

    @F.arrow_udf(T.BinaryType())
    def resize(batch: pa.Array) -> pa.Array:
        values, lengths = _bytes_of(batch)
        _check_lengths(lengths, batch, h * w * c)
        picked = values.reshape(-1, h, w, c)[:, rows][:, :, cols]
        sizes = np.where(lengths > 0, out_h * out_w * c, 0)
        return _binary(picked.reshape(-1), sizes, batch)

    return resize(image)


def coerce_image(data: Column, shape: Column, size: int) -> Column:
    """Channel-first ``size`` x ``size`` image bytes, or zeros for anything else.

    A leading batch dimension of 1 is dropped. Channel-last images of the expected
    size are reordered, channel-first ones kept.
    """
    n = size * size * IMAGE_CHANNELS
    dims = F.when((F.size(shape) == 4) & (shape[0] == 1), F.slice(shape, 2, 3)).otherwise(shape)
    dims = dims.cast("array<int>")
    full = F.octet_length(data) == n
    last = full & (dims == F.lit([size, size, IMAGE_CHANNELS]))
    first = full & (dims == F.lit([IMAGE_CHANNELS, size, size]))
    zeros = F.unhex(F.repeat(F.lit("00"), n))
    reordered = hwc_to_chw_bytes(F.when(last, data), size, size, IMAGE_CHANNELS)
    return F.when(F.coalesce(last, F.lit(False)), reordered).when(first, data).otherwise(zeros)


def row_bytes(df: DataFrame) -> Column:
    """Bytes held by the tensor columns of a row; scalars and strings count nothing."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        column = named(f.name)
        if isinstance(f.dataType, T.BinaryType):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = VALUE_BYTES.get(type(f.dataType.elementType))
            if width:
                total = total + F.coalesce(F.size(column), F.lit(0)).cast("long") * width
    return total


def image_report(df: DataFrame) -> DataFrame:
    """One row per tensor column: number of values, and whether it looks like an image.

    A column is an image if its shape has 3 or 4 dimensions with one of 3, or its
    name says so, and it holds more than 1024 values. Shapes come from the column
    metadata; only columns without one are measured, over the whole table.
    """
    rows = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.ArrayType | T.BinaryType):
            continue
        shape = (f.metadata or {}).get("shape") or []
        column = named(f.name)
        if shape:
            values = F.lit(int(np.prod(shape))).cast("long")
        elif isinstance(f.dataType, T.BinaryType):
            values = F.max(F.octet_length(column)).cast("long")
        else:
            values = F.max(F.size(column)).cast("long")
        shaped = len(shape) in (3, 4) and IMAGE_CHANNELS in shape
        by_name = any(word in f.name.lower() for word in IMAGE_WORDS)
        rows.append((f.name, values, shaped or by_name))
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            values.alias("n_values"),
            (F.lit(candidate) & (values > MIN_IMAGE_VALUES)).alias("is_image"),
        )
        for name, values, candidate in rows
    ]
    return df.agg(F.array(*entries).alias("_r")).select(F.inline("_r"))


def detect_image_columns(df: DataFrame) -> list[str]:
    """Names of the image columns; the list has one entry per column at most."""
    return [r["column_name"] for r in image_report(df).where("is_image").collect()]


def normalized_report(df: DataFrame, column: str) -> DataFrame:
    """Largest value of a column and whether it counts as normalised to [0, 1].

    The whole column is tested: one bright row decides, wherever it is.
    """
    dtype = df.schema[column].dataType
    values = named(column)
    if not isinstance(dtype, T.ArrayType):
        return df.agg(F.lit(None).cast("double").alias("max_value"), F.lit(False).alias("is_normalized"))
    floating = isinstance(dtype.elementType, T.FloatType | T.DoubleType)
    top = F.max(F.array_max(values)).cast("double")
    return df.agg(
        top.alias("max_value"),
        F.coalesce(F.lit(floating) & (top <= NORMALIZED_MAX), F.lit(False)).alias("is_normalized"),
    )


def is_normalized(df: DataFrame, column: str) -> bool:
    return normalized_report(df, column).first()["is_normalized"]


def normalized_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that are normalised floats, by one aggregate over all of them."""
    floats = [c for c in columns if isinstance(t := df.schema[c].dataType, T.ArrayType) and isinstance(t.elementType, T.FloatType | T.DoubleType)]
    if not floats:
        return []
    row = df.agg(*[(F.max(F.array_max(named(c))).cast("double") <= NORMALIZED_MAX).alias(f"c{n}") for n, c in enumerate(floats)]).first()
    return [c for n, c in enumerate(floats) if row[n]]


def quantize_normalized(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its normalised float columns of ``columns`` as bytes, and which these were; others pass through."""
    packed = normalized_columns(df, columns)
    return df.withColumns({c: quantize_u8(named(c)).alias(c, metadata=df.schema[c].metadata) for c in packed}), packed


LEVELS = int(U8_MAX) + 1
HISTOGRAM = "feature string, channel int, value int, n long"


def _channels(df: DataFrame, column: str) -> int:
    """Channels of an image column by its declared shape, in height, width, channel order; 1 if it has none."""
    shape = (df.schema[column].metadata or {}).get("shape") or []
    return int(shape[-1]) if len(shape) >= 3 else 1


def image_histogram(df: DataFrame, columns: Sequence[str], channels: Mapping[str, int] | None = None) -> DataFrame:
    """feature, channel, value (0 to 255) and how many pixels have it: 256 rows a channel at most.

    Byte columns are counted as they are, normalised float columns as ``quantize_u8`` makes them. A task counts its batches in
    arrays; only histograms are shuffled, and they add up. Null and empty images count nothing; an
    image whose values do not divide into channels is an error.
    """
    counts = {c: (channels or {}).get(c) or _channels(df, c) for c in columns}
    floats = {c for c in columns if isinstance(df.schema[c].dataType, T.ArrayType)}

    def run(batches):
        sums = {c: np.zeros((n, LEVELS), np.int64) for c, n in counts.items()}
        for batch in batches:
            for (c, n), array in zip(counts.items(), batch.columns):
                values, lengths = _lists(array) if c in floats else _bytes_of(array)
                if c in floats:
                    values = np.clip(values.astype(np.float32, copy=False) * np.float32(U8_MAX), 0, U8_MAX).astype(np.uint8)
                if (np.asarray(lengths) % n).any():
                    raise ValueError(f"{c}: images that do not divide into {n} channels")
                for k in range(n):
                    sums[c][k] += np.bincount(values[k::n], minlength=LEVELS)
        rows = [(c, k, v, int(x)) for c, table in sums.items() for k, row in enumerate(table.tolist()) for v, x in enumerate(row) if x]
        columns_ = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns_, kinds)], names=["feature", "channel", "value", "n"])

    # names with dots do not reach Python functions
    parts = df.select(*[named(c).alias(f"c{n}") for n, c in enumerate(counts)]).mapInArrow(run, HISTOGRAM)
    return parts.groupBy("feature", "channel", "value").agg(F.sum("n").alias("n"))


def image_stats(df: DataFrame, columns: Sequence[str], channels: Mapping[str, int] | None = None) -> DataFrame:
    """Per image column and channel: pixels, min, max, mean, population deviation and quantiles, exact in byte values.

    A quantile is the smallest value that at least its share of the pixels do not exceed.
    """
    bins = image_histogram(df, columns, channels)
    below = W.partitionBy("feature", "channel").orderBy("value")
    total = F.sum("n").over(W.partitionBy("feature", "channel"))
    ranked = bins.withColumns({"_upto": F.sum("n").over(below), "_all": total})
    v, n = F.col("value").cast("double"), F.col("n")
    mean = F.sum(v * n) / F.sum(n)
    quantiles = [F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * q, F.col("value"))).alias(f"q{q:02d}") for q in (1, 50, 99)]
    # sums of integers below 2 ** 53 a term: the variance from whole moments
    facts = ranked.groupBy("feature", "channel").agg(
        F.sum("n").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), mean.alias("mean"),
        F.sum(v * v * n).alias("_squares"), *quantiles,
    )
    spread = F.sqrt(F.greatest(F.col("_squares") / F.col("count") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    return facts.select("feature", "channel", "count", "min", "max", "mean", spread.alias("std"), "q01", "q50", "q99")
