"""Image columns and state vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiframe.functions import images, state
from epiframe.functions.images import image_stats


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(42)
    return [(i, (rng.integers(0, 256, 3 * 64 * 64) / 255).astype(np.float32)) for i in range(4)]


@pytest.fixture(scope="module")
def normalised(spark, rows):
    return spark.createDataFrame([(i, v.tolist()) for i, v in rows], "row_index long, image array<float>")


def test_round_trip(normalised, rows):
    out = normalised.select("row_index", images.quantize_u8("image").alias("b")).select("row_index", "b", images.dequantize_u8("b").alias("x"))
    for r in out.collect():
        assert len(r["b"]) == 3 * 64 * 64
        assert np.abs(np.array(r["x"], dtype=np.float32) - rows[r["row_index"]][1]).max() <= 1 / 255 + 1e-6


def test_quantisation_truncates_in_single_precision(spark):
    values = [0.0, 1.0, -0.5, 2.0, 0.5, 0.999, 1 / 255, 0.3, 100 / 255]
    df = spark.createDataFrame([(values,)], "x array<float>")
    want = (np.clip(np.array(values, np.float32) * np.float32(255), 0, 255)).astype(np.uint8).tolist()
    row = df.select(images.quantize_u8("x").alias("b"), images.quantize_array(F.col("x")).alias("a")).first()
    assert list(row["b"]) == want == list(row["a"])


def test_null_images_stay_null(spark):
    df = spark.createDataFrame([([0.5, 1.0],), (None,), ([0.0, 0.25],)], "x array<float>").coalesce(1)
    out = df.select(images.quantize_u8("x").alias("b")).select("b", images.dequantize_u8("b").alias("x")).collect()
    assert [r["b"] and list(r["b"]) for r in out] == [[127, 255], None, [0, 63]]
    assert out[1]["x"] is None and len(out[2]["x"]) == 2


def test_size_of_the_cache(normalised):
    packed = normalised.select(images.quantize_u8("image").alias("image"), F.array_repeat(F.lit(0.0).cast("float"), 6).alias("state"))
    total = packed.select(F.sum(images.row_bytes(packed))).first()[0]
    assert 30_000 <= total <= 60_000 and total == 4 * (12288 + 24)
    full = normalised.select("image")
    assert full.select(F.sum(images.row_bytes(full))).first()[0] == 4 * 4 * 12288


def test_detection(spark, normalised):
    named = normalised.withColumnRenamed("image", "observation.images.top").withColumn("state", F.array_repeat(F.lit(0.0), 6))
    assert images.detect_image_columns(named) == ["observation.images.top"]
    shaped = T.StructType([T.StructField("front", T.BinaryType(), True, {"shape": [3, 32, 32]}), T.StructField("flat", T.BinaryType(), True, {"shape": [3072]})])
    assert images.detect_image_columns(spark.createDataFrame([(b"", b"")], shaped)) == ["front"]
    small = T.StructType([T.StructField("image", T.BinaryType(), True, {"shape": [4, 4, 3]})])
    assert images.detect_image_columns(spark.createDataFrame([(b"",)], small)) == []


@pytest.mark.parametrize("values,normal", [([[0.0, 0.5, 0.2, 1.0]], True), ([[0.0, 255.0]], False), ([[0.5], [255.0]], False), ([[-3.0, 1.5]], True)])
def test_normalised(spark, values, normal):
    assert images.is_normalized(spark.createDataFrame([(v,) for v in values], "x array<float>"), "x") is normal


def test_bytes_are_not_normalised_floats(spark):
    assert images.is_normalized(spark.createDataFrame([(bytearray(4),)], "x binary"), "x") is False
    assert images.is_normalized(spark.createDataFrame([([0, 1],)], "x array<int>"), "x") is False


@pytest.mark.parametrize("h,w,c", [(4, 6, 3), (5, 2, 1), (3, 3, 3)])
def test_channel_first(spark, h, w, c):
    a = np.arange(h * w * c, dtype=np.uint8).reshape(h, w, c)
    want = a.transpose(2, 0, 1).reshape(-1).tolist()
    df = spark.createDataFrame([(bytearray(a.tobytes()), a.reshape(-1).tolist())] * 3, "b binary, a array<int>")
    for r in df.select(images.hwc_to_chw_bytes(F.col("b"), h, w, c).alias("b"), images.hwc_to_chw(F.col("a"), h, w, c).alias("a")).collect():
        assert list(r["b"]) == want == list(r["a"])


@pytest.mark.parametrize("h,w,oh,ow", [(480, 640, 64, 64), (4, 4, 8, 8), (5, 7, 3, 2)])
def test_resize(spark, h, w, oh, ow):
    a = np.random.default_rng(1).integers(0, 256, (h, w, 3), dtype=np.uint8)
    df = spark.createDataFrame([(bytearray(a.tobytes()),), (None,)], "b binary").coalesce(1)
    out = df.select(images.resize_bytes(F.col("b"), h, w, 3, oh, ow).alias("b")).collect()
    want = a[np.arange(oh) * h // oh][:, np.arange(ow) * w // ow]
    assert bytes(out[0]["b"]) == want.tobytes() and out[1]["b"] is None


def test_coerce(spark):
    a = np.arange(48, dtype=np.uint8)
    first = a.reshape(4, 4, 3).transpose(2, 0, 1).tobytes()
    cases = [
        ([4, 4, 3], first), ([3, 4, 4], a.tobytes()), ([1, 4, 4, 3], first), ([2, 4, 4, 3], bytes(48)), ([4, 3, 4], bytes(48)),
        ([8, 2, 3], bytes(48)), (None, bytes(48)),
    ]
    df = spark.createDataFrame([(i, bytearray(a.tobytes()), s) for i, (s, _) in enumerate(cases)] + [(7, None, [4, 4, 3])], "i int, b binary, shape array<int>")
    got = {r["i"]: bytes(r["x"]) for r in df.select("i", images.coerce_image(F.col("b"), F.col("shape"), 4).alias("x")).collect()}
    assert got == {**{i: w for i, (_, w) in enumerate(cases)}, 7: bytes(48)}


@pytest.mark.parametrize("size", [0, 5, 6, 18, 25, 30])
@pytest.mark.parametrize("pose", [False, True])
def test_state_widths(spark, size, pose):
    flat = [float(i + 1) for i in range(size)]
    row = spark.createDataFrame([(flat,)], "flat array<float>").select(state.split_state(F.col("flat"), pose).alias("s")).first()
    width = 13 if pose else 6
    want = flat[:6] if size >= 6 else [0.0] * width
    if pose and size >= 6:
        want = want + (flat[18:25] if size >= 25 else [0.0] * 7)
    assert row["s"] == want and len(row["s"]) == width


def test_missing_terms_are_zero(spark):
    df = spark.createDataFrame([([1.0] * 8, None), (None, [2.0] * 7), ([1.0] * 3, [2.0] * 7)], "j array<float>, p array<float>").coalesce(1)
    rows = [r["s"] for r in df.select(state.assemble_state_terms(F.col("j"), F.col("p")).alias("s")).collect()]
    assert rows == [[1.0] * 6 + [0.0] * 7, [0.0] * 6 + [2.0] * 7, [0.0] * 13]


def test_motor_order(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0, 3.0)], "id long, `b.pos` double, `a.pos` double, `c.pos` double")
    assert state.motors_to_state(df, "s").first()["s"] == [1.0, 2.0, 3.0]
    named = state.action_to_columns(state.motors_to_state(df, "action"), ["z", "a", "m"])
    assert named.columns == ["id", "z.pos", "a.pos", "m.pos"] and tuple(named.first())[1:] == (1.0, 2.0, 3.0)
    with pytest.raises(Exception, match="action has 3 values for 2 motors"):
        state.action_to_columns(state.motors_to_state(df, "action"), ["z", "a"]).collect()


def test_image_names(spark):
    df = spark.createDataFrame([(1.0, 2, 3)], "`b.pos` double, wrist long, top long")
    assert state.rename_image_columns(df).columns == ["b.pos", "observation.images.wrist", "observation.images.top"]


def test_image_stats_are_those_of_all_pixels(spark):
    rng = np.random.default_rng(4)
    pixels = rng.integers(0, 256, (40, 12), np.uint8) // 3
    rows = [(i, bytearray(p.tobytes()), [float(x) / 255 for x in p]) for i, p in enumerate(pixels)] + [(98, None, None), (99, bytearray(), [])]
    df = spark.createDataFrame(rows, "i long, cam binary, top array<float>")
    df = df.select("i", F.col("cam").alias("cam.left", metadata={"shape": [2, 2, 3]}), "top").repartition(5)
    found = {(r["feature"], r["channel"]): r for r in image_stats(df, ["cam.left", "top"], {"top": 2}).collect()}
    assert len(found) == 5
    for (name, k), r in found.items():
        x = np.sort(pixels.reshape(40, -1)[:, k :: 3 if name == "cam.left" else 2].ravel()).astype(float)
        assert (r["count"], r["min"], r["max"]) == (len(x), x[0], x[-1])
        assert (r["mean"], r["std"]) == (pytest.approx(x.mean()), pytest.approx(x.std()))
        assert [r[q] for q in ("q01", "q50", "q99")] == [x[int(np.ceil(len(x) * p / 100)) - 1] for p in (1, 50, 99)]
    assert image_stats(df.limit(0), ["cam.left"]).count() == 0
    with pytest.raises(Exception, match="do not divide"):
        image_stats(df, ["cam.left"], {"cam.left": 5}).collect()
