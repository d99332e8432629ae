"""Ranks, totals and percentiles by class against a plain sort."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiframe.operators import sampling, tables, windows
from epiframe.operators.ordered import classes_of, dense_index, index_in_group, percentile_of, rank_below, row_width, running_total


def values(n, seed):
    """A third of all values are the same one."""
    rng = random.Random(seed)
    return [0.25 if rng.random() < 1 / 3 else rng.random() for _ in range(n)]


@pytest.fixture
def table(spark):
    def build(vals):
        return spark.createDataFrame(list(enumerate(vals)), "id long, v double").repartition(6)

    return build


@pytest.mark.parametrize("per_class", [3, 25, 10_000])
def test_rank_with_ties(table, per_class):
    vals = values(300, 1)
    got = rank_below(table(vals), "v", "below", ["id"], len(vals), per_class)
    assert {r["id"]: r["below"] for r in got.collect()} == {i: sum(w < v for w in vals) for i, v in enumerate(vals)}


def test_a_common_value_gets_a_class_of_its_own(table):
    df = table(values(300, 1)).withColumn("_order", F.col("v"))
    classes = classes_of(df, "_order", 300, 25)
    assert 0.25 in classes.cuts
    open_classes = classes.assign(df).where("_class % 2 = 1")
    assert open_classes.groupBy("_class").count().agg(F.max("count")).first()[0] <= 50


@pytest.mark.parametrize("per_class", [3, 25, 10_000])
@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.8, 0.99, 1.0])
def test_percentile(table, per_class, fraction):
    vals = values(200, 2)
    assert percentile_of(table(vals), "v", fraction, len(vals), per_class) == pytest.approx(float(np.quantile(vals, fraction)), abs=1e-12)


@pytest.mark.parametrize("per_class", [4, 10_000])
def test_running_total(table, per_class):
    df = table([0.0] * 100).withColumn("n", F.col("id") % 7)
    got = {r["id"]: r["before"] for r in running_total(df, "id", "n", "before", 100, per_class).collect()}
    assert got == {i: sum(j % 7 for j in range(i)) for i in range(100)}


@pytest.mark.parametrize("per_class", [5, 10_000])
def test_index_in_group_with_one_hot_group(spark, per_class):
    rng = random.Random(3)
    rows = [(0 if i % 3 else rng.randrange(1, 9), rng.randrange(1000), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, t long, id long").repartition(4)
    got = index_in_group(df, ["g"], [F.col("t"), F.col("id")], F.col("t"), "i", per_class)
    want = {}
    for g in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            want[r[2]] = i
    assert {r["id"]: r["i"] for r in got.collect()} == want


@pytest.fixture
def some_windows(make_frames):
    return windows.sliding_windows(make_frames({e: [[e, i] for i in range(8 * e + 10)] for e in (5, 1, 9, 2)}))


def test_window_numbers_are_dense(some_windows):
    for some in (some_windows, some_windows.where("start >= 16"), some_windows.where("start % 16 = 8")):
        rows = sampling.number_windows(some).orderBy("episode_index", "start").collect()
        assert [r["window_id"] for r in rows] == list(range(len(rows)))
        assert sampling.sample_windows(some, 100).count() == 100


def test_batches_keep_the_last_partial_one(some_windows):
    n = some_windows.count()
    rows = sampling.epoch_batches(some_windows, 4, epochs=3).collect()
    assert len(rows) == 3 * n
    for epoch in range(3):
        mine = [r for r in rows if r["epoch"] == epoch]
        assert sorted((r["batch_id"], r["slot"]) for r in mine) == [(i // 4, i % 4) for i in range(n)]
        assert len({(r["episode_index"], r["start"]) for r in mine}) == n
    orders = [sorted(((r["batch_id"], r["slot"]), r["episode_index"], r["start"]) for r in rows if r["epoch"] == e) for e in range(3)]
    assert orders[0] != orders[1] != orders[2]


def test_sampling_does_not_depend_on_partitioning(some_windows):
    seen = []
    for parts in (1, 4, 17):
        w = some_windows.repartition(parts)
        seen.append(
            (
                sorted(map(tuple, sampling.epoch_batches(w, 4, epochs=2).collect())),
                sorted((r["draw"], r["window_id"]) for r in sampling.sample_windows(w, 50).collect()),
            )
        )
    assert seen[0] == seen[1] == seen[2]


def test_draws_are_with_replacement_and_cover(some_windows):
    n = some_windows.count()
    drawn = [r["window_id"] for r in sampling.sample_windows(some_windows, 40 * n).collect()]
    assert len(drawn) == 40 * n and set(drawn) == set(range(n))


def test_unshuffled_batches_follow_stored_order(some_windows):
    rows = sampling.epoch_batches(some_windows, 4, shuffle=False).orderBy("batch_id", "slot").collect()
    keys = [(r["episode_index"], r["start"]) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_budget_names_the_first_sample_over(spark, chunk):
    df = spark.range(20).select(F.col("id").alias("row_index"), F.array_repeat(F.lit(1.0).cast("float"), (F.col("id") + 1).cast("int")).alias("x"))
    row = tables.size_budget(df, max_gb=1e-7, chunk=chunk, rows_per_class=2).first()
    sums = np.cumsum([4 * (i + 1) for i in range(20)])
    at = int(np.argmax(sums > 100))
    assert (row["n_rows"], row["total_bytes"], row["over_budget"]) == (20, int(sums[-1]), True)
    assert (row["first_over_sample"], row["bytes_at_sample"]) == (at + 1, int(sums[at]))


def test_budget_is_exceeded_only_beyond_the_limit(spark):
    df = spark.range(4).select(F.col("id").alias("row_index"), F.array(F.lit(1.0).cast("float")).alias("x"))
    assert tables.size_budget(df, max_gb=16e-9).first()["over_budget"] is False
    assert tables.check_budget(df, max_gb=16e-9) == 16
    with pytest.raises(MemoryError, match="sample 4 of 4"):
        tables.check_budget(df, max_gb=15e-9)


def test_order_is_restored_over_many_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_index").repartition(13)
    back = sampling.restore_order(df, part_bytes=8 * 64)
    assert back.rdd.getNumPartitions() == 16
    assert [r[0] for r in back.collect()] == list(range(1000))
    assert sampling.restore_order(df.limit(0)).count() == 0


def test_select_rows(spark):
    df = spark.range(10).select(F.col("id").alias("row_index"), (F.col("id") * 2).alias("x"))
    assert [r["x"] for r in tables.select_rows(df, [4, 0, 4, 2]).collect()] == [8, 0, 8, 4]
    assert tables.select_rows(df, []).count() == 0
    for unknown in (10, -1):
        with pytest.raises(Exception, match="no row has"):
            tables.select_rows(df, [0, unknown]).collect()
    assert [r["x"] for r in tables.select_rows(df, None).collect()] == [2 * i for i in range(10)]


def test_renumbering_is_dense_over_sources(spark):
    rows = [("b", 7, 0), ("a", 3, 0), ("a", 9, 0), ("a", 3, 1), ("b", 1, 0)]
    df = spark.createDataFrame(rows, "source string, episode_index long, frame_index long")
    got = {(r["source"], r["episode_index"]): r["merged_index"] for r in tables.renumber_episodes(df).collect()}
    assert got == {("a", 3): 0, ("a", 9): 1, ("b", 1): 2, ("b", 7): 3}
    assert tables.renumber_episodes(df).count() == 5


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_dense_index_over_any_type(spark, parts):
    rng = random.Random(parts)
    rows = list({(rng.choice("abc"), rng.randrange(10**12)) for _ in range(300)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dense_index(spark.createDataFrame(rows, "k string, n long").repartition(parts), ["k", "n"], "i").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(r["k"], r["n"]) for r in sorted(got, key=lambda r: r["i"])] == sorted(rows)
    assert sorted(r["i"] for r in got) == list(range(len(rows)))


@pytest.mark.parametrize("values", [[5, 10**11, 7], [None, -3, 0, None, 2], list(range(0, 10**6, 1999)) + [4] * 60, list(range(100)), []])
def test_order_of_any_index(spark, values):
    rows = spark.createDataFrame([(v, str(v)) for v in values], "row_index long, x string").repartition(3)
    back = sampling.restore_order(rows, part_bytes=20 * row_width(rows.schema))
    assert [r["x"] for r in back.collect()] == [str(v) for v in sorted(values, key=lambda v: (v is not None, v or 0))]
    assert back.rdd.getNumPartitions() <= 2 * len(values) // 20 + 8
