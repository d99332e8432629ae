"""Rows picked by index from the files that hold them."""

import pytest
from pyspark.sql import functions as F

from epiframe.sources import indexed
from epiframe.sources.indexed import add_ranges, read_indexed, write_indexed


@pytest.fixture
def hundred(spark, tmp_path):
    """A table of a hundred files of ten rows, in no order."""
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.col("id").alias("row_index"), (F.col("id") * 3).alias("value")).repartition(7)
    write_indexed(rows, path, part_bytes=160)
    assert len(spark.read.parquet(f"{path}/rows").inputFiles()) == 100
    return path


def picked(spark, path, indices, monkeypatch):
    """The rows, and the files that were opened for them."""
    opened = []
    select = indexed.select_rows
    monkeypatch.setattr(indexed, "select_rows", lambda df, *a: opened.append(df.inputFiles()) or select(df, *a))
    rows = [(r["row_index"], r["value"]) for r in read_indexed(spark, path, indices).collect()]
    return rows, opened[0]


def test_three_rows_open_three_files(spark, hundred, monkeypatch):
    rows, files = picked(spark, hundred, [905, 3, 451, 3], monkeypatch)
    assert rows == [(905, 2715), (3, 9), (451, 1353), (3, 9)] and len(files) == 3


def test_a_table_of_indices_opens_its_files(spark, hundred, monkeypatch):
    listed = spark.createDataFrame([(0, 17), (1, 12), (2, 999)], "pos long, row_index long")
    rows, files = picked(spark, hundred, listed, monkeypatch)
    assert rows == [(17, 51), (12, 36), (999, 2997)] and len(files) == 2
    everything = spark.range(1000).selectExpr("id AS pos", "id AS row_index")
    rows, files = picked(spark, hundred, everything, monkeypatch)
    assert rows == [(i, 3 * i) for i in range(1000)] and len(files) == 100


def test_rows_between_ranges_are_an_error(spark, hundred, monkeypatch):
    with pytest.raises(LookupError, match="1000"):
        read_indexed(spark, hundred, [3, 1000])
    with pytest.raises(LookupError):
        read_indexed(spark, hundred, [-1])
    assert read_indexed(spark, hundred, []).count() == 0


def test_appended_files_are_found_with_and_without_ranges(spark, hundred, monkeypatch):
    more = spark.createDataFrame([(5000, 1), (-4, 2), (None, 3)], "row_index long, value long").coalesce(1)
    more.write.mode("append").parquet(f"{hundred}/rows")
    rows, files = picked(spark, hundred, [5000, 20], monkeypatch)
    assert rows == [(5000, 1), (20, 60)] and len(files) == 2
    monkeypatch.undo()
    add_ranges(spark, hundred)
    add_ranges(spark, hundred)
    rows, files = picked(spark, hundred, [-4, 999], monkeypatch)
    # the new file spans all the others
    assert rows == [(-4, 2), (999, 2997)] and len(files) == 2
    monkeypatch.undo()
    write_indexed(spark.range(6000, 6003).selectExpr("id AS row_index", "id AS value"), hundred, mode="append")
    assert [r["value"] for r in read_indexed(spark, hundred, [6002, 5000]).collect()] == [6002, 1]


def test_an_empty_table_has_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_indexed(spark.createDataFrame([], "row_index long, value long"), path)
    assert read_indexed(spark, path, []).count() == 0
    with pytest.raises(LookupError):
        read_indexed(spark, path, [0])
