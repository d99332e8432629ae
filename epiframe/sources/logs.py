"""Training logs as tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epiframe.functions.metrics import format_metric


def read_train_log(spark: SparkSession, path: str | list[str], numbered: bool = True) -> DataFrame:
    """One row per log line: file, block_start, line, and its number in the file.

    Files are read split by split. A line's place is (split, place within the split);
    the splits' line counts turn that into a line number, so a huge log is neither
    read nor numbered in one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("_read"),
        F.col("value").alias("line"),
    )
    if not numbered:
        return lines.withColumnRenamed("_read", "read_order")
    inside = F.row_number().over(W.partitionBy("file", "block_start").orderBy("_read"))
    lower = W.partitionBy("file").orderBy("block_start").rowsBetween(W.unboundedPreceding, -1)
    counts = (
        lines.groupBy("file", "block_start")
        .agg(F.count("*").alias("_n"))
        .select("file", "block_start", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before"))
    )
    numbered_lines = lines.withColumn("_inside", inside).join(counts, ["file", "block_start"])
    return numbered_lines.select("file", (F.col("_before") + F.col("_inside")).cast("long").alias("line_no"), "line")


def write_metric_lines(
    df: DataFrame, path: str, name: Column, value: Column, step: Column | None = None, prefix: str = "",
    mode: str = "errorifexists",
) -> None:
    """Write one ``name=value  # step=n`` line per row."""
    df.select(format_metric(name, value, step, prefix).alias("line")).write.mode(mode).text(path)


def stream_train_log(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The lines of the log files that appear under ``path``, as a stream."""
    reader = spark.readStream.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
