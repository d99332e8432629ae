"""Driving a stream into a Parquet table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None) -> DataFrame:
    """New Parquet files under ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream to a Parquet table; each input row is written exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process all available input, wait for the end and read the table back."""
    query = append_to(stream, path, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def stream_ingest(spark: SparkSession, source: str, path: str, checkpoint: str, schema: T.StructType, glob: str | None = None):
    """Append live step files to the frame table; returns a started query."""
    return append_to(stream_parquet(spark, source, schema, glob), path, checkpoint).trigger(availableNow=True).start()
