"""Tables that a job writes once and reads again, and small shared helpers."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epiframe.operators.chunked import join_null_safe
from epiframe.storage import scratch_dir


def store(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lowest_hashes(df: DataFrame, groups: list[str], hashed: Column, n: int) -> DataFrame:
    """At most ``n`` rows of every group, those with the lowest hash.

    Groups are counted first and rows whose hash cannot be among the lowest are left where they are,
    so a large group does not meet in one task.
    """
    top = 1 << 30
    placed = df.withColumns({"_h": hashed, "_u": F.pmod(hashed, F.lit(top))})
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_all"))
    low = join_null_safe(placed, sizes, groups, small=True).filter(F.col("_u") * F.col("_all") < (1.3 * n + 300) * top)
    order = Window.partitionBy(*groups).orderBy("_u", "_h")
    return low.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).drop("_h", "_u", "_r", "_all")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Documents that travel to a Python worker at once; more would stand in the memory of both sides.
ROWS_AT_ONCE = 1000


def few_at_once(docs: DataFrame) -> DataFrame:
    """``docs``, with the session sending rows to Python in batches of ``ROWS_AT_ONCE`` from now on."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    return docs


def texts(docs: DataFrame) -> DataFrame:
    """Only what text operators read, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
