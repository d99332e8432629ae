"""Reading windows and converting frames into them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from epiframe.operators.windows import WINDOW_SIZE, head_truncate
from epiframe.sources.frames import read_frames
from epiframe.storage import exists, is_complete


def read_windows(spark: SparkSession, path: str, columns: Sequence[str] = ("action",)) -> DataFrame:
    """Stored windows if they are complete, else one head window per stored episode."""
    base = path.rstrip("/")
    if is_complete(spark, f"{base}/windows"):
        return spark.read.parquet(f"{base}/windows")
    if exists(spark, f"{base}/frames"):
        return head_truncate(read_frames(spark, base, schema=None), WINDOW_SIZE, columns)
    raise FileNotFoundError(f"neither complete windows nor frames under {path}")
