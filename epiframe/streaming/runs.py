"""A table of runs that is kept up to date while logs grow."""

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.operators.tables import attach_primary_metric
from epiframe.storage import publish, published

POINTER = "CURRENT"


def _summary(rows: DataFrame, run: str) -> DataFrame:
    """Rows (run, name, last, lo, hi, n) of the same run and metric become one."""
    return rows.groupBy(run, "name").agg(F.max("last").alias("last"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))


def update_runs(
    batch: DataFrame, batch_id: int, path: str, run: str = "run_id", order: str | Sequence[str] = "line_no", stream: str = "metrics"
) -> bool:
    """Merge a batch of metrics (run, name, value, order) into the run table at ``path``; False if it was merged before.

    The table has a row per run and metric. It is written beside the published version, and one pointer, replaced in one step, names
    the version and the last batch of every ``stream`` that is in it. So a batch that is delivered again after a
    crash, before or after the pointer moved, counts once, and readers of the old version finish. One writer at a time.
    Rows without a run, a name or a value do not count.
    """
    spark = batch.sparkSession
    base = path.rstrip("/")
    state = _state(spark, base)
    if batch_id <= state["batches"].get(stream, -1):
        return False
    keys = [order] if isinstance(order, str) else list(order)
    good = batch.where(F.col(run).isNotNull() & F.col("name").isNotNull() & F.col("value").isNotNull())
    # ties in the order fall to the larger value
    last = F.struct(*keys, "value").alias("last")
    rows = good.select(run, "name", last, F.col("value").alias("lo"), F.col("value").alias("hi"), F.lit(1).cast("long").alias("n"))
    new = _summary(rows, run)
    version = f"{base}/v-{uuid.uuid4().hex}"
    merged = new if state["version"] is None else _summary(spark.read.parquet(state["version"]).unionByName(new), run)
    merged.write.parquet(version)
    publish(spark, f"{base}/{POINTER}", json.dumps({"version": version, "batches": {**state["batches"], stream: batch_id}}))
    return True


def _state(spark: SparkSession, base: str) -> dict:
    text = published(spark, f"{base}/{POINTER}")
    return json.loads(text) if text else {"version": None, "batches": {}}


def stream_runs(
    metrics: DataFrame, path: str, checkpoint: str, run: str = "run_id", order: str | Sequence[str] = "line_no", stream: str = "metrics"
):
    """A writer that keeps the run table at ``path``: set a trigger and start it.

    ``stream`` names the checkpoint in the table's ledger: a stream that starts over with a new checkpoint needs a new
    name, or its first batches are taken for old ones.
    """
    return metrics.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: update_runs(batch, batch_id, path, run, order, stream) and None
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame | None:
    """The published run table: run, name, last, lo, hi, n; None before the first batch."""
    version = _state(spark, path.rstrip("/"))["version"]
    return None if version is None else spark.read.parquet(version)


def run_report(runs: DataFrame, table: DataFrame | None, run: str = "run_id", arch: str = "target_arch") -> DataFrame:
    """``last_metric`` and ``best_metric`` of every run from the run table.

    Adds its primary metric, ``value`` (the last one, 0 without any), ``best`` (null without any) and ``n_values``.
    """
    wanted = attach_primary_metric(runs, arch)
    if table is None:
        nothing = {"value": F.lit(0.0), "best": F.lit(None).cast("double"), "n_values": F.lit(0).cast("long")}
        return wanted.withColumns(nothing).select(*runs.columns, "metric", *nothing)
    found = wanted.join(table.withColumnRenamed("name", "metric"), [run, "metric"], "left")
    best = F.when(F.col("direction") == "max", F.col("hi")).otherwise(F.col("lo"))
    columns = {"value": F.coalesce("last.value", F.lit(0.0)), "best": best, "n_values": F.coalesce("n", F.lit(0).cast("long"))}
    return found.withColumns(columns).select(*runs.columns, "metric", *columns)
