"""The given tables seen as frames, step logs, images, training logs and runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.operators.control import interval_micros
from epiframe.operators.ordered import index_in_group


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def frames(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Every user's events in time order are an episode."""
    events = table(spark, sf, "events").drop("props").withColumnRenamed("user_id", "episode_index")
    micros = interval_micros(F.col("ts"), F.expr("TIMESTAMP_NTZ'1970-01-01'"))
    indexed = index_in_group(events, ["episode_index"], [F.col("ts"), F.col("event_id")], micros, "frame_index", **options)
    length = F.length("event_type").cast("double")
    return indexed.withColumns({"action": F.array("value", length), "state": F.array(length, F.col("value"))})


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Every user is a stream of environment steps; errors terminate, purchases truncate."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("stream_id"),
        F.col("event_id").alias("seq"),
        F.array(F.lit(-1.0)).alias("reset_obs"),
        F.array("value").alias("next_obs"),
        F.array(F.length("event_type").cast("double")).alias("action"),
        F.col("value").alias("reward"),
        (F.col("event_type") == "error").alias("terminated"),
        (F.col("event_type") == "purchase").alias("truncated"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is a line of its user's training log."""
    line = F.concat(F.col("event_type"), F.lit("="), F.col("value").cast("string"), F.lit("  # step="), F.col("event_id").cast("string"))
    return table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("line_no"), line.alias("line"))


ARCHS = ["smolvla", "act", "diffusion", "dreamerv3", "le_world_model"]


def arch_of(run) -> F.Column:
    return F.element_at(F.lit(ARCHS), (F.pmod(run, F.lit(len(ARCHS))) + 1).cast("int"))


def arch_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines in which clicks, views and errors report the three primary metrics."""
    kind = F.col("event_type")
    name = F.when(kind == "click", "eval/pc_success").when(kind == "view", "recon_loss").when(kind == "error", "pred_loss")
    line = F.concat(F.lit("step "), F.col("event_id").cast("string"), F.lit(": "), F.coalesce(name, kind), F.lit("="), F.col("value").cast("string"))
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("line_no"), arch_of(F.col("user_id")).alias("target_arch"), line.alias("line")
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer is a training run."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"), arch_of(F.col("c_custkey")).alias("target_arch"))


def images(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding, three times over, is an 8 x 8 image with 3 channels."""
    tripled = F.concat("embedding", "embedding", "embedding")
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_index"), "label", tripled.alias("image"))


def pixels(spark: SparkSession, sf: str):
    """The 64 values of a vector as bytes: the magnitude in hundredths."""
    code = F.transform("embedding", lambda x: F.lpad(F.hex(F.floor(F.abs(x.cast("double")) * 100).cast("long")), 2, "0"))
    return F.unhex(F.array_join(code, ""))
