"""Metrics parsed from a live log."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.functions.metrics import parse_arch_metric, parse_metric, parse_step


def stream_metrics(lines: DataFrame, arch: Column | None = None, line: str = "line") -> DataFrame:
    """One row per line that holds a metric: stateless, for streams and tables alike."""
    found = parse_metric(F.col(line)) if arch is None else parse_arch_metric(F.col(line), arch)
    kept = [c for c in lines.columns if c != line]
    return (
        lines.withColumns({"_m": found, "step": parse_step(F.col(line))})
        .where(F.col("_m").isNotNull())
        .select(*kept, "_m.name", "_m.value", "step")
    )
