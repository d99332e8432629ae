"""Metric lines: golden strings, rejected names, parsing and run tables."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from epiframe.functions.metrics import format_metric, format_value, is_metric_name, parse_arch_metric, parse_metric, parse_step
from epiframe.operators import tables


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    "value,shown",
    [
        (0.73, "0.73"), (3.17e-2, "0.0317"), (1e-5, "1e-05"), (100.0, "100"), (0.0, "0"), (-0.0, "-0"), (123456789.0, "1.23457e+08"),
        (999999.5, "1e+06"), (0.1234565, "0.123456"), (1.0000005, "1"), (float("nan"), "nan"), (float("inf"), "inf"),
        (float("-inf"), "-inf"), (1e100, "1e+100"), (120.0, "120"), (5e-324, "4.94066e-324"), (-2.5, "-2.5"), (1234.565, "1234.57"),
    ],
)
def test_format_value(spark, value, shown):
    assert f"{value:.6g}" == shown
    assert one(spark, s=format_value(F.lit(value)))["s"] == shown


def test_format_value_equals_python_on_many(spark):
    rng = random.Random(3)
    values = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(4000)]
    values += [rng.randrange(-(10**7), 10**7) / 10.0 ** rng.randrange(9) for _ in range(4000)]
    values += [(2 * i + 1) * 0.5 * 10.0**-e for i in range(500000, 500400) for e in range(9)]  # ties
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shown = df.select("v", format_value(F.col("v")).alias("s")).collect()
    assert [(r["v"], r["s"]) for r in shown if r["s"] != f"{r['v']:.6g}"] == []


@pytest.mark.parametrize(
    "name,valid",
    [
        ("pc_success", True), ("pc_success_v2", True), ("été", True), ("bad name", False), ("bad-name", False), ("bad.name", False),
        ("___", False), ("", False), ("_a", True), ("a\n", False), ("a__", True),
    ],
)
def test_names(spark, name, valid):
    assert name.replace("_", "").isalnum() is valid
    assert one(spark, v=is_metric_name(F.lit(name)))["v"] is valid


def test_lines(spark):
    assert one(spark, s=format_metric(F.lit("pc_success"), F.lit(0.73)))["s"] == "pc_success=0.73"
    assert one(spark, s=format_metric(F.lit("pc_success"), F.lit(0.73), F.lit(1000)))["s"] == "pc_success=0.73  # step=1000"
    assert one(spark, s=format_metric(F.lit("pred_loss"), F.lit(0.021), F.lit(500), prefix="eval"))["s"] == "eval_pred_loss=0.021  # step=500"
    assert one(spark, s=format_metric(F.lit("a"), F.lit(1.0), F.lit(None).cast("long")))["s"] == "a=1"
    with pytest.raises(Exception, match="not a metric name"):
        one(spark, s=format_metric(F.lit("bad name"), F.lit(0.73)))


@pytest.mark.parametrize(
    "line,name,value",
    [
        ("pc_success=0.73", "pc_success", 0.73), ("recon_loss=0.0317", "recon_loss", 0.0317), ("pred_loss=0.0214", "pred_loss", 0.0214),
        ("val_loss=1e-5", "val_loss", 1e-5), ("pc_success=0.73  # step=1000", "pc_success", 0.73), ("loss: 0.5", "loss", 0.5),
        ("INFO epoch done", None, None), ("x=0.5.", "x", None), ("step 100 loss=0.5", "step", 100.0), ("x=1e400", "x", float("inf")),
        ("perte_é=0.5", "perte_é", 0.5), ("x = 0.5", "x", 0.5), ("x=nan", None, None), ("", None, None),
    ],
)
def test_parse(spark, line, name, value):
    found = one(spark, m=parse_metric(F.lit(line)))["m"]
    assert (found is None) if value is None else (found["name"], found["value"]) == (name, value)


def test_parse_by_target(spark):
    def parsed(line, arch):
        m = one(spark, m=parse_arch_metric(F.lit(line), F.lit(arch)))["m"]
        return m and (m["name"], m["value"])

    assert parsed("step 3: eval/pc_success=0.75", "act") == ("pc_success", 0.75)
    assert parsed("pc_success=0.75", "act") is None
    assert parsed("loss=1 recon_loss=0.042", "dreamerv3") == ("recon_loss", 0.042)
    assert parsed("step=100", "dreamerv3") is None
    assert parsed("pred_loss: 0.018", "le_world_model") == ("pred_loss", 0.018)
    assert parsed("pred_loss: 0.018", "smolvla") is None


def test_step_round_trip(spark):
    line = format_metric(F.lit("a"), F.lit(0.5), F.lit(77))
    assert one(spark, s=parse_step(line))["s"] == 77
    assert one(spark, s=parse_step(F.lit("a=0.5")))["s"] is None


def test_runs(spark):
    runs = spark.createDataFrame([(1, "act"), (2, "dreamerv3"), (3, "le_world_model")], "run_id long, target_arch string")
    metrics = spark.createDataFrame([(1, 1, "pc_success", 0.2), (1, 2, "pc_success", 0.9), (1, 3, "pc_success", 0.4), (2, 1, "recon_loss", 0.5), (2, 2, "recon_loss", 0.3), (2, 3, "recon_loss", 0.3)], "run_id long, line_no long, name string, value double")
    noisy = metrics.unionByName(spark.createDataFrame([(1, 9, "step", 100.0)], metrics.schema))
    named = tables.attach_primary_metric(runs)
    assert {r["run_id"]: (r["metric"], r["direction"]) for r in named.collect()} == {1: ("pc_success", "max"), 2: ("recon_loss", "min"), 3: ("pred_loss", "min")}
    assert {r["run_id"]: r["value"] for r in tables.last_metric(runs, noisy).collect()} == {1: 0.4, 2: 0.3, 3: 0.0}
    assert {r["run_id"]: r["best"] for r in tables.best_metric(named, metrics).collect()} == {1: 0.9, 2: 0.3, 3: None}
    with pytest.raises(Exception, match="unknown target: none"):
        tables.attach_primary_metric(runs.withColumn("target_arch", F.lit("none"))).collect()


def test_thin_log(spark):
    steps = spark.range(1, 124).selectExpr("id AS step", "1 AS run_id")
    other = spark.range(1, 74).selectExpr("id AS step", "2 AS run_id")
    assert sorted(r["step"] for r in tables.thin_log(steps.union(other), 50).where("run_id = 2").collect()) == [1, 50, 73]
    assert sorted(r["step"] for r in tables.thin_log(steps, 50).collect()) == [1, 50, 100, 123]
    assert sorted(r["step"] for r in tables.thin_log(steps, 50, total=60).collect()) == [1, 50, 60, 100]


def test_repeated_metrics_are_dropped(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "a"), (1, 6, "a")], "run_id long, step long, name string")
    assert tables.distinct_metrics(df).count() == 2
    again = spark.createDataFrame([(1, 5, "a", 0.5, 3), (1, 5, "a", 0.9, 1), (1, 5, "a", 0.1, 2)], "run_id long, step long, name string, value double, line_no long")
    assert [(r["value"], r["line_no"]) for r in tables.distinct_metrics(again).collect()] == [(0.5, 3)]
    assert [r["value"] for r in tables.distinct_metrics(again.drop("line_no")).collect()] == [0.9]
