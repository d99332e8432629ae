"""Text form of training metrics: formatting and parsing as column expressions."""

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the metric line format. Letters and digits of any script count as
# word characters, and (?U) makes all Unicode spaces count as spaces.
WORD = r"[\p{L}\p{N}_]"
GAP = r"[=:\s\x1c-\x1f]"
NUMBER = r"[0-9.eE+-]"
NAME_PATTERN = rf"\A(?=_*[\p{{L}}\p{{N}}]){WORD}+\z"
STEP_PATTERN = r"#\s*step=(\d+)"
# A match starts at the start of a word and never gives back a character it took, so
# neither the lookbehind nor the possessive quantifiers change what is found.
LINE_PATTERN = rf"(?U)(?<!{WORD})({WORD}++){GAP}++({NUMBER}+)"
VALUE_AFTER = rf"(?U){GAP}++({NUMBER}+)"

# Primary metric of each training target and the text its log shows.
# (target, metric, name in the log, better direction)
PRIMARY_METRICS = [
    ("smolvla", "pc_success", "eval/pc_success", "max"),
    ("act", "pc_success", "eval/pc_success", "max"),
    ("diffusion", "pc_success", "eval/pc_success", "max"),
    ("dreamerv3", "recon_loss", "recon_loss", "min"),
    ("le_world_model", "pred_loss", "pred_loss", "min"),
]


#: Below this a double may not hold six digits.
TINY = 1e-300


@F.arrow_udf(T.StringType())
def _exact_general(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else format(v, ".6g") for v in values.to_pylist()], pa.string())


def format_value(value: Column, exact: bool = True) -> Column:
    """Six significant digits without trailing zeros, as C's ``%.6g``.

    The JVM rounds the shortest decimal form of a double. That differs from C only
    where the seventh and last digit is a 5, and for doubles too small to have six exact
    digits, so only those values are sent to Python.
    """
    padded = F.format_string("%.6g", value)
    short = F.regexp_replace(padded, r"(\.\d*?)0+(e|$)", "$1$2")
    short = F.regexp_replace(short, r"\.(e|$)", "$1")
    text = (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .otherwise(short)
    )
    if not exact:
        return text
    mantissa = F.regexp_replace(F.regexp_replace(value.cast("string"), r"E.*$", ""), r"[-.]", "")
    digits = F.regexp_replace(mantissa, r"^0+|0+$", "")
    tie = (F.length(digits) == 7) & digits.endswith("5")
    tiny = (F.abs(value) < TINY) & (value != 0)
    return F.coalesce(_exact_general(F.when(tie | tiny, value)), text)


def is_metric_name(name: Column) -> Column:
    """At least one letter or digit, and nothing but letters, digits and underscores."""
    return name.rlike(NAME_PATTERN)


def format_metric(
    name: Column, value: Column, step: Column | None = None, prefix: str = "", exact: bool = True
) -> Column:
    """One ``name=value`` line, with the step as a trailing comment when there is one."""
    full = F.concat(F.lit(f"{prefix}_"), name) if prefix else name
    line = F.concat(full, F.lit("="), format_value(value, exact))
    if step is not None:
        comment = F.concat(F.lit("  # step="), step.cast("string"))
        line = F.concat(line, F.coalesce(comment, F.lit("")))
    refused = F.raise_error(F.concat(F.lit("not a metric name: "), full)).cast("string")
    return F.when(is_metric_name(full), line).otherwise(refused)


def parse_metric(line: Column) -> Column:
    """First ``name=value`` of a line as struct(name, value); null unless value is a number."""
    name = F.regexp_extract(line, LINE_PATTERN, 1)
    value = F.regexp_extract(line, LINE_PATTERN, 2).try_cast("double")
    return F.when(value.isNotNull(), F.struct(name.alias("name"), value.alias("value")))


def parse_arch_metric(line: Column, arch: Column) -> Column:
    """The primary metric of ``arch`` in a line as struct(name, value), else null."""
    value = F.lit(None).cast("string")
    name = F.lit(None).cast("string")
    for shown in dict.fromkeys(m[2] for m in PRIMARY_METRICS):
        archs = [m[0] for m in PRIMARY_METRICS if m[2] == shown]
        metric = next(m[1] for m in PRIMARY_METRICS if m[2] == shown)
        value = F.when(arch.isin(archs), F.regexp_extract(line, shown + VALUE_AFTER, 1)).otherwise(value)
        name = F.when(arch.isin(archs), F.lit(metric)).otherwise(name)
    number = value.try_cast("double")
    return F.when(number.isNotNull(), F.struct(name.alias("name"), number.alias("value")))


def parse_step(line: Column) -> Column:
    """The step written behind a metric, or null."""
    return F.regexp_extract(line, STEP_PATTERN, 1).try_cast("long")
