"""Ranks, positions and running totals over a whole table, without one big sort task.

Rows are split into classes of the ordering value: cut points come from
approximate quantiles, each cut point is a class of its own, and each open
interval between two cut points is another. The class is a function of the row's
own value, so a retried task always places a row alike. Totals of lower classes
give the offset, a window inside the class gives the rest, and a value so common
that it fills a class by itself needs no window at all.

The number of classes follows from the row count and is bounded by ``MAX_CUTS``,
which is also what bounds the totals brought to the driver.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import prod

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from epiframe.operators.chunked import join_null_safe
from epiframe.schema import VALUE_BYTES
from epiframe.storage import pin

ROWS_PER_CLASS = 1 << 20
MAX_CUTS = 10_000
#: Class of rows without an ordering value; odd like the other open ones.
NULL_CLASS = -1
#: Bytes that one partition of an arranged table should hold.
PART_BYTES = 256 << 20

#: Values assumed in a vector whose column declares no shape.
UNDECLARED_VALUES = 64


@dataclass
class Classes:
    """Cut points of an ordering value; class 2i+1 is open, class 2i is one value."""

    value: str
    cuts: list[float] = field(default_factory=list)

    def assign(self, df: DataFrame) -> DataFrame:
        if not self.cuts:
            return df.withColumn("_class", F.lit(1))
        splits = [float("-inf"), *self.cuts, float("inf")]
        slot = Bucketizer(splits=splits, inputCol=self.value, outputCol="_slot", handleInvalid="keep")
        at = F.col("_slot").cast("int")
        # NaN has a slot behind the last cut, null none: it is the class below all others, as nulls sort first
        cut = F.try_element_at(F.lit(self.cuts), F.greatest(at, F.lit(1)))
        single = (at > 0) & F.coalesce(F.col(self.value) == cut, F.lit(False))
        placed = F.coalesce(2 * at + F.when(single, 0).otherwise(1), F.lit(NULL_CLASS))
        return slot.transform(df).withColumn("_class", placed).drop("_slot")


def classes_of(df: DataFrame, value: str, rows: int, rows_per_class: int = ROWS_PER_CLASS) -> Classes:
    """Choose cut points so that an open class holds about ``rows_per_class`` rows."""
    cuts = min(rows // rows_per_class, MAX_CUTS)
    if cuts == 0:
        return Classes(value)
    probs = [(i + 1) / (cuts + 1) for i in range(cuts)]
    found = df.agg(F.percentile_approx(value, probs, max(10_000, 10 * cuts))).first()[0] or []
    return Classes(value, sorted({float(v) for v in found if v == v}))


def _offsets(df: DataFrame, total: Column) -> DataFrame:
    """One row per class with the total of all lower classes; at most 2 * MAX_CUTS + 2 rows."""
    totals = df.groupBy("_class").agg(total.alias("_total")).collect()
    rows, before = [], 0
    for row in sorted(totals, key=lambda r: r["_class"]):
        rows.append((row["_class"], before))
        before += row["_total"]
    return df.sparkSession.createDataFrame(rows, "_class int, _before long")


def _with_offset(df: DataFrame, classes: Classes, total: Column) -> DataFrame:
    if not classes.cuts:
        return df.withColumn("_before", F.lit(0).cast("long"))
    return df.join(F.broadcast(_offsets(df, total)), "_class")


def running_total(
    df: DataFrame, order: str, amount: str, out: str, rows: int, rows_per_class: int = ROWS_PER_CLASS
) -> DataFrame:
    """Exclusive running sum of the integer column ``amount`` in the order of a unique key."""
    df = df.withColumn("_order", F.col(order).cast("double"))
    classes = classes_of(df, "_order", rows, rows_per_class)
    placed = _with_offset(classes.assign(df), classes, F.sum(amount))
    before = W.partitionBy("_class").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(before), F.lit(0))
    return placed.withColumn(out, F.col("_before") + inside).drop("_class", "_before", "_order")


def rank_below(
    df: DataFrame, value: str, out: str, spread: Sequence[str], rows: int, rows_per_class: int = ROWS_PER_CLASS
) -> DataFrame:
    """Number of rows with a smaller ``value``: the minimum rank less one.

    Rows equal to a cut point take the class offset; ``spread`` scatters them so
    that a value held by many rows does not gather in one task.
    """
    df = df.withColumn("_order", F.col(value).cast("double"))
    classes = classes_of(df, "_order", rows, rows_per_class)
    placed = _with_offset(classes.assign(df), classes, F.count("*"))
    single = F.pmod("_class", F.lit(2)) == 0
    scatter = F.when(single, F.xxhash64(*spread)).otherwise(F.lit(0))
    inside = F.rank().over(W.partitionBy("_class", scatter).orderBy("_order")) - 1
    below = F.col("_before") + F.when(single, 0).otherwise(inside)
    return placed.withColumn(out, below.cast("long")).drop("_class", "_before", "_order")


def percentile_of(
    df: DataFrame, value: str, fraction: float, rows: int, rows_per_class: int = ROWS_PER_CLASS
) -> float:
    """Exact interpolated percentile of a pinned column.

    Within ``rows_per_class`` rows the built-in aggregate is used; beyond that only
    the class that holds the position is looked at.
    """
    if rows <= rows_per_class:
        return df.agg(F.percentile(value, F.lit(fraction))).first()[0]
    df = df.withColumn("_order", F.col(value).cast("double"))
    classes = classes_of(df, "_order", rows, rows_per_class)
    placed = classes.assign(df)
    totals = sorted(placed.groupBy("_class").count().collect())
    where = (rows - 1) * fraction

    def at(position: int) -> float:
        before = 0
        for cls, count in totals:
            if position < before + count:
                if cls % 2 == 0:
                    return classes.cuts[cls // 2 - 1]
                inside = placed.where(F.col("_class") == cls).select("_order").orderBy("_order")
                return inside.offset(position - before).first()[0]
            before += count
        raise IndexError(position)

    lower = at(int(where))
    upper = at(min(int(where) + 1, rows - 1))
    return lower if lower == upper else lower + (upper - lower) * (where - int(where))


def index_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: Column,
    out: str,
    rows_per_class: int = ROWS_PER_CLASS,
) -> DataFrame:
    """Zero-based position within the group, in the order of ``order``.

    ``value`` is a number that never decreases along ``order``. A table larger than
    ``rows_per_class`` is cut along it, so one group is spread over many tasks.
    """
    rows = df.count()
    if rows <= rows_per_class:
        within = W.partitionBy(*group).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(within) - 1).cast("long"))
    df = df.withColumn("_order", value.cast("double"))
    placed = classes_of(df, "_order", rows, rows_per_class).assign(df)
    lower = W.partitionBy(*group).orderBy("_class").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*group, "_class")
        .agg(F.count("*").alias("_n"))
        .select(*group, "_class", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(W.partitionBy(*group, "_class").orderBy(*order)) - 1
    numbered = join_null_safe(placed.withColumn("_inside", inside), offsets, [*group, "_class"])
    return numbered.withColumn(out, (F.col("_before") + F.col("_inside")).cast("long")).drop(
        "_class", "_before", "_inside", "_order"
    )


def dense_index(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Number the rows of a narrow table 0, 1, 2, ... in the order of a unique key of any type.

    The table is range-partitioned and sorted, and pinned with each row's partition and
    place in it. Partition sizes, one number per partition, then give the offsets.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = pin(ranged.withColumns({"_part": F.spark_partition_id(), "_place": place}))
    rows, before = [], 0
    for part, count in sorted(placed.groupBy("_part").count().collect()):
        rows.append((part, before))
        before += count
    offsets = df.sparkSession.createDataFrame(rows, "_part int, _before long")
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def row_width(schema: T.StructType) -> int:
    """Bytes of a row as its schema declares them."""
    width = 0
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType | T.BinaryType):
            value = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
            shape = (f.metadata or {}).get("shape") or [UNDECLARED_VALUES]
            width += prod(shape) * VALUE_BYTES.get(type(value), 8)
        else:
            width += 8
    return max(width, 1)


def arrange(
    df: DataFrame, position: str, total: int, order: Sequence[str], part_bytes: int = PART_BYTES
) -> DataFrame:
    """Sort a table by the known position 0 .. total - 1 of its rows, in partitions of about ``part_bytes``.

    The position says which partition a row belongs to. A sort by value would first read
    the whole table, images included, to sample its key.
    """
    width = row_width(T.StructType([f for f in df.schema.fields if f.name != position or position in order]))
    rows = max(1, part_bytes // width)
    parts = max(1, -(-total // rows))
    placed = df.withColumn("_part", F.floor(F.col(position) / F.lit(rows)).cast("int"))
    return placed.repartitionById(parts, "_part").drop("_part").sortWithinPartitions(*order)
