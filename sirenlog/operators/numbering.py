"""Row numbers within groups of any size.

Rows are range-partitioned by group and order and written once with the number
of their partition; a group's rows in earlier partitions are counted and added
to the rank inside the partition.  A hot group is spread over as many tasks as
its size asks for, and no task ranks more than its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sirenlog.session import stored


def parts_of(rows: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows, stored in order, with ``part``; groups and order must tell all rows apart."""
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    return stored(dealt.withColumn("part", F.spark_partition_id()), "numbered")


def part_offsets(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group and part: ``before``, the group's rows in earlier parts, and ``total``, all of them."""
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n")).select(
        *group, "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(*group)).alias("total"),
    )


def numbered(parts: DataFrame, offsets: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The rows whose parts ``offsets`` still holds, with their 1-based number ``name`` in the group."""
    inside = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))
    return parts.join(offsets, [*group, "part"]).withColumn(name, (F.col("before") + inside).cast("bigint"))
