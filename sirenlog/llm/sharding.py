"""Contiguous shards of near equal size whose groups stay whole: the least feasible capacity, then the cuts.

Rows of one group (equal texts, say) go to one shard.  Groups are ordered by
their first row, and shards are runs of that order.  The capacity is found by
binary search, each candidate checked greedily: fill a shard until the next
group does not fit.  A group as large as the mean of what is left could only
raise every capacity, so it gets a shard of its own first, and the search runs
over the other groups and shards.

The search sees prefix sums, of which the driver holds a summary of bounded
size: the first and last group end of each of about ``DETAIL`` equal slices.  A
greedy check over known ends only is pessimistic, one that may cut anywhere
inside a slice of unknown ends is hopeful; the capacity lies between the two
answers, and slices that a cut may fall into are divided again until both agree.
The result is exact for any number of groups.

Columns only: no step leaves the JVM but the search over the summary.

Defined results: a null group is a group; a null or negative size counts as 0;
rows with null order values come first; equal rows are separate rows with slots
of their own; with fewer groups than shards some shards stay empty; an empty
table gives no rows; input columns named like a result are replaced by it.  A
text's length matters only to the digest, never to a row's width.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sirenlog.llm.common import materialize
from sirenlog.operators.numbering import numbered, part_offsets, parts_of

DETAIL = 1 << 16   # slices of a summary, about
HOT_GROUPS = 64    # groups with the most rows, whose rows take their shard from a broadcast table

Slices = list[tuple[int, int, int]]  # first end, last end, number of ends


class Ends:
    """What is known of the ends of groups on the line from 0 to ``total``."""

    def __init__(self, total: int, slices: Slices, more: set[int]):
        self.total = total
        self.points = sorted({0, total, *more, *(low for low, _, _ in slices), *(high for _, high, _ in slices)})
        self.open = sorted((low, high) for low, high, n in slices if n > 2 and high - low > 1)
        self._lows = [low for low, _ in self.open]

    def last_end(self, x: int, hopeful: bool) -> int:
        """The last end up to ``x``: the last one known, or ``x`` itself where an end may lie there."""
        if hopeful:
            i = bisect_left(self._lows, x) - 1
            if i >= 0 and x < self.open[i][1]:
                return x
        return self.points[bisect_right(self.points, x) - 1]

    def fill(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Where each shard ends, filled greedily; the last value is ``total`` when all fits."""
        ends, at = [], 0
        for _ in range(shards):
            at = self.last_end(min(at + capacity, self.total), hopeful)
            ends.append(at)
        return ends

    def least(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        """The smallest capacity from ``low`` on that fits, given that ``high`` does."""
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, shards, hopeful)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low


def search(total: int, largest: int, shards: int, summary: Callable[[int, list[tuple[int, int]]], Slices]) -> list[int]:
    """The end of every shard under the least feasible capacity.

    ``summary(step, windows)`` gives the slices of width ``step`` that hold ends
    inside the windows (inclusive ranges of the line).
    """
    low, high = max(largest, -(-total // shards)), total
    step, windows, known = max(1, total // DETAIL), [(0, total)], set()
    while True:
        ends = Ends(total, summary(step, windows), known)
        high = ends.least(low, high, shards, hopeful=False)
        low = ends.least(low, high, shards, hopeful=True)
        first, last = ends.fill(low, shards, hopeful=False), ends.fill(high, shards, hopeful=True)
        if first == last:
            return last
        unsure = [(a, b) for a, b in ends.open if any(a < y and x < b for x, y in zip(first, last))]
        windows, known = _merged(unsure, step), {*first, *ends.fill(high, shards, hopeful=False)}
        known |= {x for x in ends.points if any(a <= x <= b for a, b in zip(first, last))}
        step = max(1, step // max(2, DETAIL // len(unsure)))


def _merged(ranges: list[tuple[int, int]], gap: int) -> list[tuple[int, int]]:
    """Sorted ranges, joined where less than ``gap`` lies between them."""
    merged = []
    for a, b in ranges:
        if merged and a - merged[-1][1] <= gap:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _own_shards(largest: list, total: int, shards: int) -> list:
    """The groups, largest first, that are as large as the mean of what is left."""
    own = []
    for row in largest[:shards - 1]:  # the last shard takes what is left
        if row["__size"] * (shards - len(own)) < total:
            break
        own.append(row["__group"])
        total -= row["__size"]
    return own


def _among(groups: list) -> Column:
    """Whether a row's group is one of these (few) values, null included; never null."""
    found = F.col("__group").isin([g for g in groups if g is not None])
    return F.coalesce(found, F.lit(None in groups))


def _positions(groups: DataFrame) -> DataFrame:
    """Groups with ``__end``, the summed size up to and with each, in order of first row; stored."""
    order = [F.asc_nulls_first("__first"), F.asc_nulls_first("__group")]
    dealt = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = materialize(dealt.withColumn("__part", F.spark_partition_id()), "shard-groups")
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy("__part").agg(F.sum("__size").alias("n")).select(
        "__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))  # one row a part
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = parts.join(before, "__part").withColumn("__end", F.col("__before") + F.sum("__size").over(inside))
    return materialize(ends.select("__group", "__end"), "shard-ends")


def _summary(positions: DataFrame) -> Callable[[int, list[tuple[int, int]]], Slices]:
    def summary(step: int, windows: list[tuple[int, int]]) -> Slices:
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | F.col("__end").between(a, b)
        found = positions.filter(inside).groupBy(F.floor(F.col("__end") / step)).agg(
            F.min("__end").alias("low"), F.max("__end").alias("high"), F.count(F.lit(1)).alias("n"))
        return [(r.low, r.high, r.n) for r in found.collect()]  # bounded by DETAIL

    return summary


def assign_groups(rows: DataFrame, group: str, size: str, order: str, shards: int) -> tuple[DataFrame, list]:
    """(``__group``, ``__shard``, ``__end``) of every group, and the groups with the most bytes or rows.

    ``rows`` is read several times, so it should be a stored table.
    """
    groups = materialize(
        rows.groupBy(F.col(group).alias("__group")).agg(
            F.sum(size).alias("__size"), F.count(F.lit(1)).alias("__rows"), F.min(order).alias("__first")),
        "shard-sizes")
    tie = F.asc_nulls_first("__group")
    largest = groups.orderBy(F.desc("__size"), tie).limit(shards).collect()
    longest = groups.orderBy(F.desc("__rows"), tie).limit(HOT_GROUPS).collect()
    hot = [r["__group"] for r in longest]
    own = _own_shards(largest, groups.agg(F.sum("__size")).first()[0] or 0, shards)
    alone = groups.filter(_among(own)).select(
        "__group", _numbered_own(own).alias("__shard"), F.lit(0).cast("bigint").alias("__end"))
    rest = groups.filter(~_among(own))
    left = rest.agg(F.sum("__size"), F.max("__size"), F.count(F.lit(1))).first()
    if not left[2]:
        return alone, hot
    positions = _positions(rest)
    cuts = search(left[0], left[1], shards - len(own), _summary(positions))
    # A shard's number is the number of cuts before its groups' ends.
    cut = F.array(*[F.lit(c).cast("bigint") for c in cuts[:-1]]) if len(cuts) > 1 else F.array().cast("array<bigint>")
    shard = F.lit(len(own)) + F.size(F.filter(cut, lambda c: c < F.col("__end")))
    return alone.unionByName(positions.select("__group", shard.cast("int").alias("__shard"), "__end")), hot


def _numbered_own(own: list) -> Column:
    number = F.lit(None).cast("int")
    for i, value in enumerate(own):
        number = F.when(F.col("__group").eqNullSafe(F.lit(value)), i).otherwise(number)
    return number.cast("int")


def shard_rows(rows: DataFrame, group: str, size: str, order: str, shards: int) -> DataFrame:
    """The rows with ``shard`` (0 to ``shards`` - 1) and ``slot``, gapless from 0 in each shard.

    Slots follow the order of groups and rows.  Rows of the largest groups take
    their shard from a broadcast table of at most ``HOT_GROUPS`` rows, so no
    task meets a hot group; ``rows`` should be narrow, as all its columns are
    sorted and written twice.
    """
    rows = rows.drop("shard", "slot").withColumn(size, F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("bigint"))
    rows = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    assigned, hot = assign_groups(rows, group, size, order, shards)
    assigned = materialize(assigned, "shard-assigned")
    keyed = rows.withColumn("__group", F.col(group))
    dealt = [
        _placed(keyed.filter(_among(hot)), F.broadcast(assigned.filter(_among(hot)))),
        _placed(keyed.filter(~_among(hot)), assigned.filter(~_among(hot))),
    ]
    by, sort = ["shard"], [F.asc("__end"), F.asc_nulls_first("__group"), F.asc_nulls_first(order), F.asc("__row")]
    parts = parts_of(dealt[0].unionByName(dealt[1]), by, sort)
    slots = numbered(parts, part_offsets(parts, by), by, sort, "slot")
    return slots.withColumn("slot", F.col("slot") - 1).select(*rows.drop("__row").columns, "shard", "slot")


def _placed(keyed: DataFrame, assigned: DataFrame) -> DataFrame:
    # Groups may be null.
    return keyed.alias("r").join(assigned.alias("a"), F.expr("r.__group <=> a.__group")).select(
        "r.*", F.col("a.__shard").alias("shard"), F.col("a.__end").alias("__end"))


def document_sizes(documents: DataFrame, text: str = "text") -> DataFrame:
    """The other columns with ``size`` (UTF-8 bytes and 16), ``text_crc32`` and ``text_group``, a digest of the text.

    A null text counts as empty.  Equal texts have equal digests (SHA-256).
    """
    content = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    return documents.withColumns({
        "size": (F.octet_length(content) + 16).cast("bigint"),
        "text_crc32": F.crc32(content), "text_group": F.unhex(F.sha2(content, 256)),
    }).drop(text)


def write_shards(rows: DataFrame, folder: str) -> None:
    """Sharded rows as one folder ``shard=N`` each, in order of slots; a large shard is several files."""
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
