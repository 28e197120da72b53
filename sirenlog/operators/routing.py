"""First-seen detection and routing.

A message id is marked by the earliest message that carries it and gets as far
as the mark; later ones are duplicates.  A window over the id would send every
copy of one hot id to a single task, so both forms here aggregate first: at
most one row per id leaves each map task.

``first_deliveries``  the winning rows themselves, in one shuffle
``route_events``      every message with its final route; winners are matched
                      back by log position, which is unique and so never skewed
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlog.operators.parsing import DUPLICATE, VERDICTS, reaches_mark

CONSUMER_GROUP = "incident-events-projection-group"  # fixed value

# Offsets are below 2^63, so partition * 2^63 + offset orders like the pair; a
# decimal keeps the aggregation hash-based, which a struct would not.  The
# topic's hash tells equal positions of different topics apart.
_OFFSETS_PER_PARTITION = "9223372036854775808"
_TOPICS = 100_000_000


def position() -> Column:
    """(partition, offset, topic) as one number, unique in a log of several topics."""
    place = (
        F.col("partition").cast("decimal(10,0)") * F.lit(_OFFSETS_PER_PARTITION).cast("decimal(19,0)")
        + F.col("offset").cast("decimal(19,0)")
    ).cast("decimal(29,0)")
    topic = F.pmod(F.xxhash64("topic"), F.lit(_TOPICS)).cast("decimal(8,0)")
    return (place * F.lit(_TOPICS).cast("decimal(9,0)")).cast("decimal(37,0)") + topic


def first_positions(parsed: DataFrame) -> DataFrame:
    """Per marked id: the offset and position of its first message and how many carried it."""
    return (
        parsed.filter(reaches_mark())
        .groupBy(F.col("event_id").alias("message_id"))
        .agg(F.min(position()).alias("first_position"), F.count(F.lit(1)).alias("deliveries"))
    )


def offset_of(position: Column) -> Column:
    """The offset in a position."""
    place = F.floor(position / F.lit(_TOPICS))
    return (place % F.lit(_OFFSETS_PER_PARTITION).cast("decimal(19,0)")).cast("bigint")


def unseen(first: DataFrame, ledger: DataFrame | None, id_column: str) -> DataFrame:
    """Drop the ids that ``ledger`` holds for this consumer group."""
    if ledger is None:
        return first
    known = ledger.filter(F.col("consumer_group") == CONSUMER_GROUP).select(F.col("message_id").alias(id_column))
    return first.join(known, id_column, "left_anti")


def first_deliveries(
    parsed: DataFrame, columns: Sequence[str], ledger: DataFrame | None = None
) -> DataFrame:
    """The first message of each unseen id: ``event_id``, ``verdict`` and ``columns``."""
    kept = ["verdict", *[c for c in columns if c not in ("event_id", "verdict")]]
    winners = (
        parsed.filter(reaches_mark())
        .groupBy("event_id")
        .agg(F.min_by(F.struct(*kept), position()).alias("first"))
    )
    return unseen(winners, ledger, "event_id").select("event_id", "first.*")


def route_events(parsed: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """All messages with ``route``: the verdict, or ``duplicate``.

    ``parsed`` is read twice, so it should be a stored table.
    """
    winners = unseen(first_positions(parsed), ledger, "message_id").select(
        F.col("first_position").alias("position"), F.lit(True).alias("is_first")
    )
    return (
        parsed.withColumn("position", position())
        .join(winners, "position", "left")
        .withColumn(
            "route",
            F.when(reaches_mark() & F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("verdict")),
        )
        .drop("is_first", "position", "verdict")
    )


def route_counts(parsed: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Messages per route in one pass: an id's first verdict counts once, the rest of it as duplicates.

    The first message's verdict travels as the last digit of the smallest position.
    """
    code = F.array_position(F.array(*map(F.lit, VERDICTS)), F.col("verdict")).cast("decimal(1,0)")
    ranked = (position().cast("decimal(37,0)") * 10 + code).cast("decimal(38,0)")
    marked = reaches_mark()
    groups = parsed.groupBy(
        F.when(marked, F.col("event_id")).alias("message_id"), F.when(~marked, F.col("verdict")).alias("dead")
    ).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(marked, ranked)).alias("first"))
    if ledger is None:
        groups = groups.withColumn("known", F.lit(False))
    else:
        known = ledger.filter(F.col("consumer_group") == CONSUMER_GROUP).select("message_id").distinct()
        groups = groups.join(known.withColumn("known", F.lit(True)), "message_id", "left")
    verdict = F.element_at(F.array(*map(F.lit, VERDICTS)), (F.col("first") % 10).cast("int"))
    fresh = F.when(F.col("dead").isNotNull(), F.col("n")).when(F.coalesce("known", F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    return (
        groups.select(F.inline(F.array(
            F.struct(F.coalesce("dead", verdict).alias("route"), fresh.cast("bigint").alias("n")),
            F.struct(F.lit(DUPLICATE).alias("route"), (F.col("n") - fresh).cast("bigint").alias("n")),
        )))
        .groupBy("route").agg(F.sum("n").cast("bigint").alias("n"))
        .filter("n > 0")
    )
