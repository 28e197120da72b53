"""The newest events of stored incidents, found through a position index.

The stored timeline is laid out by incident and time, so a file holds a run of
an incident's events.  The index has one row per incident and file: how many
events, from when to when.  From it alone follow an incident's total, how many
events a request keeps, and a time before which none of them lies; the files
that hold nothing newer are not opened, and of the others only rows from that
time on are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sirenlog.operators.numbering import numbered, part_offsets, parts_of
from sirenlog.operators.summaries import asked_limits, kept_of, newest_first


def file_index(timeline: DataFrame) -> DataFrame:
    """One row per incident and file of a stored timeline; events without a time are counted apart."""
    return timeline.groupBy("incident_id", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_timestamp").alias("oldest"), F.max("event_timestamp").alias("newest"),
        F.count_if(F.col("event_timestamp").isNull()).alias("undated"))


def kept_by_index(index: DataFrame, requests: DataFrame) -> DataFrame:
    """(``request_id``, ``incident_id``, ``kept``): how many events each request keeps, from counts alone."""
    asked = asked_limits(requests)
    totals = index.join(asked.select("incident_id").distinct(), "incident_id", "left_semi").groupBy(
        "incident_id").agg(F.sum("n").alias("total"))
    return asked.join(totals, "incident_id").select("request_id", "incident_id", kept_of().alias("kept")).filter("kept > 0")


def needed_from(index: DataFrame, kept: DataFrame) -> DataFrame:
    """Per incident ``most``, the most events that a request keeps, and ``since``: those are not older.

    Files are counted from the one whose oldest event is newest; where enough
    events are counted, the wanted ones lie at or after the oldest of them.  A
    null ``since`` means that all events are needed, those without a time too.
    """
    most = kept.groupBy("incident_id").agg(F.max("kept").alias("most"))
    before = Window.partitionBy("incident_id").orderBy(F.desc_nulls_last("oldest"), "file").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counted = index.join(most, "incident_id").withColumn("seen", F.sum(F.col("n") - F.col("undated")).over(before))
    return counted.groupBy("incident_id", "most").agg(
        F.max(F.when(F.col("seen") >= F.col("most"), F.col("oldest"))).alias("since"))


def _is_needed() -> Column:
    return F.col("since").isNull() | (F.col("newest") >= F.col("since"))


def needed_files(index: DataFrame, needed: DataFrame) -> list[str]:
    """The files to open; at most all files of the table."""
    found = index.join(needed, "incident_id").filter(_is_needed()).select("file").distinct().collect()
    return sorted(row.file for row in found)


def ranked_newest(rows: DataFrame, kept: DataFrame, needed: DataFrame) -> DataFrame:
    """Per request its newest events with their 1-based ``position``, from the needed files' rows."""
    columns = ["incident_id", "event_id", "event_type", "message", "event_timestamp"]
    since = rows.join(needed, "incident_id").filter(
        F.col("since").isNull() | (F.col("event_timestamp") >= F.col("since"))).select(*columns, "most")
    group, order = ["incident_id"], newest_first()
    parts = parts_of(since, group, order)
    offsets = part_offsets(parts, group).join(needed.select("incident_id", "most"), "incident_id").filter(
        "before < most").drop("most")
    ranked = numbered(parts, offsets, group, order, "position").filter("position <= most").select(*columns, "position")
    return ranked.join(kept, "incident_id").filter("position <= kept").select(
        "request_id", "position", "event_id", "event_type", "message", "event_timestamp")
