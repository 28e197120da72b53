"""Reading and writing log envelopes: files (Parquet, JSON) and Kafka."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sirenlog.schemas import ENVELOPE

# What one micro-batch takes, so that a backlog comes in batches of bounded size.
MAX_FILES = 1_000
MAX_OFFSETS = 5_000_000


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(ENVELOPE).load(path)


def stream_log(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int = MAX_FILES
) -> DataFrame:
    """The same log as a stream, from its beginning, ``max_files`` files to a batch."""
    return spark.readStream.format(fmt).schema(ENVELOPE).option("maxFilesPerTrigger", max_files).load(path)


def read_dead_letter_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Everything dead-lettered so far, as one bounded read; an absent log is an error."""
    try:
        return read_log(spark, path, fmt)
    except AnalysisException as error:
        raise FileNotFoundError(f"no dead-letter log at {path}; nothing was dead-lettered yet") from error


def append_log(envelopes: DataFrame, path: str, fmt: str = "parquet") -> None:
    envelopes.select(ENVELOPE.fieldNames()).write.format(fmt).mode("append").save(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source (``includeHeaders=true``) as envelopes."""
    text = lambda column: F.make_valid_utf8(column.cast("string"))
    return records.select(
        "topic", "partition", "offset",
        text(F.col("key")).alias("key"),
        text(F.col("value")).alias("value"),
        F.map_from_entries(
            F.transform(
                _last_of_each_key(F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>"))),
                lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")),
            )
        ).alias("headers"),
    )


def _last_of_each_key(headers):
    """A message may repeat a header; a map may not."""
    later = lambda i: F.slice(headers, i + 2, F.size(headers))
    return F.filter(headers, lambda h, i: ~F.exists(later(i), lambda other: other["key"] == h["key"]))


def to_kafka(envelopes: DataFrame) -> DataFrame:
    """Envelopes as rows for Spark's Kafka sink; the broker assigns partition and offset."""
    return envelopes.select(
        "topic", "key", "value",
        F.transform(
            F.map_entries("headers"),
            lambda h: F.struct(h["key"].alias("key"), h["value"].cast("binary").alias("value")),
        ).alias("headers"),
    )


def publish(envelopes: DataFrame, path: str | None = None, fmt: str = "parquet", servers: str | None = None) -> None:
    """Append messages to a file log, or send them to a broker (needs the Kafka connector package).

    A broker numbers the messages; a file log takes the offsets that they carry.
    """
    if (path is None) == (servers is None):
        raise ValueError("give either a path or servers")
    if path is not None:
        append_log(envelopes, path, fmt)
    else:
        to_kafka(envelopes).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def publish_stream(envelopes: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "parquet",
                   servers: str | None = None) -> StreamingQuery:
    """The same for a stream of messages, one bounded run from its checkpoint."""
    if (path is None) == (servers is None):
        raise ValueError("give either a path or servers")
    if path is not None:
        writer = envelopes.select(ENVELOPE.fieldNames()).writeStream.format(fmt).option("path", path)
    else:
        writer = to_kafka(envelopes).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kafka_log(spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """Streaming read of a topic from its beginning (needs the Kafka connector package)."""
    return from_kafka(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("includeHeaders", "true")
        .load()
    )


def kafka_snapshot(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Bounded read of what a topic holds now (needs the Kafka connector package)."""
    return from_kafka(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .option("includeHeaders", "true")
        .load()
    )
