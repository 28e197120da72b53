"""The log as a stream: dedup, routing and projections, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sirenlog.functions.timestamps import iso_millis
from sirenlog.operators import dead_letters as dl
from sirenlog.operators import projections as pj
from sirenlog.operators.parsing import DUPLICATE, LOST, TIMELINE_ONLY, VERDICTS, parse_events, reaches_mark
from sirenlog.operators.routing import CONSUMER_GROUP, first_deliveries, position
from sirenlog.sources.outbox import Outbox
from sirenlog.streaming.tables import Tables

FAILED_AFTER_MARK = "failed after the message id was recorded"
NEEDED = sorted({*pj.TIMELINE_INPUT, *pj.HEALTH_INPUT, *pj.ARTIFACT_INPUT})
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def project_batch(
    batch: DataFrame,
    batch_id: int,
    tables: Tables,
    processed_at: Column | None = None,
    after_mark_failure: str = "lose",
    missing: str = "keep",
) -> None:
    """Write one batch of envelopes to every table.

    ``after_mark_failure='lose'`` only counts messages whose projection fails
    after their id is recorded; ``quarantine`` dead-letters them.  Their ids stay
    recorded, so a replay of such a dead letter is a duplicate: it is kept to be
    looked at and corrected under a new id, not to be replayed as it is.
    """
    if after_mark_failure not in ("lose", "quarantine"):
        raise ValueError("after_mark_failure must be 'lose' or 'quarantine'")
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    quarantine = after_mark_failure == "quarantine"

    # Written once, read back by every step: their plans start from files and
    # survive the loss of an executor.  Counts come from the writes themselves.
    parsed, received = _written(_parsed(batch, quarantine), f"{tables.root}/received/batch_id={batch_id}")
    kept = _kept(quarantine)
    ids = parsed.filter(reaches_mark()).select(F.col("event_id").alias("message_id"))
    ledger = tables.ledger_before(batch_id, ids).filter(F.col("consumer_group") == CONSUMER_GROUP)
    first, accepted = _written(
        first_deliveries(parsed, kept, ledger), f"{tables.root}/accepted/batch_id={batch_id}")

    _project(parsed, first, received, accepted, batch_id, tables, processed_at, quarantine, missing)


def _parsed(log: DataFrame, quarantine: bool) -> DataFrame:
    parsed = parse_events(log, [*NEEDED, *dl.INPUT])
    if quarantine:
        return parsed
    # Only dead letters carry their message on.
    return parsed.withColumn("value", F.when(F.col("verdict").isin(*dl.DEAD_ROUTES), F.col("value")))


def _kept(quarantine: bool) -> list[str]:
    """The columns of a first delivery that the tables need."""
    return NEEDED + (["topic", "value", "headers", "incident_kind", "incident_raw"] if quarantine else [])


def _project(parsed: DataFrame, first: DataFrame, received: dict[str, int], accepted: dict[str, int], batch_id: int,
             tables: Tables, processed_at: Column, quarantine: bool, missing: str) -> None:
    """Every table's rows of a batch, from all its messages and the first deliveries among them."""
    failed_at = iso_millis(processed_at)
    tables.write("ledger", batch_id, pj.ledger_rows(first, processed_at))
    tables.write("timeline", batch_id, pj.timeline_rows(first))
    tables.write("artifacts", batch_id, pj.artifact_rows(first))
    tables.write("health_changes", batch_id, pj.fold_health(pj.health_changes(first, batch_id, missing)))
    dead = dl.stored_dead_letters(parsed, failed_at)
    if quarantine:
        dead = dead.unionByName(_quarantined(first, failed_at))
    tables.write("dead_letters", batch_id, dead)

    outcomes = {v: received[v] if v in dl.DEAD_ROUTES else accepted[v] for v in VERDICTS}
    outcomes[DUPLICATE] = sum(received.values()) - sum(outcomes.values())
    rows = [(route, n) for route, n in sorted(outcomes.items()) if received.get(route) or route == DUPLICATE]
    tables.write("outcomes", batch_id, tables.spark.createDataFrame(rows, "route string, n bigint").coalesce(1))


def _written(rows: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """The rows, stored and read back, and how many of them have each verdict, observed while they are written."""
    seen = Observation()
    observed = rows.observe(seen, *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS])
    observed.write.mode("overwrite").parquet(path)
    counts = seen.get
    return rows.sparkSession.read.schema(rows.schema).parquet(path), {v: counts.get(v, 0) for v in VERDICTS}


def _quarantined(first: DataFrame, failed_at: Column) -> DataFrame:
    return first.filter(F.col("verdict").isin(LOST, TIMELINE_ONLY)).select(
        F.when(F.col("incident_kind") != "VOID", F.col("incident_raw")).alias("incidentId"),
        failed_at.alias("failedAt"),
        F.lit(dl.ATTEMPTS).alias("retryCount"),
        F.lit(FAILED_AFTER_MARK).alias("errorMessage"),
        F.col("topic").alias("originalTopic"),
        F.col("partition").alias("originalPartition"),
        F.col("offset").cast("string").alias("originalOffset"),
        F.col("value").alias("originalMessage"),
        F.lit(None).cast("string").alias("originalRawValue"),
        F.expr(dl.ORIGIN).alias("origin"),
        F.expr(dl.ATTEMPT).alias("attempt"),
    )


def start_projection(
    log: DataFrame, root: str, checkpoint: str, available_now: bool = True, **options
) -> StreamingQuery:
    """Run the projection over a streaming log, resuming from ``checkpoint``.

    Transient failures are Spark's to retry, by task and then by batch; what
    still fails row by row is dead-lettered at once, as it would fail again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        project_batch(batch, batch_id, Tables(batch.sparkSession, root), **options)

    writer = log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def keyed_messages(log: DataFrame, quarantine: bool = False) -> DataFrame:
    """A streaming log's messages, and beside them the positions that first carried an id (``is_first``).

    The state per id is its first position and the times of the first and the
    last micro-batch that held it.  Both are one batch's time only while the id
    was never met before that batch, and only then its position is told: an id
    that comes back, also at a smaller position of another partition, stays
    known.  A repeated micro-batch has the same time and meets the same state.
    """
    messages = _parsed(log, quarantine).withColumn("position", position())
    marked = messages.filter(reaches_mark()).select("event_id", "position", F.current_timestamp().alias("arrival"))
    known = marked.groupBy("event_id").agg(
        F.min(F.struct("arrival", "position")).alias("first"), F.max("arrival").alias("last"))
    firsts = known.filter(F.col("first.arrival") == F.col("last")).select("first.position", F.lit(True).alias("is_first"))
    return messages.unionByName(firsts, allowMissingColumns=True)


def project_keyed_batch(batch: DataFrame, batch_id: int, tables: Tables, processed_at: Column | None = None,
                        after_mark_failure: str = "lose", missing: str = "keep") -> None:
    """The same tables as :func:`project_batch`, from one batch of :func:`keyed_messages`; no ledger is read."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    quarantine = after_mark_failure == "quarantine"
    # A second look at the batch would run the state again: everything starts from the written one.
    rows, received = _written(batch, f"{tables.root}/received/batch_id={batch_id}")
    parsed, firsts = rows.filter("is_first IS NULL").drop("is_first"), rows.filter("is_first").select("position")
    # Positions are unique, so no key of this join is hot; of copies at one position one is taken.
    first, accepted = _written(
        parsed.filter(reaches_mark()).join(firsts, "position", "left_semi").dropDuplicates(["position"]).select(
            "event_id", "verdict", *_kept(quarantine)),
        f"{tables.root}/accepted/batch_id={batch_id}")
    _project(parsed.drop("position"), first, received, accepted, batch_id, tables, processed_at, quarantine, missing)


def start_keyed_projection(
    log: DataFrame, root: str, checkpoint: str, available_now: bool = True, **options
) -> StreamingQuery:
    """The projection with its first-seen test in keyed state instead of the ledger.

    A batch then costs by its own ids, however long the history is.  The state
    lies in RocksDB on the executors and, by version, in the checkpoint; the
    number of its partitions is the session's when the checkpoint is made.  A
    projection keeps to the way it was started with: the state knows nothing of
    an older ledger.
    """
    spark = log.sparkSession
    quarantine = options.get("after_mark_failure") == "quarantine"

    def write(batch: DataFrame, batch_id: int) -> None:
        project_keyed_batch(batch, batch_id, Tables(batch.sparkSession, root), **options)

    writer = keyed_messages(log, quarantine).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query takes its settings along when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(STATE_STORE, before)


def wait_until_projected(query: StreamingQuery, seconds: float = 15.0) -> bool:
    """Wait, for a bounded time, until a bounded run has written everything; errors are raised."""
    return bool(query.awaitTermination(seconds))


def replay_to_log(
    spark: SparkSession, tables: Tables, log_path: str, fmt: str = "parquet", most: int = dl.MAX_REPLAYS
) -> None:
    """Append the replayable dead letters of the committed batches to a file log.

    Each run appends an original at most once, and each original at most
    ``most`` times in all: dead letters say where their message was first read
    and which replay brought it.  What is due is a function of the committed
    batches, so the newest of them names the load, and a run that ended half-way
    is repeated without appending anything twice.  The log itself is not read.
    """
    last = tables.last_batch()
    if last is None:
        return
    load, outbox = f"replay-{last}", Outbox(spark, log_path, fmt)
    if outbox.is_published(load):
        return
    replay = dl.replay_messages(tables.read("dead_letters"), tables.replays(before=last), most)
    if not outbox.is_staged(load):
        tables.write("replays", last, dl.replay_rows(replay))
    outbox.publish(load, replay.select("topic", "partition", "key", "value", "headers", "source_offset", "source_topic"),
                   dl.replay_order())


def replay_report(tables: Tables, most: int = dl.MAX_REPLAYS) -> DataFrame:
    """What became of every dead-lettered original: ``origin``, ``replays`` and ``status``."""
    return dl.replay_report(tables.read("dead_letters"), tables.replays(), most)
