"""The stored tables: one Parquet folder each, one ``batch_id`` folder per micro-batch.

A batch overwrites its own folders, so running it again leaves the same rows.
Its outcome counts are written last; readers see only batches that have them,
and so never one table ahead of another.

The compacted ledger is looked up in two steps.  A filter beside it holds about
two bytes an id: 64-bit words, in which every id sets five bits of one word by
its hashes.  Ids of a batch whose bits are not all set are new, and need no
ledger; for the others (known ones, and about one in two hundred new ones) the
ledger lies in folders by a hash of the id, of about ``BUCKET_IDS`` ids each, of
which only theirs are read.  How many words and folders there are is counted at
compaction and stored in its marker, so a lookup always uses the numbers that
the files were written with.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from sirenlog.operators import newest
from sirenlog.operators.projections import fold_health
from sirenlog.schemas import ARTIFACTS, HEALTH_CHANGES, LEDGER, REPLAYS, STORED_DEAD_LETTERS, TIMELINE, TIMELINE_INDEX
from sirenlog.session import stored

OUTCOMES = StructType([StructField("route", StringType()), StructField("n", LongType())])

SCHEMAS = {
    "ledger": LEDGER,
    "timeline": TIMELINE,
    "health_changes": HEALTH_CHANGES,
    "artifacts": ARTIFACTS,
    "dead_letters": STORED_DEAD_LETTERS,
    "replays": REPLAYS,
    "timeline_index": TIMELINE_INDEX,
    "outcomes": OUTCOMES,
}

# How rows are laid out in files: range partitioning over unique columns keeps a
# key's rows together, splits a hot key, and lets a key filter skip row groups.
LAYOUTS = {
    "timeline": ("incident_id", "event_timestamp", "event_id"),
    "artifacts": ("incident_id", "uploaded_at", "artifact_id"),
    "ledger": ("message_id",),
    "health_changes": ("org_id", "service_name"),
}

BUCKET_IDS = 1_000_000      # ids of a folder of the compacted ledger, about
IDS_PER_WORD, BITS = 4, 5   # ids of a filter word, about; bits that an id sets in it
SMALL_BATCH = 1_000_000     # ids of a batch that are sent to all tasks (16 bytes each); more are joined by shuffling
COMPACTED = "done bigint, buckets int, words bigint"
FILTER = "word bigint, bits bigint"


def ledger_bucket(message_id: Column, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(message_id), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def filter_word(message_id: Column, words: int) -> Column:
    # Another hash than the bucket's, or ids of a bucket would crowd into few words.
    return F.pmod(F.xxhash64(message_id, F.lit("word")), F.lit(words).cast("bigint"))


def filter_bits(message_id: Column) -> Column:
    """The bits that an id sets: five places, six bits each, of a third hash."""
    h, bits = F.xxhash64(message_id, F.lit("bits")), F.lit(0).cast("bigint")
    for i in range(BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return bits


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def write(self, name: str, batch_id: int, rows: DataFrame) -> None:
        layout = LAYOUTS.get(name)
        if layout:
            rows = rows.repartitionByRange(*layout).sortWithinPartitions(*layout)
        path = f"{self.root}/{name}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        if name == "timeline":
            self._index_timeline(path, f"{self.root}/timeline_index/batch_id={batch_id}")

    def _index_timeline(self, path: str, index: str) -> None:
        newest.file_index(self.spark.read.schema(TIMELINE).parquet(path)).write.mode("overwrite").parquet(index)

    def recent_events(self, requests: DataFrame) -> DataFrame:
        """Per request the newest events of its incident, from the files that hold them."""
        index = self.read("timeline_index")
        kept = stored(newest.kept_by_index(index, requests), "kept")
        needed = stored(newest.needed_from(index, kept), "needed")
        files = newest.needed_files(index, needed)
        rows = self.spark.read.schema(TIMELINE)
        rows = rows.parquet(*files) if files else self.spark.createDataFrame([], TIMELINE)
        return newest.ranked_newest(rows, kept, needed)

    def all_batches(self, name: str) -> DataFrame:
        """Every row with its ``batch_id``, committed or not."""
        schema = StructType([*SCHEMAS[name].fields, StructField("batch_id", LongType())])
        return self._load(name, schema)

    def read(self, name: str) -> DataFrame:
        """The rows of committed batches, compacted ones included."""
        last = self._last("outcomes", "batch_id")
        return self._rows(name, -1 if last is None else last)

    def read_before(self, name: str, batch_id: int) -> DataFrame:
        """Rows of the batches before ``batch_id``; a repeated batch must not meet its own."""
        return self._rows(name, batch_id - 1)

    def last_batch(self) -> int | None:
        """The newest committed batch."""
        return self._last("outcomes", "batch_id")

    def replays(self, before: int | None = None) -> DataFrame:
        """(``origin``, ``attempt``) of the messages that were replayed, after batches before ``before`` only."""
        rows = self.all_batches("replays")
        return (rows if before is None else rows.filter(F.col("batch_id") < before)).drop("batch_id")

    def ledger_before(self, batch_id: int, ids: DataFrame | None = None) -> DataFrame:
        """The ledger of the batches before ``batch_id``; with ``ids`` (``message_id``), at least what it has of them."""
        done = self._compacted("ledger", batch_id - 1)
        recent = self._recent("ledger", batch_id - 1, done)
        if done is None:
            return recent
        through, buckets, words = done
        compacted = self._compacted_rows("ledger", through)
        if ids is not None:
            suspects = self.suspects(ids, through, words).select(ledger_bucket(F.col("message_id"), buckets).alias("bucket"))
            wanted = sorted(r.bucket for r in suspects.distinct().collect())  # <= buckets numbers
            compacted = compacted.filter(F.col("bucket").isin(wanted))
        return compacted.drop("bucket").unionByName(recent)

    def suspects(self, ids: DataFrame, through: int, words: int) -> DataFrame:
        """The ids that the filter of a compacted ledger does not rule out."""
        asked = ids.select("message_id", filter_word(F.col("message_id"), words).alias("word"),
                           filter_bits(F.col("message_id")).alias("mask"))
        held = self.spark.read.schema(FILTER).parquet(f"{self.root}/compacted_ledger_filter/through={through}")
        # The filter is the larger side; it stays where it is while a batch is small enough to travel.
        few = asked.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH
        met = held.join(F.broadcast(asked) if few else asked, "word")
        return met.filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("message_id")

    def _recent(self, name: str, last: int, done: tuple[int, int, int] | None) -> DataFrame:
        """Rows of the batch folders after the compaction, up to ``last``."""
        rows = self.all_batches(name).filter(F.col("batch_id") <= last)
        return (rows if done is None else rows.filter(F.col("batch_id") > done[0])).drop("batch_id")

    def _compacted(self, name: str, last: int) -> tuple[int, int, int] | None:
        """Through which batch a table is compacted, and the ledger's numbers of folders and filter words."""
        through = self._last(f"compacted_{name}_done", "through")
        if through is None:
            return None
        if through > last:
            raise ValueError(f"{name} is compacted through batch {through}; batch {last + 1} cannot be repeated")
        marker = self.spark.read.schema(COMPACTED).parquet(f"{self.root}/compacted_{name}_done/through={through}").first()
        return through, marker.buckets, marker.words

    def _compacted_rows(self, name: str, through: int) -> DataFrame:
        schema = SCHEMAS[name]
        if name == "ledger":
            schema = StructType([*schema.fields, StructField("bucket", IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/compacted_{name}/through={through}")

    def _rows(self, name: str, last: int) -> DataFrame:
        """Rows of the batches up to ``last``: compacted ones, then the folders after them."""
        done = self._compacted(name, last)
        recent = self._recent(name, last, done)
        return recent if done is None else self._compacted_rows(name, done[0]).select(recent.columns).unionByName(recent)

    def health(self, org_id: str | None = None) -> DataFrame:
        """Current state per service, of one organisation or of all.

        Compaction folds the changes into one row per service, and that state
        and the changes since lie in the order of organisations: one
        organisation's filter skips the files and row groups of the others.
        """
        changes = self.read("health_changes")
        return fold_health(changes if org_id is None else changes.filter(F.col("org_id") == org_id))

    def compact(self, name: str) -> None:
        """Rewrite all committed batches but the newest as one sorted set of files.

        The marker written last makes readers start from the compacted files;
        then the folders that they replace are removed: earlier batches, earlier
        compactions and the received and accepted messages.  The newest batch stays as it
        is, since a restarted query may repeat it.  Health changes are folded.
        Readers that began before may lose their files: compact between runs.
        """
        newest = self._last("outcomes", "batch_id")
        done = self._last(f"compacted_{name}_done", "through")
        if newest is None or newest < 1 or newest - 1 == done:
            return
        last = newest - 1
        rows, buckets, words = self._rows(name, last), 0, 0
        if name == "health_changes":
            rows = fold_health(rows)
        layout = LAYOUTS.get(name)
        path = f"{self.root}/compacted_{name}/through={last}"
        if name == "ledger":
            ids = rows.count()
            buckets, words = max(1, -(-ids // BUCKET_IDS)), max(1, ids // IDS_PER_WORD)
            id_ = F.col("message_id")
            # Range-dealt, so that a folder of many ids is several files, and a few ids need not open all.
            rows.withColumn("bucket", ledger_bucket(id_, buckets)).repartitionByRange("bucket", "message_id").sortWithinPartitions(
                "bucket", "message_id").write.mode("overwrite").partitionBy("bucket").parquet(path)
            rows.groupBy(filter_word(id_, words).alias("word")).agg(F.bit_or(filter_bits(id_)).alias("bits")).repartitionByRange(
                "word").sortWithinPartitions("word").write.mode("overwrite").parquet(
                    f"{self.root}/compacted_ledger_filter/through={last}")
        else:
            if layout:
                rows = rows.repartitionByRange(*layout).sortWithinPartitions(*layout)
            rows.write.mode("overwrite").parquet(path)
        if name == "timeline":
            index = f"{self.root}/compacted_timeline_index"
            self._index_timeline(path, f"{index}/through={last}")
            self._mark("timeline_index", last, 0, 0)
        self._mark(name, last, buckets, words)
        self._remove(name, "batch_id", last)
        for kept in ("accepted", "received"):
            self._remove(kept, "batch_id", last)
        self._remove(f"compacted_{name}", "through", last - 1)
        self._remove(f"compacted_{name}_done", "through", last - 1)
        if name == "ledger":
            self._remove("compacted_ledger_filter", "through", last - 1)
        if name == "timeline":
            self._remove("timeline_index", "batch_id", last)
            for kept in ("compacted_timeline_index", "compacted_timeline_index_done"):
                self._remove(kept, "through", last - 1)

    def _mark(self, name: str, last: int, buckets: int, words: int) -> None:
        self.spark.range(1).select(
            F.lit(last).cast("bigint").alias("done"), F.lit(buckets).alias("buckets"), F.lit(words).cast("bigint").alias("words"),
        ).write.mode("overwrite").parquet(f"{self.root}/compacted_{name}_done/through={last}")

    def folders(self, name: str) -> list[str]:
        """The names of a table's batch (or compaction) folders."""
        found = self._list(name)
        return sorted(status.getPath().getName() for status in found if "=" in status.getPath().getName())

    def _list(self, name: str) -> list:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return list(files.listStatus(path)) if files.exists(path) else []

    def _remove(self, name: str, column: str, last: int) -> None:
        """Remove the folders of a column's values up to ``last``."""
        for status in self._list(name):
            path = status.getPath()
            key, _, value = path.getName().partition("=")
            if key == column and int(value) <= last:
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _last(self, name: str, column: str) -> int | None:
        """The highest partition value, from folder names and a one-row aggregate."""
        schema = StructType([StructField(column, LongType())])
        return self._load(name, schema).agg(F.max(column)).first()[0]

    def _load(self, name: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
