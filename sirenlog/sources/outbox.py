"""Publishing to a file log, so that a publish may be repeated.

A load is a named set of messages.  It goes through three steps, each of which
finds out whether it was done before:

``_offsets``    the load's offset ranges are allotted, from the newest allotment
                alone: a row per topic and partition, never a scan of the log
``_staged``     the messages are written once, numbered, where readers do not look
the log         the staged files are moved into it one by one, each under a name
                that says its load, and ``_published`` says when all are there

A publish that ended anywhere is repeated under the same name: staged messages
are not computed again, moved files are not moved again, and a load that is
complete is left alone.  Each message is in the log once, and a reader or a
stream never sees a file change.  A log has one publisher at a time.  A file log
that was written without allotments is scanned once, at its first publish.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.operators.numbering import numbered, part_offsets, parts_of
from sirenlog.schemas import ENVELOPE
from sirenlog.sources.event_log import read_log

GROUP = ["topic", "partition"]
ALLOTTED = "topic string, partition int, first bigint, next bigint"
_LOAD = re.compile(r"[A-Za-z0-9._-]+")


class Outbox:
    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def publish(self, load: str, messages: DataFrame, order: Sequence[Column]) -> None:
        """Append the messages (envelopes without offsets), numbered per topic and partition in ``order``.

        The order must tell all messages of a partition apart.
        """
        if not _LOAD.fullmatch(load):
            raise ValueError(f"a load's name is made of letters, digits, dots, dashes and underscores, not {load!r}")
        if self.is_published(load):
            return
        staged = f"_staged/load={load}"
        if not self._exists(f"{staged}/_SUCCESS"):
            self._stage(load, messages, order, staged)
        for name in self._names(staged):
            if not name.startswith("_"):
                self._move(f"{staged}/{name}", f"{load}-{name}")
        self._touch(f"_published/{load}")

    def is_published(self, load: str) -> bool:
        return self._exists(f"_published/{load}")

    def is_staged(self, load: str) -> bool:
        """Whether repeating the publish needs the messages no more."""
        return self._exists(f"_staged/load={load}/_SUCCESS")

    def next_offsets(self) -> DataFrame:
        """(``topic``, ``partition``, ``next``), from the newest allotment."""
        newest = self._newest()
        if newest is not None:
            return self._allotment(newest[1]).select(*GROUP, "next")
        if any(not name.startswith(("_", ".")) for name in self._names("")):
            return read_log(self.spark, self.path, self.fmt).groupBy(*GROUP).agg((F.max("offset") + 1).alias("next"))
        return self.spark.createDataFrame([], "topic string, partition int, next bigint")

    def _stage(self, load: str, messages: DataFrame, order: Sequence[Column], folder: str) -> None:
        parts = parts_of(messages, GROUP, order)
        before = part_offsets(parts, GROUP)
        first = self._allot(load, before.groupBy(*GROUP).agg(F.max("total").alias("n")))
        ranked = numbered(parts, before, GROUP, order, "rank").join(first, GROUP)
        envelopes = ranked.withColumn("offset", F.col("first") + F.col("rank") - 1).select(*ENVELOPE.fieldNames())
        envelopes.write.format(self.fmt).mode("overwrite").save(f"{self.path}/{folder}")

    def _allot(self, load: str, counts: DataFrame) -> DataFrame:
        """(``topic``, ``partition``, ``first``) for ``n`` messages each; a repeated load keeps what it was given.

        An allotment also carries the next offsets of all other partitions, so
        that the newest one is all that a later load reads.
        """
        newest = self._newest()
        if newest is None or newest[0] != load:
            number = 0 if newest is None else newest[2] + 1
            known = self.next_offsets()
            held = known.join(counts, GROUP, "full_outer").select(
                *GROUP, F.when(F.col("n").isNotNull(), F.coalesce("next", F.lit(0))).alias("first"),
                (F.coalesce("next", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("next"))
            name = f"{number:012d}-{load}"
            held.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_offsets/{name}")
            newest = (load, name, number)
        return self._allotment(newest[1]).filter(F.col("first").isNotNull()).select(*GROUP, "first")

    def _allotment(self, name: str) -> DataFrame:
        return self.spark.read.schema(ALLOTTED).parquet(f"{self.path}/_offsets/{name}")

    def _newest(self) -> tuple[str, str, int] | None:
        """Load, folder and number of the newest finished allotment."""
        done = [name for name in self._names("_offsets") if self._exists(f"_offsets/{name}/_SUCCESS")]
        if not done:
            return None
        number, _, load = max(done).partition("-")
        return load, max(done), int(number)

    def _hadoop(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        path, files = self._hadoop(name)
        return files.exists(path)

    def _names(self, folder: str) -> list[str]:
        path, files = self._hadoop(folder)
        if not files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(path) if not status.getPath().getName().startswith("."))

    def _move(self, source: str, target: str) -> None:
        path, files = self._hadoop(source)
        to, _ = self._hadoop(target)
        if not files.rename(path, to):
            raise OSError(f"{source} could not be moved to {target}")

    def _touch(self, name: str) -> None:
        path, files = self._hadoop(name)
        files.create(path, True).close()
