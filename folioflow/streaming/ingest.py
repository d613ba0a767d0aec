"""Incremental ingestion with Structured Streaming over landed files."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from folioflow.operators.incremental import add_keys, not_in_keys, stale_queue
from folioflow.operators.ordering import first_rows
from folioflow.operators.runs import counters, run_counters
from folioflow.schemas import COUNTERS
from folioflow.sources.store import Store

LEDGER = ", ".join(["batch long", "taken long", *(f"{c} long" for c in COUNTERS)])
KEYS = "url string, scraped_at timestamp, batch long"
PROGRESS = "batch long, input_rows long, duration_ms long"


def stream_records(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """Records of arriving Parquet files, a bounded number of files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def batch_progress(outcomes: DataFrame) -> DataFrame:
    return run_counters(outcomes)


class Ledger:
    """What each micro-batch took and what became of it: a folder a batch, so that a replayed batch writes its own again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        """(batch, taken, counters) of all batches so far."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def taken_before(self, batch: int) -> int:
        return self.read().filter(F.col("batch") < batch).agg(F.sum("taken")).first()[0] or 0

    def write(self, batch: int, outcomes: DataFrame) -> None:
        row = outcomes.agg(F.count(F.lit(1)).alias("taken"), *counters())
        row.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def stream_upsert(
    stream: DataFrame, store: Store, as_of: Column, checkpoint: str, report: Callable[[int, DataFrame], None] | None = None, limit: int | None = None, order: Sequence[str] = ("seq", "source_url"), ledger: Ledger | None = None, land: bool = True
) -> StreamingQuery:
    """Upserts each micro-batch into the store and stops when there is no more.

    A restart goes on from the checkpoint. A batch that ended between the store and the checkpoint is replayed: the
    snapshot knows its number, so nothing is applied twice, and its ledger row is written from the outcomes that its
    snapshot keeps. With ``limit`` the stream takes so many rows in all, over batches and restarts: the ledger says what
    the batches before took, and a batch gives its first rows by ``order``, the same ones when replayed. ``land=False``
    reads a batch more than once instead of writing it: for files as they are, where nobody asks how many rows were read.
    """
    if limit is not None and ledger is None:
        raise ValueError("a limit over batches needs a ledger")

    def apply(batch: DataFrame, number: int) -> None:
        if limit is not None:
            batch = first_rows(batch, order, limit - ledger.taken_before(number))
        applied = store.upsert(batch, as_of, number, land=land)
        found = store.outcomes(batch_id=number)
        if ledger:
            ledger.write(number, found)
        if report and applied:
            report(number, batch_progress(found))

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_unseen(stream: DataFrame, keys_path: str, as_of: Column, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Passes on listed urls that no batch has had before. Keys are a table of a folder per batch, so that a replay
    overwrites its own part and any number of keys costs a join and no state. A batch that ended between sink and keys is
    replayed to the sink with its number: a sink that writes by number ends as if it had run once."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(KEYS).parquet(keys_path).filter(F.col("batch") < number) if number else spark.createDataFrame([], KEYS)
        fresh = not_in_keys(batch.dropDuplicates(["source_url"]), old)
        sink(fresh, number)
        new = add_keys(old.select("url", "scraped_at").limit(0), fresh.select(F.col("source_url").alias("url"), as_of.alias("scraped_at")))
        new.write.mode("overwrite").parquet(f"{keys_path}/batch={number}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unseen_within(stream: DataFrame, at: str, horizon: str) -> DataFrame:
    """A stream without listed urls that came up to ``horizon`` before, by the time column ``at``. Its state holds the urls
    of the horizon alone: a url that comes again once the watermark has passed its first time by the horizon is new. Rows
    older than the watermark are dropped as late, and so is a null time."""
    return stream.filter(F.col(at).isNotNull()).withWatermark(at, horizon).dropDuplicatesWithinWatermark(["source_url"])


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes a stream as Parquet files, each row once, and stops when there is no more."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


class ProgressLog(StreamingQueryListener):
    """The progress of a session's streams as rows: batch, input rows and time, from the events that Spark sends."""

    def __init__(self) -> None:
        self._rows: dict[str, dict[int, tuple[int, int, int]]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        self._rows.setdefault(p["runId"], {})[p["batchId"]] = (p["batchId"], p["numInputRows"], p["batchDuration"])

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def rows(self, query: StreamingQuery, timeout: float = 60) -> DataFrame:
        """(batch, input_rows, duration_ms) of an ended query; events come in order, the end last."""
        if not self._end(query.runId).wait(timeout):
            raise TimeoutError(f"no end of {query.runId} reported")
        found = [r for r in self._rows.get(query.runId, {}).values() if r[1]]
        return SparkSession.getActiveSession().createDataFrame(found, PROGRESS)


def stream_progress(progress: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows a micro-batch: what Spark measured with what became of its rows. Batches of runs that broke off have no
    measures."""
    return ledger.join(progress, "batch", "left").select("batch", "input_rows", "duration_ms", "taken", *COUNTERS)


def due_batch(docs: DataFrame, interval: Column, as_of: Column, limit: int | None = None) -> DataFrame:
    """What a recheck at ``as_of`` has to fetch."""
    return stale_queue(docs, interval, as_of, limit=limit)
