"""Progress and lifecycle of running queries as rows.

The listener puts each event into a bounded hand-over; a flusher thread writes what is there
every few seconds while the query runs, and the rest when it stops.  A full hand-over makes the
listener wait, so nothing is dropped and the driver holds at most its bound of events.
Flattening to numeric series is a Spark job over the written rows (P24), never work of the
listener thread.
"""

from __future__ import annotations

import datetime
import queue
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.json import flatten_json

EVENTS = "event string, query_id string, run_id string, query_name string, batch_id long, at string, json string"
STARTED, PROGRESS, TERMINATED = "started", "progress", "terminated"


class EventSink(StreamingQueryListener):
    """Writes started / progress / terminated rows of the queries called ``query_name`` (of all, if None) to ``path``.

    ``close`` writes what is left and takes the listener off; with ``close_after_end`` it closes by
    itself when a followed query ends.  A failed write is tried again with the next flush; after
    ``close`` it is raised.
    """

    def __init__(self, spark: SparkSession, path: str, query_name: str | None = None, bound: int = 1000,
                 flush_seconds: float = 5.0, close_after_end: bool = False):
        self.spark, self.path, self.query_name = spark, path, query_name
        self.close_after_end, self.flush_seconds = close_after_end, flush_seconds
        self._rows: queue.Queue = queue.Queue(maxsize=bound)
        self._runs: dict[str, str] = {}              # run id -> name, of the followed queries
        self._pending: list[tuple] = []
        self._ending = threading.Event()
        self._thread = threading.Thread(target=self._work, name="tablewatch-events", daemon=True)
        self.failure: Exception | None = None

    def open(self) -> "EventSink":
        self.spark.streams.addListener(self)
        self._thread.start()
        return self

    # -- the listener's thread

    def onQueryStarted(self, event):
        name = event.name
        if self.query_name is None or name == self.query_name:
            self._runs[str(event.runId)] = name
            self._rows.put((STARTED, str(event.id), str(event.runId), name, None, event.timestamp, None))

    def onQueryProgress(self, event):
        p = event.progress
        if str(p.runId) in self._runs:
            self._rows.put((PROGRESS, str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.json))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        run = str(event.runId)
        if run in self._runs:
            at = datetime.datetime.now(datetime.timezone.utc).isoformat()
            self._rows.put((TERMINATED, str(event.id), run, self._runs.pop(run), None, at, event.exception))
            if self.close_after_end and not self._runs:
                self._ending.set()

    # -- the flusher

    def _work(self):
        while not self._ending.wait(self.flush_seconds):
            self._flush()
        self.spark.streams.removeListener(self)
        self._flush()

    def _flush(self):
        while len(self._pending) < self._rows.maxsize:
            try:
                self._pending.append(self._rows.get_nowait())
            except queue.Empty:
                break
        if self._pending:
            try:
                self.spark.createDataFrame(self._pending, EVENTS).coalesce(1).write.mode("append").parquet(self.path)
                self._pending, self.failure = [], None
            except Exception as e:                   # kept and tried again; never raised into the stream
                self.failure = e

    def wait(self, timeout: float = 60.0) -> None:
        """Until the sink has closed by itself (``close_after_end``)."""
        self._thread.join(timeout)
        if self._thread.is_alive():
            raise TimeoutError("the event sink is still open")
        if self.failure is not None:
            raise self.failure

    def close(self) -> None:
        self._ending.set()
        self.wait()


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The written rows, each once: a flush tried again after a half-written one repeats rows."""
    return spark.read.schema(EVENTS).parquet(path).dropDuplicates(["event", "run_id", "batch_id", "at"])


def events_progress(events: DataFrame) -> DataFrame:
    """Every numeric leaf of the progress rows as (run_id, batch_id, instance, value)."""
    docs = events.where(F.col("event") == PROGRESS)
    return flatten_json(docs, "json", keep=["run_id", "batch_id"]).select(
        "run_id", "batch_id", F.col("name").alias("instance"), "value")


class ProgressRecorder(StreamingQueryListener):
    """Progress documents and lifecycle events in driver lists: for short runs and tests."""

    def __init__(self):
        self._lock = threading.Lock()
        self.progress: list[str] = []
        self.events: list[tuple[str, str, str]] = []   # (event, query id, name)

    def onQueryStarted(self, event):
        with self._lock:
            self.events.append(("started", str(event.id), str(event.name)))

    def onQueryProgress(self, event):
        try:
            with self._lock:
                self.progress.append(event.progress.json)
        except Exception as e:  # errors are logged, never raised into the stream
            print(f"[tablewatch] progress capture failed: {e}")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._lock:
            self.events.append(("terminated", str(event.id), ""))

    def drain(self) -> tuple[list[str], list[tuple[str, str, str]]]:
        with self._lock:
            p, e = self.progress, self.events
            self.progress, self.events = [], []
        return p, e


def events_frame(spark: SparkSession, events: list[tuple[str, str, str]]) -> DataFrame:
    """Recorded start / terminate events as rows (event, query id, query name)."""
    return spark.createDataFrame(events, "event string, query_id string, query_name string")


def progress_frame(spark: SparkSession, progress_json: list[str]) -> DataFrame:
    """Recorded progress documents as rows (one per micro-batch)."""
    return spark.createDataFrame([(i, j) for i, j in enumerate(progress_json)], "seq long, json string")


def progress_metrics(progress: DataFrame) -> DataFrame:
    """Every numeric leaf of each progress document as
    ``(seq, batch_id, instance, value)`` with a sanitised name."""
    flat = flatten_json(progress, "json", keep=["seq"])
    batch = progress.select("seq", F.get_json_object("json", "$.batchId").cast("long").alias("batch_id"))
    return flat.join(batch, "seq").select("seq", "batch_id", F.col("name").alias("instance"), "value")
