"""What became of an ingest: batches, records, times, state and error of every run, in a table that outlives it."""

from __future__ import annotations

import threading
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

RUNNING, COMPLETED, FAILED = "running", "completed", "failed"
STATUS = (
    "run string, attempt string, at timestamp, seq int, status string, batches bigint, pages bigint, error_message string"
)


class ProgressLog(StreamingQueryListener):
    """Adds a row to the table at ``root`` when a stream starts, after every batch, and when it ends or fails.

    ``run`` is the stream's id, kept in its checkpoint; every start is an ``attempt`` of its own.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark, self.root = spark, root
        self.state: dict[str, list] = {}
        self.ended: dict[str, threading.Event] = {}

    def add(self, run: str, attempt: str, status: str, batches: int, pages: int, error: str | None = None) -> None:
        held = self.state.setdefault(attempt, [0, 0, 0])
        held[0], held[1], held[2] = held[0] + 1, held[1] + batches, held[2] + pages
        row = (run, attempt, datetime.now(UTC).replace(tzinfo=None), held[0], status, held[1], held[2], error)
        self.spark.createDataFrame([row], STATUS).coalesce(1).write.mode("append").parquet(self.root)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.ended.setdefault(str(event.runId), threading.Event())
        self.add(str(event.id), str(event.runId), RUNNING, 0, 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.numInputRows:
            self.add(str(p.id), str(p.runId), RUNNING, 1, p.numInputRows)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        attempt = str(event.runId)
        status = FAILED if event.exception else COMPLETED
        self.add(str(event.id), attempt, status, 0, 0, event.exception)
        self.ended.setdefault(attempt, threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a query is in the table; events come a little after the query itself has ended."""
        self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds)


def ingest_status(spark: SparkSession, root: str) -> DataFrame:
    """The last word on every attempt: run, attempt, started, updated, status, batches, pages, error."""
    rows = spark.read.schema(STATUS).parquet(root)
    last = Window.partitionBy("attempt").orderBy(F.desc("seq"))
    started = F.min("at").over(Window.partitionBy("attempt"))
    rows = rows.withColumns({"started": started, "place": F.row_number().over(last)}).where("place = 1")
    return rows.select("run", "attempt", "started", F.col("at").alias("updated"), "status", "batches", "pages", "error_message")
