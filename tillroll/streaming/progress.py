"""Progress of streams and of batch jobs while they run, as lines of text."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

Tell = Callable[[str], None]


class BatchProgress(StreamingQueryListener):
    """A line per micro-batch with rows, and one more whenever all rows pass a multiple of `every`.
    Totals are kept per query, from its start."""

    def __init__(self, tell: Tell = print, every: int = 50_000):
        self.tell, self.every = tell, every
        self.rows: dict[str, int] = {}
        #: Set when a query has ended and its last line is told; events arrive a little later.
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.rows[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        now = event.progress
        if not now.numInputRows:
            return
        run = str(now.runId)
        before = self.rows.get(run, 0)
        total = self.rows[run] = before + now.numInputRows
        self.tell(f"batch {now.batchId}: {now.numInputRows:,} rows, {now.processedRowsPerSecond:,.0f} rows/s")
        if total // self.every > before // self.every:
            self.tell(f"{total // self.every * self.every:,} rows taken in")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        total = self.rows.pop(str(event.runId), 0)
        self.tell(f"stopped after {total:,} rows" + (f": {event.exception}" if event.exception else ""))
        self.ended.set()


@contextmanager
def listening(spark: SparkSession, listener: StreamingQueryListener) -> Iterator[None]:
    """Listen to the session's streams inside a `with` block."""
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        spark.streams.removeListener(listener)


@contextmanager
def watching(spark: SparkSession, label: str, tell: Tell = print, seconds: float = 10) -> Iterator[None]:
    """A line every so many seconds with the finished tasks of the stages that run inside a `with`
    block, as Spark's status tracker counts them: no row is touched for it."""
    tracker, stopped = spark.sparkContext.statusTracker(), threading.Event()

    def report() -> None:
        while not stopped.wait(seconds):
            stages = [tracker.getStageInfo(stage) for stage in tracker.getActiveStageIds()]
            done = sum(stage.numCompletedTasks for stage in stages if stage)
            tasks = sum(stage.numTasks for stage in stages if stage)
            if tasks:
                tell(f"{label}: {done:,} of {tasks:,} tasks of {len(stages)} stages")

    thread = threading.Thread(target=report, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stopped.set()
        thread.join()
