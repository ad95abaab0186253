"""Progress of a run: counts by accumulators in batches, by a listener in streams."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Progress:
    """Counts of done, cached and failed items that tasks add to, with an estimate of the time left."""

    def __init__(self, spark: SparkSession, total: int, clock: Callable[[], float] = time.monotonic) -> None:
        sc = spark.sparkContext
        self.total, self.clock, self.begun = total, clock, clock()
        self.done, self.cached, self.errors = sc.accumulator(0), sc.accumulator(0), sc.accumulator(0)

    def add(self, cached: bool = False, error: bool = False) -> None:
        """One more item; called in tasks."""
        self.done.add(1)
        if cached:
            self.cached.add(1)
        if error:
            self.errors.add(1)

    def line(self) -> str:
        """The state in one line; called on the driver."""
        n, took = self.done.value, self.clock() - self.begun
        left = took / n * (self.total - n) if n else 0.0
        share = 100 * n // self.total if self.total else 100
        return f"{n}/{self.total} ({share} %), cached {self.cached.value}, errors {self.errors.value}, {left:.0f} s left"


class BatchLog(StreamingQueryListener):
    """Hands a line per finished micro-batch to ``say``."""

    def __init__(self, say: Callable[[str], None] = print) -> None:
        self.say = say

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.say(f"started {event.name or event.id}")

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.say(f"batch {p.batchId}: {p.numInputRows} rows")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        return

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.say(f"ended {event.id}" + (f": {event.exception}" if event.exception else ""))
