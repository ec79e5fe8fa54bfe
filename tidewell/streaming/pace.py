"""Pace of streams: rows and bytes done, rate and time left, and waiting for room.

`paced` observes counts within the query, so nothing is counted twice or collected; a listener adds up what
each micro-batch reports.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAME = "pace"


def paced(df: DataFrame, size: Column | None = None, name: str = NAME) -> DataFrame:
    """df as it is, with its rows and the sum of `size` observed. For sinks that run a batch once."""
    size = F.lit(0) if size is None else F.coalesce(size, F.lit(0))
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes"))


class Pace(StreamingQueryListener):
    """Adds up the batches of queries observed under a name; `clock` gives seconds."""

    def __init__(self, name: str = NAME, clock: Callable[[], float] = time.monotonic):
        self.name, self.clock = name, clock
        self.rows = self.bytes = self.batches = 0
        self.began = clock()
        self.last = self.began

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        met = event.progress.observedMetrics.get(self.name)
        if met is not None:
            self.rows, self.bytes, self.batches, self.last = self.rows + met["rows"], self.bytes + met["bytes"], self.batches + 1, self.clock()

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        pass

    def report(self, total: int | None = None) -> dict:
        """rows, bytes, seconds up to the last batch, rows_per_s, and seconds_left of `total` rows (null while there's no rate)."""
        seconds = self.last - self.began
        rate = self.rows / seconds if seconds > 0 else None
        left = None if total is None or not rate else max(0, total - self.rows) / rate
        return {"rows": self.rows, "bytes": self.bytes, "seconds": seconds, "rows_per_s": rate, "seconds_left": left}


def with_progress(found: DataFrame, total: Column, done: Column, seconds: Column) -> DataFrame:
    """Adds rate (done a second, null before any time has passed) and seconds_left (null without a rate) to rows of counts."""
    rate = F.when(seconds > 0, done / seconds)
    return found.withColumns({"rate": rate, "seconds_left": F.when(rate > 0, F.greatest(total - done, F.lit(0)) / rate)})


def room(free: Callable[[], int], needed: int, poll: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> float:
    """Waits until `free()` bytes are at least `needed`; the seconds waited."""
    waited = 0.0
    while free() < needed:
        sleep(poll)
        waited += poll
    return waited
