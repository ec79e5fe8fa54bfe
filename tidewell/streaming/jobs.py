"""Jobs of remote services as a keyed state machine with timers: submitted, polled, then ready, failed or expired.

Events are rows (job, at, kind, status, seq): kind `submit` starts a job, kind `answer` has the service's
status. Each job is a key with its state; timers give a row whenever a poll is due, and end jobs that have no
final answer in time. In event time (for replays) time is the watermark; in processing time (for live
services) it's the clock; times have milliseconds. Answers are applied in order of (at, seq) within a batch.

Answers to jobs that weren't submitted, or that have ended, change nothing, so repeated and late answers are
harmless; so is a repeated submission of a job that runs, or ended less than `keep` ago. What ended longer ago
is forgotten, so the state is bounded by the jobs of that time.

`run` closes the circle: polls ask the service, its answers are appended to the events, and what is ready is
downloaded, with a sidecar of its facts.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidewell.session import ready
from tidewell.sources.fetch import Limits, contents, saved

EVENTS = "job string, at timestamp, kind string, status string, seq bigint"
ACTIONS = "job string, at timestamp, action string, status string, polls int"
READY, FAILED = ("SUCCEEDED",), ("KILLED", "CANCELLED", "FAILED", "FILE_ERASED")
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(at: datetime | pd.Timestamp) -> int:
    return int(pd.Timestamp(at).tz_localize("UTC").timestamp() * 1000) if pd.Timestamp(at).tzinfo is None else int(pd.Timestamp(at).timestamp() * 1000)


def _at(ms: int) -> pd.Timestamp:
    return pd.Timestamp(ms, unit="ms")


class Tracker(StatefulProcessor):
    """State of a job: phase (running or ended), when it began or ended (milliseconds), polls that came due."""

    def __init__(self, poll: float, expire: float, keep: float, live: bool, first_submits: bool):
        self.poll, self.expire, self.keep = int(poll * 1000), int(expire * 1000), int(keep * 1000)
        self.live, self.first_submits = live, first_submits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "phase string, since bigint, polls int")

    def now(self, timers: TimerValues, at: int) -> int:
        return timers.getCurrentProcessingTimeInMs() if self.live else at

    def ended(self, key: tuple, at: int, action: str, status: str | None, polls: int, now: int) -> tuple:
        self.forget()
        self.state.update(("ended", now, polls))
        self.handle.registerTimer(now + self.keep)
        return (*key, _at(at), action, status, polls)

    def forget(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["at", "seq"], kind="stable")
        out = []
        for at, kind, status in zip(events["at"], events["kind"], events["status"], strict=True):
            ms = _ms(at)
            now = self.now(timerValues, ms)
            had = self.state.get() if self.state.exists() else None
            if had is not None and had[0] == "running" and now > had[1] + self.expire:
                out.append(self.ended(key, had[1] + self.expire, "expired", None, had[2], had[1] + self.expire))
                continue
            if had is not None and had[0] == "ended" and now >= had[1] + self.keep:  # its timer hasn't come yet
                self.forget()
                had = None
            if had is None and (kind == "submit" or self.first_submits):
                self.state.update(("running", now, 0))
                self.handle.registerTimer(now + self.poll)
                self.handle.registerTimer(now + self.expire)
                out.append((*key, _at(ms), "submitted", None, 0))
            elif had is not None and had[0] == "running" and kind == "answer" and status in READY + FAILED:
                out.append(self.ended(key, ms, "ready" if status in READY else "failed", status, had[2], now))
        if out:
            yield pd.DataFrame(out, columns=["job", "at", "action", "status", "polls"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        had = self.state.get() if self.state.exists() else None
        row = None
        if had is None:
            return
        if had[0] == "ended":
            if due >= had[1] + self.keep:
                self.state.clear()
        elif due >= had[1] + self.expire:
            row = self.ended(key, had[1] + self.expire, "expired", None, had[2], due)
        else:
            self.state.update(("running", had[1], had[2] + 1))
            self.handle.registerTimer(due + self.poll)
            row = (*key, _at(due), "poll", None, had[2] + 1)
        if row:
            yield pd.DataFrame([row], columns=["job", "at", "action", "status", "polls"])

    def close(self) -> None:
        pass


def tracked(events: DataFrame, poll: float = 30, expire: float = 86_400, keep: float = 86_400, live: bool = False, late: str = "0 seconds", first_submits: bool = False) -> DataFrame:
    """Actions (job, at, action, status, polls) of a stream of events: submitted, poll, ready, failed, expired. Times in seconds.

    In event time (live = False) `late` is how far events may lag; polls that would be due before an answer that
    came in the same batch aren't given. With first_submits the first event of a job submits it, whatever its kind. The session's state store has to be RocksDB (`with_timers`).
    """
    ready(events.sparkSession)
    rows = events.select("job", "at", "kind", "status", "seq")
    if not live:
        rows = rows.withWatermark("at", late)
    return rows.groupBy("job").transformWithStateInPandas(Tracker(poll, expire, keep, live, first_submits), ACTIONS, "append", "processingTime" if live else "eventTime")


def with_timers(spark: SparkSession) -> SparkSession:
    """Lets the session keep state in RocksDB, which timers need. Streams that have begun with another store keep it in their checkpoint."""
    spark.conf.set(STORE, ROCKS)
    return spark


def asked(polls: DataFrame, address: str, limits: Limits = Limits()) -> DataFrame:
    """Events of answers to polls: `address` has {job}. A service that can't be reached gives no answer, and is polled again."""
    before, _, after = address.partition("{job}")
    found = contents(polls.select("job", F.concat(F.lit(before), "job", F.lit(after)).alias("address")), "address", limits=limits).where("error IS NULL")
    status = F.get_json_object(F.col("content").cast("string"), "$.status")
    return found.select("job", F.current_timestamp().alias("at"), F.lit("answer").alias("kind"), status.alias("status"), F.lit(0).cast("long").alias("seq"), F.col("content").cast("string").alias("facts"))


def run(spark: SparkSession, events: str, out: str, address: str, poll: float = 30, expire: float = 86_400, keep: float = 86_400, limits: Limits = Limits()) -> StreamingQuery:
    """Follows the jobs of a folder of events (Parquet of EVENTS) until it's stopped. Writes below `out`: actions, facts of
    answers, downloads (sidecar columns job, status, facts) and their outcomes; answers go to the folder of events.

    A batch that is repeated after a crash asks and downloads again: answers change nothing twice, files that are there are skipped.
    """
    stream = spark.readStream.schema(EVENTS).parquet(events)

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{out}/actions/batch={number}")
            due = batch.where("action IN ('submitted', 'poll')")
            answers = asked(due, address, limits)
            answers.write.mode("overwrite").parquet(f"{out}/facts/batch={number}")
            told = batch.sparkSession.read.schema(f"{EVENTS}, facts string").parquet(f"{out}/facts/batch={number}")
            told.select("job", "at", "kind", "status", "seq").write.mode("append").parquet(events)
            done = batch.where("action = 'ready'").select("job", "status")
            if not done.isEmpty():
                known = batch.sparkSession.read.schema(f"{EVENTS}, facts string").parquet(f"{out}/facts").where(F.col("status").isin(*READY))
                facts = done.join(known.groupBy("job").agg(F.max_by("facts", "at").alias("facts")), "job", "left")
                links = facts.withColumns({"link": F.get_json_object("facts", "$.downloadLink"), "key": F.xxhash64("job")})
                saved(links, "key", "link", f"{out}/files", ("job", "status", "facts"), limits=limits).write.mode("overwrite").parquet(f"{out}/outcomes/batch={number}")
        finally:
            batch.unpersist()

    actions = tracked(stream, poll, expire, keep, live=True)
    return actions.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", f"{out}/checkpoint").trigger(processingTime="1 second").start()


def submitted(spark: SparkSession, events: str, jobs: list[str]) -> None:
    """Appends submissions of jobs to a folder of events."""
    now = datetime.now(UTC).replace(tzinfo=None)
    spark.createDataFrame([(j, now, "submit", None, 0) for j in jobs], EVENTS).write.mode("append").parquet(events)
