"""Fetching items by address: bounded in flight for each task and host, in input order, failures as rows.

A task has at most `in_flight` fetches under way, and at most `per_host` with one host; rows wait for their
turn in a window of bounded length, and results leave in the order of the rows. So a slow host holds back
neither others nor more than the window. All tasks together have as many times that under way as run at once.

Answers that may pass (429, 5xx, broken connections) are tried again with growing waits, others fail at once;
a failed item is a row with its error and never ends the task.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.files import photo_path
from tidewell.session import ready
from tidewell.sources.places import place, size_of, written

AGENT = "tidewell"
PASSING = (429, 500, 502, 503, 504)


def opened(address: str, timeout: float = 90) -> BinaryIO:
    """A stream of what stands at a web address, or in a file."""
    if address.startswith(("http://", "https://")):
        return urllib.request.urlopen(urllib.request.Request(address, headers={"User-Agent": AGENT}), timeout=timeout)
    store, path = place(address)
    return store.open_input_stream(path)


@dataclass(frozen=True)
class Limits:
    in_flight: int = 64
    per_host: int = 16
    attempts: int = 4
    first_wait: float = 1.0
    longest_wait: float = 30.0
    window: int = 4  # rows that wait or are held, as multiples of in_flight


def host_of(address: str | None) -> str:
    return urllib.parse.urlsplit(address or "").netloc


def in_order(jobs: Iterable[Any], work: Callable[[Any], Any], host: Callable[[Any], str], limits: Limits) -> Iterator[Any]:
    """work(job) of every job, in the jobs' order. A job whose host is busy lets later ones pass."""
    source, more = iter(jobs), True
    waiting: deque = deque()
    running: dict[Future, tuple[int, str]] = {}
    done: dict[int, Any] = {}
    busy: Counter = Counter()
    taken = given = 0
    with ThreadPoolExecutor(limits.in_flight) as pool:
        while True:
            while more and len(waiting) + len(running) + len(done) < limits.in_flight * limits.window:
                try:
                    waiting.append((taken, next(source)))
                    taken += 1
                except StopIteration:
                    more = False
            held: deque = deque()
            while waiting and len(running) < limits.in_flight:
                number, job = waiting.popleft()
                at = host(job)
                if busy[at] < limits.per_host:
                    busy[at] += 1
                    running[pool.submit(work, job)] = number, at
                else:
                    held.append((number, job))
            waiting.extendleft(reversed(held))
            while given in done:
                yield done.pop(given)
                given += 1
            if running:
                for f in wait(running, return_when=FIRST_COMPLETED).done:
                    number, at = running.pop(f)
                    busy[at] -= 1
                    done[number] = f.result()
            elif not more and not waiting and not done:
                return


@dataclass(frozen=True)
class Outcome:
    value: Any = None
    attempts: int = 0
    http_status: int | None = None
    error: str | None = None


def tried(address: str | None, take: Callable[[BinaryIO], Any], opener: Callable[[str], BinaryIO], limits: Limits, sleep: Callable[[float], None] = time.sleep) -> Outcome:
    """take(stream) of an address, tried again while the failure may pass. Never raises."""
    if not address:
        return Outcome(error="no address")
    attempt = 0
    while True:
        attempt += 1
        try:
            with opener(address) as stream:
                return Outcome(take(stream), attempt, getattr(stream, "status", None))
        except urllib.error.HTTPError as e:
            status, error, passing = e.code, f"HTTP {e.code}", e.code in PASSING
            told = e.headers.get("Retry-After") if e.headers else None
        except (FileNotFoundError, IsADirectoryError, PermissionError, ValueError) as e:
            status, error, passing, told = None, type(e).__name__, False, None
        except Exception as e:
            status, error, passing, told = None, f"{type(e).__name__}: {e}", True, None
        if not passing or attempt >= limits.attempts:
            return Outcome(None, attempt, status, error)
        sleep(min(limits.longest_wait, float(told) if told and told.isdigit() else limits.first_wait * 2 ** (attempt - 1)))


def contents(df: DataFrame, url: str, opener: Callable[[str], BinaryIO] = opened, limits: Limits = Limits()) -> DataFrame:
    """df with content (null where it failed), attempts, http_status and error. Rows of a partition keep their order."""
    clash = {"content", "attempts", "http_status", "error"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be given twice")
    ready(df.sparkSession)
    target = df.withColumns({"content": F.lit(None).cast("binary"), "attempts": F.lit(0), "http_status": F.lit(None).cast("int"), "error": F.lit(None).cast("string")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((batch.slice(k, 1), address) for batch in batches for k, address in enumerate(batch.column(url).to_pylist()))
        work = lambda job: (job[0], tried(job[1], lambda s: s.read(), opener, limits))
        for row, o in in_order(rows, work, lambda job: host_of(job[1]), limits):
            more = [pa.array([o.value], pa.binary()), pa.array([o.attempts], pa.int32()), pa.array([o.http_status], pa.int32()), pa.array([o.error], pa.string())]
            yield pa.RecordBatch.from_arrays([*row.columns, *more], [*row.schema.names, "content", "attempts", "http_status", "error"])

    return df.mapInArrow(run, target)


def streamed(stream: BinaryIO, address: str, chunk: int = 1 << 20) -> tuple[int, str]:
    """Writes a stream to an address, a chunk at a time, under another name that is changed at the end; (bytes, sha256)."""
    store, path = place(address)
    store.create_dir(posixpath.dirname(path), recursive=True)
    beside, digest, size = f"{path}.{uuid.uuid4().hex}.tmp", hashlib.sha256(), 0
    try:
        with store.open_output_stream(beside) as out:
            while part := stream.read(chunk):
                out.write(part)
                digest.update(part)
                size += len(part)
        store.move(beside, path)
    except BaseException:
        if store.get_file_info(beside).is_file:
            store.delete_file(beside)
        raise
    return size, digest.hexdigest()


SAVED = "status string, size_bytes long, sha256 string, path string, attempts int, http_status int, error string"


def save(row: dict, url: str, path: str, sidecar: Sequence[str], folder: str, opener: Callable[[str], BinaryIO], limits: Limits) -> dict:
    """One item to its file, with a JSON file of the row's columns beside it; nothing is fetched where the file is."""
    address = f"{folder.rstrip('/')}/{row[path]}"
    had = size_of(address)
    if had is not None:
        return {"status": "skipped_exists", "size_bytes": had, "sha256": None, "path": address, "attempts": 0, "http_status": None, "error": None}
    start = time.monotonic()
    o = tried(row[url], lambda s: streamed(s, address), opener, limits)
    if o.error is not None:
        return {"status": "fail", "size_bytes": None, "sha256": None, "path": None, "attempts": o.attempts, "http_status": o.http_status, "error": o.error}
    if sidecar:
        facts = {c: row[c] for c in sidecar} | {"downloaded_utc": datetime.now(UTC).isoformat(), "elapsed_s": round(time.monotonic() - start, 3)}
        written(address.rsplit(".", 1)[0] + ".json", json.dumps(facts, default=str).encode())
    return {"status": "ok", "size_bytes": o.value[0], "sha256": o.value[1], "path": address, "attempts": o.attempts, "http_status": o.http_status, "error": None}


def saved(df: DataFrame, key: str, url: str, folder: str, sidecar: Sequence[str] = (), opener: Callable[[str], BinaryIO] = opened, limits: Limits = Limits()) -> DataFrame:
    """Per row: key, url, status (ok, skipped_exists or fail), size_bytes, sha256 (of what was fetched now), path, attempts, http_status, error.

    Files stand at photo_path(key, url) below the folder, which all executors have to share. Null addresses fail.
    A repeated address of a key is one file; a task that is run again skips what it has already.
    """
    ready(df.sparkSession)
    extra = [c for c in sidecar if c not in (key, url)]
    rows = df.select(F.col(key), F.col(url), *extra, photo_path(F.col(key), F.coalesce(F.col(url), F.lit(""))).alias("__path"))
    target = rows.select(key, url).withColumns({f.split(" ")[0]: F.lit(None).cast(f.split(" ")[1]) for f in SAVED.split(", ")}).schema
    names = [f.split(" ")[0] for f in SAVED.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs = ((batch.slice(k, 1).select([key, url]), row) for batch in batches for k, row in enumerate(batch.to_pylist()))
        work = lambda job: (job[0], save(job[1], url, "__path", sidecar, folder, opener, limits))
        for row, found in in_order(jobs, work, lambda job: host_of(job[1][url]), limits):
            more = [pa.array([found[n]], kinds[f.split(" ")[1]]) for n, f in zip(names, SAVED.split(", "), strict=True)]
            yield pa.RecordBatch.from_arrays([*row.columns, *more], [*row.schema.names, *names])

    return rows.mapInArrow(run, target)


def save_work(url: str, path: str, folder: str, sidecar: Sequence[str] = (), opener: Callable[[str], BinaryIO] = opened, limits: Limits = Limits()) -> Callable[[list[dict]], list[dict]]:
    """The same as the work of a resumable stage (streaming.stages.stage): rows with `path` below the folder; failures have an error."""

    def work(rows: list[dict]) -> list[dict]:
        done = in_order(rows, lambda r: save(r, url, path, sidecar, folder, opener, limits), lambda r: host_of(r[url]), limits)
        return [{**row, **found} for row, found in zip(rows, done, strict=True)]

    return work
