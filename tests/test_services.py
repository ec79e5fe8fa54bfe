"""Fetching, publishing, records by page and by id."""

import json
import threading
import time
import urllib.error
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewell.plans.services import service
from tidewell.sources import by_id, fetch, publish, sinks
from tidewell.sources.fetch import Limits, in_order, tried
from tidewell.sources.places import sizes_below, written
from tidewell.sources.rest import record_stream, records
from tidewell.streaming.stages import failures, stage, stored


def test_order_and_limits_of_fetches():
    now, most, lock = Counter(), Counter(), threading.Lock()

    def work(job):
        n, host = job
        with lock:
            now[host] += 1
            now["all"] += 1
            most[host], most["all"] = max(most[host], now[host]), max(most["all"], now["all"])
        time.sleep(0.02 if host == "slow" else 0.001)
        with lock:
            now[host] -= 1
            now["all"] -= 1
        return n

    jobs = [(k, "slow" if k % 3 == 0 else f"h{k % 4}") for k in range(120)]
    assert list(in_order(jobs, work, lambda j: j[1], Limits(in_flight=8, per_host=2))) == list(range(120))
    assert most["all"] <= 8 and all(n <= 2 for h, n in most.items() if h != "all") and most["slow"] == 2
    assert list(in_order([], work, lambda j: j[1], Limits())) == []


def test_rows_wait_in_a_bounded_window():
    taken, first = [], threading.Event()

    def jobs():
        for k in range(1000):
            taken.append(k)
            yield k

    out = in_order(jobs(), lambda k: first.wait(5) if k == 0 else k, str, Limits(in_flight=4, window=3))
    timer = threading.Timer(0.3, lambda: (seen.append(len(taken)), first.set()))
    seen = []
    timer.start()
    next(out)
    assert seen[0] <= 12 and len(list(out)) == 999


def answer(status, after=None):
    return urllib.error.HTTPError("u", status, "x", {"Retry-After": after} if after else {}, None)


def test_tries_and_waits(tmp_path):
    (tmp_path / "x").write_bytes(b"body")

    def outcome(*errors):
        left, waits = list(errors), []

        def opener(address):
            if left:
                raise left.pop(0)
            return open(address, "rb")

        o = tried(str(tmp_path / "x"), lambda s: s.read(), opener, Limits(attempts=4), waits.append)
        return o.value, o.attempts, o.http_status, o.error, waits

    assert outcome() == (b"body", 1, None, None, [])
    assert outcome(answer(503), answer(429, "7"), ConnectionError("cut")) == (b"body", 4, None, None, [1.0, 7.0, 4.0])
    assert outcome(answer(404)) == (None, 1, 404, "HTTP 404", [])
    assert outcome(*[answer(500)] * 9)[:4] == (None, 4, 500, "HTTP 500")
    assert tried(None, None, None, Limits()).error == tried("", None, None, Limits()).error == "no address"


def test_contents_keep_the_order_of_rows(spark, tmp_path):
    for k in range(0, 60, 2):
        (tmp_path / f"{k}.txt").write_bytes(b"%d" % k)
    rows = [(k, None if k == 7 else f"{tmp_path}/{k}.txt", "kept") for k in range(60)]
    got = fetch.contents(spark.createDataFrame(rows, "id bigint, url string, more string").coalesce(1), "url", limits=Limits(in_flight=5)).collect()
    assert [r.id for r in got] == list(range(60)) and all(r.more == "kept" for r in got)
    assert all((r.content is None) == bool(r.id % 2) == (r.error is not None) for r in got)
    assert got[7].error == "no address" and bytes(got[8].content) == b"8"
    with pytest.raises(ValueError, match="twice"):
        fetch.contents(spark.createDataFrame([], "url string, Content binary"), "url")
    assert fetch.contents(spark.createDataFrame([], "url string"), "url").count() == 0


def test_saved_files_sidecars_and_repeats(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.PNG").write_bytes(bytes([k]) * 3_000_000 if k == 1 else b"x" * k)
    rows = [(1000 + k, f"{tmp_path}/{k}.PNG", f"by {k}") for k in range(8)] + [(1003, f"{tmp_path}/3.PNG", "by 3"), (5, None, None)]
    df, out = spark.createDataFrame(rows, "id bigint, url string, who string").repartition(3), str(tmp_path / "out")
    got = {r.id: r for r in fetch.saved(df, "id", "url", out, ["id", "who"]).collect()}
    assert [got[1000 + k].status for k in range(8)] == ["ok"] * 3 + [got[1003].status] + ["ok"] * 2 + ["fail"] * 2 and got[5].error == "no address"
    assert got[1001].size_bytes == 3_000_000 and got[1001].path.endswith(".png") and Path(got[1001].path).stat().st_size == 3_000_000
    beside = json.loads(Path(got[1002].path).with_suffix(".json").read_text())
    assert beside["who"] == "by 2" and beside["id"] == 1002 and "downloaded_utc" in beside
    before = sizes_below(out)
    assert not any(p.endswith(".tmp") for p in before) and len(before) == 12
    again = fetch.saved(df, "id", "url", out).groupBy("status").count().collect()
    assert dict(map(tuple, again)) == {"skipped_exists": 7, "fail": 3} and sizes_below(out) == before


def test_fetching_as_a_stage_with_dead_letters(spark, tmp_path):
    for k in range(4):
        (tmp_path / f"{k}.jpg").write_bytes(b"x" * (k + 1))
    rows = [(f"{tmp_path}/{k}.jpg", f"a/{k}.jpg") for k in range(6)]
    schema, result, source, out = "url string, path string", f"url string, {fetch.SAVED}", str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    work = fetch.save_work("url", "path", str(tmp_path / "got"), limits=Limits(attempts=1))
    run = lambda: stage(spark, source, schema, "url", work, result, out, str(tmp_path / "c")).awaitTermination()
    run()
    assert sorted(r.size_bytes for r in stored(spark, f"{out}/results", "size_bytes bigint").collect()) == [1, 2, 3, 4]
    assert failures(spark, out, "url", result).count() == 2
    (tmp_path / "4.jpg").write_bytes(b"late")
    run()
    assert failures(spark, out, "url", result).count() == 1 and stored(spark, f"{out}/results", "url string").count() == 5


def shards(tmp_path, n=5):
    here = tmp_path / "here"
    here.mkdir(exist_ok=True)
    for k in range(n):
        (here / f"s{k}.parquet").write_bytes(b"%d" % k * (k + 1))
    return str(here), str(tmp_path / "remote")


def test_publish_confirms_then_frees(spark, tmp_path):
    here, remote = shards(tmp_path)
    local = publish.local_files(spark, here)
    publish.publish(local, remote, "r1", free=False)
    assert sizes_below(remote) == sizes_below(here) and len(sizes_below(here)) == 5
    written(f"{remote}/s2.parquet", b"cut")  # of another size: published again
    written(f"{here}/s9.parquet", b"new")
    publish.publish(publish.local_files(spark, here), remote, "r2")
    assert sizes_below(here) == {} and sizes_below(remote)["s2.parquet"] == 3 and len(sizes_below(remote)) == 6
    assert sorted(map(tuple, publish.published(spark, remote).where("run = 'r2'").collect()))[-1] == ("r2", "s9.parquet", 3)
    assert not (tmp_path / "remote/_staging/r2").exists()
    publish.publish(publish.local_files(spark, here), remote, "r3")  # nothing left
    assert publish.published(spark, remote).where("run = 'r3'").count() == 0


def test_a_killed_task_changes_nothing_and_the_run_can_be_repeated(spark, tmp_path):
    here, remote = shards(tmp_path)
    local = publish.local_files(spark, here).repartition(5)
    broken = local.unionByName(spark.createDataFrame([("lost.parquet", f"{here}/none", 4)], publish.LOCAL))
    with pytest.raises(Exception, match="none"):
        publish.publish(broken, remote, "r1")
    assert sizes_below(remote) == {} and len(sizes_below(here)) == 5 and not (tmp_path / "remote/_staging/r1").exists()
    publish.publish(local, remote, "r1")
    assert len(sizes_below(remote)) == 5 and sizes_below(here) == {}


def test_a_commit_may_be_repeated_or_cut_short(tmp_path):
    here, remote = shards(tmp_path)
    writer = publish.PublishWriter({"remote": remote, "run": "r"})
    rows = [{"name": n, "path": f"{here}/{n}", "size_bytes": size} for n, size in sizes_below(here).items()]
    first, lost = writer.write(iter(rows)), writer.write(iter(rows[:2]))  # an attempt whose message never came
    assert all(s and "/_staging/" in s for _, s, _, _ in lost.files) and sizes_below(remote) == {}
    Path(remote).mkdir(exist_ok=True)
    Path(first.files[0][1]).rename(f"{remote}/{first.files[0][0]}")  # a commit that ended after one move
    writer.commit([first, None])
    assert len(sizes_below(remote)) == 5 and sizes_below(here) == {}
    writer.commit([first])
    assert len(sizes_below(remote)) == 5 and not Path(f"{remote}/_staging/r").exists()
    short = publish.Staged([("other.parquet", None, f"{here}/x", 3)])
    with pytest.raises(OSError, match="aren't confirmed"):
        writer.commit([short])


def test_names_of_published_files(spark, tmp_path):
    here, remote = shards(tmp_path, 1)
    for name in ("../x.parquet", "_x/y.parquet", "/x"):
        with pytest.raises(Exception, match="can't be the name"):
            publish.PublishWriter({"remote": remote, "run": "r"}).write(iter([{"name": name, "path": here, "size_bytes": 1}]))
    twice = publish.local_files(spark, here)
    with pytest.raises(ValueError, match="once each"):
        publish.publish(twice.unionByName(twice), remote, "r")


def known(tmp_path, ids):
    for k in ids:
        (tmp_path / f"{k}.json").write_text(json.dumps({"id": k, "name": f"n{k}", "tags": [k]}))
    return str(tmp_path)


def test_details_pack_ids_into_calls(spark, tmp_path, monkeypatch):
    base = known(tmp_path, range(0, 100, 2))
    ids = spark.createDataFrame([(k % 100 if k % 9 else None,) for k in range(300)], "taxon bigint")
    got = by_id.details(ids, "taxon", base, "name string, tags string", partitions=1).collect()
    assert sorted(r.id for r in got) == sorted({k % 100 for k in range(300) if k % 9})
    assert all(r.known == (r.id % 2 == 0) and r.name == (f"n{r.id}" if r.known else None) and r.tags == (f"[{r.id}]" if r.known else None) and r.error is None for r in got)
    assert by_id.details(spark.createDataFrame([], "taxon bigint"), "taxon", base, "name string").count() == 0


def test_number_of_calls(tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(by_id, "asked", lambda base, ids: calls.append(len(ids)) or {})
    reader = by_id.IdReader.__new__(by_id.IdReader)
    reader.names, reader.base, reader.per_call, reader.calls, reader.ids = ["id", "name"], "x", 30, 2, set(range(95))
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert calls == [30, 30, 30, 5] and len(reader.partitions()) == 2 and rows == [(k, None) for k in range(95)]


def test_ids_are_pushed_into_the_source(spark, tmp_path):
    base = known(tmp_path, range(50))
    spark.dataSource.register(by_id.IdSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        new = lambda: spark.read.format("by_id").option("base", base).schema("id bigint, name string, record string").load()
        got = new().where("id IN (3, 4, 77, 3) AND (name IS NULL OR name <> 'n4')").orderBy("id").collect()
        assert [(r.id, r.name) for r in got] == [(3, "n3"), (77, None)] and json.loads(got[0].record)["tags"] == [3]
        assert new().where("id = 5 AND id IN (6, 7)").count() == 0
        with pytest.raises(Exception, match="asked by id"):
            new().collect()
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_failed_calls_are_not_unknown_ids(spark, tmp_path):
    (tmp_path / "1.json").write_text("{broken")
    (tmp_path / "40.json").write_text('{"id": 40, "name": "n"}')
    got = {r.id: r for r in by_id.details(spark.createDataFrame([(1,), (40,)], "taxon bigint"), "taxon", str(tmp_path), "name string", per_call=1, partitions=1).collect()}
    assert got[1].known is None and "JSONDecodeError" in got[1].error and got[40].known and got[40].error is None


def test_pages_one_row_a_key_in_order(spark, tmp_path):
    pages = [[(1, "a"), (2, "b")], [(2, "later"), (3, "c")], [(4, "d")]]
    for n, rows in enumerate(pages):
        (tmp_path / f"page_{n}.json").write_text(json.dumps({"total_results": 5, "per_page": 2, "results": [{"id": i, "name": x} for i, x in rows]}))
    assert sorted(map(tuple, records(spark, str(tmp_path), "id bigint, name string", partitions=3).collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    (tmp_path / "page_1.json").write_text(json.dumps({"results": []}))
    with pytest.raises(Exception, match="page 1 of 3 is empty"):
        records(spark, str(tmp_path), "id bigint, name string").collect()
    assert records(spark, str(tmp_path / "none"), "id bigint").count() == 0


def test_a_stream_of_pages_that_shift(spark, tmp_path):
    base, out = str(tmp_path / "service"), str(tmp_path / "out")

    def run(ids, **options):
        service(spark.createDataFrame([(k, f"n{k}") for k in ids], "id bigint, name string"), "id", base, 4)
        rows = record_stream(spark, base, "id bigint, name string", **options)
        rows.writeStream.option("checkpointLocation", f"{out}/c").trigger(availableNow=True).format("parquet").start(f"{out}/rows").awaitTermination()
        return sorted(r.id for r in spark.read.schema("id bigint").parquet(f"{out}/rows").collect())

    assert run(range(20, 30)) == list(range(20, 30))
    assert run(range(20, 30)) == list(range(20, 30))  # nothing new
    assert run(range(13, 31)) == list(range(13, 31))  # records before and after
    assert run(range(13, 40), order="append") == list(range(13, 40))


def test_files_are_whole_and_nested(spark, tmp_path):
    df = spark.createDataFrame([("a/b/x.txt", b"1"), ("y.txt", None)], "path string, content binary")
    assert sorted(map(tuple, sinks.files(df, str(tmp_path)).collect())) == [("a/b/x.txt", 1), ("y.txt", 0)]
    assert sizes_below(str(tmp_path)) == {"a/b/x.txt": 1, "y.txt": 0}


def test_count_probes(spark, tmp_path):
    (tmp_path / "a").write_text('{"count": 12, "results": []}')
    (tmp_path / "b").write_text('{"total_results": 3}')
    rows = [(x, f"{tmp_path}/{x}") for x in "abc"]
    got = {r.x: (r.n_records, r.probe_error) for r in by_id.counted(spark.createDataFrame(rows, "x string, at string"), "at").withColumn("z", F.lit(1)).collect()}
    assert got == {"a": (12, None), "b": (3, None), "c": (None, "FileNotFoundError")}
