import hashlib
import time

import numpy as np
from pyspark.sql import functions as F

from tidewell.streaming.done import DoneTable, bloom, passing
from tidewell.streaming.features import embedding_work
from tidewell.streaming.pace import Pace, paced, room
from tidewell.streaming.stages import failures, stage, stored


def stand_in(size):
    """In place of a model: vectors drawn from the content's hash. Local to a function, so that workers get it by value."""

    class HashExtractor:
        def embed(self, contents):
            seeds = [int.from_bytes(hashlib.sha256(c).digest()[:8], "big") if c else None for c in contents]
            return [None if s is None else np.random.default_rng(s).standard_normal(size).astype(np.float16) for s in seeds]

    return HashExtractor()


def test_stage_resumes_and_keeps_failures(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("u1", b"a"), ("u2", b""), ("u1", b"a")]
    schema = "image_url_large string, content binary"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    work = embedding_work(stand_in(4))
    result = "image_url_large string, cls_fp16 binary, cls_shape array<int>, error string"

    def run(checkpoint):
        stage(spark, source, schema, "image_url_large", work, result, out, str(tmp_path / checkpoint)).awaitTermination()
        done = sorted(r.image_url_large for r in stored(spark, f"{out}/results", "image_url_large string").collect())
        return done, stored(spark, f"{out}/failed", "image_url_large string, error string").collect()

    done, failed = run("c1")
    assert done == ["u1"] and [(r.image_url_large, r.error) for r in failed] == [("u2", "undecodable")]
    assert run("c1")[0] == ["u1"]  # nothing new
    spark.createDataFrame([("u3", b"c")], schema).write.mode("append").parquet(source)
    assert run("c1")[0] == ["u1", "u3"]
    packed = stored(spark, f"{out}/results", "image_url_large string, cls_fp16 binary, cls_shape array<int>").collect()
    assert all(len(np.frombuffer(r.cls_fp16, "<f2")) == 4 and r.cls_shape == [4] for r in packed)


def test_stage_tries_failures_again_and_keeps_results_of_other_checkpoints(spark, tmp_path):
    source, out, broken = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "broken"
    broken.write_text("")

    def work(rows):
        if broken.exists() and any(r["id"] % 5 == 0 for r in rows):
            raise ValueError("no")
        return [{"id": r["id"], "twice": 2 * r["id"], "error": None} for r in rows]

    def run(checkpoint):
        stage(spark, source, "id bigint", "id", work, "id bigint, twice bigint, error string", out, str(tmp_path / checkpoint)).awaitTermination()
        return sorted(r.id for r in stored(spark, f"{out}/results", "id bigint").collect()), sorted(r.id for r in failures(spark, out, "id", "id bigint, error string").collect())

    spark.range(1, 11).coalesce(1).write.parquet(source)
    good = [k for k in range(1, 11) if k % 5]
    assert run("c1") == (good, [5, 10]) and run("c1") == (good, [5, 10])
    spark.range(11, 14).coalesce(1).write.mode("append").parquet(source)
    assert run("c2") == (sorted([*good, 11, 12, 13]), [5, 10])  # a new checkpoint counts batches from 0 again
    broken.unlink()
    assert run("c1") == (list(range(1, 14)), []) and run("c1") == (list(range(1, 14)), [])


def test_rows_kept_for_retry_stay_one_a_key_over_many_starts(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def work(rows):
        raise ValueError("never")

    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id bigint, x string").coalesce(1).write.parquet(source)
    for k in range(6):
        if k == 3:
            spark.createDataFrame([(2, "b"), (3, "c")], "id bigint, x string").coalesce(1).write.mode("append").parquet(source)
        stage(spark, source, "id bigint, x string", "id", work, "id bigint, error string", out, str(tmp_path / "c")).awaitTermination()
        kept = sorted(r.id for r in stored(spark, f"{out}/again", "id bigint, x string").collect())
        assert set(kept) == ({1, 2} if k < 3 else {1, 2, 3}) and len(kept) <= len(set(kept)) + (k == 3)  # 2 came again at k = 3
    assert kept == [1, 2, 3]


def test_filters_pass_all_their_keys_and_few_others():
    rng = np.random.default_rng(3)
    for n in (1, 5, 1000, 30_000):
        h, g = (rng.integers(-(2**63), 2**63 - 1, 2 * n) for _ in range(2))
        bits = bloom(h[:n], g[:n])
        assert passing(h[:n], g[:n], bits).all() and passing(h[n:], g[n:], bits).mean() <= 0.01 + (n == 1)


def test_only_files_that_may_hold_keys_are_read(spark, tmp_path):
    done = DoneTable(spark, str(tmp_path), "id", "bigint")
    assert done.unseen(spark.range(5)).count() == 5
    for k in range(4):
        done.add(spark.range(k * 1000, k * 1000 + 1000), f"b{k}")
    new = spark.range(100_000, 100_500)
    assert len(done.may_hold(new)) <= 8 and done.unseen(new).count() == 500  # of 256 files
    some = spark.createDataFrame([(1500,), (1501,), (77_777,), (None,)], "id bigint")
    files = done.may_hold(some)
    assert {x for x, _ in files} >= {"b1"} and len(files) <= 4
    assert sorted(r.id or -1 for r in done.unseen(some).collect()) == [-1, 77_777]
    assert done.unseen(some, "b1").count() == 4
    done.add(spark.range(1500, 1501), "b1")  # a batch that is repeated
    assert sorted(r.id or -1 for r in done.unseen(some).collect()) == [-1, 1501, 77_777]
    assert done.merged("all") == 4 and done.unseen(spark.range(4000)).count() == 999 and {x for x, _ in done.may_hold(spark.range(9))} == {"all"}


def test_text_keys(spark, tmp_path):
    done = DoneTable(spark, str(tmp_path), "url", "string")
    done.add(spark.createDataFrame([("a", "t"), ("é", "t"), (None, "t")], "url string, done_utc string"), "x")
    assert sorted(r.url for r in done.unseen(spark.createDataFrame([("a",), ("b",), ("é",)], "url string")).collect()) == ["b"]


def test_portions_wait_for_room(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(40).selectExpr("id", "100L AS size").coalesce(1).write.parquet(source)
    asked = []

    def free():
        asked.append(stored(spark, f"{out}/results", "id bigint").count())
        return 1000 if len(asked) % 2 == 0 else 0

    work = lambda rows: [{"id": r["id"], "error": None} for r in rows]
    stage(spark, source, "id bigint, size bigint", "id", work, "id bigint, error string", out, str(tmp_path / "c"), size="size", portion_bytes=1000, free=free).awaitTermination()
    assert sorted(r.id for r in stored(spark, f"{out}/results", "id bigint").collect()) == list(range(40))
    assert len(asked) == 8 and asked == sorted(asked) and 0 < asked[-1] < 40


def test_pace_by_observed_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).selectExpr("id", "7 AS size").coalesce(1).write.mode("append").parquet(source)
    now = iter(range(0, 1000, 5))
    pace = Pace("p", lambda: next(now))
    spark.streams.addListener(pace)
    try:
        df = paced(spark.readStream.schema("id bigint, size int").option("maxFilesPerTrigger", 1).parquet(source), F.col("size"), "p")
        df.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        deadline = time.time() + 20
        while pace.batches < 3 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(pace)
    assert pace.report(60) == {"rows": 30, "bytes": 210, "seconds": 15, "rows_per_s": 2.0, "seconds_left": 15.0}
    waits = iter([5, 5, 20])
    assert room(lambda: next(waits), 10, 2, lambda s: None) == 4
