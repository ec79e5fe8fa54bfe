"""Archives, shards, versioned tables, samples and jobs."""

import hashlib
import io
import json
import random
import time
import zipfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewell.operators import sampling
from tidewell.plans.streams import job_outcomes
from tidewell.sources import archives, replaced, tables, workbooks
from tidewell.sources.projection import projection
from tidewell.streaming import jobs

SCHEMA = "id bigint, name string, x double"


def packed(path, members, kind):
    with zipfile.ZipFile(path, "w", kind) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return str(path)


def lines(n, first=0):
    return "name\tid\tother\n" + "".join(f"n{k}\t{k}\t{'o' * (k % 50)}\n" for k in range(first, first + n))


@pytest.mark.parametrize(("kind", "split"), [(zipfile.ZIP_DEFLATED, 1), (zipfile.ZIP_STORED, 97), (zipfile.ZIP_STORED, 1 << 20), (zipfile.ZIP_STORED, 20_000)])
def test_members_of_archives(spark, tmp_path, kind, split):
    a = packed(tmp_path / "a.zip", {"readme": "x", "dwca/occurrence.txt": lines(500)}, kind)
    b = packed(tmp_path / "b.zip", {"occurrence.txt": lines(20, 500).rstrip("\n")}, kind)
    c = packed(tmp_path / "c.zip", {"other": "x"}, kind)
    df = archives.zip_table(spark, [a, b, c], "occurrence.txt", SCHEMA, split_bytes=split)
    assert sorted(map(tuple, df.collect())) == [(k, f"n{k}", None) for k in range(520)]
    if kind == zipfile.ZIP_STORED and split == 97:
        assert df.rdd.getNumPartitions() > 100
    assert archives.zip_table(spark, a, "occurrence.txt", SCHEMA, ["name"]).columns == ["name"]
    assert archives.zip_table(spark, c, "occurrence.txt", SCHEMA).count() == 0


def test_odd_members(spark, tmp_path):
    text = 'id\tname\tx\r\n1\t"a b"\t1.5\r\n2\ttoo\tmany\tcells\r\nbad\tz\t2\n4\t\t\n5\n6\té\t-3e2'
    path = packed(tmp_path / "o.zip", {"t.txt": text, "head.txt": "id\tname\tx\n", "none.txt": ""}, zipfile.ZIP_DEFLATED)
    assert sorted(map(tuple, archives.zip_table(spark, path, "t.txt", SCHEMA).collect())) == [(1, "a b", 1.5), (4, None, None), (6, "é", -300.0)]
    assert archives.zip_table(spark, path, "head.txt", SCHEMA).count() == archives.zip_table(spark, path, "none.txt", SCHEMA).count() == 0
    (tmp_path / "bad.zip").write_bytes(b"nothing")
    found = {(r.path.rsplit("/", 1)[1], r.member, r.size_bytes, r.error) for r in archives.members(spark, [path, str(tmp_path / "bad.zip")]).collect()}
    assert found == {("o.zip", "t.txt", len(text.encode()), None), ("o.zip", "head.txt", 10, None), ("o.zip", "none.txt", 0, None), ("bad.zip", None, None, "BadZipFile")}


def test_zip64_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_STORED) as z, z.open("t.txt", "w", force_zip64=True) as f:
        f.write(lines(50).encode())
    assert archives.zip_table(spark, str(tmp_path / "z.zip"), "t.txt", SCHEMA, split_bytes=100).count() == 50


def test_lines_of_stretches_are_each_read_once():
    rng = random.Random(5)
    for _ in range(300):
        data = b"\n".join(b"x" * rng.randint(0, 6) for _ in range(rng.randint(1, 12))) + rng.choice([b"", b"\n"])
        cuts = [0, *sorted(rng.choices(range(1, len(data) + 1), k=rng.randint(0, 4))), len(data)] if data else [0, 0]
        cuts = sorted(set(cuts)) if data else cuts
        got = b"".join(io.BufferedReader(archives.Stretch(io.BytesIO(b"??" + data), 2, len(data), a, b), rng.choice([1, 3, 64])).read() for a, b in zip(cuts, cuts[1:], strict=False))
        assert got == data


SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c></row>
<row r="6"><c r="A6" t="s"><v>1</v></c><c r="C6" t="inlineStr"><is><t>Height (min)</t></is></c><c r="D6" t="s"><v>1</v></c><c r="AA6" t="s"><v>2</v></c></row>
<row r="7"><c r="A7" t="s"><v>3</v></c><c r="C7"><v>20.0</v></c><c r="D7" t="b"><v>1</v></c><c r="AA7" t="str"><f>A1</f><v>No</v></c></row>
<row r="9"><c r="C9"><v>1.5</v></c><c r="D9" t="e"><v>#N/A</v></c></row><row r="10"/></sheetData></worksheet>"""


def test_workbooks_of_other_writers(spark, tmp_path):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    strings = ["note", "Botanical Name", "Is Cultivar"]
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Plants" r:id="rId7"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="rId7" Target="/xl/worksheets/s.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}">' + "".join(f"<si><t>{x}</t></si>" for x in strings) + "<si><r><t>Salvia </t></r><r><t>apiana</t></r><rPh><t>no</t></rPh></si></sst>",
        "xl/worksheets/s.xml": SHEET,
    }
    path = packed(tmp_path / "p.xlsx", parts, zipfile.ZIP_DEFLATED)
    df = workbooks.workbook(spark, path, "Plants", 5)
    assert df.columns[:4] == ["Botanical Name", "column_1", "Height (min)", "Botanical Name.1"] and df.columns[26] == "Is Cultivar" and len(df.columns) == 27
    got = [(r[0], r[2], r[3], r[26]) for r in df.collect()]
    assert got == [("Salvia apiana", "20", "true", "No"), (None, "1.5", None, None)]
    plant = tables.plant_export(spark, path).collect()
    assert [(p.scientific_name, p.height_min, p.is_cultivar) for p in plant] == [("Salvia apiana", 20.0, False)]


def order(key, seed):
    return int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("k", [0, 1, 17, 999, 1000, 5000])
def test_exact_samples_are_the_same_on_any_partitioning(spark, k):
    df = spark.range(1000).withColumn("more", F.lit("x"))
    want = sorted(sorted(range(1000), key=lambda i: (order(i, 4), i))[:k])
    for parts in (1, 7):
        assert sorted(r.id for r in sampling.exact_sample(df.repartition(parts), ["id"], k, 4).collect()) == want


def test_samples_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None,)] * 5 + [(7,)] * 20 + [(8,)], "id long")
    for k in (1, 6, 20, 25, 26, 99):
        assert sampling.exact_sample(df, ["id"], k).count() == min(k, 26)
    assert sampling.exact_sample(df.limit(0), ["id"], 3).count() == 0


def test_weighted_end(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(1 << 60), rng.randint(0, 9)) for _ in range(200)] + [(5, 3), (5, 4)]
    df = spark.createDataFrame(rows, "h long, w long")
    for need in (1, 7, 8, 300, 600):
        total, want = 0, None
        for h in sorted({h for h, _ in rows}):
            here = sum(w for x, w in rows if x == h)
            if total + here >= need:
                want = (h, total)
                break
            total += here
        assert sampling.end_of(df, "h", need, F.col("w")) == want
    assert sampling.end_of(df, "h", 10**6, F.col("w")) is None


def test_clusters_are_taken_whole(spark):
    df = spark.createDataFrame([(k, None if k % 10 == 0 else k % 10) for k in range(1000)], "id long, shard long")
    every = sorted({None, *range(1, 10)}, key=lambda s: order(s, 9))
    chosen = every[:3]
    got = sampling.cluster_sample(df, "shard", ["id"], 250, 10_000, 9).collect()
    assert len(got) == 300 and {r.shard for r in got} == set(chosen)
    assert sampling.cluster_sample(df, "shard", ["id"], 250, 20, 9).count() == 20
    assert sampling.cluster_sample(df, "shard", ["id"], 10**6, 10**6, 9).count() == 1000


def test_projection_reports_what_fails(spark, tmp_path):
    for k in range(3):
        spark.range(k * 100, k * 100 + 100).withColumn("extra", F.lit(k)).coalesce(1).write.option("parquet.block.size", 1024).parquet(str(tmp_path / f"s{k}"))
    spark.range(5).withColumn("name", F.lit("a")).coalesce(1).write.parquet(str(tmp_path / "s3"))
    broken = next((tmp_path / "s1").glob("*.parquet"))
    data = bytearray(broken.read_bytes())
    data[4:60] = b"\xff" * 56  # the first page; the footer is sound
    broken.write_bytes(bytes(data))
    (tmp_path / "cut.parquet").write_bytes(b"PAR1")
    rows, failures = projection(spark, str(tmp_path), "id bigint, name string", target_bytes=100)
    failed = {(r.shard_path, r.row_group is None) for r in failures.collect()}
    assert failed == {("cut.parquet", True), (broken.name, False)}
    got = rows.collect()
    assert {r.id for r in got if r.name is None} >= {*range(100), *range(200, 300)} and sum(r.name == "a" for r in got) == 5
    none, failures = projection(spark, [], "id bigint")
    assert none.count() == failures.count() == 0


def test_readers_see_the_old_or_the_new_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        replaced.current(spark, folder)
    one = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id long, x string")
    assert replaced.replace(one, folder) and not replaced.replace(one.repartition(3), folder)
    before = replaced.current(spark, folder)
    assert replaced.replace(one.limit(2), folder)
    assert before.count() == 3 and replaced.current(spark, folder).count() == 2
    assert len(list((tmp_path / "t/versions").iterdir())) == 2 and not list((tmp_path / "t").glob("*.tmp"))
    assert replaced.replace(one.withColumnRenamed("x", "y"), folder) and replaced.replace(one.limit(0), folder)
    assert replaced.tidied(spark, folder, keep=1) == 2 and replaced.current(spark, folder).columns == ["id", "x"] and replaced.tidied(spark, folder, keep=1) == 0


def test_digest_of_content(spark):
    d = lambda rows, schema="id long, x string": replaced.digest(spark.createDataFrame(rows, schema))
    assert d([(1, "a"), (2, "b")]) == d([(2, "b"), (1, "a")]) != d([(1, "a")])
    assert d([(1, "a"), (1, "a")]) != d([]) != d([(None, None)]) != d([(1, "a")] * 4) and d([(1, None)]) != d([(None, "1")])


def test_raw_input_is_kept_once(tmp_path):
    (tmp_path / "in.csv").write_text("a")
    at = replaced.archived(str(tmp_path / "in.csv"), str(tmp_path / "raw"))
    assert Path(at).read_text() == "a" and replaced.archived(str(tmp_path / "in.csv"), str(tmp_path / "raw")) is None
    (tmp_path / "in.csv").write_text("b")
    assert replaced.archived(str(tmp_path / "in.csv"), str(tmp_path / "raw")) and len(list((tmp_path / "raw").iterdir())) == 2


T0 = datetime(2026, 1, 1)


@pytest.fixture
def timers(spark):
    before = spark.conf.get(jobs.STORE)
    jobs.with_timers(spark)
    yield spark
    spark.conf.set(jobs.STORE, before)


def test_jobs_end_once_whatever_comes_late_or_twice(timers, tmp_path):
    spark, events = timers, str(tmp_path / "events")

    def run(*rows):
        spark.createDataFrame([(j, T0 + timedelta(minutes=m), kind, status, k) for k, (j, m, kind, status) in enumerate(rows)], jobs.EVENTS).coalesce(1).write.mode("append").parquet(events)
        stream = jobs.tracked(spark.readStream.schema(jobs.EVENTS).parquet(events), poll=600, expire=3600, keep=7200)
        stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out")).awaitTermination()
        got = spark.read.schema(jobs.ACTIONS).parquet(str(tmp_path / "out")).collect()
        return {j: sorted((r.action, r.status) for r in got if r.job == j and r.action != "poll") for j in {r.job for r in got}}, sum(r.action == "poll" for r in got)

    first, polls = run(("a", 0, "submit", None), ("a", 5, "answer", "RUNNING"), ("b", 0, "submit", None), ("c", 1, "submit", None), ("x", 2, "answer", "SUCCEEDED"), ("d", 9, "answer", "FAILED"), ("d", 3, "submit", None))
    assert first == {"a": [("submitted", None)], "b": [("submitted", None)], "c": [("submitted", None)], "d": [("failed", "FAILED"), ("submitted", None)]}
    second, polls = run(("a", 30, "answer", "SUCCEEDED"), ("a", 31, "answer", "SUCCEEDED"), ("a", 32, "answer", "FAILED"), ("a", 33, "submit", None), ("b", 40, "answer", "KILLED"), ("d", 41, "answer", "SUCCEEDED"))
    assert second["a"] == [("ready", "SUCCEEDED"), ("submitted", None)] and second["b"] == [("failed", "KILLED"), ("submitted", None)] and second["d"] == first["d"] and polls >= 1
    third, _ = run(("c", 90, "answer", "SUCCEEDED"), ("e", 95, "submit", None))
    assert third["c"] == [("expired", None), ("submitted", None)] and "x" not in third
    fourth, _ = run(("e", 400, "answer", "SUCCEEDED"), ("a", 401, "submit", None))
    assert fourth["e"] == [("expired", None), ("submitted", None)] and fourth["a"] == [("ready", "SUCCEEDED"), ("submitted", None), ("submitted", None)]


def test_a_live_service_is_polled_and_its_result_downloaded(timers, tmp_path):
    spark, events, out = timers, str(tmp_path / "events"), str(tmp_path / "out")
    (tmp_path / "status").mkdir()
    (tmp_path / "data.jpg").write_bytes(b"result")
    jobs.submitted(spark, events, ["j1", "j2"])
    (tmp_path / "status/j1").write_text('{"status": "RUNNING"}')
    (tmp_path / "status/j2").write_text('{"status": "FAILED"}')
    query = jobs.run(spark, events, out, f"{tmp_path}/status/{{job}}", poll=1, expire=600)
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not list(Path(out).glob("outcomes/batch=*/*.parquet")):
            if list(Path(out).glob("facts/batch=*/*.parquet")):
                (tmp_path / "status/j1").write_text(json.dumps({"status": "SUCCEEDED", "downloadLink": f"{tmp_path}/data.jpg", "totalRecords": 6}))
            time.sleep(0.5)
            assert query.exception() is None
        time.sleep(2)
    finally:
        query.stop()
    got = [r for r in spark.read.parquet(f"{out}/outcomes").collect()]
    assert [(r.status, r.size_bytes) for r in got] == [("ok", 6)]
    beside = json.loads(Path(got[0].path).with_suffix(".json").read_text())
    assert beside["job"] == "j1" and json.loads(beside["facts"])["totalRecords"] == 6
    assert {(r.job, r.action) for r in spark.read.parquet(f"{out}/actions").where("action IN ('ready', 'failed')").collect()} == {("j1", "ready"), ("j2", "failed")}


def test_job_outcomes_of_the_query(spark, sf_dir):
    assert job_outcomes(spark, sf_dir).groupBy("job").count().where("count > 1").count() == 0
