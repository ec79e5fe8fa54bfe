import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidewell.operators import gating, interactions, manifest, network, versioned
from tidewell.operators import relational as rel
from tidewell.operators.vectors import nearest
from tidewell.sources import predicates, sinks, tables
from tidewell.sources.rest import PagedSource, get_json

T, S = interactions.PLANT_IS_TARGET[0], interactions.PLANT_IS_SOURCE[0]


def test_interactions(spark):
    schema = "id int, sourceTaxonId string, sourceTaxonName string, targetTaxonId string, targetTaxonName string, interactionTypeId string, decimalLatitude double, decimalLongitude double, localityName string"
    rows = [
        (1, "a", "bee", "p", "plant", T, 32.53, -124.55, None),  # on the edge of the box
        (2, "a", "bee", "p", "plant", T, 32.52, -120.0, None),
        (3, "p", "plant", "a", "bee", T, 35.0, -120.0, None),  # the plant on the wrong side
        (4, "p", "plant", "a", "bee", S, None, None, "Kern, California"),
        (5, None, "bee", "p", "plant", T, 35.0, -120.0, None),  # null key: never refuted
        (6, "r", "bee", "p", "plant", T, 35.0, -120.0, None),  # refuted
        (7, "a", "bee", "p", "plant", T, None, None, None),
        (8, "a", "bee", "p", "plant", T, 35.0, -120.0, "Baja California"),
        (9, "a", "bee", "p", "plant", "other", 35.0, -120.0, None),
    ]
    df = spark.createDataFrame(rows, schema)
    refuted = spark.createDataFrame([("r", "p", T, "doi"), (None, "p", T, "doi")], "sourceTaxonId string, targetTaxonId string, interactionTypeId string, referenceDoi string")
    area = interactions.in_area(F.col("decimalLatitude"), F.col("decimalLongitude"), F.col("localityName"))
    listed = spark.createDataFrame([("plant",), ("plant",)], "scientific_name string")
    assert sorted(r.id for r in interactions.select_interactions(df, listed, refuted, area).collect()) == [1, 4, 5, 8]


def test_rules(spark, tmp_path):
    (tmp_path / "rules.csv").write_text("level,name,flying,notes\norder,Hymenoptera,true,winged\nfamily,Formicidae,false,ants\norder,Coleoptera,unknown,see families\nfamily,Meloidae,true,blister\nclass,Mammalia,false,no\norder,Chiroptera,true,bats\ntribe,X,true,\n")
    rules = gating.parsed_rules(tables.rules(spark, str(tmp_path / "rules.csv")))
    rows = [("Insecta", "Hymenoptera", "Formicidae"), ("Insecta", "Hymenoptera", "Apidae"), ("Insecta", "Coleoptera", "Carabidae"), ("Insecta", "Coleoptera", " meloidae "), ("Mammalia", "Chiroptera", None), ("Mammalia", "Rodentia", None), ("Insecta", "Orthoptera", None)]
    df = spark.createDataFrame([(k, *r, 1 if k else None, None if k != 1 else "x") for k, r in enumerate(rows)], "k int, class string, order string, family string, ca_inat_count int, error string")
    got = gating.with_verdict(gating.with_rule(df, rules)).orderBy("k").collect()
    assert [r.is_flying for r in got] == [False, True, False, True, True, False, False]
    assert [r.flight_rule.split(";")[0] for r in got] == ["family=formicidae", "order=hymenoptera", "order=coleoptera", "family=meloidae", "order=chiroptera", "class=mammalia", "no rule matched"]
    assert got[0].exclusion_reason == "not_flying; no_CA_iNat_observation" and got[1].kept and got[1].exclusion_reason == ""


def test_relational(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "z", 3), (None, "w", 4)], "k int, v string, o int")
    assert sorted(r.v for r in rel.keep_first(a, ["k"], [F.col("o")]).collect()) == ["x", "z"]
    assert sorted(r.v for r in rel.keep_best(a, ["k"], "o", "v").collect()) == ["w", "y"]
    b = spark.createDataFrame([(1, "new"), (2, "more")], "k int, v string")
    merged = rel.merge_first([a, b], ["k"], [F.col("o")]).collect()
    assert sorted((r.k or 0, r.v) for r in merged) == [(0, "z"), (1, "x"), (2, "more")]
    up = rel.upsert(a, spark.createDataFrame([(1, None)], "k int, v string"), "k", ["v"]).orderBy("o").collect()
    assert [r.v for r in up] == [None, None, "z", "w"]
    lookup = spark.createDataFrame([(1, "l1", 1), (1, "l2", 2), (None, "n", 3)], "k int, v string, p int")
    done = rel.patched(a, lookup, ["k"], [F.col("p")]).orderBy("o").collect()
    assert [r.v for r in done] == ["l1", "l1", "n", "n"]
    assert [r.n for r in rel.numbered(spark.range(50).repartition(7), ["id"], "n").orderBy("id").collect()] == list(range(50))
    assert rel.coverage(a, ["k"]).first().k == 50.0 and rel.coverage(a.limit(0), ["k"]).first().k == 0.0
    kept = rel.conditional_semi(a.withColumn("role", F.expr("CASE WHEN o < 3 THEN 'plant' WHEN o = 3 THEN NULL ELSE 'x' END")), F.col("role") == "plant", "v", spark.createDataFrame([("x",)], "n string"), "n")
    assert sorted(r.v for r in kept.collect()) == ["w", "x", "z"]
    replaced = rel.replace_slice(a, b, F.col("k") == 1).collect()
    assert sorted(r.v for r in replaced) == ["more", "new", "w", "z"]


def test_manifest(spark):
    occ = spark.createDataFrame([(1, "A b L.", 7, "SPECIES", "A b", "A", None, None, 1.0, 2.0, "2020", "CC0", "occ holder", "me", "https://i/observations/9", "F", "here"), (2, "B", 8, "GENUS", None, "B", None, None, 1.0, 2.0, "2020", None, None, None, None, "Formicidae", None)], "gbifID long, scientificName string, taxonKey long, taxonRank string, species string, genus string, infraspecificEpithet string, cultivarEpithet string, decimalLatitude double, decimalLongitude double, eventDate string, license string, rightsHolder string, recordedBy string, occurrenceID string, family string, verbatimLocality string")
    good = "https://static.inaturalist.org/photos/1/square.jpg"
    med = spark.createDataFrame([(1, "StillImage", good, None, "CC-BY", None, "c"), (1, "Sound", good, None, None, None, None), (2, "stillimage", good, None, None, None, None), (2, "StillImage", None, good, None, None, None), (3, "StillImage", good, None, None, None, None), (2, None, good, None, None, None, None)], "gbifID long, type string, identifier string, references string, license string, rightsHolder string, creator string")
    names = spark.createDataFrame([("zed", 8), ("abc", 8), ("none", None)], "name string, taxon_key long")
    got = {r.gbif_occurrence_id: r for r in manifest.build(med, occ, names, "plant", F.lit("now")).collect()}
    assert set(got) == {1, 2}
    assert got[1].license == "CC-BY" and got[1].rights_holder == "occ holder" and got[1].taxon_name == "A b" and got[1].inat_observation_id == 9
    assert got[2].taxon_name == "zed" and got[2].image_url_large.endswith("/large.jpg")
    assert manifest.without_family(occ).count() == 1
    assert manifest.still_images(med.drop("type")).count() == 6


def test_network(spark):
    rows = [("p1", "a1", "O1", None), ("p1", "a1", "O1", "F"), ("p1", "a2", "O2", None), ("p2", "a1", None, None), (None, "a3", "O3", None)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "ordinal int, plant_name string, animal_name string, animal_order string, animal_family string")
    rich = {r.plant_name: r for r in network.richness(df).collect()}
    assert rich["p1"].top_pollinator_orders == "O1; O2" and rich["p1"].globi_pollinator_count == 2 and rich["p2"].top_pollinator_orders is None
    g = {r.animal_name: r for r in network.generalists(df, "ordinal").collect()}
    assert g["a1"].n_distinct_plants == 2 and g["a1"].animal_family == "F" and g["a3"].n_records == 0
    s = network.stats(df.where("plant_name IS NOT NULL")).first()
    assert (s.n_plant_nodes, s.n_pollinator_nodes, s.n_unique_edges) == (2, 2, 3) and s.bipartite_density == 0.75
    assert network.stats(df.limit(0)).first().bipartite_density == 0.0


def test_versioned(spark):
    t = versioned.SWAPPED_BEFORE
    rows = [(f"embeddings_{run}_000001.parquet" if run else "embeddings_000001.parquet", 0.1, 0.9) for run in ("20260524T070915", t, "20260524T070917", "")] + [("embeddings_20260101T000000_000002.parquet", 0.1, 0.9)]
    shards = spark.createDataFrame(rows, f"shard_path string, {versioned.FLOWERING} double, {versioned.FRUITING} double")
    log = spark.createDataFrame([("fix swap in data/embeddings_20260101T000000_000002.parquet",), ("add embeddings_20260524T070915_000001.parquet",)], "value string")
    got = {r.shard_path: r[versioned.FLOWERING] for r in versioned.corrected(shards, versioned.fixed_shards(log)).collect()}
    assert list(got[r[0]] for r in rows) == [0.9, 0.1, 0.1, 0.9, 0.1]
    assert versioned.swapped(shards.drop(versioned.FRUITING), F.lit(True)).count() == 5


def test_nearest(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)], "q long, v array<double>")
    t = spark.createDataFrame([(1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "t long, w array<double>")
    assert [(r.q, r.rank, r.t) for r in nearest(q, t, 2, "q", "v", "t", "w").orderBy("rank").collect()] == [(1, 1, 1), (1, 2, 2)]
    assert nearest(q, t.limit(0), 2, "q", "v", "t", "w").count() == 0


def test_nearest_in_cells_of_both_sides(spark, monkeypatch):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(90, 4)).astype(np.float32).astype(float)
    t = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "t long, w array<double>").repartition(5)
    q = t.where("t % 10 = 0").withColumnsRenamed({"t": "q", "w": "v"})
    seen, kind, real = [], type(t), type(t).collect
    monkeypatch.setattr(kind, "toPandas", lambda df: pytest.fail("a whole table goes to the driver"))
    monkeypatch.setattr(kind, "collect", lambda df: seen.append(real(df)) or seen[-1])
    got = real(nearest(q, t, 3, "q", "v", "t", "w", block=7, cell_bytes=100))
    assert sum(map(len, seen)) <= 2  # rows of counts
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(a, r + 1, int(b)) for a in range(0, 90, 10) for r, b in enumerate(np.argsort(1 - unit[a] @ unit.T, kind="stable")[:3])}
    assert {(r.q, r["rank"], r.t) for r in got} == want and len(got) == 27


def test_nearest_ties_and_odd_rows(spark):
    same = [(k, [1.0, 2.0]) for k in range(40)] + [(99, None), (98, [0.0, 0.0]), (None, [1.0, 2.0])]
    t = spark.createDataFrame(same, "t long, w array<double>").repartition(7)
    q = spark.createDataFrame([(1, [2.0, 4.0]), (2, None), (3, [0.0, 0.0]), (4, [-1.0, 0.0])], "q long, v array<double>")
    got = nearest(q, t, 3, "q", "v", "t", "w", block=4, cell_bytes=64).collect()
    assert sorted((r.q, r["rank"], r.t) for r in got) == [(a, k + 1, k) for a in (1, 4) for k in range(3)]


def test_nearest_over_blocks_equals_brute_force():
    import numpy as np

    from tidewell.operators.vectors import _top

    rng = np.random.default_rng(7)
    for dim, k, block in ((1, 3, 4), (2, 5, 9), (3, 7, 16), (2, 1, 5), (2, 40, 8)):  # in few dimensions most are tied
        t = rng.integers(-2, 3, size=(90, dim)).astype(float)
        t = t[np.abs(t).sum(1) > 0]
        t /= np.linalg.norm(t, axis=1)[:, None]
        ids = rng.permutation(1000)[: len(t)]
        d = np.round(1 - t[:20] @ t.T, 12)
        want = [(a, int(ids[b]), d[a, b]) for a in range(20) for b in sorted(range(len(t)), key=lambda b: (d[a, b], ids[b]))[:k]]  # noqa: B023
        assert [(int(a), int(b), c) for a, b, c in zip(*_top(t[:20], ids, t, k, block), strict=True)] == want


def test_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("occurrence.txt", "gbifID\tname\n1\tx\n2\ty\n")
    got = tables.archive_tables(spark, str(tmp_path / "a.zip"), {"occurrence.txt": "gbifID long, name string", "multimedia.txt": "gbifID long"}, {"occurrence.txt": ["name"]})
    assert [r.name for r in got["occurrence.txt"].orderBy("name").collect()] == ["x", "y"] and got["multimedia.txt"].count() == 0
    (tmp_path / "plants.csv").write_text("\n" * 0 + "a\nb\nc\nd\ne\nBotanical Name,Common Name,Height (min),Is Cultivar\nSalvia apiana,White Sage,20 - 30 ft,No\n ,blank,,\n")
    plants = tables.plant_export(spark, str(tmp_path / "plants.csv")).collect()
    assert len(plants) == 1 and plants[0].height_min == 20.0 and plants[0].rank == "species" and plants[0].is_cultivar is False
    (tmp_path / "keys.json").write_text(json.dumps({"n_names": 2, "name_to_taxon_key": {"a": 1, "b": None}}))
    assert sorted((r.name, r.taxon_key) for r in tables.key_dictionary(spark, str(tmp_path / "keys.json")).collect()) == [("a", 1), ("b", None)]
    photos = tmp_path / "img" / "001"
    photos.mkdir(parents=True)
    for name, text in {"1_ab.jpg": "x", "1_ab.json": '{"url": "u1"}', "2_cd.jpg": "yy", "2_cd.json": "{bad", "x.jpg": "z", "3.tmp": "t"}.items():
        (photos / name).write_text(text)
    assert sorted((r.gbif_occurrence_id, r.url) for r in tables.images(spark, str(tmp_path / "img")).collect()) == [(1, "u1"), (2, None)]
    sinks.provenance(spark, str(tmp_path / "log"), "result", n=3)
    assert tables.event_log(spark, str(tmp_path / "log")).first().n == 3
    sinks.bounded_shards(spark.range(25).coalesce(1), str(tmp_path / "sh"), "r1", 10)
    shards = tables.shards(spark, str(tmp_path / "sh"), ["id", "absent"])
    assert shards.select("shard_path").distinct().count() == 3 and shards.columns == ["id", "shard_path"]


def test_paged_source(spark, tmp_path):
    for n, ids in enumerate([[1, 2], [3], []]):
        (tmp_path / f"page_{n}.json").write_text(json.dumps({"results": [{"id": i, "taxon": {"name": f"t{i}"}} for i in ids]}))
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged").option("base", str(tmp_path)).option("pages", "3").schema("id bigint, taxon string").load()
    assert sorted(r.id for r in df.collect()) == [1, 2, 3]
    assert df.select(F.get_json_object("taxon", "$.name")).first()[0].startswith("t")
    assert spark.read.format("paged").option("base", str(tmp_path)).option("pages", "1").schema("id bigint").load().count() == 2


@pytest.mark.parametrize("parts", [1, 3, 20])
@pytest.mark.parametrize("said", [{}, {"total_results": 28, "per_page": 2}, {"total_results": 28}])
def test_paged_source_finds_its_end(spark, tmp_path, parts, said):
    for n in range(14):
        (tmp_path / f"page_{n}.json").write_text(json.dumps({"results": [{"id": 2 * n}, {"id": 2 * n + 1}], **said}))
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged").option("base", str(tmp_path)).option("partitions", parts).schema("id bigint").load()
    assert sorted(r.id for r in df.collect()) == list(range(28))


def test_retries():
    import io
    import urllib.error

    waits, answers = [], [urllib.error.HTTPError("u", 429, "", {"Retry-After": "2"}, None), urllib.error.HTTPError("u", 503, "", {}, None), io.BytesIO(b'{"ok": 1}')]

    def opener(address, timeout):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert get_json("u", opener=opener, sleep=waits.append) == {"ok": 1} and waits[0] == 2.0
    with pytest.raises(urllib.error.HTTPError):
        get_json("u", opener=lambda *a, **k: (_ for _ in ()).throw(urllib.error.HTTPError("u", 400, "", {}, None)), sleep=waits.append)


def test_predicates(spark):
    df = spark.createDataFrame([("US", 1), ("MX", 2), ("US", 3)], "country string, taxon_key int")
    tree = predicates.all_of(predicates.equals("COUNTRY", "US"), predicates.one_of("TAXON_KEY", [1, 2]))
    assert df.where(predicates.as_column(tree)).count() == 1
    with pytest.raises(ValueError):
        predicates.as_column({"type": "near"})


def test_row_numbers_of_many_wide_rows(spark):
    df = spark.range(400_000).selectExpr("hash(id) AS k", "id", "concat('row ', id, repeat('x', 40)) AS text")
    for pieces in (None, 16):
        found = rel.numbered(df, ["k", "id"], "n", pieces).agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n"), F.count_distinct("id")).first()
        assert tuple(found) == (400_000, 400_000, 0, 399_999, 400_000)


def test_rows_that_survive_dont_depend_on_the_columns_read(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\tc\n1\t2\t3\n4\t5\n6\t7\t8\t9\n")
    for schema in (None, "a int, b int, c int"):
        df = tables.tsv(spark, str(tmp_path / "t.tsv"), schema)
        assert df.count() == df.select("a").count() == df.select("c").count() == len(df.collect()) == 1 and df.columns == ["a", "b", "c"]


def test_plant_export_with_line_breaks_in_cells(spark, tmp_path):
    lines = ["about", "", "x", "y", "z", "Botanical Name,Tips,Height (min)", 'Salvia alba,"line one\nline two, ""so""",3 ft', "Acer rubrum,,"]
    (tmp_path / "p.csv").write_text("\n".join(lines))
    got = {r.scientific_name: r.tips for r in tables.plant_export(spark, str(tmp_path / "p.csv")).collect()}
    assert got == {"Salvia alba": 'line one\nline two, "so"', "Acer rubrum": None}


def test_generated_names_leave_users_columns_alone(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "b", 2), (2, "c", 3)], "id long, __part string, __rank int")
    assert sorted(map(tuple, rel.numbered(df, ["id"]).collect())) == [(1, "b", 2, 0), (2, "c", 3, 1), (3, "a", 1, 2)]
    assert [tuple(r) for r in rel.top_per_group(df, [], [F.col("id")], 1).collect()] == [(1, "b", 2)]


def test_running_least_over_ranges(spark):
    # One key fills many ranges, with the least value far before; another has no value at all.
    rows = [("a", k, 1000 - k if k % 50 == 7 else None) for k in range(400)] + [("b", k, None) for k in range(5)] + [(None, k, k + 3) for k in range(5)]
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(3)
    got = {(r.k, r.at): r.least for r in rel.running_least(df, ["k"], [F.col("at")], "v").collect()}
    least = lambda k, at: min((v for x, a, v in rows if x == k and a <= at and v is not None), default=None)
    assert got == {(k, at): least(k, at) for k, at, _ in rows}


def test_picked_photos(spark):
    rows = [(1, 10, 5, [(None,), (" ",)]), (1, 11, 4, [("",), ("https://static.inaturalist.org/2/square.jpg",)]), (1, 12, 4, [("https://x/y.jpg",)]), (2, 13, None, [("https://x/square.png",)]), (3, 14, 9, []), (3, 15, 9, None)]
    df = spark.createDataFrame(rows, "taxon_id long, observation_id long, votes int, photos array<struct<url: string>>")
    got = sorted(map(tuple, manifest.picked_photos(df).collect()), key=repr)
    assert got == [(1, 11, 4, "https://static.inaturalist.org/2/large.jpg"), (2, 13, None, "https://x/square.png")]


def test_open_work(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "  ")], "id long, name string")
    assert sorted(r.id for r in rel.open_work(df, "name").collect()) == [2, 3] and rel.open_work(df, "name", False).count() == 3
    assert rel.open_work(df, "id").count() == 0
