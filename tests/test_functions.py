import pytest
from pyspark.sql import functions as F

from tidewell.functions import files, names, tensors


def values(spark, column, rows):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x string")
    return [r.v for r in df.select("k", column(F.col("x")).alias("v")).orderBy("k").collect()]


def test_first_number(spark):
    assert values(spark, names.first_number, ["20 - 236 ft", "-5.5 cm", "abc", None, "", ".5", "1,200 ft"]) == [20.0, -5.5, None, None, None, 5.0, 1.0]


def test_lenient_long(spark):
    assert values(spark, names.lenient_long, ["12", "12.0", "12.5", "x", None, ""]) == [12, 12, None, None, None, None]


def test_tri_state(spark):
    assert values(spark, names.tri_state, [" Yes", "0", "maybe", None, "TRUE", "No "]) == [True, False, None, None, True, False]


def test_derived_rank(spark):
    cases = {"Salvia apiana": "species", "Salvia apiana var. compacta": "variety", "A b ssp. x": "subspecies", "A b subsp. x": "subspecies", "Genus sp f. alba": "form", "Quercus × alvordiana": "hybrid", "A x b": "hybrid", "Salvia": "genus", "Salvia 'Bee's Bliss'": "unknown", "": "unknown", None: "unknown", "A B": "unknown", "A été": "species"}
    assert values(spark, names.derived_rank, list(cases)) == list(cases.values())


def test_name_variants(spark):
    got = values(spark, names.name_variants, ["A b VAR. c", "A × b", "A b", None, "A x b c", " "])
    assert got == [["A b VAR. c", "A b"], ["A × b", "A  b", "A ×"], ["A b"], [], ["A x b c", "A b c", "A x"], []]


@pytest.mark.parametrize(
    "parts,want",
    [
        (("VARIETY", "A b", "A", "c", None, None), "A b var. c"),
        (("SUBSPECIES", "A b", "A", "c", None, None), "A b subsp. c"),
        (("forma", "A b", "A", "c", None, None), "A b f. c"),
        (("CULTIVAR", None, "A", None, "Gold", None), "A 'Gold'"),
        (("VARIETY", "A b", "A", None, None, None), "A b"),
        (("GENUS", None, "A", None, None, None), "A"),
        (("FAMILY", None, None, None, None, "Xidae L."), "Xidae L."),
        ((None, " ", "", None, None, None), ""),
    ],
)
def test_clean_name(spark, parts, want):
    df = spark.createDataFrame([parts], "a string, b string, c string, d string, e string, f string")
    assert df.select(names.clean_name(*(F.col(c) for c in "abcdef"))).first()[0] == want


def test_locality(spark):
    cases = {"Calif.": False, "x Calif.coast": True, "ca. 5 mi N": True, "CAñon": True, "éCA": True, "CAlt": False, None: False, "California": True, "Baja California": False, "Northern Baja  California, CA": False}
    assert values(spark, names.in_state, list(cases)) == list(cases.values())


def test_photo_addresses(spark):
    cases = {
        "https://static.inaturalist.org/photos/1/square.jpg": "https://static.inaturalist.org/photos/1/large.jpg",
        "https://inaturalist-open-data.s3.amazonaws.com/photos/1/SQUARE.JPEG?1": "https://inaturalist-open-data.s3.amazonaws.com/photos/1/large.JPEG?1",
        "https://example.org/photos/1/small.png": None,
        None: None,
    }
    assert values(spark, files.photo_url, list(cases)) == list(cases.values())
    assert values(spark, files.extension, ["a/b.JPEG?1", "a/b.png", "a/b", "x.webp?y=1.2"]) == ["jpg", "png", "jpg", "jpg"]
    assert values(spark, files.leading_id, ["a/123_ab.jpg", "123.jpg", "x.jpg", None]) == [123, 123, None, None]
    assert values(spark, files.sidecar_url, ['{"url":"u"}', '{"image_url_large":"l","url":"u"}', "{bad", None, "{}"]) == ["u", "l", None, None, None]


def test_tensors(spark):
    df = spark.createDataFrame([([0.5, -1.25, 2.0, 0.0],), (None,)], "v array<float>")
    rows = df.select(tensors.unpack_half(tensors.pack_half("v")).alias("v"), tensors.packed_fits(tensors.pack_half("v"), F.array(F.lit(2), F.lit(2))).alias("ok")).collect()
    assert rows[0].v == [0.5, -1.25, 2.0, 0.0] and rows[0].ok and rows[1].v is None
    tokens = spark.createDataFrame([(list(range(11)),)], "t array<int>")
    grid = tokens.select(tensors.token_grid(F.col("t"), 2, 3).alias("g")).first().g
    assert grid.cls == 0 and grid.patches == [[5, 6, 7], [8, 9, 10]]
    with pytest.raises(Exception, match="fit"):
        tokens.select(tensors.token_grid(F.col("t"), 2, 4)).collect()
    b = spark.range(1).select(tensors.to_byte(F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("same"), tensors.to_byte(F.lit(3.0), F.lit(1.0), F.lit(2.0)).alias("over")).first()
    assert (b.same, b.over) == (0, 255)
