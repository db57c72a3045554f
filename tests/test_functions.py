import pytest
from pyspark.sql import functions as F

from quadrille.functions import geo, numbers, rules, text, zones


def test_text_key(column):
    given = ["Année du financement - agrément", None, "  Où? ", "été", "___", "Œuvre n°2"]
    assert column(given, text.text_key) == ["annee_du_financement_agrement", "", "ou", "ete", "", "uvre_n_2"]
    assert column([None], lambda c: text.text_key(c, null="nan")) == ["nan"]


def test_text_key_any_script(column):
    assert column(["ﬁn", "Ｐａｒｉｓ ½"], lambda c: text.text_key(c, any_script=True)) == ["fin", "paris_1_2"]


def test_headers():
    assert text.fold_header(" Année du financement - agrément ") == "annee_du_financement_agrement"
    assert text.fold_place_header("Numéro d’arrondissement") == "numero_d’arrondissement"


def test_geo_name_and_name_key(column):
    assert column(["Saint-Germain_l'Auxerrois", None, " Élysée "], text.geo_name) == [
        "saint germain l'auxerrois", "inconnu", "elysee",
    ]
    assert column(["Père-Lachaise", None], text.name_key) == ["PERE LACHAISE", ""]


def test_numbers(column):
    given = ["1 234,5", "1 000", "abc", None, "nan", "inf", "1e3", "1.0d", " 7 ", "-3", ""]
    assert column(given, numbers.lenient_number) == [1234.5, 1000, None, None, None, None, 1000, None, 7, -3, None]
    assert column(["1,5", "1.5", " 2 "], numbers.as_number) == [None, 1.5, 2.0]
    assert column(["2.0", "2.5", "x"], lambda c: numbers.whole(numbers.as_number(c))) == [2, None, None]


def test_half_even(column):
    assert column([2.5, 0.5, -1.5, None], lambda c: numbers.half_even(c, 0), "double") == [2, 0, -2, None]
    assert column([0.125, 0.375], lambda c: numbers.half_even(c, 2), "double") == [0.12, 0.38]


def test_ratios(spark):
    row = spark.range(1).select(
        numbers.unit_price(F.lit(410000.0), F.lit(31.0)).alias("p"),
        numbers.years_of_rent(F.lit(6000.0), F.lit(25.0)).alias("y"),
        numbers.percent_change(F.lit(3.0), F.lit(4.0)).alias("c"),
        numbers.percent_change(F.lit(0.0), F.lit(4.0)).alias("z"),
        numbers.mean_available(F.lit(2.0), F.lit(None).cast("double"), F.lit(4.0)).alias("m"),
        numbers.mean_available(F.lit(None).cast("double")).alias("n"),
        numbers.clip(F.lit(None).cast("double"), 0, 1).alias("k"),
    ).first()
    assert round(row.p, 2) == 13225.81 and row.y == 20.0 and row.c == 33.3333
    assert row.z is None and row.m == 3.0 and row.n is None and row.k is None


def test_zone(column):
    given = ["7", "7.0", "75007", "21", None, "07", "20", "0", "100", "75021", "7,0", "7507", "75120", "x"]
    assert column(given, zones.zone2) == ["07", "07", "07", None, None, "07", "20", None, None, None, "07", None, None, None]
    assert column(["75007", "3"], lambda c: zones.zone2(c, postal=False)) == [None, "03"]


def test_zone_published(column):
    assert column(["1", "1.0", "01", "Paris", "", "75001"], zones.zone2_published) == ["01", "01", "01", "Paris", "", "75001"]


def test_codes(column):
    assert column(["7500112", "75001.0", "12", "n° 5", "x"], lambda c: zones.digits_padded(c, 5)) == [
        "7500112", "75001", "00012", "00005", None,
    ]
    assert column(["75101", "75116", "75120", "92044"], zones.zone_of_commune) == ["01", "16", "20", ""]
    assert column(["7510702", "7512199"], zones.zone_from_insee) == ["07", None]
    assert column(["75011.0", "x"], zones.postal_suffix) == [11, None]
    assert column(["75011.0", "75020"], zones.postal_modulo) == [11, 20]


def test_years(column):
    assert column(["2021-05-04", "04/05/2020", "bad", None], lambda c: zones.year_of(c, "dd/MM/yyyy")) == [2021, 2020, None, None]


def test_categories(spark):
    texts = ["Dépôt d'ordures", "Étage", "Trou sur la chaussée", "Lampe cassée", "rien", "feuille"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, t string")
    out = rules.with_category(df, [F.col("t")], {"a": False, "w": True}).orderBy("i").collect()
    assert [r.a for r in out] == ["proprete", "incivilite", "voirie", "eclairage", "autre", "eclairage"]
    assert [r.w for r in out] == ["autre", "autre", "voirie", "eclairage", "autre", "autre"]


def test_weights(column):
    given = ["Infestation de PUNAISES", "graffiti", "Graffiti sur mur, façade ou rideau", "carton", None, "Déjection canine"]
    assert column(given, lambda c: rules.weight_all(c, rules.SEVERITY_RULES)) == [3.0, 1.3, 1.5, 1.0, 1.0, 1.5]
    assert column(["Sport", "x"], lambda c: rules.weight_exact(c, rules.WORKS_WEIGHTS, rules.WORKS_DEFAULT)) == [1.0, 0.5]


def test_encodings(column):
    mode = lambda c: rules.encode_first(text.text_key(c), rules.MODE_RULES)
    assert column(["Construction neuve", "Acquisition-Réhabilitation", "conventionnement", "?"], mode) == [0, 1, 2, None]
    code = lambda c: rules.encode_exact(text.text_key(c), rules.RENTAL_CODES)
    assert column(["Meublé", "non meublé", "meublés"], code) == [1, 0, None]


def test_split_point(column):
    assert column(["48.85, 2.35", "48.85", "a,2", None], lambda c: geo.split_point(c)[0]) == [48.85, 48.85, None, None]
    assert column(["48.85, 2.35", "48.85", "a,2", "1,2,3"], lambda c: geo.split_point(c)[1]) == [2.35, None, 2.0, None]


def test_distance(spark):
    km = spark.range(1).select(geo.distance_km(F.lit(48.85), F.lit(2.35), F.lit(48.86), F.lit(2.35))).first()[0]
    assert round(km, 2) == 1.11


SQUARE_WITH_HOLE = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[3,1],[3,3],[1,3],[1,1]]]}'
TWO = '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,6],[5,5]]]]}'


@pytest.mark.parametrize(
    ("shape", "x", "y", "inside"),
    [
        (SQUARE_WITH_HOLE, 0.5, 0.5, True),
        (SQUARE_WITH_HOLE, 2.0, 2.0, False),
        (SQUARE_WITH_HOLE, 5.0, 2.0, False),
        (TWO, 5.5, 5.5, True),
        (TWO, 3.0, 3.0, False),
    ],
)
def test_point_in_polygon(spark, shape, x, y, inside):
    df = spark.createDataFrame([(shape,)], "s string").withColumn("p", geo.polygons_of(F.col("s")))
    assert df.select(geo.in_rings(F.lit(x), F.lit(y), F.col("p"))).first()[0] is inside


def test_polygon_text(column):
    given = [SQUARE_WITH_HOLE, TWO, '{"type":"Point","coordinates":[1,2]}', "{broken", None, ""]
    assert [v is not None for v in column(given, geo.polygon_text)] == [True, True, False, False, False, False]


def test_point_from_any(spark):
    rows = [
        ("2.3", "48.8", None, None),
        (None, "48.8", "48.9,2.4", None),
        (None, None, None, '{"type":"Point","coordinates":[2.5,48.7]}'),
        (None, None, "nan", "2.6,48.6"),
        (None, None, "", "none"),
    ]
    df = spark.createDataFrame(rows, "longitude string, latitude string, geo_point_2d string, geo_shape string")
    got = [tuple(r.p) if r.p else None for r in df.select(geo.point_from_any(df.columns).alias("p")).collect()]
    assert got == [(2.3, 48.8), (2.4, 48.9), (2.5, 48.7), (2.6, 48.6), None]


def test_first_non_empty(spark):
    row = spark.createDataFrame([("", None, "c")], "a string, b string, c string")
    assert row.select(text.first_non_empty(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "c"
    assert row.select(text.first_non_empty(F.col("a"), F.col("b"))).first()[0] == ""
    assert row.select(text.any_match([F.col("a"), F.col("b"), F.col("c")], "^C$")).first()[0] is True
