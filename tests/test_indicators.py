"""Indicators on a hand-made city of two zones, with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from quadrille.plans import indicators as kpi
from quadrille.plans.jobs import run_exports, run_indicators
from quadrille.sources.delimited import write_layer
from quadrille.sources.geojson import read_features


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def quarters(spark):
    data = [
        ("01", "01", "7510101", "Nord", 100.0, "48.80,2.30"),
        ("01", "02", "7510102", "Sud", 300.0, "48.82,2.30"),
        ("02", "05", "7510201", "Été-Place", 50.0, "48.90,2.40"),
    ]
    schema = "arrondissement string, code_quartier_id string, code_insee_quartier string, nom_quartier string, surface_quartier_m2 double, geometry_xy string"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def sales(spark):
    data = [(2021, "01", p) for p in (10.0, 20.0, 60.0)] + [(2021, "02", 8.0), (2022, "01", 30.0), (None, "01", 1.0), (2021, "21", 1.0)]
    return spark.createDataFrame(data, "annee int, arrondissement string, prix_m2 double")


@pytest.fixture(scope="module")
def rents(spark):
    data = [
        (2021, "01", "7510101", 1.0, 1.2, 0.8, 2.0, "Nord", "meublé", "B"),
        (2021, "01", "7510101", 3.0, 3.6, 2.4, 2.0, "Nord", "non meublé", "A"),
        (2021, "01", "7510201", 2.0, None, None, 1.0, None, "meublé", None),
        (2021, "01", None, None, 1.0, 1.0, 1.0, "x", "x", "x"),
    ]
    schema = "annee int, arrondissement string, code_insee_quartier string, loyer_reference double, loyer_reference_majore double, loyer_reference_minore double, nombre_pieces_principales double, nom_quartier string, type_location string, epoque_construction string"
    return spark.createDataFrame(data, schema)


def test_price_by_quarter_year(sales, quarters):
    out = kpi.price_by_quarter_year(sales, quarters)
    assert rows(out, "annee", "code_insee_quartier") == [
        (2021, "01", "7510101", 20.0, 30.0, 3, 1, 100.0, 0.25),
        (2021, "01", "7510102", 20.0, 30.0, 3, 2, 300.0, 0.75),
        (2021, "02", "7510201", 8.0, 8.0, 1, 1, 50.0, 1.0),
        (2022, "01", "7510101", 30.0, 30.0, 1, 0, 100.0, 0.25),
        (2022, "01", "7510102", 30.0, 30.0, 1, 1, 300.0, 0.75),
    ]


def test_price_to_rent(sales, rents, quarters):
    out = kpi.price_to_rent_by_zone_year(sales, rents)
    # The second zone's rent is known only through its code.
    assert rows(out, "arrondissement") == [
        (2021, "01", 20.0, 30.0, 3, 2.0, 2.0, 2, 0.8333),
        (2021, "02", 8.0, 8.0, 1, 2.0, 2.0, 1, 0.3333),
    ]
    assert len(rows(kpi.price_to_rent_by_zone_year(sales, rents, repair_zone=False))) == 1
    wide = kpi.price_to_rent_by_quarter_year(out, quarters)
    assert rows(wide.select("code_insee_quartier", "nb_transactions_estime", "nb_observations_estime"), "code_insee_quartier") == [
        ("7510101", 1, 0), ("7510102", 2, 2), ("7510201", 1, 1),
    ]


def test_rents_by_quarter(rents):
    out = kpi.rents_by_quarter_year(rents)
    assert rows(out, "code_insee_quartier") == [
        (2021, "01", "7510101", 2.0, 2.0, 2, pytest.approx(2.4), pytest.approx(1.6), 2.0, "Nord", "meublé", "A"),
        (2021, "02", "7510201", 2.0, 2.0, 1, None, None, 1.0, None, "meublé", None),
    ]


def test_social_housing(spark, quarters):
    data = [
        (2020, "01", 48.801, 2.30, 10, "A", 4),
        (2020, "01", 48.802, 2.30, 5, "A", 0),
        (2020, "01", 48.819, 2.30, 7, "B", 1),
        (2020, "03", 48.8, 2.3, 7, "B", 1),
        (2020, "01", None, 2.3, 7, "B", 1),
    ]
    housing = spark.createDataFrame(data, "annee int, arrondissement string, latitude double, longitude double, nb_logements_finances int, bailleur_social string, nb_pla_i int")
    out = kpi.social_housing_by_quarter(housing, quarters).select(
        "code_insee_quartier", "nom_quartier", "logements_finances_total", "logements_finances_moyen", "nb_programmes",
        "nb_bailleurs", "nb_pla_i_total", "latitude_moyenne",
    )
    # A programme outside the known zones, or without position, drops out.
    assert rows(out, "code_insee_quartier") == [
        ("7510101", "Nord", 15, 7.5, 2, 1, 4, 48.8015), ("7510102", "Sud", 7, 7.0, 1, 1, 1, 48.819),
    ]


def test_comfort(spark, quarters):
    reports = spark.createDataFrame([("01",)] * 8 + [("75002",)] * 2 + [(None,)], "arrondissement string")
    works = spark.createDataFrame([("75001",)] * 4, "code_postal string")
    stations = spark.createDataFrame([(48.81, 2.30), (48.89, 2.41), (None, 2.3)], "latitude double, longitude double")
    out = {r.code_insee_quartier: r for r in kpi.comfort_by_quarter(reports, stations, works, quarters).collect()}
    one, two, three = out["7510101"], out["7510102"], out["7510201"]
    assert [(r.incidents_estime, r.travaux_estime, r.gares_estime) for r in (one, two, three)] == [(2, 1, 0), (6, 3, 1), (2, 0, 1)]
    assert one.risque_incidents_100 == 0.0 and two.risque_incidents_100 == 100.0
    assert one.score_confort_urbain_100 == pytest.approx(0.5 * 100 + 0 + 0.25 * 100 / 3)
    assert two.score_confort_urbain_100 == pytest.approx(0.25 * 100 + 0.25 * 100)


@pytest.fixture(scope="module")
def safety_inputs(spark):
    iris = spark.createDataFrame(
        [
            ("75101", "751010101", " Louvre ", "48.80,2.30"),
            ("75101", "751010102", "Halles", "48.809,2.30"),
            ("75101", "751010103", "Halles", "48.83,2.30"),
            ("75102", "751020101", "Opéra", "48.90,2.40"),
            ("92044", "920440101", "Ailleurs", "48.9,2.3"),
            ("75102", "751020102", "Nulle part", "inconnu"),
        ],
        "INSEE_COM string, CODE_IRIS string, NOM_IRIS string, `Geo Point` string",
    )
    crime = spark.createDataFrame(
        [("75101", 2020, "vols", 1.0, None), ("75102", 2020, "vols", None, 3.0), ("75101", 2021, "vols", 2.0, 9.0), ("92044", 2020, "vols", 9.0, None)],
        "codgeo string, annee int, indicateur string, taux_pour_mille double, complement_info_taux double",
    )
    cameras = spark.createDataFrame([("1",), ("75001",), ("02",)], "arrondissement string")
    stations = spark.createDataFrame([("p1", 48.80, 2.30)], "station string, lat double, lon double")
    return iris, crime, cameras, stations


def test_safety(safety_inputs, quarters):
    iris, crime, cameras, stations = safety_inputs
    risk = kpi.crime_risk(crime)
    assert rows(risk, "annee", "arrondissement") == [(2020, "01", 0.0, 100.0), (2020, "02", 100.0, 0.0), (2021, "01", 50.0, 50.0)]
    cams = kpi.camera_risk(cameras)
    assert rows(cams, "arrondissement") == [("01", 2, 0.0), ("02", 1, 100.0)]
    scores = kpi.safety_by_iris(kpi.iris_points(iris), risk, cams, stations)
    assert scores.count() == 7  # three places over two years, one place over one year
    out = {(r.annee, r.code_insee_quartier): r for r in kpi.safety_by_quarter(scores, quarters).collect()}
    assert sorted(out) == [(2020, "7510101"), (2020, "7510102"), (2020, "7510201"), (2021, "7510101"), (2021, "7510102")]
    south = out[2020, "7510102"]
    assert (south.nb_iris_rattaches, south.codes_iris_rattaches, south.noms_iris_rattaches) == (1, "751010103", "Halles")
    assert south.score_surete_iris_std_100 is None and south.nb_cameras_arrondissement == 2
    north = out[2020, "7510101"]
    assert (north.codes_iris_rattaches, north.noms_iris_rattaches) == ("751010101 | 751010102", "Halles | Louvre")
    far = 111 * ((0.1 * 0.6584) ** 2 + 0.1**2) ** 0.5
    assert out[2020, "7510201"].dist_commissariat_km_moyenne == pytest.approx(far, rel=1e-3)
    assert out[2020, "7510201"].score_risque_quartier_moyen_100 == 100.0
    assert north.score_risque_quartier_moyen_100 == pytest.approx(0.2 * 100 * (0.999 / 2) / far, abs=0.05)
    zone = {(r.annee, r.arrondissement): r.nb_iris for r in kpi.safety_by_zone(scores).collect()}
    assert zone == {(2020, "01"): 3, (2020, "02"): 1, (2021, "01"): 3}


def test_wrong_code_is_repaired_by_the_short_code(spark, quarters):
    wrong = quarters.withColumn("code_insee_quartier", F.when(F.col("nom_quartier") == "Nord", "9999999").otherwise(F.col("code_insee_quartier")))
    double = wrong.unionByName(wrong.where("nom_quartier = 'Nord'").withColumns({"code_insee_quartier": F.lit("7510101"), "geometry_xy": F.lit("40.0,0.0")}))
    points = spark.createDataFrame([("i1", "01", 48.80, 2.30)], "CODE_IRIS string, arrondissement string, lat double, lon double")
    assert kpi.attach_quarters(points, double).first().code_insee_quartier == "7510101"


def test_name_match(spark, quarters):
    reports = spark.createDataFrame([("ÉTÉ PLACE",), ("Nord ",), ("Inconnu",), (None,)], "conseil string")
    matched = kpi.match_by_name(reports, "conseil", quarters)
    assert {r.conseil: r.code_insee_quartier for r in matched.collect()} == {
        "ÉTÉ PLACE": "7510201", "Nord ": "7510101", "Inconnu": None, None: None,
    }
    assert tuple(kpi.match_rate(matched).first()) == (2, 4, 50.0)


def test_bridge(safety_inputs, quarters):
    out = kpi.bridge(safety_inputs[0], quarters)
    got = rows(out.where("code_iris in ('751010101', '920440101')").select("code_iris", "code_insee_quartier", "arrondissement"), "code_iris", "code_insee_quartier")
    assert got == [("751010101", "7510101", "01"), ("751010101", "7510102", "01"), ("920440101", "", "")]


def test_extensions(spark):
    df = spark.createDataFrame([("a", 2020, 10.0), ("a", 2021, 15.0), ("a", 2023, 30.0)], "k string, annee int, v double")
    assert [r.d for r in kpi.yearly_change(df, ["k"], "v", "d").orderBy("annee").collect()] == [None, 50.0, None]
    mix = kpi.mix_by(spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y")], "k string, t string"), ["k"], "t")
    assert rows(mix.select("t", "nb", F.round("part_pct", 2)), "t") == [("x", 2, 66.67), ("y", 1, 33.33)]
    level = kpi.crime_level(
        spark.createDataFrame([("a", 2.0, 1.0, 10.0), ("a", 4.0, 1.0, 10.0), ("b", None, 3.0, 1000.0)], "k string, r double, n double, p double"),
        ["k"], "r", "n", "p",
    )
    assert rows(level, "k") == [("a", 3.0), ("b", 3.0)]


def test_five_axes(spark):
    quarters = spark.createDataFrame(
        [("01", "a", 10.0, 48.85, 2.35), ("01", "b", 10.0, 48.95, 2.35)],
        "arrondissement string, code_insee_quartier string, surface_m2 double, lat_q double, lon_q double",
    )
    reports = spark.createDataFrame([("a", "Propreté", "x"), ("b", "Graffitis, tags, affiches et autocollants", "graffiti")],
                                    "code_insee_quartier string, type_declaration string, sous_type_declaration string")
    works = spark.createDataFrame([("Sport", "75001"), ("?", "75001.0")], "categorie string, code_postal string")
    rents = spark.createDataFrame([(2020, "a", "Non meublé", "2", 99.0), (2021, "a", "non meublé", "2", 30.0), (2021, "b", "Non meublé", "2", 20.0), (2021, "a", "meublé", "2", 1.0)],
                                  "annee int, code_insee_quartier string, type_location string, nombre_pieces string, loyer double")
    stations = spark.createDataFrame([(48.851, 2.35), (48.849, 2.35)], "latitude double, longitude double")
    out = {r.code_insee_quartier: r for r in kpi.urban_comfort_five_axes(reports, works, rents, stations, quarters).collect()}
    a, b = out["a"], out["b"]
    assert (a.s1, b.s1, a.s2, b.s2) == (0.01, 5.0, 5.0, 0.01)
    assert a.s3 == b.s3 == 7.5 and (a.s5, b.s5) == (10.0, 5.0)
    assert a.s4 == b.s4 == 0.01  # both as far from the median as can be
    assert a.kpi_confort_urbain == round(0.01**0.30 * 5**0.25 * 7.5**0.15 * 0.01**0.15 * 10**0.15, 3)


def test_runs_from_layer_to_published_tables(spark, tmp_path, sales, rents, quarters, safety_inputs):
    layer, target, exports = str(tmp_path / "layer"), str(tmp_path / "published"), str(tmp_path / "exports")
    iris, crime, _, _ = safety_inputs
    cameras = spark.createDataFrame([("01", 48.8, 2.3), ("02", 48.9, 2.4)], "arrondissement string, latitude double, longitude double")
    police = spark.createDataFrame([("Central", 48.8, 2.3)], "nom string, latitude double, longitude double")
    for name, df in {"sales": sales, "rents": rents, "quarters": quarters, "iris": iris, "crime": crime, "cameras": cameras, "police_stations": police}.items():
        write_layer(df, f"{layer}/{name}", partition_by=["annee"] if name == "sales" else [])
    done = run_indicators(spark, layer, target)
    assert sorted(done) == [
        "fact_kpi_comparaison_achat_location_arrondissement", "fact_kpi_comparaison_achat_location_quartier",
        "fact_kpi_evolution_quartier", "fact_kpi_loyers_quartier", "fact_kpi_prix_m2_arrondissement",
        "fact_kpi_prix_m2_quartier_annuel", "fact_kpi_surete_arrondissement", "fact_kpi_surete_iris", "fact_kpi_surete_quartier",
    ]
    fact = spark.read.parquet(done["fact_kpi_prix_m2_quartier_annuel"])
    assert dict(fact.dtypes)["prix_m2_median"] == "decimal(20,6)" and {"source_file", "loaded_at"} <= set(fact.columns)
    manifest = {r.table_name: r.rows for r in spark.read.json(f"{target}/manifest").collect()}
    assert manifest["fact_kpi_prix_m2_quartier_annuel"] == 5
    tables = run_indicators(spark, layer, str(tmp_path / "catalog"), catalog=True)
    try:
        assert sorted(tables) == sorted(done)
        for name, path in done.items():
            assert spark.table(name).drop("loaded_at").exceptAll(spark.read.schema(spark.table(name).schema).parquet(path).drop("loaded_at")).isEmpty()
        assert [c.name for c in spark.catalog.listColumns("fact_kpi_loyers_quartier") if c.isBucket] == ["code_insee_quartier"]
    finally:
        for name in tables:
            spark.sql(f"drop table if exists {name}")
    written = run_exports(spark, layer, exports)
    assert sorted(written) == ["cameras", "commissariats", "iris", "iris_to_quartier", "quartiers"]
    points = {r.properties: r.geometry for r in read_features(spark, written["cameras"]).collect()}
    assert points['{"arrondissement":"02"}'] == '{"type":"Point","coordinates":[2.4,48.9]}'


def test_a_table_with_repeated_keys_is_not_published(spark, tmp_path, sales, quarters):
    write_layer(sales, str(tmp_path / "layer/sales"))
    write_layer(quarters.unionByName(quarters), str(tmp_path / "layer/quarters"))
    with pytest.raises(ValueError, match="fact_kpi_prix_m2_quartier_annuel is not published: duplicate_key"):
        run_indicators(spark, str(tmp_path / "layer"), str(tmp_path / "published"))
    assert not (tmp_path / "published" / "fact_kpi_prix_m2_quartier_annuel").exists()


def test_staged_tables_go_with_their_run(spark):
    from pathlib import Path

    from quadrille.session import stage, staging, staging_root

    folder = Path(staging_root(spark)) / "staged"
    before = {p.name for p in folder.glob("*")} if folder.exists() else set()
    with staging(spark):
        assert stage(spark.range(3)).count() == 3
        assert {p.name for p in folder.glob("*")} - before
    assert {p.name for p in folder.glob("*")} == before


def test_five_axes_from_the_cleaned_layer(spark):
    quarters = spark.createDataFrame(
        [("01", "7510101", "Halles", 1e5, "48.86, 2.34"), ("01", "7510102", "Palais", 2e5, "48.865, 2.335")],
        "arrondissement string, code_insee_quartier string, nom_quartier string, surface_quartier_m2 double, geometry_xy string",
    )
    reports = spark.createDataFrame(
        [("Propreté", "dépôt", "Halles"), ("Propreté", "dépôt", "ailleurs")], "type_objet string, sous_type_objet string, conseil_de_quartier string"
    )
    works = spark.createDataFrame([("Voirie", "75001")], "categorie_operation string, code_postal string")
    rents = spark.createDataFrame(
        [(2024, "7510101", "non meublé", 2.0, 25.0), (2024, "7510102", "non meublé", 2.0, 30.0)],
        "annee int, code_insee_quartier string, type_location string, nombre_pieces_principales double, loyer_reference double",
    )
    stations = spark.createDataFrame([(48.86, 2.34)], "latitude double, longitude double")
    out = kpi.urban_comfort_from_layer(reports, works, rents, stations, quarters).collect()
    assert {r.code_insee_quartier for r in out} == {"7510101", "7510102"} and all(0 < r.kpi_confort_urbain <= 10 for r in out)
    assert kpi.urban_comfort_from_layer(reports.drop("conseil_de_quartier"), works, rents, stations, quarters) is None
