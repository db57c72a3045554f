"""Cleaning jobs on small invented files, with the traps their sources are known for."""

import pytest

from quadrille.plans import clean
from quadrille.plans.jobs import RAW_FILES, run_cleaning, run_indicators
from quadrille.sources.delimited import exists, read_delimited, read_if_exists, read_layer


@pytest.fixture()
def write(tmp_path):
    def run(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    return run


SALES_HEAD = "id_mutation,date_mutation,nature_mutation,valeur_fonciere,code_postal,type_local,surface_reelle_bati,nombre_pieces_principales,longitude,latitude\n"


def sale(i, price=500000, postal="75011.0", kind="Appartement", area="50", day="2021-03-04"):
    return f"m{i},{day},Vente,{price},{postal},{kind},{area},2,2.37,48.86\n"


def sales_text():
    kept = [sale(i, price=400000 + 1000 * i) for i in range(100)]
    traps = [
        sale("bad-date", day="bientôt"),
        sale("suburb", postal="92100"),
        sale("shed", kind="Dépendance"),
        sale("tiny", area="9"),
        sale("huge", area="500"),
        sale("cheap", price=10000),
        sale("zone21", postal="75021"),
        sale("noprice", price=""),
        kept[50],
    ]
    return SALES_HEAD + "".join(kept + traps)


def test_sales(spark, write):
    df = read_delimited(spark, write("75.csv", sales_text()))
    out = clean.clean_sales([df, df]).collect()
    # 101 valid lines (one a copy): the trim keeps those between the 1st and 99th percentile.
    assert len(out) == 98
    assert {r.arrondissement for r in out} == {"11"} and {r.annee for r in out} == {2021}
    assert {r.code_postal for r in out} == {"75011"}
    assert min(r.prix_m2 for r in out) == 8020.0 and max(r.prix_m2 for r in out) == 9960.0


def test_sales_need_their_columns(spark, write):
    df = read_delimited(spark, write("x.csv", "date_mutation,code_postal\n2020-01-01,75001\n"))
    with pytest.raises(ValueError, match="surface_reelle_bati"):
        clean.clean_sales_source(df)


HOUSING = """Identifiant livraison;Adresse du programme;Code postal;Ville;Année du financement - agrément;Bailleur social;Nombre total de logements financés;Dont nombre de logements PLA I;Dont nombre de logements PLUS;Dont nombre de logements PLUS CD;Dont nombre de logements PLS;Mode de réalisation;Commentaires;Arrondissement;Nature de programme;Coordonnée en X (L93);Coordonnée en Y (L93);geo_shape;geo_point_2d
1; 1 rue A ;75013;Paris;2019;Bailleur Un;30;10;;;20;Construction neuve;c;13;Logement familial;650000,5;6860000;;48.83, 2.36
2;2 rue B;75013;Paris;2020;Bailleur Deux;;;;;;Acquisition-réhabilitation;c;13;Étudiant;;;;
3;3 rue C;92000;Nanterre;2020;Bailleur Deux;5;;;;;autre;c;13;;;;;
4;4 rue D;75014;Paris;2020;;7;;;;;Conventionnement;c;99;;;;;
"""


def test_social_housing(spark, write):
    df = read_delimited(spark, write("hlm.csv", HOUSING), sep=";")
    out = {r.identifiant_livraison: r for r in clean.clean_social_housing([df, df]).collect()}
    assert sorted(out) == ["1", "2"]
    one, two = out["1"], out["2"]
    assert (one.nb_logements_finances, one.nb_pla_i, one.nb_plus, one.nb_pls) == (30, 10, 0, 20)
    assert (one.arrondissement, one.annee, one.latitude, one.x_l93) == ("13", 2019, 48.83, 650000.5)
    assert (one.mode_de_realisation_code, two.mode_de_realisation_code) == (0, 1)
    assert (one.adresse_du_programme, two.nature_de_programme_norm) == ("1 rue A", "etudiant")
    assert two.nb_logements_finances == 0 and two.latitude is None and two.geo_point_2d == "non_renseigne"


RENTS = """Année;Secteurs géographiques;Numéro du quartier;Nom du quartier;Nombre de pièces principales;Epoque de construction;Type de location;Loyers de référence;Loyers de référence majorés;Loyers de référence minorés;Ville;Numéro INSEE du quartier;geo_shape;geo_point_2d
2023;1;4;Place-Vendôme;2;Avant 1946;Meublé;30,5;36,6;21,4;Paris;7510104;;48.86,2.33
2023;1;4;Place-Vendôme;2;Avant 1946;Non meublé;25,5;30,6;17,9;Paris;7510104;;48.86,2.33
2023;1;4;Place-Vendôme;3;Après 1990;Non meublé;24,5;;;Paris;7510104;;48.86,2.33
2023;21;4;Hors;3;Après 1990;Non meublé;24,5;;;Paris;7510104;;
2023;2;5;Gaillon;2;Avant 1946;Non meublé;;;;Paris;7510205;;
"""


def test_rents(spark, write):
    path = write("loyers.csv", "\ufeff" + RENTS)
    df = read_delimited(spark, path, sep=";")
    assert df.columns[0] == "Année"
    out = clean.clean_rents(df)
    assert out.columns == clean.RENT_COLUMNS
    got = sorted((r.loyer_reference, r.type_location_code, r.arrondissement, r.code_insee_quartier) for r in out.collect())
    assert got == [(24.5, 0, "01", "7510104"), (25.5, 0, "01", "7510104"), (30.5, 1, "01", "7510104")]


CRIME = """CODGEO_2025;annee;indicateur;unite_de_compte;nombre;taux_pour_mille;est_diffuse;insee_pop;complement_info_taux
75101;2020;Vols;victime;12;"1,5";diff;16000;NA
75102;2020;Vols;victime;NA;NA;ndiff;20000;"0,75"
92044;2020;Vols;victime;3;"0,2";diff;9000;NA
75101;NA;Vols;victime;3;"0,2";diff;9000;NA
"""


def test_crime(spark, write):
    df = read_delimited(spark, write("d.csv", CRIME), sep=";", null_value="NA")
    out = {r.arrondissement: r for r in clean.clean_crime(df).collect()}
    assert sorted(out) == ["01", "02"]
    assert (out["01"].taux_effectif, out["01"].faits) == (1.5, 12)
    assert (out["02"].taux_effectif, out["02"].faits, out["02"].annee) == (0.75, 0, 2020)


def test_police_stations(spark, write):
    text = "Nom;Code postal;geo_point_2d\nCentral;75001;48.86, 2.34\nBanlieue;93100;48.9,2.4\nPerdu;75002;\n"
    out = clean.clean_police_stations(read_delimited(spark, write("c.csv", text), sep=";")).collect()
    assert [(r.nom, r.arrondissement, r.latitude) for r in out] == [("Central", "01", 48.86)]


def test_cameras_accept_both_encodings(spark, write):
    text = 'NUMÉRO,ARRONDISSEMENT,coordonnees\n1,7,"48.85, 2.31"\n2,75007,"48.85,2.32"\n3,21,"48.8,2.3"\n4,8,\n4,8,\n'
    out = clean.clean_cameras(read_delimited(spark, write("points.csv", text))).collect()
    assert sorted((r.numero, r.arrondissement) for r in out) == [("1", "07"), ("2", "07")]


REPORTS = """date du signalement;etat;type objet;sous type objet;conseil de quartier;code postal;geo_point_2d
2022-01-05;Traité;Propreté;Sac;Père-Lachaise;75020;48.86,2.39
2022-01-05;Annulé;Propreté;Sac;Belleville;75020;48.86,2.39
2022-01-06;Non fondé;Voirie;Trou;Belleville;75020;
jamais;Traité;Voirie;Trou;Belleville;75020;
2021-05-01;;Arbre;à l'étage;;75019;
2021-05-02;Traité;Lampe;Feu;X;93500;
"""


def test_reports(spark, write):
    out = clean.clean_reports(read_delimited(spark, write("dmr.csv", REPORTS), sep=";"))
    got = {r.type_objet: r for r in out.collect()}
    assert sorted(got) == ["Arbre", "Propreté"]
    assert (got["Propreté"].categorie_signalement, got["Propreté"].annee, got["Propreté"].nom_cq_norm) == ("proprete", 2022, "pere_lachaise")
    # The keyword is found inside another word, and a missing state keeps its row.
    assert (got["Arbre"].categorie_signalement, got["Arbre"].etat, got["Arbre"].latitude) == ("incivilite", "non_renseigne", None)


def test_reports_second_header_generation(spark, write):
    text = "TYPE DECLARATION;SOUS TYPE DECLARATION;ARRONDISSEMENT;CODE POSTAL;ANNEE DECLARATION;CONSEIL DE QUARTIER\nÉclairage;Lampe;11;75011;2021;Roquette\n"
    row = clean.clean_reports(read_delimited(spark, write("dmr.csv", text), sep=";")).first()
    assert (row.categorie_signalement, row.annee, row.arrondissement) == ("eclairage", 2021, "11")


def test_stations(spark, write):
    text = "Geo Point;gares_id;nom_long;nom_ZdC\n48.88, 2.35;1; Gare du Nord ;Nord\n;2;Perdue;X\n"
    out = clean.clean_stations(read_delimited(spark, write("g.csv", text), sep=";")).collect()
    assert [(r.nom_gare, r.latitude) for r in out] == [("Gare du Nord", 48.88)]


def test_city_stations(spark, write):
    text = "Geo Point;gares_id;nom_long;nom_su_gar;nom_ZdC;res_com;indice_lig;mode;exploitant\n48.88,2.35;1;Nord;;;RER;B;TRAIN;SNCF\n48.94,2.5;2;Halte;;Porte de Paris;RER;B;TRAIN;SNCF\n48.2,2.3;3;Paris-Loin;;;RER;B;TRAIN;SNCF\n48.94,2.5;4;Halte;;;RER;B;TRAIN;SNCF\n"
    out = clean.city_stations(read_delimited(spark, write("g.csv", text), sep=";"))
    assert sorted(r.id_gare for r in out.collect()) == ["1", "2"]
    assert "zone_commerciale" in out.columns


def test_works(spark, write):
    text = "Titre;Catégorie;Date début;Date de livraison;Arrondissement\n Square ;Sport;2020-02-01;2021-01-01;11\n;Sport;2020-02-01;;12\nRue;Voirie;pas de date;2022-01-01;75012\nSquare;Sport;2020-02-01;2021-01-01;11\n"
    out = {r.titre_operation: r for r in clean.clean_works(read_delimited(spark, write("w.csv", text), sep=";")).collect()}
    assert sorted(out) == ["Rue", "Square"]
    assert (out["Square"].annee, out["Square"].arrondissement, out["Square"].categorie_operation_norm) == (2020, "11", "sport")
    assert (out["Rue"].annee, out["Rue"].arrondissement) == (None, None)


def test_works_by_postal(spark, write):
    text = "Titre;Catégorie;Sous-catégorie;Adresse;Code postal;Date de livraison\nA;Sport;S;r;75011.0;2020\nA;Sport;S;r;75011.0;2020\nB;X;;r;n/a;\n"
    out = clean.works_by_postal(read_delimited(spark, write("w.csv", text), sep=";"))
    assert sorted((r.titre_projet, r.arrondissement) for r in out.collect()) == [("A", 11), ("B", None)]


QUARTERS = """N_SQ_QU;C_QU;C_QUINSEE;L_QU;C_AR;N_SQ_AR;PERIMETRE;SURFACE;Geometry X Y;Geometry
750000001;1.0;7510101;St-Germain;1.0;1;1;1000,;48.86, 2.33;{}
750000002;2;7510102; Halles ;1;1;1;3000;48.86, 2.34;{}
750000003;5;7510201;Gaillon;2;1;1;;48.87, 2.33;{}
"""


def test_quarters(spark, write):
    out = {r.code_insee_quartier: r for r in clean.clean_quarters(read_delimited(spark, write("q.csv", QUARTERS), sep=";")).collect()}
    assert sorted(out) == ["7510101", "7510102", "7510201"]
    two = out["7510102"]
    assert (two.arrondissement, two.code_quartier_id, two.nom_quartier, two.surface_quartier_m2) == ("01", "02", "Halles", 3000.0)
    assert out["7510201"].surface_quartier_m2 is None and two.geometry_xy == "48.86, 2.34"


def test_quarters_without_code_build_it(spark, write):
    text = "C_QU;L_QU;C_AR;SURFACE;Geometry X Y\n2;Halles;1;3000;48.86, 2.34\n"
    assert clean.clean_quarters(read_delimited(spark, write("q.csv", text), sep=";")).first().code_insee_quartier == "7510102"


def test_iris(spark, write):
    text = "Geo Shape;DEP;INSEE_COM;NOM_COM;IRIS;CODE_IRIS;NOM_IRIS;TYP_IRIS;Geo Point;ID\n{};75;75101;Paris;0101;751010101;Louvre;H;48.86, 2.33;1\n{};75;75101;Paris;0101;751010101;Louvre;H;48.86, 2.33;1\n"
    out = clean.clean_iris(read_delimited(spark, write("i.csv", text), sep=";")).collect()
    assert [(r.INSEE_COM, r.CODE_IRIS, r.NOM_IRIS, r["Geo Point"], r["Geo Shape"]) for r in out] == [
        ("75101", "751010101", "Louvre", "48.86, 2.33", "{}")
    ]


def test_zones_keep_the_typographic_apostrophe(spark, write):
    text = "Identifiant;Numéro d’arrondissement;Nom de l’arrondissement;Surface\n1;3.0;Temple;\n2;;X;1\n"
    out = clean.clean_zones(read_delimited(spark, write("z.csv", text), sep=";"))
    assert "numero_d’arrondissement" in out.columns
    assert [(r.arrondissement, r.surface) for r in out.collect()] == [("03", "0")]


def test_loose_rents(spark, write):
    out = clean.loose_rents(read_delimited(spark, write("l.csv", RENTS.replace(",", ".")), sep=";")).collect()
    first = out[0]
    assert (first.annee, first.loyer_ref, first.loyer_majore, first.arrondissement) == ("2023", 30.5, 36.6, 1)


def test_delimited_options(spark, write, tmp_path):
    path = write("latin.csv", "Année;b\nété;1\nx;2;3\n", "latin-1")
    df = read_delimited(spark, path, sep=";", encoding="auto", on_bad="drop")
    assert df.columns == ["Année", "b"] and [tuple(r) for r in df.collect()] == [("été", "1")]
    assert read_delimited(spark, path, sep=";", encoding="auto", columns=["b", "absent"]).columns == ["b"]
    assert read_if_exists(spark, str(tmp_path / "absent.csv")) is None


def test_run_cleaning(spark, tmp_path):
    raw, layer = tmp_path / "raw", tmp_path / "clean"
    raw.mkdir()
    (raw / "75.csv").write_text(sales_text(), "utf-8")
    (raw / "quartier_paris.csv").write_text("\ufeff" + QUARTERS, "utf-8")
    (raw / "loyers.csv").write_text(RENTS, "utf-8")
    done = run_cleaning(spark, str(raw), str(layer))
    assert sorted(done) == ["quarters", "rents", "sales"]
    assert read_layer(spark, done["sales"]).count() == 98
    assert not exists(spark, str(layer / "cameras")) and "cameras" in RAW_FILES


def test_raw_files_stand_in_for_a_missing_layer(spark, write, tmp_path):
    write("75.csv", sales_text())
    done = run_indicators(spark, str(tmp_path / "layer"), str(tmp_path / "published"), raw=str(tmp_path))
    assert list(done) == ["fact_kpi_prix_m2_arrondissement"]
    assert [r.arrondissement for r in spark.read.parquet(done["fact_kpi_prix_m2_arrondissement"]).collect()] == ["11"]
    assert run_indicators(spark, str(tmp_path / "layer"), str(tmp_path / "other")) == {}
