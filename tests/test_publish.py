import json
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quadrille.operators import quality
from quadrille.sources import delimited, geojson, publish


def test_contract_casts_by_name(spark):
    df = spark.createDataFrame([(" ", "1", 2.5, "7510101")], "prix_m2_moyen string, annee string, prix_m2_median double, code_insee_quartier string")
    out = publish.cast_to_contract(df, publish.CONTRACTS["fact_kpi_prix_m2_quartier_annuel"])
    row = out.first()
    assert (row.annee, row.prix_m2_median, row.prix_m2_moyen, row.nb_ventes) == (1, Decimal("2.500000"), None, None)
    assert out.columns[:3] == ["annee", "arrondissement", "code_insee_quartier"]
    assert set(publish.CONTRACTS) <= set(publish.CONTRACT_KEYS)
    many = spark.createDataFrame([(3_000_000_000, float("nan"))], "nb_ventes bigint, prix_m2_median double")
    row = publish.cast_to_contract(many, publish.CONTRACTS["fact_kpi_prix_m2_quartier_annuel"]).first()
    assert (row.nb_ventes, row.prix_m2_median) == (3_000_000_000, None)
    for bad in ("x", "1e30"):
        wrong = spark.createDataFrame([(bad,)], "prix_m2_moyen string")
        with pytest.raises(Exception, match="prix_m2_moyen: no decimal"):
            publish.cast_to_contract(wrong, publish.CONTRACTS["fact_kpi_prix_m2_quartier_annuel"]).collect()


def test_fingerprint_tells_nulls_and_columns_apart(spark):
    def of(rows, schema="a string, b string"):
        return tuple(quality.table_fingerprint(spark.createDataFrame(rows, schema)).first())

    assert of([("x", None), ("y", "z")]) == of([("y", "z"), ("x", None)])
    assert len({of([("x", None)]), of([(None, "x")]), of([("x", "")]), of([("", "x")]), of([("x", "-")])}) == 5
    assert of([]) == (0, 0, 0)


def test_a_large_folder_is_written_by_as_many_tasks_as_it_needs(spark, tmp_path):
    year = "case when id % 100 = 0 then 2000 + id % 700 div 100 else 2020 end as annee"
    df = spark.range(0, 40_000, 1, 32).selectExpr(year, "id", "lpad(id % 20, 2, '0') as arrondissement", "md5(cast(id as string)) as x")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        delimited.write_layer(df, str(tmp_path / "t"), partition_by=["annee"], sort_by=["annee", "arrondissement"])
    finally:
        spark.conf.unset(key)
    files = list((tmp_path / "t").rglob("part-*.parquet"))
    held = Counter(p.parent.name for p in files)
    # Small folders have a file each, but for those that were dealt to the large one's partition.
    assert held["annee=2020"] > 8 and sum(n == 1 for n in held.values()) >= 4
    assert max(p.stat().st_size for p in files) < 400_000
    for path in files:
        zones = [r[0] for r in spark.read.parquet(str(path)).select("arrondissement").coalesce(1).collect()]
        assert zones == sorted(zones)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_encoding_is_decided_per_line(spark, tmp_path):
    lines = ["\ufeffnom;é;n".encode(), "Été;x;1".encode(), "Été;y;2".encode("latin-1"), b"", 'a;"b;c";3'.encode(), b"d;e;4;5"]
    (tmp_path / "f.csv").write_bytes(b"\n".join(lines) + b"\n")
    df = delimited.read_delimited(spark, str(tmp_path / "f.csv"), sep=";", encoding="auto", on_bad="drop")
    assert df.columns == ["nom", "é", "n"]
    assert sorted(tuple(r) for r in df.collect()) == [("a", "b;c", "3"), ("Été", "x", "1"), ("Été", "y", "2")]
    kept = delimited.read_delimited(spark, str(tmp_path / "f.csv"), sep=";", encoding="auto", columns=["n"])
    assert sorted(r.n for r in kept.collect()) == ["1", "2", "3", "4"]


def test_publish_fact(spark, tmp_path):
    df = spark.createDataFrame([(2020, "", 3), (2021, "b", 4)], "annee int, name string, n int")
    path = publish.publish_fact(df, "fact_x", "x.csv", str(tmp_path))
    publish.publish_fact(df, "fact_x", "x.csv", str(tmp_path), replace=False)
    back = spark.read.parquet(path)
    assert back.count() == 4 and back.where("name is null").count() == 2
    assert {r.source_file for r in back.collect()} == {"x.csv"}


def test_features(spark, tmp_path):
    rows = [
        (1, '{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,1],[0,0]]]}', "48.8,2.3", float("nan")),
        (2, "{broken", "48.9,2.4", 1.5),
        (3, None, None, 2.0),
    ]
    df = spark.createDataFrame(rows, "id int, `Geo Shape` string, geometry_xy string, v double")
    df = df.withColumn("t", F.expr("timestamp_ntz'2024-01-02 03:04:05'"))
    path = str(tmp_path / "layer")
    geojson.write_features(geojson.to_features(df, "polygon"), path)
    back = {json.loads(r.properties)["id"]: r for r in geojson.read_features(spark, path).collect()}
    assert sorted(back) == [1, 2]
    assert json.loads(back[1].geometry)["type"] == "Polygon"
    assert json.loads(back[2].geometry) == {"type": "Point", "coordinates": [2.4, 48.9]}
    assert json.loads(back[1].properties) == {"id": 1, "v": None, "t": "2024-01-02T03:04:05"}


def test_feature_documents(spark, tmp_path):
    feature = '{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"a":1}}'
    (tmp_path / "c.geojson").write_text('{"type":"FeatureCollection","features":[' + feature + ',{"type":"Feature","properties":{"a":2}}]}')
    (tmp_path / "b.geojson").write_text("[" + feature + "]")
    whole = geojson.read_features(spark, str(tmp_path / "c.geojson"), whole_document=True)
    assert sorted(r.properties for r in whole.collect()) == ['{"a":1}', '{"a":2}']
    assert [json.loads(r.value)["geometry"]["coordinates"] for r in geojson.feature_text(whole).orderBy("value").collect()] == [[0, 0], [1, 2]]
    assert geojson.read_features(spark, str(tmp_path / "b.geojson"), whole_document=True).count() == 1


def test_manifest_of_files(spark, tmp_path):
    root = tmp_path / "layer"
    (root / "sub").mkdir(parents=True)
    (root / "a.csv").write_text("a")
    (root / "sub" / "b.csv").write_text("b")
    files = quality.layer_files(spark, str(root))
    recorded = quality.write_manifest(files)
    assert {r.path for r in recorded.collect()} == {"a.csv", "sub/b.csv"}
    lines = "\n".join(f"{r.sha256}  {r.path}" for r in recorded.collect())
    (tmp_path / "m.sha256").write_text(f"# made today\n\n{lines}\n{'0' * 64}  gone.csv\n")
    manifest = quality.read_manifest(spark, str(tmp_path / "m.sha256"))
    manifest = manifest.withColumn("sha256", F.when(F.col("path") == "a.csv", "x").otherwise(F.col("sha256")))
    (root / "new.csv").write_text("n")
    status = {r.path: r.status for r in quality.verify_manifest(quality.layer_files(spark, str(root)), manifest).collect()}
    assert status == {"a.csv": "tampered", "sub/b.csv": "ok", "gone.csv": "missing", "new.csv": "untracked"}
    again = {r.path: r.change for r in quality.write_manifest(quality.layer_files(spark, str(root)), manifest).collect()}
    assert again == {"a.csv": "changed", "sub/b.csv": "same", "gone.csv": "same", "new.csv": "new"}


def test_catalog(spark, tmp_path):
    (tmp_path / "catalog.json").write_text(json.dumps({"datasets": [{"id": "a", "file": "a.csv", "layer": "raw"}]}))
    catalog = quality.read_catalog(spark, str(tmp_path / "catalog.json"))
    files = spark.createDataFrame([("a.csv",), ("b.csv",)], "path string")
    assert [r.path for r in quality.uncatalogued(files, catalog).collect()] == ["b.csv"]


def test_staging_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from quadrille import session

    def fake(master, root):
        conf = SimpleNamespace(get=lambda key, default=None: root)
        context = SimpleNamespace(master=master, applicationId="app", getConf=lambda: conf)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert session.staging_root(fake("spark://x", "/shared/")) == "/shared"
    own = session.staging_root(fake("local[2]", None))
    assert own == session.staging_root(fake("local[2]", None))
    try:
        session.staging_root(fake("spark://x", None))
    except RuntimeError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("a cluster needs a shared folder")
    assert session.stage(spark.range(3)).count() == 3
