"""Whole runs: raw folder to clean layer, clean layer to published tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import blocking_findings
from ..session import stage, staging
from ..sources.catalog import publish_table
from ..sources.delimited import exists, first_path, read_delimited, read_layer, write_layer
from ..sources.geojson import LAYERS, to_features, write_features
from ..sources.publish import CONTRACT_KEYS, contract_columns, publish_fact, publish_manifest
from . import clean
from . import indicators as kpi

# The raw files of each clean table and how they are written.
RAW_FILES = {
    "quarters": (["quartier_paris.csv"], {"sep": ";", "on_bad": "drop"}),
    "iris": (["iris.csv"], {"sep": ";"}),
    "zones": (["arrondissements.csv"], {"sep": ";"}),
    "sales": (["75.csv", "valeurs_foncieres.csv"], {"sep": ","}),
    "social_housing": (["hlm.csv", "logements-sociaux-finances-a-paris.csv"], {"sep": ";"}),
    "rents": (["loyers.csv"], {"sep": ";"}),
    "crime": (["dataset_delinquances.csv"], {"sep": ";", "null_value": "NA"}),
    "police_stations": (
        ["cartographie-des-emplacements-des-commissariats-a-paris-et-petite-couronne.csv"],
        {"sep": ";"},
    ),
    "cameras": (["points.csv"], {"sep": ","}),
    "reports": (["dans-ma-rue.csv"], {"sep": ";", "encoding": "auto"}),
    "stations": (["emplacement-des-gares-idf.csv"], {"sep": ";"}),
    "works": (["parissetransforme.csv"], {"sep": ";"}),
}

_CLEANERS: dict[str, Callable[[Sequence[DataFrame]], DataFrame]] = {
    "quarters": lambda f: clean.clean_quarters(f[0]),
    "iris": lambda f: clean.clean_iris(f[0]),
    "zones": lambda f: clean.clean_zones(f[0]),
    "sales": clean.clean_sales,
    "social_housing": clean.clean_social_housing,
    "rents": lambda f: clean.clean_rents(f[0]),
    "crime": lambda f: clean.clean_crime(f[0]),
    "police_stations": lambda f: clean.clean_police_stations(f[0]),
    "cameras": lambda f: clean.clean_cameras(f[0]),
    "reports": lambda f: clean.clean_reports(f[0]),
    "stations": lambda f: clean.clean_stations(f[0]),
    "works": lambda f: clean.clean_works(f[0]),
}

# The order of the written tables.
_ORDER = {
    "sales": ["annee", "arrondissement", "date_mutation"],
    "social_housing": ["arrondissement", "annee_financement"],
    "rents": ["annee", "arrondissement", "numero_quartier"],
}

# Tables with a year are written one folder per year, so yearly reads are pruned.
_YEARLY = {"sales", "social_housing", "rents", "crime", "reports"}


def run_cleaning(spark: SparkSession, raw: str, layer: str) -> dict[str, str]:
    """Clean every domain whose raw file is there; returns the written path per table."""
    written = {}
    for name, (files, options) in RAW_FILES.items():
        found = [p for p in (f"{raw.rstrip('/')}/{f}" for f in files) if exists(spark, p)]
        if not found:
            continue
        target = f"{layer.rstrip('/')}/{name}"
        with staging(spark):
            table = _CLEANERS[name]([read_delimited(spark, p, **options) for p in found])
            by_year = ["annee"] if name in _YEARLY and "annee" in table.columns else []
            write_layer(table, target, partition_by=by_year, sort_by=_ORDER.get(name, by_year))
        written[name] = target
    return written


# The years that the evolution compares.
EVOLUTION_YEARS = (2021, 2025)


def _tables(spark: SparkSession, layer: str, raw: str | None = None) -> dict[str, DataFrame]:
    """Every table of the cleaned layer; what it lacks is cleaned from its raw file, where one is given and there."""
    found = {}
    for name, (files, options) in RAW_FILES.items():
        cleaned = f"{layer.rstrip('/')}/{name}"
        path = first_path(spark, [cleaned, *[f"{raw.rstrip('/')}/{f}" for f in files if raw]])
        if path == cleaned:
            found[name] = read_layer(spark, path)
        elif path:
            found[name] = stage(_CLEANERS[name]([read_delimited(spark, path, **options)]))
    # A folder name such as annee=2021 is read back as a number; codes stay text by type.
    return {n: d.withColumn("annee", F.col("annee").cast("int")) if "annee" in d.columns else d for n, d in found.items()}


def published_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every indicator whose inputs are there, by published name."""
    out: dict[str, DataFrame] = {}

    def ready(*names: str) -> bool:
        return all(n in tables for n in names)

    if ready("sales"):
        out["fact_kpi_prix_m2_arrondissement"] = kpi.mean_price_by_zone(tables["sales"])
    if ready("sales", "quarters"):
        out["fact_kpi_prix_m2_quartier_annuel"] = kpi.price_by_quarter_year(tables["sales"], tables["quarters"])
    if ready("sales", "rents"):
        ratio = kpi.price_to_rent_by_zone_year(tables["sales"], tables["rents"])
        out["fact_kpi_comparaison_achat_location_arrondissement"] = ratio
        if ready("quarters"):
            by_quarter = stage(kpi.price_to_rent_by_quarter_year(ratio, tables["quarters"]))
            out["fact_kpi_comparaison_achat_location_quartier"] = by_quarter
            out["fact_kpi_evolution_quartier"] = kpi.price_to_rent_evolution(by_quarter, *EVOLUTION_YEARS)
    if ready("rents"):
        out["fact_kpi_loyers_quartier"] = kpi.rents_by_quarter_year(tables["rents"])
    if ready("social_housing", "quarters"):
        out["fact_kpi_repartition_logements_sociaux"] = kpi.social_housing_by_quarter(
            tables["social_housing"], tables["quarters"]
        )
    if ready("reports", "stations", "works", "quarters"):
        out["fact_kpi_confort_quartier"] = kpi.comfort_by_quarter(
            tables["reports"], tables["stations"], tables["works"], tables["quarters"]
        )
    if ready("crime", "cameras", "police_stations", "iris", "quarters"):
        stations = tables["police_stations"].select(
            F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.xxhash64("*").alias("station")
        )
        scores = stage(
            kpi.safety_by_iris(
                kpi.iris_points(tables["iris"]), kpi.crime_risk(tables["crime"]), kpi.camera_risk(tables["cameras"]), stations
            )
        )
        out["fact_kpi_surete_quartier"] = kpi.safety_by_quarter(scores, tables["quarters"])
        out["fact_kpi_surete_arrondissement"] = kpi.safety_by_zone(scores)
        out["fact_kpi_surete_iris"] = scores
    if ready("reports", "works", "rents", "stations", "quarters"):
        index = kpi.urban_comfort_from_layer(*[tables[n] for n in ("reports", "works", "rents", "stations", "quarters")])
        if index is not None:
            out["fact_kpi_confort_cinq_axes"] = index
    return out


def run_indicators(spark: SparkSession, layer: str, target: str, raw: str | None = None, catalog: bool = False) -> dict[str, str]:
    """Publish every indicator and a manifest; any failure stops the run. ``raw``: where to find what the layer lacks.
    ``catalog`` publishes them as catalog tables in buckets by their code, under the same paths.

    Each table is computed once, audited and then written: absent contract columns, ill-formed zones or years and
    repeated keys raise before anything of it is published.
    """
    written, lines = {}, {}
    with staging(spark):
        for name, df in published_tables(_tables(spark, layer, raw)).items():
            ready = stage(df)
            found = blocking_findings(ready, contract_columns(name), CONTRACT_KEYS.get(name, []))
            if found:
                raise ValueError(f"{name} is not published: {'; '.join(found)}")
            key = next((c for c in ("code_insee_quartier", "arrondissement") if c in ready.columns), None)
            if catalog and key:
                # An empty table has no file to tell its columns by; the catalog knows them.
                written[name], back = f"{target.rstrip('/')}/{name}", publish_table(ready, name, f"{name}.parquet", target, bucket_by=key)
            else:
                written[name] = publish_fact(ready, name, f"{name}.parquet", target)
                back = spark.read.parquet(written[name])
            lines[name] = back.drop("loaded_at"), written[name]
    if written:
        publish_manifest(lines).write.mode("overwrite").json(f"{target.rstrip('/')}/manifest")
    return written


# The exported layer of each clean table.
_EXPORTED = {
    "quartiers": "quarters",
    "arrondissements": "zones",
    "iris": "iris",
    "commissariats": "police_stations",
    "cameras": "cameras",
    "gares": "stations",
}


def run_exports(spark: SparkSession, layer: str, target: str) -> dict[str, str]:
    """Write the feature layers and the bridge between statistical and fine zones."""
    tables = _tables(spark, layer)
    written = {}
    for name, mode in LAYERS.items():
        table = tables.get(_EXPORTED[name])
        if table is not None:
            written[name] = f"{target.rstrip('/')}/{name}"
            write_features(to_features(table, mode), written[name])
    if "iris" in tables and "quarters" in tables:
        written["iris_to_quartier"] = f"{target.rstrip('/')}/iris_to_quartier"
        write_layer(kpi.bridge(tables["iris"], tables["quarters"]), written["iris_to_quartier"])
    return written
