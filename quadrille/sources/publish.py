"""Published fact tables: typed contracts, lineage, manifest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.hygiene import blank_to_null
from ..operators.quality import table_fingerprint

# The published tables, their columns and types, and their keys.
CONTRACTS = {
    "fact_kpi_prix_m2_arrondissement": "arrondissement string, prix_m2_moyen decimal(20,6)",
    "fact_kpi_prix_m2_quartier_annuel": """
        annee int, arrondissement string, code_insee_quartier string,
        prix_m2_median decimal(20,6), prix_m2_moyen decimal(20,6), nb_ventes bigint, nb_ventes_estime bigint,
        surface_quartier_m2 decimal(20,6), part_surface decimal(20,10)""",
    "fact_kpi_comparaison_achat_location_arrondissement": """
        annee int, arrondissement string, prix_m2_median decimal(20,6), prix_m2_moyen decimal(20,6),
        nb_transactions bigint, loyer_reference_median decimal(20,6), loyer_reference_moyen decimal(20,6),
        nb_observations bigint, kpi_comparaison_achat_location decimal(20,6)""",
    "fact_kpi_comparaison_achat_location_quartier": """
        annee int, arrondissement string, code_insee_quartier string,
        prix_m2_median decimal(20,6), prix_m2_moyen decimal(20,6), nb_transactions bigint,
        loyer_reference_median decimal(20,6), loyer_reference_moyen decimal(20,6), nb_observations bigint,
        kpi_comparaison_achat_location decimal(20,6), surface_quartier_m2 decimal(20,6),
        part_surface decimal(20,10), nb_transactions_estime bigint, nb_observations_estime bigint""",
    "fact_kpi_loyers_quartier": """
        annee int, arrondissement string, code_insee_quartier string,
        loyer_reference_median decimal(20,6), loyer_reference_moyen decimal(20,6), nb_observations bigint,
        loyer_reference_majore_median decimal(20,6), loyer_reference_minore_median decimal(20,6),
        nombre_pieces_median decimal(20,6), nom_quartier string, type_location_mode string,
        epoque_construction_mode string""",
    "fact_kpi_repartition_logements_sociaux": """
        annee int, arrondissement string, code_insee_quartier string, nom_quartier string,
        logements_finances_total decimal(20,6), logements_finances_moyen decimal(20,6), nb_programmes bigint,
        nb_bailleurs bigint, nb_pla_i_total decimal(20,6), nb_plus_total decimal(20,6),
        nb_plus_cd_total decimal(20,6), nb_pls_total decimal(20,6), latitude_moyenne decimal(20,6),
        longitude_moyenne decimal(20,6)""",
    "fact_kpi_confort_quartier": """
        arrondissement string, code_insee_quartier string, nom_quartier string,
        surface_quartier_m2 decimal(20,6), part_surface decimal(20,10), incidents_estime decimal(20,6),
        travaux_estime decimal(20,6), gares_estime decimal(20,6), risque_incidents_100 decimal(20,6),
        score_confort_urbain_100 decimal(20,6)""",
    "fact_kpi_surete_quartier": """
        annee int, arrondissement string, code_insee_quartier string,
        score_surete_quartier_moyen_100 decimal(20,6), score_risque_quartier_moyen_100 decimal(20,6),
        score_surete_iris_min_100 decimal(20,6), score_surete_iris_max_100 decimal(20,6),
        score_surete_iris_std_100 decimal(20,6), score_risque_iris_min_100 decimal(20,6),
        score_risque_iris_max_100 decimal(20,6), score_risque_iris_std_100 decimal(20,6),
        nb_iris_rattaches bigint, codes_iris_rattaches string, noms_iris_rattaches string,
        dist_commissariat_km_moyenne decimal(20,6), nb_cameras_arrondissement bigint""",
}
CONTRACT_KEYS = {
    "fact_kpi_evolution_quartier": ["code_insee_quartier"],
    "fact_kpi_surete_arrondissement": ["annee", "arrondissement"],
    "fact_kpi_confort_cinq_axes": ["code_insee_quartier"],
    "fact_kpi_prix_m2_arrondissement": ["arrondissement"],
    "fact_kpi_prix_m2_quartier_annuel": ["annee", "code_insee_quartier"],
    "fact_kpi_comparaison_achat_location_arrondissement": ["annee", "arrondissement"],
    "fact_kpi_comparaison_achat_location_quartier": ["annee", "code_insee_quartier"],
    "fact_kpi_loyers_quartier": ["annee", "code_insee_quartier"],
    "fact_kpi_repartition_logements_sociaux": ["annee", "arrondissement", "code_insee_quartier"],
    "fact_kpi_confort_quartier": ["code_insee_quartier"],
    "fact_kpi_surete_quartier": ["annee", "code_insee_quartier"],
}


def contract_columns(name: str) -> list[str]:
    """Columns that a published table must have; none for a table without a contract."""
    return StructType.fromDDL(CONTRACTS[name]).fieldNames() if name in CONTRACTS else []


def cast_to_contract(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of a contract by name, in its order and types; absent ones are null.

    Null, blank text and NaN are missing values. Any other value that does not fit its type fails the load, with its
    column and text in the message: a published count is right or not published.
    """

    def typed(name: str, dtype) -> Column:
        text = F.trim(F.col(name).cast("string"))
        missing = F.col(name).isNull() | text.isin("", "NaN")
        fitted = F.col(name).try_cast(dtype)
        complaint = F.raise_error(F.concat(F.lit(f"{name}: no {dtype.simpleString()}: "), text))
        return F.when(missing, F.lit(None)).when(fitted.isNull(), complaint.cast(dtype)).otherwise(fitted)

    return df.select(
        *[
            (typed(f.name, f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in StructType.fromDDL(ddl).fields
        ]
    )


def with_lineage(df: DataFrame, source: str, clock: bool = True) -> DataFrame:
    """Blank text as null, plus where the rows came from and when they were loaded."""
    out = blank_to_null(df).withColumn("source_file", F.lit(source))
    return out.withColumn("loaded_at", F.current_timestamp()) if clock else out


def publish_fact(
    df: DataFrame, name: str, source: str, path: str, replace: bool = True, partition_by: str | None = "annee"
) -> str:
    """Write one fact table under ``path`` by contract, partitioned by year where it has one."""
    typed = cast_to_contract(df, CONTRACTS[name]) if name in CONTRACTS else df
    writer = with_lineage(typed, source).write.mode("overwrite" if replace else "append")
    if partition_by and partition_by in typed.columns:
        writer = writer.partitionBy(partition_by)
    target = f"{path.rstrip('/')}/{name}"
    writer.parquet(target)
    return target


def publish_jdbc(df: DataFrame, name: str, source: str, url: str, replace: bool = True, **options: str) -> None:
    """The same load into a relational database, by column name; needs its driver on the classpath."""
    typed = cast_to_contract(df, CONTRACTS[name]) if name in CONTRACTS else df
    writer = with_lineage(typed, source).write.format("jdbc").option("url", url).option("dbtable", name)
    writer.options(truncate="true", **options).mode("overwrite" if replace else "append").save()


def publish_manifest(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per published table: source, row count and content fingerprint."""
    out = None
    for name, (df, source) in tables.items():
        line = table_fingerprint(df).select(
            F.lit(name).alias("table_name"), F.lit(source).alias("source"), "rows", "content_sum", "content_xor"
        )
        out = line if out is None else out.unionByName(line)
    return out
