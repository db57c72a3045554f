"""Audits of published tables and fingerprints of layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import half_even

from ..functions.zones import zone2_published
from .distribution import medians

# Other names a required column may go by.
ALIASES = {"code_iris": ["CODE_IRIS"], "kpi_confort_urbain": ["KPI_confort_urbain"]}

# Columns every published table must have.
REQUIRED = {
    "kpi_prix_m2_arrondissement": ["annee", "arrondissement", "prix_m2_median"],
    "kpi_evolution_achat_prix_m2": ["annee", "arrondissement", "prix_m2_median"],
    "kpi_evolution_location_loyer": ["annee", "arrondissement", "loyer_reference_median"],
    "kpi_score_surete_arrondissement_agrege_depuis_iris": ["annee", "arrondissement", "score_surete_zone_moyen_100"],
    "kpi_score_surete_iris": ["annee", "arrondissement", "code_iris", "score_surete_final_100"],
    "kpi_comparaison_achat_location": [
        "arrondissement", "kpi_comparaison_achat_location_2021", "kpi_comparaison_achat_location_2025",
    ],
    "kpi_repartition_logements_sociaux": ["arrondissement"],
    "kpi_loyers": ["arrondissement", "loyer_reference_median"],
    "kpi_loyer_par_arrondissement": ["arrondissement", "loyer_reference_median"],
    "gold_kpi_confort_urbain": ["arrondissement", "kpi_confort_urbain"],
}

# Old names that only deserve a warning.
LEGACY_NAMES = {"nb_ventes": "nb_transactions"}

BLOCKING, WARNING = "blocking", "warning"

_CHECK = "check string, severity string, detail string, violations bigint"


def missing_required(df: DataFrame, names: Sequence[str], aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Required columns that neither they nor an alias provide, with the rows that lack them."""
    absent = [n for n in names if n not in df.columns and not set(aliases.get(n, ())) & set(df.columns)]
    return _flagged(df, [("required_column", BLOCKING, n) for n in absent])


def _flagged(df: DataFrame, findings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Findings about whole columns: each concerns every row of the table."""
    if not findings:
        return df.sparkSession.createDataFrame([], _CHECK)
    lines = [_violation(*f, F.lit(True)) for f in findings]
    return df.agg(F.array(*lines).alias("t")).select(F.explode("t").alias("t")).select("t.*")


def _violation(check: str, severity: str, detail: str, bad: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        F.lit(detail).alias("detail"),
        F.count_if(bad).cast("bigint").alias("violations"),
    )


def bad_zone(col: Column) -> Column:
    return ~F.coalesce(zone2_published(col).rlike(r"^\d{2}$"), F.lit(False))


def bad_year(col: Column) -> Column:
    text = col.cast("string")
    return text.isNotNull() & (F.trim(text) != "") & text.try_cast("double").isNull()


def value_checks(df: DataFrame, zone: str = "arrondissement", year: str = "annee") -> DataFrame:
    """Zone format and year checks, both counted in one pass."""
    tests = []
    if zone in df.columns:
        tests.append(_violation("zone_format", BLOCKING, zone, bad_zone(F.col(zone))))
    if year in df.columns:
        tests.append(_violation("year_numeric", BLOCKING, year, bad_year(F.col(year))))
    return df.agg(F.array(*tests).alias("t")).select(F.explode("t").alias("t")).select("t.*")


def report(df: DataFrame, required: Sequence[str], legacy: Mapping[str, str] = LEGACY_NAMES) -> DataFrame:
    """Every finding on a table, blocking or warning; an empty report is a clean table."""
    old = [("legacy_name", WARNING, n) for n in legacy if n in df.columns]
    names = missing_required(df, required)
    return value_checks(df).where("violations > 0").unionByName(names).unionByName(_flagged(df, old))


def blocking_findings(df: DataFrame, required: Sequence[str], keys: Sequence[str]) -> list[str]:
    """What forbids publishing a table: absent columns, ill-formed zones and years, keys that occur twice."""
    found = [f"{r.check} {r.detail}: {r.violations}" for r in report(df, required).where(F.col("severity") == BLOCKING).collect()]
    absent = [k for k in keys if k not in df.columns]
    if keys and not absent:
        twice = duplicate_keys(df, keys).count()
        found += [f"duplicate_key {', '.join(keys)}: {twice}"] if twice else []
    return found


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_summary(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Missing values and their percent per column, in one pass over the table."""
    names = list(names or df.columns)
    lines = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.count_if(F.col(n).isNull()).alias("missing"),
            half_even(F.try_divide(F.count_if(F.col(n).isNull()) * 100.0, F.count(F.lit(1))), 2).alias("missing_pct"),
        )
        for n in names
    ]
    return df.agg(F.array(*lines).alias("l")).select(F.explode("l").alias("l")).select("l.*")


def snapshot(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Comparable facts of one table version in long form (metric, value)."""
    facts = {
        "rows": F.count(F.lit(1)).cast("double"),
        "keys": F.count_distinct(F.struct(*keys)).cast("double"),
        **{f"{m}_mean": F.avg(m) for m in measures},
        **{f"{m}_missing": F.count_if(F.col(m).isNull()).cast("double") for m in measures},
    }
    line = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"`{k}`").alias("value")) for k in facts])
    return df.agg(*[c.alias(k) for k, c in facts.items()]).select(F.explode(line).alias("f")).select("f.*")


def regression_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Metric by metric, the two versions of a table and their difference."""
    def facts(df: DataFrame, name: str) -> DataFrame:
        middle = medians(df, [], {f"{m}_median": m for m in measures})
        long = middle.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in middle.columns])).alias("f")
        ).select("f.*")
        return snapshot(df, keys, measures).unionByName(long).withColumnRenamed("value", name)

    both = facts(before, "before").join(facts(after, "after"), "metric", "outer")
    return both.withColumn("change", F.col("after") - F.col("before"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free content hash of a table.

    A row is the text of its columns by name, each with its length in front and null told apart, so values cannot move
    between columns unseen; its number is 60 bits of the md5 of that. Sums are decimals, which no table overflows.
    """
    parts = []
    for name in sorted(df.columns):
        text = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    number = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(number.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("content_sum"),
        F.coalesce(F.bit_xor(number), F.lit(0)).alias("content_xor"),
    )


def layer_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Path relative to the layer root and SHA-256 of every file under it, hashed in tasks."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    base = root.rstrip("/") + "/"
    return reader.load(root).select(
        F.expr("path").alias("_p"), F.sha2("content", 256).alias("sha256"), "length"
    ).select(F.substring("_p", F.locate(base, F.col("_p")) + len(base), F.length("_p")).alias("path"), "sha256", "length")


def verify_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """ok, tampered, untracked or missing for every path on either side."""
    joined = files.select("path", F.col("sha256").alias("found")).join(
        manifest.select("path", F.col("sha256").alias("recorded")), "path", "outer"
    )
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("recorded").isNull(), "untracked")
        .when(F.col("found") == F.col("recorded"), "ok")
        .otherwise("tampered")
    )
    return joined.withColumn("status", status)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``<sha256>  <relative path>`` lines; comments and blanks are skipped."""
    text = F.trim("value")
    return (
        spark.read.text(path)
        .where((text != "") & ~text.startswith("#") & F.contains(text, F.lit("  ")))
        .select(F.regexp_extract(text, r"^(\S+)  (.*)$", 2).alias("path"), F.regexp_extract(text, r"^(\S+)  ", 1).alias("sha256"))
    )


def write_manifest(files: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Manifest after a scan: recorded files not seen now are kept; new and changed are marked."""
    if previous is None:
        return files.select("path", "sha256", F.lit("new").alias("change"))
    both = verify_manifest(files, previous)
    change = F.when(F.col("status") == "untracked", "new").when(F.col("status") == "tampered", "changed")
    return both.select("path", F.coalesce("found", "recorded").alias("sha256"), F.coalesce(change, F.lit("same")).alias("change"))


def uncatalogued(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """Files no catalog entry names."""
    return files.join(catalog.select(F.col("file").alias("path")), "path", "left_anti")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").json(path).select(F.explode("datasets").alias("d")).select("d.*")
