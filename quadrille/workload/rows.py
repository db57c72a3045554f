"""Unions, dedupes, projections and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.zones import zone2_published
from ..operators.columns import drop_existing, keep, normalize_headers, rename_existing
from ..operators.hygiene import first_per_key, union_sources
from ..operators.serving import zone_members
from ..plans import indicators as kpi
from ..sources.publish import CONTRACTS, cast_to_contract
from .prices import rounded
from .registry import Tables, query
from .standins import IRIS, QUARTERS, iris, q, quarters, with_sql, z, code_of, zone_of


@query("union_sources", f"""
select distinct code, zone, segment from (
  select {q('c_custkey')} as code, {z('c_custkey')} as zone, c_mktsegment as segment from customer
  union all select {q('s_suppkey')}, {z('s_suppkey')}, null from supplier
  union all select {q('c_custkey')}, {z('c_custkey')}, c_mktsegment from customer) u""")
def union_of_sources(t: Tables) -> DataFrame:
    """Sources with different columns, one of them arriving twice, without exact copies."""
    first = t.customer.select(
        code_of(F.col("c_custkey")).alias("code"), zone_of(F.col("c_custkey")).alias("zone"), F.col("c_mktsegment").alias("segment")
    )
    second = t.supplier.select(zone_of(F.col("s_suppkey")).alias("zone"), code_of(F.col("s_suppkey")).alias("code"))
    return union_sources([first, second, first]).dropDuplicates()


@query("dedupe_first", f"""
select code, l_orderkey, l_linenumber, l_extendedprice from (
  select {q('l_suppkey')} as code, l_orderkey, l_linenumber, l_extendedprice, row_number() over (
    partition by {q('l_suppkey')} order by l_orderkey, l_linenumber, l_extendedprice) as rn from lineitem) x where rn = 1""")
def dedupe_first(t: Tables) -> DataFrame:
    rows = t.lineitem.select(code_of(F.col("l_suppkey")).alias("code"), "l_orderkey", "l_linenumber", "l_extendedprice")
    return first_per_key(rows, ["code"], ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("distinct_zones", f"""
select distinct {z('l_suppkey')} as arrondissement, {q('l_suppkey')} as code_insee_quartier from lineitem""")
def distinct_zones(t: Tables) -> DataFrame:
    key = F.col("l_suppkey")
    return t.lineitem.select(zone_of(key).alias("arrondissement"), code_of(key).alias("code_insee_quartier")).distinct()


@query("rename_and_project", """
select cast(c_custkey as bigint) as identifiant, trim(c_name) as nom_client,
  lpad(cast(c_nationkey % 20 + 1 as varchar), 2, '0') as arrondissement from customer""")
def rename_and_project(t: Tables) -> DataFrame:
    """Published-file hygiene: header keys, renames, kept columns in order, zone text."""
    raw = t.customer.select(
        F.col("c_custkey").alias("Identifiant "),
        F.concat(F.lit(" "), F.col("c_name")).alias("Nom-Client"),
        F.concat((F.col("c_nationkey") % 20 + 1).cast("string"), F.lit(".0")).alias("Numéro d’Arrondissement"),
        F.col("c_acctbal").alias("Commentaires"),
    )
    df = rename_existing(normalize_headers(raw), {"numero_d_arrondissement": "arrondissement", "absent": "x"})
    df = keep(drop_existing(df, ["commentaires", "ville"]), ["identifiant", "absent", "nom_client", "arrondissement"])
    return df.withColumns({"nom_client": F.trim("nom_client"), "arrondissement": zone2_published(F.col("arrondissement"))})


@query("cast_contract", with_sql(QUARTERS, select="""
select arrondissement, code_insee_quartier, nom_quartier, round_even(cast(surface_quartier_m2 as decimal(20,6))::double, 4) as surface,
  null::double as incidents from quarters"""))
def cast_contract(t: Tables) -> DataFrame:
    """Columns of a published table by name and type; one that is absent is null."""
    out = cast_to_contract(quarters(t).drop("geometry_xy"), CONTRACTS["fact_kpi_confort_quartier"])
    return rounded(
        out.select(
            "arrondissement",
            "code_insee_quartier",
            "nom_quartier",
            F.col("surface_quartier_m2").cast("double").alias("surface"),
            F.col("incidents_estime").cast("double").alias("incidents"),
        ),
        4,
    )


@query("concat_sorted_unique", with_sql(IRIS, select="""
select substr(code_iris, 1, 7) as code_insee_quartier, string_agg(distinct nom_iris, ' | ' order by nom_iris) as noms,
  string_agg(distinct code_iris, ' | ' order by code_iris) as codes from iris group by 1"""))
def concat_sorted_unique(t: Tables) -> DataFrame:
    """Labels and codes of the statistical zones of each fine zone."""
    rows = iris(t).withColumn("code_insee_quartier", F.substring("CODE_IRIS", 1, 7))
    return rows.groupBy("code_insee_quartier").agg(
        kpi.sorted_labels("NOM_IRIS").alias("noms"), kpi.sorted_labels("CODE_IRIS").alias("codes")
    )


@query("zone_members", with_sql(QUARTERS, select="""
select arrondissement, count(*) as nb_quartiers, string_agg(nom_quartier, '; ' order by nom_quartier) as quartiers
from quarters group by all"""))
def members_of_zones(t: Tables) -> DataFrame:
    out = zone_members(quarters(t), "arrondissement", "nom_quartier")
    return out.withColumn("quartiers", F.array_join("quartiers", "; "))


@query("bridge_table", with_sql(IRIS, QUARTERS, select="""
, i as (select *, case when arrondissement = '20' then '92020' else '751' || arrondissement end as insee_com from iris)
select code_iris, coalesce(code_insee_quartier, '') as code_insee_quartier, coalesce(nom_quartier, '') as nom_quartier, insee_com,
  case when i.arrondissement = '20' then '' else i.arrondissement end as arrondissement, nom_iris
from i left join quarters q on i.insee_com = '751' || q.arrondissement"""))
def bridge_table(t: Tables) -> DataFrame:
    """Statistical to fine zones; those outside the city stay with blanks."""
    outside = F.when(F.col("INSEE_COM") == "75120", "92020").otherwise(F.col("INSEE_COM"))
    return kpi.bridge(iris(t).withColumn("INSEE_COM", outside), quarters(t))
