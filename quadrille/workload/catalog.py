"""Facts as bucketed catalog tables and as clustered files, and the reads they are laid out for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import serving
from ..session import staged_path
from ..sources.catalog import beside, lookup, publish_table, replace_partitions, write_clustered
from .prices import rounded
from .registry import Tables, query
from .serving import CODE, GOLD, YEAR, published
from .standins import RAW_SALES, raw_sales, with_sql


def fact_tables(t: Tables) -> dict[str, DataFrame]:
    """Four facts as catalog tables; the prices of 1997 are then published anew, a hundred higher."""
    run, path = uuid.uuid4().hex, staged_path(t.spark)
    facts = published(t, "prix_m2", "loyers", "confort", "logements_sociaux")
    tables = {c: publish_table(df, f"fact_{c}_{run}", c, path, buckets=8) for c, df in facts.items()}
    again = facts["prix_m2"].where(F.col(YEAR) == 1997).withColumn("prix_m2_median", F.col("prix_m2_median") + 100)
    tables["prix_m2"] = replace_partitions(again, f"fact_prix_m2_{run}", "prix_m2 of 1997")
    return tables


def fact_profile(tables: dict[str, DataFrame]) -> DataFrame:
    wide = tables["prix_m2"].select(YEAR, CODE, "prix_m2_median", "source_file")
    wide = beside(wide, tables["loyers"].select(YEAR, CODE, "loyer_reference_median"))
    wide = beside(wide, tables["confort"].select(CODE, "score_confort_urbain_100"))
    return beside(wide, tables["logements_sociaux"].select(YEAR, CODE, "logements_finances_moyen"))


@query("fact_table_profile", with_sql(GOLD, select="""
select p.annee, p.code_insee_quartier, round_even(p.v + case when p.annee = 1997 then 100 else 0 end, 6) as prix_m2_median,
  case when p.annee = 1997 then 'prix_m2 of 1997' else 'prix_m2' end as source_file, round_even(l.v, 6) as loyer_reference_median,
  round_even(c.v, 6) as score_confort_urbain_100, round_even(s.v, 6) as logements_finances_moyen
from t_prix_m2 p left join t_loyers l using (code_insee_quartier, annee) left join t_confort c on c.code_insee_quartier = p.code_insee_quartier
  left join t_logements_sociaux s on s.code_insee_quartier = p.code_insee_quartier and s.annee = p.annee"""))
def fact_table_profile(t: Tables) -> DataFrame:
    """Facts side by side from tables in the same buckets, one year of one of them replaced before."""
    return rounded(fact_profile(fact_tables(t)))


@query("lookup_clustered", with_sql(GOLD, select="""
select code_insee_quartier, category, annee, round_even(case when category = 'logements_sociaux' then total else v end, 6) as value
from stacked left join (select annee as y, code_insee_quartier as c, total from social) s
  on s.y = annee and s.c = code_insee_quartier
where category in ('prix_m2', 'loyers', 'logements_sociaux') and annee = 1997 and code_insee_quartier like '75107%'"""))
def lookup_clustered(t: Tables) -> DataFrame:
    """Equality on the year and prefix of the code over the published series, laid out along a curve of both."""
    series = serving.history(published(t, "prix_m2", "loyers", "logements_sociaux"))
    path = write_clustered(series, staged_path(t.spark), (CODE, YEAR))
    return rounded(lookup(t.spark.read.parquet(path), prefix="75107", year=1997))


@query("sales_lookup_clustered", with_sql(RAW_SALES, select="""
select annee, code_insee_quartier, source, valeur_fonciere, round_even(prix_m2, 6) as prix_m2 from raw_sales
where annee = 1996 and code_insee_quartier = '7510703'"""))
def sales_lookup_clustered(t: Tables) -> DataFrame:
    """All sales of one fine zone and year, from the sales laid out along a curve of both."""
    sales = raw_sales(t).select(YEAR, CODE, "source", "valeur_fonciere", "prix_m2")
    path = write_clustered(sales, staged_path(t.spark), (CODE, YEAR))
    return rounded(lookup(t.spark.read.schema(sales.schema).parquet(path), code="7510703", year=1996))
