"""Audits of published tables and of the files of a layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_even
from ..operators import quality
from ..operators.distribution import quantiles
from .prices import rounded
from .registry import Tables, query
from .standins import RAW_SALES, code_of, q, raw_sales, with_sql, z, zone_of


def damaged(t: Tables) -> DataFrame:
    """A published table with flaws set by rule: lost zones, words for years, copies."""
    base = t.lineitem.groupBy(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("y")).agg(
        F.count(F.lit(1)).cast("double").alias("nb_ventes")
    )
    zone = F.when(F.col("k") % 7 == 0, "").when(F.col("k") % 7 == 1, "Paris").otherwise(
        F.concat((F.col("k") % 20 + 1).cast("string"), F.lit(".0"))
    )
    year = F.when(F.col("k") % 11 == 0, "an 2000").otherwise(F.col("y").cast("string"))
    return base.select(
        zone.alias("arrondissement"),
        year.alias("annee"),
        code_of(F.col("k")).alias("code_insee_quartier"),
        F.when(F.col("k") % 5 != 0, F.col("nb_ventes")).alias("nb_ventes"),
    )


DAMAGED = f"""base as (
  select l_suppkey as k, year(l_shipdate) as y, cast(count(*) as double) as nb_ventes from lineitem group by all), damaged as (
  select case k % 7 when 0 then '' when 1 then 'Paris' else lpad(cast(k % 20 + 1 as varchar), 2, '0') end as arrondissement,
    case when k % 11 = 0 then 'an 2000' else cast(y as varchar) end as annee, {q('k')} as code_insee_quartier,
    case when k % 5 <> 0 then nb_ventes end as nb_ventes, k from base)"""


@query("dq_required_columns", with_sql(DAMAGED, select="""
select 'required_column' as check, 'blocking' as severity, 'prix_m2_median' as detail, count(*) as violations from damaged"""))
def dq_required_columns(t: Tables) -> DataFrame:
    return quality.missing_required(damaged(t), quality.REQUIRED["kpi_prix_m2_arrondissement"])


@query("dq_zone_format", with_sql(DAMAGED, select="""
select 'zone_format' as check, 'blocking' as severity, 'arrondissement' as detail,
  count(case when k % 7 < 2 then 1 end) as violations from damaged"""))
def dq_zone_format(t: Tables) -> DataFrame:
    return quality.value_checks(damaged(t)).where("check = 'zone_format'")


@query("dq_year_numeric", with_sql(DAMAGED, select="""
select 'year_numeric' as check, 'blocking' as severity, 'annee' as detail,
  count(case when k % 11 = 0 then 1 end) as violations from damaged"""))
def dq_year_numeric(t: Tables) -> DataFrame:
    return quality.value_checks(damaged(t)).where("check = 'year_numeric'")


@query("dq_report", with_sql(DAMAGED, select="""
select 'zone_format' as check, 'blocking' as severity, 'arrondissement' as detail, count(*) as violations from damaged where k % 7 < 2
union all select 'year_numeric', 'blocking', 'annee', count(*) from damaged where k % 11 = 0
union all select 'required_column', 'blocking', 'prix_m2_median', count(*) from damaged
union all select 'legacy_name', 'warning', 'nb_ventes', count(*) from damaged"""))
def dq_report(t: Tables) -> DataFrame:
    return quality.report(damaged(t), quality.REQUIRED["kpi_prix_m2_arrondissement"])


@query("dq_unique_key", with_sql(DAMAGED, select="""
select annee, code_insee_quartier, count(*) as n from damaged group by all having count(*) > 1"""))
def dq_unique_key(t: Tables) -> DataFrame:
    return quality.duplicate_keys(damaged(t), ["annee", "code_insee_quartier"])


@query("null_summary", with_sql(DAMAGED, select="""
select 'nb_ventes' as column_name, count(case when nb_ventes is null then 1 end) as missing,
  round_even(count(case when nb_ventes is null then 1 end) * 100.0::double / count(*), 2) as missing_pct from damaged
union all select 'annee', 0, 0.0 from (select count(*) from damaged) c"""))
def null_summary(t: Tables) -> DataFrame:
    return quality.null_summary(damaged(t), ["nb_ventes", "annee"])


def two_versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The sales before and after the filter on value."""
    rows = raw_sales(t).select("annee", "arrondissement", "prix_m2", "valeur_fonciere")
    return rows.drop("valeur_fonciere"), rows.where("valeur_fonciere > 10000").drop("valeur_fonciere")


def _facts(where: str, name: str) -> str:
    return f"""{name} as (select unnest(['rows', 'keys', 'prix_m2_mean', 'prix_m2_missing', 'prix_m2_median']) as metric,
  unnest([count(*)::double, count(distinct annee::varchar || arrondissement)::double, avg(prix_m2),
    count(case when prix_m2 is null then 1 end)::double, median(prix_m2)]) as v from raw_sales where {where})"""


@query("regression_diff", with_sql(RAW_SALES, _facts("true", "a"), _facts("valeur_fonciere > 10000", "b"), select="""
select metric, round_even(a.v, 6) as before, round_even(b.v, 6) as after, round_even(b.v - a.v, 6) as change
from a join b using (metric)"""))
def regression_diff(t: Tables) -> DataFrame:
    before, after = two_versions(t)
    return rounded(quality.regression_diff(before, after, ["annee", "arrondissement"], ["prix_m2"]))


#: Columns of whole tables, by how their values are written so that any engine writes them alike.
WHOLE = {
    "customer": {"c_custkey": "", "c_name": "", "c_nationkey": "", "c_acctbal": "number", "c_mktsegment": ""},
    "part": {"p_partkey": "", "p_name": "", "p_brand": "", "p_type": "", "p_size": "", "p_retailprice": "number"},
    "orders": {
        "o_orderkey": "", "o_custkey": "", "o_orderstatus": "", "o_totalprice": "number", "o_orderdate": "time", "o_orderpriority": "",
    },
    "events": {"event_id": "", "ts": "time", "user_id": "", "event_type": "", "value": "number", "props": ""},
}


def portable(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Every column of ``df``: numbers as whole millionths, times as text to the microsecond."""
    said = {
        "": lambda c: F.col(c),
        "number": lambda c: F.floor(F.col(c) * 1e6 + 0.5).cast("bigint"),
        "time": lambda c: F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    }
    return df.select(*[said[kinds.get(c, "")](c).alias(c) for c in df.columns])


def fingerprint_sql(table: str, kinds: Mapping[str, str], **named: str) -> str:
    """Row count and content hash of a table's columns, in SQL."""
    said = {"": "{}", "number": "floor({} * 1e6::double + 0.5)::bigint", "time": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"}
    texts = [f"({said[kinds[c]].format(c)})::varchar" for c in sorted(kinds)]
    parts = " || ".join(f"coalesce(length({x}) || ':' || {x}, '-')" for x in texts)
    more = "".join(f"'{v}' as {k}, " for k, v in named.items())
    return f"""select {more}count(*) as rows, sum(n)::varchar as content_sum, bit_xor(n) as content_xor
from (select ('0x' || substr(md5({parts}), 1, 15))::bigint as n from {table}) x"""


@query("table_fingerprint", " union all ".join(fingerprint_sql(n, c, table_name=n) for n, c in WHOLE.items()))
def table_fingerprint(t: Tables) -> DataFrame:
    """Row counts and content hashes of whole tables."""
    lines = [
        quality.table_fingerprint(portable(getattr(t, name), kinds)).select(
            F.lit(name).alias("table_name"), "rows", F.col("content_sum").cast("string").alias("content_sum"), "content_xor"
        )
        for name, kinds in WHOLE.items()
    ]
    return reduce(DataFrame.unionByName, lines)
