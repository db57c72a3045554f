"""Catalog tables in buckets, replacement of years, and files clustered for lookups."""

import pytest
from pyspark.sql import functions as F

from quadrille.sources import catalog

CODE, YEAR = catalog.CODE, catalog.YEAR


@pytest.fixture()
def names(spark):
    made = []
    yield lambda name: made.append(name) or name
    for name in made:
        spark.sql(f"drop table if exists {name}")


def facts(spark, n=240, years=4):
    code = F.format_string("7510%03d", (F.col("id") % (n // years)).cast("int")).alias(CODE)
    year = (F.lit(2020) + F.floor(F.col("id") / (n // years))).cast("int").alias(YEAR)
    return spark.range(n).select(year, code, F.col("id").cast("double").alias("v"))


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*.parquet")}


def scanned_rows(df):
    """Rows that the scans of an executed plan returned, after files and row groups were ruled out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_facts_in_the_same_buckets_join_without_exchange(spark, names, tmp_path):
    one = catalog.publish_table(facts(spark), names("cat_one"), "a", str(tmp_path), buckets=4)
    two = catalog.publish_table(facts(spark).withColumn("w", F.col("v") * 2).drop("v"), names("cat_two"), "b", str(tmp_path), buckets=4)
    still = facts(spark).groupBy(CODE).agg(F.max("v").alias("s"))
    three = catalog.publish_table(still, names("cat_three"), "c", str(tmp_path), buckets=4)
    with catalog.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        wide = catalog.beside(catalog.beside(one, two), three)
        rows = wide.collect()
        plan = wide._jdf.queryExecution().toString()
        grouped = wide.groupBy(CODE).agg(F.sum("w").alias("w"))
        both = plan + grouped._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Exchange" not in both
    assert len(rows) == 240 and all(r.w == r.v * 2 and r.s >= r.v for r in rows)
    assert wide.columns.count("source_file") == 1


def test_facts_beside_keep_rows_without_a_partner(spark, names, tmp_path):
    left = spark.createDataFrame([(2020, "a", 1.0), (2021, "a", 2.0), (None, "a", 3.0), (2020, None, 4.0)], f"{YEAR} int, {CODE} string, v double")
    right = spark.createDataFrame([(2021, "a", 9.0), (None, "a", 8.0), (2020, None, 7.0)], f"{YEAR} int, {CODE} string, w double")
    tables = [catalog.publish_table(d, names(n), n, str(tmp_path), buckets=2) for n, d in (("cat_l", left), ("cat_r", right))]
    found = catalog.beside(*tables).select("v", "w").collect()
    assert sorted(map(tuple, found), key=str) == [(1.0, None), (2.0, 9.0), (3.0, None), (4.0, None)]


def test_a_rerun_of_one_year_leaves_the_others(spark, names, tmp_path):
    name = names("cat_years")
    catalog.publish_table(facts(spark), name, "first", str(tmp_path), buckets=4)
    before = files_of(tmp_path / name)
    # One year comes with fewer rows than before, one is new; columns come in another order.
    again = facts(spark).where(F.col(YEAR) == 2021).limit(10).withColumn("v", F.lit(-1.0))
    new = facts(spark).where(F.col(YEAR) == 2020).withColumn(YEAR, F.lit(2030))
    catalog.replace_partitions(again.unionByName(new).select("v", CODE, YEAR), name, "second")
    after = files_of(tmp_path / name)
    untouched = {f: t for f, t in before.items() if "annee=2021" not in f}
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    assert not any(f in after for f in before if "annee=2021" in f)
    found = {(r[YEAR], r.source_file): r["n"] for r in spark.table(name).groupBy(YEAR, "source_file").agg(F.count("*").alias("n")).collect()}
    assert found == {(2020, "first"): 60, (2021, "second"): 10, (2022, "first"): 60, (2023, "first"): 60, (2030, "second"): 60}
    # Still in buckets: a file per bucket, and a group by code needs no exchange.
    assert max(sum(f.startswith(f"annee={y}") for f in after) for y in (2020, 2021, 2030)) <= 4
    grouped = spark.table(name).groupBy(CODE).count()
    grouped.collect()
    assert "Exchange" not in grouped._jdf.queryExecution().toString()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_replacement_refuses_what_it_cannot_place(spark, names, tmp_path):
    name, flat = names("cat_strict"), names("cat_flat")
    catalog.publish_table(facts(spark), name, "a", str(tmp_path), buckets=2)
    with pytest.raises(ValueError, match="no column x"):
        catalog.replace_partitions(facts(spark).withColumn("x", F.lit(1)), name, "b")
    catalog.replace_partitions(facts(spark).where("false"), name, "b")
    assert spark.table(name).where("source_file = 'a'").count() == 240
    catalog.replace_partitions(facts(spark).where(F.col(YEAR) == 2020).drop("v"), name, "b")
    assert spark.table(name).where("v is null").count() == 60
    catalog.publish_table(facts(spark).drop(YEAR), flat, "a", str(tmp_path), buckets=2)
    with pytest.raises(ValueError, match="no partitions"):
        catalog.replace_partitions(facts(spark).drop(YEAR), flat, "b")


def test_tables_follow_their_contract_and_are_published_again(spark, names, tmp_path):
    name = names("fact_kpi_prix_m2_quartier_annuel")
    df = spark.createDataFrame([(2020, "7510101", " ", 12.5), (None, None, "01", None)], f"{YEAR} int, {CODE} string, arrondissement string, prix_m2_median double")
    table = catalog.publish_table(df, name, "f.csv", str(tmp_path), buckets=2)
    assert {"nb_ventes", "source_file", "loaded_at"} <= set(table.columns) and table.where("arrondissement is null").count() == 1
    assert catalog.publish_table(df.limit(0), name, "f.csv", str(tmp_path), buckets=2).count() == 0
    # A new session knows no table yet, but the files are there.
    spark.sql(f"drop table {name}")
    assert catalog.publish_table(df, name, "f.csv", str(tmp_path), buckets=2).count() == 2


def test_lookups_read_matching_files(spark, tmp_path):
    code = F.format_string("7510%03d", (F.col("id") * 7919 % 200).cast("int")).alias(CODE)
    df = spark.range(60_000).select(code, (F.lit(1990) + F.col("id") * 104_729 % 30).cast("int").alias(YEAR), "id")
    path = catalog.write_clustered(df, str(tmp_path / "t"), file_rows=1_000)
    table = spark.read.parquet(path)
    assert table.count() == 60_000 and table.agg(F.sum("id")).first()[0] == 60_000 * 59_999 // 2
    reads = {
        "code": ({"code": "7510042"}, F.col(CODE) == "7510042"),
        "year": ({"year": 2001}, F.col(YEAR) == 2001),
        "both": ({"prefix": "751004", "year": 2001}, F.col(CODE).like("751004%") & (F.col(YEAR) == 2001)),
    }
    read = {}
    for name, (asked, test) in reads.items():
        found = catalog.lookup(table, **asked)
        read[name] = scanned_rows(found)
        assert sorted(r.id for r in found.collect()) == sorted(r.id for r in df.where(test).collect())
    # Sixty files: a cell of the curve that straddles two of them counts for both.
    assert read["code"] <= 15_000 and read["year"] <= 15_000 and read["both"] <= 4_000, read


def test_clustered_files_are_of_one_size(spark, tmp_path):
    df = spark.range(20_000).select(F.format_string("%05d", F.col("id") * 7919 % 20_000).alias(CODE), F.lit(2020).alias(YEAR))
    path = catalog.write_clustered(df, str(tmp_path / "even"), file_rows=1_000)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 20 and min(sizes) >= 990 and max(sizes) <= 1_010, sizes
    assert "spark.sql.execution.rangeExchange.sampleSizePerPartition" not in spark.conf.getAll


def test_clustered_tables_of_odd_rows(spark, tmp_path):
    schema = f"{CODE} string, {YEAR} int, x string"
    rows = [(None, None, None), ("", 2020, ""), ("é", None, "a")] + [("75", 2020, "same")] * 500 + [("75" * 5000, 2021, "long")]
    path = catalog.write_clustered(spark.createDataFrame(rows, schema), str(tmp_path / "odd"), file_rows=50)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert catalog.lookup(back, code="75").count() == 500 and catalog.lookup(back, prefix="75", year=2021).count() == 1
    empty = catalog.write_clustered(spark.createDataFrame([], schema), str(tmp_path / "none"))
    assert spark.read.schema(schema).parquet(empty).count() == 0
