"""Fact tables in the catalog, laid out for the reads that follow: bucketed for joins, clustered for lookups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import CONTRACTS, cast_to_contract, with_lineage

CODE, YEAR = "code_insee_quartier", "annee"
BUCKETS = 64
#: A clustered table: bits of a column's cells on the curve, accuracy of their cuts, rows of a file, bytes of a row group.
CURVE_BITS = 6
CUT_ACCURACY = 1_000
FILE_ROWS = 4_000_000
GROUP_BYTES = 16 << 20


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def publish_table(
    df: DataFrame,
    name: str,
    source: str,
    path: str,
    bucket_by: str = CODE,
    partition_by: str | None = YEAR,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Create or replace a catalog table under ``path``, by contract and with lineage, and return it.

    Rows are in ``buckets`` buckets by ``bucket_by``, sorted by it, one file a bucket and partition: tables published
    with the same number of buckets join and group by that column without an exchange. ``partition_by`` makes a folder
    per value, where the table has that column. Rows without a code share a bucket. An empty table is created empty.
    """
    spark = df.sparkSession
    typed = with_lineage(cast_to_contract(df, CONTRACTS[name]) if name in CONTRACTS else df, source)
    # Tasks own whole buckets, so a bucket is one file in every partition.
    writer = typed.repartition(buckets, bucket_by).write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", f"{path.rstrip('/')}/{name}")
    if partition_by and partition_by in typed.columns:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str, source: str) -> DataFrame:
    """Replace the partitions of a published table that ``df`` has rows of, and leave the others as they are.

    Columns go by name; absent ones are null, ones that the table does not have are an error. ``df`` may read the table
    itself only if it was staged before. Without rows nothing changes.
    """
    spark = df.sparkSession
    table = spark.table(name)
    typed = with_lineage(cast_to_contract(df, CONTRACTS[name]) if name in CONTRACTS else df, source)
    unknown = sorted(set(typed.columns) - set(table.columns))
    if unknown:
        raise ValueError(f"{name} has no column {', '.join(unknown)}")
    if not [f for f in spark.catalog.listColumns(name) if f.isPartition]:
        raise ValueError(f"{name} has no partitions")
    bucketed = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    fields = [(F.col(f.name) if f.name in typed.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
    rows = typed.select(*fields)
    if bucketed:
        rows = rows.repartition(_buckets(spark, name), *bucketed)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.insertInto(name, overwrite=True)
    return spark.table(name)


def _buckets(spark: SparkSession, name: str) -> int:
    described = spark.sql(f"describe table extended `{name}`").where(F.col("col_name") == "Num Buckets")
    return int(described.first()["data_type"])


def beside(facts: DataFrame, other: DataFrame, code: str = CODE, year: str = YEAR) -> DataFrame:
    """``facts`` left joined with another fact on code and, where it has one, on year; shared columns are kept once.

    The hash key is the code alone, by which both tables are in buckets already. The year is compared inside a code,
    which holds a row per year: as an equality it would become a key as well, and both sides would be shuffled by it.
    """
    yearly = year in other.columns
    renamed = other.withColumnsRenamed({code: "__code", **({year: "__year"} if yearly else {})})
    drop = [c for c in renamed.columns if c in facts.columns]
    on = F.col(code) == F.col("__code")
    if yearly:
        on = on & (F.col(year) <= F.col("__year")) & (F.col(year) >= F.col("__year"))
    return facts.join(renamed.drop(*drop), on, "left").drop("__code", "__year")


def _ordered_number(df: DataFrame, column: str) -> Column:
    """A number in the column's order: the value itself, for text its first seven bytes."""
    if dict(df.dtypes)[column] != "string":
        return F.col(column).cast("double")
    lead = F.rpad(F.hex(F.substring(F.encode(F.col(column), "utf-8"), 1, 7)), 14, "0")
    return F.conv(lead, 16, 10).cast("bigint").cast("double")


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """Place on a Z-order curve: the bits of all columns' cells in turn, the highest first.

    A column's cells are cut at its quantiles, so they hold about as many rows each. One job finds all cuts; nulls are
    in the first cell. Cuts only decide how rows are laid out, never what a read returns.
    """
    numbers = [_ordered_number(df, c) for c in columns]
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(n, shares, CUT_ACCURACY).alias(f"c{i}") for i, n in enumerate(numbers)]).first()
    place = F.lit(0).cast("bigint")
    for at, number in enumerate(numbers):
        found = sorted(set(cuts[at] or []))
        over = sum([F.when(number > F.lit(cut), 1).otherwise(0) for cut in found], F.lit(0))
        # A column of few values spreads over all bits, or the others would decide the order ahead of it.
        cell = F.floor(over * F.lit(2**bits) / F.lit(len(found) + 1)).cast("bigint")
        for bit in range(bits):
            taken = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(taken, bit * len(numbers) + len(numbers) - 1 - at))
    return place


#: Cuts between files are taken from so many rows a file (Spark's 100 leave files of uneven size, another each run), as
#: long as the driver holds no more than so many in all.
SAMPLES_PER_FILE, MOST_SAMPLES = 400, 100_000
_SAMPLES_KEY = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str] = (CODE, YEAR), file_rows: int = FILE_ROWS, bits: int = CURVE_BITS
) -> str:
    """Write a table for lookups by any of ``columns`` or by several: files hold neighbours on a Z-order curve.

    Each file and row group then spans few values of every column, so their least and greatest values rule most of
    them out; Parquet Bloom filters (dictionaries, where a group has few values) serve equality. Three jobs: cuts, rows
    and the write. A hot value spans as many files as its rows need: ties on the curve go by a digest of the row.
    Nulls are in the first cells. An empty table is written empty.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = df.withColumns({"__place": curve_place(df, columns, bits), "__tie": tie})
    files = max(1, -(-df.count() // file_rows))
    rows = placed.repartitionByRange(files, "__place", "__tie").sortWithinPartitions("__place", *columns)
    writer = rows.drop("__place", "__tie").write.mode("overwrite").option("parquet.block.size", str(GROUP_BYTES))
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    conf, held = df.sparkSession.conf, df.sparkSession.conf.getAll.get(_SAMPLES_KEY)
    if held is None and files < MOST_SAMPLES // 100:
        conf.set(_SAMPLES_KEY, str(min(SAMPLES_PER_FILE, MOST_SAMPLES // files)))
    try:
        writer.parquet(path)
    finally:
        if held is None:
            conf.unset(_SAMPLES_KEY)
    return path


def lookup(table: DataFrame, code: str | None = None, prefix: str | None = None, year: int | None = None) -> DataFrame:
    """Rows of a code, of all codes with a prefix, of a year, or of any of these together; all reach the scan."""
    found = table
    if code is not None:
        found = found.where(F.col(CODE) == code)
    if prefix is not None:
        found = found.where(F.col(CODE).startswith(prefix))
    if year is not None:
        found = found.where(F.col(YEAR) == year)
    return found
