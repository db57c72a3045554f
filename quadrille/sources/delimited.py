"""Delimited text in, layer tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EXTRA = "_beyond_last_column"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that serves it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _reader(spark: SparkSession, sep: str, encoding: str, null_value: str, multiline: bool):
    return (
        spark.read.option("header", "true")
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", null_value)
        .option("multiLine", str(multiline).lower())
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    null_value: str = "",
    on_bad: str = "keep",
    columns: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """All columns as text; typing is left to expressions.

    ``encoding="auto"`` decides line by line: UTF-8 where a line decodes, Latin-1 where it does not.
    ``on_bad="drop"`` leaves out lines with more fields than the header. Unless
    ``multiline`` is asked for, files stay splittable.
    """
    if encoding == "auto":
        df = _read_mixed(spark, path, sep, null_value, on_bad)
        return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])
    reader = _reader(spark, sep, encoding, null_value, multiline)
    df = reader.csv(path)
    header = df.columns
    if on_bad == "drop":
        names = [*[f"c{i}" for i in range(len(header))], _EXTRA]
        wide = reader.option("enforceSchema", "true").schema(", ".join(f"`{n}` string" for n in names)).csv(path)
        df = wide.where(F.col(_EXTRA).isNull()).drop(_EXTRA)
    df = df.toDF(*[name.lstrip("\ufeff") for name in header])
    return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def _read_mixed(spark: SparkSession, path: str, sep: str, null_value: str, on_bad: str) -> DataFrame:
    """Every line decoded on its own, then split into fields. A field cannot hold a line break here."""
    raw = spark.read.text(path)
    line = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    lines = raw.select(F.ltrim(line, F.lit("\ufeff")).alias("line")).where(F.trim("line") != "")
    first = lines.first()
    if first is None:
        return spark.createDataFrame([], "`" + "` string, `".join(_reader(spark, sep, "UTF-8", null_value, False).csv(path).columns or ["c0"]) + "` string")
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": null_value}
    head = spark.range(1).select(F.from_csv(F.lit(first["line"]), F.lit(", ".join(f"c{i} string" for i in range(first["line"].count(sep) + 1))), options).alias("h"))
    header = [n if n is not None else f"_c{i}" for i, n in enumerate(head.first()["h"])]
    names = [f"c{i}" for i in range(len(header))]
    fields = F.from_csv("line", F.lit(", ".join(f"`{n}` string" for n in [*names, _EXTRA])), options)
    rows = lines.where(F.col("line") != first["line"]).select(fields.alias("f")).select("f.*")
    rows = rows.where(F.col(_EXTRA).isNull()) if on_bad == "drop" else rows
    return rows.drop(_EXTRA).toDF(*header)


def read_if_exists(spark: SparkSession, path: str, **options) -> DataFrame | None:
    return read_delimited(spark, path, **options) if exists(spark, path) else None


def first_path(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """First existing path: the cleaned layer before the raw one."""
    return next((p for p in paths if exists(spark, p)), None)


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Write a layer table. Sorting, where wanted, happens here and nowhere before.

    Rows of a partitioned table are dealt by folder and then rebalanced by their bytes: a large folder is written by as
    many tasks, into as many files, as it holds advisory partition sizes; small ones share a task, and one that is dealt
    to the same partition as a large one is cut along with it. Every file is in order by itself.
    """
    keys = [c for c in sort_by if c in df.columns]
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = (df.sortWithinPartitions(*partition_by, *[k for k in keys if k not in partition_by]) if keys else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.option("header", "true").csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
