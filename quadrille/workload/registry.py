"""Registered queries: a Spark callable and, where one exists, the SQL with the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import stage

Query = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one scale factor, read lazily by name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._read[name]

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A small derived table, written on first use and read by the rest of the query."""
        if name not in self._read:
            self._read[name] = stage(build())
        return self._read[name]


def query(name: str, sql: str | None = None):
    """Register a query function under a name, with its SQL when SQL can express it."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, root: str) -> DataFrame:
            return fn(Tables(spark, root))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
