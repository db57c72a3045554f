"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

__all__ = [
    "ARROW_BYTES", "BROADCAST_ROWS", "ASCII_UPPER", "ASCII_LOWER", "WORD",
    "ascii_lower", "bounded_batches", "fresh", "joined_small", "number_rows", "stage", "text_of",
]

#: The ASCII letters, and a word as the contracts define it.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

#: A side of at most so many narrow rows (two or three numbers each) may be broadcast: 32 MB.
BROADCAST_ROWS = 500_000

#: Whole texts travel to Python in batches of about so many bytes, or of one row if that is larger.
ARROW_BYTES = 4 << 20
_ARROW_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends rows to Python in batches of ``ARROW_BYTES`` from now on, unless it has a bound of its own.

    An executor holds a batch of every running task as vectors, as a stream and as the worker's answer, outside its heap.
    Spark's bound of 10,000 rows makes that hundreds of megabytes where the rows are texts. No result depends on it. The
    setting stays, because a frame is run after the operator that made it has returned.
    """
    conf = df.sparkSession.conf
    if _ARROW_BYTES_KEY not in conf.getAll:
        conf.set(_ARROW_BYTES_KEY, str(ARROW_BYTES))
    return df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, in whatever case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder with a number per row, so that later reads agree on the numbers."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()))


def joined_small(
    df: DataFrame, small: DataFrame, on: list[str], how: str = "inner", bound: int = BROADCAST_ROWS
) -> DataFrame:
    """Join with a staged narrow table: broadcast while its counted rows stay below the bound, else a shuffled join.

    Both ways give the same rows; only the physical join differs.
    """
    rows = small.limit(bound + 1).count()
    return df.join(F.broadcast(small) if rows <= bound else small, on, how)
