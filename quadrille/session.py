"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


# Settings worth having on any cluster: runtime re-planning, and splitting of skewed join
# partitions even where that costs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_own_roots: dict[str, str] = {}
_runs: list[list[str]] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        **ADAPTIVE,
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quadrille")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back
    to a temporary folder of its own, because there every task runs on this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or context.getConf().get(_CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    if context.applicationId not in _own_roots:
        _own_roots[context.applicationId] = tempfile.mkdtemp(prefix="quadrille-")
    return _own_roots[context.applicationId]


def staged_path(spark: SparkSession) -> str:
    """A new place in the shared folder, removed with the others at the end of ``staging``."""
    path = f"{staging_root(spark)}/staged/{uuid.uuid4().hex}"
    if _runs:
        _runs[-1].append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a result is needed more than once or must not change between two reads.
    The written files also give Catalyst a true size, so a later join broadcasts the
    table only when it is really below ``spark.sql.autoBroadcastJoinThreshold`` and
    falls back to a shuffled join otherwise; no operator here carries a broadcast hint.
    """
    spark = df.sparkSession
    path = staged_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of what is staged inside, for ``remove`` once nothing reads them any more."""
    paths: list[str] = []
    _runs.append(paths)
    try:
        yield paths
    finally:
        _runs.remove(paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = path_of(path)
        target.getFileSystem(settings).delete(target, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was staged inside. For runs that write their result before they leave; a frame that
    still reads a staged table must not outlive the context."""
    paths: list[str] = []
    try:
        with recorded() as paths:
            yield
    finally:
        remove(spark, paths)
