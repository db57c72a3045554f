import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quadrille.session import local_session

    session = local_session("4", 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("staging")))
    yield session
    session.stop()


@pytest.fixture()
def column(spark):
    """Evaluate an expression of ``F.col("x")`` over a list of texts."""
    from pyspark.sql import functions as F

    def run(values, expression, dtype="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}").coalesce(1)
        return [r[0] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]

    return run
