from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from acervo.session import local_session

    session = local_session("4", shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """``value(function, text, ...)``: the function's result on literal columns, one per text."""
    from pyspark.sql import functions as F

    def run(fn, texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, c string").select("i", fn(F.col("c")).alias("out"))
        return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return run
