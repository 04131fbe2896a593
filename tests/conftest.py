from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return compare.session()


@pytest.fixture(scope="session")
def db():
    return compare.database(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def value(spark):
    """Apply a Column function to literals and return the result."""

    def run(function, *literals):
        from pyspark.sql import functions as F

        names = [f"c{i}" for i in range(len(literals))]
        row = spark.range(1).select(F.lit(0), *[F.lit(v).alias(n) for n, v in zip(names, literals)])
        return row.select(function(*[F.col(n) for n in names])).first()[0]

    return run
