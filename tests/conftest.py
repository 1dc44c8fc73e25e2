from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerproof.session import local_session

    # the whole suite runs in one JVM, for which the default heap of 1 GB is little
    session = local_session("*", app_name="ledgerproof-tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def scratch(spark, tmp_path):
    """A fresh folder for written tables (tests own their session, so a private folder is fine)."""
    return str(tmp_path)


def totals(spark, rows):
    """Control totals from ``(layer, partition_key, row_count, amount, distinct)`` tuples."""
    from ledgerproof.schemas import CONTROL_TOTALS_SCHEMA

    return spark.createDataFrame(rows, CONTROL_TOTALS_SCHEMA)


def total(layer, key, rows, amount, distinct=None):
    return (layer, key, rows, amount, rows if distinct is None else distinct)


def ts(*args):
    return datetime(*args)
