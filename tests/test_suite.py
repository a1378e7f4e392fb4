"""Every named query against its SQL statement on the smallest tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as driver  # noqa: E402
import compare  # noqa: E402
from formline.suite import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    return compare.sql_tables(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(spark, connection, name, FOLDER) is None


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


def test_every_query_of_the_engine_has_sql():
    # A hundred rounds of boosting: see test_boosting.py, and trained_metrics for a run that SQL repeats.
    assert {name for name, query in QUERIES.items() if not query.sql} == {"train_metrics"}
