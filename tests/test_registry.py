"""Registered queries against their SQL twins on the smallest data."""

import os
import subprocess
import sys

import pytest

from registry.queries import ORACLE, QUERIES
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, name):
    report = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert report.startswith("ok") and "TYPES" not in report, report


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_a_twin_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_no_operator_depends_on_arrow_for_the_driver(spark):
    """As in a session that the library did not build."""
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        for name in ("svd_recommend", "hybrid_recommend", "content_recommend"):
            assert QUERIES[name](spark, SF_DIR).count() > 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


def test_all_modules_are_collected():
    """In one run and with each folder alone, whatever the order."""
    here = os.path.dirname(os.path.abspath(__file__))
    found = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", here],
        capture_output=True, text=True, timeout=300, cwd=os.path.dirname(here),
    )
    assert found.returncode == 0, found.stdout[-2000:]
