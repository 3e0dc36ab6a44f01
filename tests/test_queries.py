"""Every query with SQL gives the same columns, types and values as DuckDB, on the smallest tables."""

import os
import subprocess
import sys

import pytest
from conftest import DATA

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = f"{DATA}/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["userId", "churn"] and df.count() == 15


def test_shared_folder_is_the_configured_one(tmp_path):
    """In a process of its own: the setting is fixed when a session starts."""
    code = f"""
from pyspark.sql import SparkSession
from lapsewise.storage import write_and_reload
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
assert write_and_reload(spark.range(3), "ids").count() == 3
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
    assert list((tmp_path / "lapsewise").glob("ids-*"))
