"""Every registered query against its SQL, where the tables and DuckDB are at hand."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from textloom.plans.oracle import ORACLE
from textloom.plans.queries import QUERIES

FOLDER = os.environ.get("TEXTLOOM_TABLES", "/root/testdata/sf0.001")
pytest.importorskip("duckdb")
if not Path(FOLDER).is_dir():
    pytest.skip("no tables", allow_module_level=True)

from check_oracle import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    line = compare(spark, connection, FOLDER, name)
    assert line.startswith("equal"), line


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["remote", "doctype", "docs", "size", "dups"]
    assert df.count() > 0
