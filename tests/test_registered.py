"""Every registered query against its SQL, on the given tables."""

from __future__ import annotations

import math
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from checks.fixtures import CHECKS

SF_DIR = Path("/root/testdata/sf0.01")
TABLES = [p.stem for p in sorted(SF_DIR.glob("*.parquet"))]

pytestmark = pytest.mark.skipif(not TABLES, reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def kind(name: str) -> str:
    """Type names of both engines on one scale."""
    known = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    return known.get(name, name.lower())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(SF_DIR))
    relation = duck.sql(contract.oracle_sql()[name])
    ours = canonical(df.columns, df.collect())
    theirs = canonical(relation.columns, relation.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
    types = dict(zip(relation.columns, (kind(str(t)) for t in relation.types), strict=True))
    assert dict(df.dtypes) == types


def test_every_query_of_the_core_has_sql():
    assert CHECKS.keys() <= contract.queries().keys()
    assert CHECKS.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("lacking", ["spineloom.llm", "public_tokenizers", "pyarrow"])
def test_queries_of_the_core_need_no_other_package(lacking):
    """A process of its own in which the package cannot be imported still offers every query of the core."""
    script = f"""
import sys, warnings
warnings.simplefilter("ignore")
sys.modules[{lacking!r}] = None
import __spark_entry__ as contract
from checks.fixtures import CHECKS
assert CHECKS.keys() <= contract.queries().keys(), "queries are missing"
assert CHECKS.keys() <= contract.oracle_sql().keys(), "SQL is missing"
"""
    root = Path(contract.__file__).parent
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 15
