"""Every query that has SQL gives the SQL's result on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest

from conftest import DATA

ROOT = Path(__file__).resolve().parents[1]
spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def con():
    return check.connect(DATA)


@pytest.mark.parametrize("name", sorted(check.entry.oracle_sql()))
def test_query(spark, con, name):
    assert check.compare(spark, con, DATA, name).startswith("ok")


def test_entry(spark):
    assert check.entry.entry(spark).count() == 5
    assert set(check.entry.oracle_sql()) <= set(check.entry.queries())
