"""Every query with an SQL counterpart against it, on the smallest tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

from compare import compare, database  # noqa: E402

from __spark_entry__ import entry, oracle_sql  # noqa: E402
from naviscope.plans.catalog import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(QUERIES)))
def test_query(spark, db, sf_dir, name):
    same, count, _, notes = compare(spark, db, sf_dir, name)
    assert same, notes
    assert count > 0


def test_models_are_checked_by_what_must_hold_of_them():
    without = set(QUERIES) - set(oracle_sql())
    checked = {"forest_checks", "cv_checks", "forest_saved", "forest_accuracy_checks", "forest_importance_checks"}
    assert without == {n for n in QUERIES if n.startswith(("forest_", "cv_"))} - checked


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and {r["rank"] for r in rows} <= {1, 2, 3, 4, 5}
