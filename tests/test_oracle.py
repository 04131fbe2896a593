"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, db, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir)
    assert compare.difference(got, db, entry.oracle_sql()[name]) == ""
