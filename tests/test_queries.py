"""Every query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    own = {name for name in entry.queries() if name.startswith("q_")}
    assert own and own <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("q_")))
def test_query(spark, name):
    good, note = compare(spark, FOLDER, name)
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).count() == 1673
