"""Every registered query against its DuckDB oracle (the driver's check), at sf0.001."""

from __future__ import annotations

import os
import sys

import pytest

from costframe import catalog
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))


def test_entry_smoke(spark):
    import __spark_entry__ as ent

    df = ent.entry(spark)
    assert df.columns == ["Service Description", "Cost", "Negotiated savings", "Savings programmes",
                          "Other savings", "Subtotal"]
    assert 0 < df.count() <= 10


def test_every_query_has_oracle():
    missing = set(catalog.queries()) - set(catalog.oracles())
    assert not missing, missing


# Queries that write some thousand day folders; scripts/oracle_check.py runs them too.
SLOW = {"cur_load_by_name", "coverage_from_metadata", "coverage_gaps_from_metadata"}


@pytest.mark.parametrize("name", [pytest.param(n, marks=pytest.mark.slow) if n in SLOW else n
                                  for n in sorted(__import__("costframe.catalog", fromlist=["x"]).queries())])
def test_query_matches_oracle(spark, name):
    from oracle_check import compare

    status, detail = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert status == "OK", detail
