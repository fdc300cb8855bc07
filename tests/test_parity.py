"""Every registered query against its SQL on the smallest tables.

Set PARITY_ALL=1 to run all of them; by default the slowest are skipped. The queries of the subpackage ``llm`` have
tests of their own.
"""

import os

import pytest

import __spark_entry__ as entry
from parity import compare, connect

SLOW = "doc_lsa word_lsa word_lsa_pmi".split()
ALL = os.environ.get("PARITY_ALL") == "1"
NAMES = [
    pytest.param(n, marks=pytest.mark.skipif(n in SLOW and not ALL, reason="set PARITY_ALL=1"))
    for n in entry.queries() if not n.startswith("op") and n != "pipeline"
]
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in NAMES if n.values[0] in ORACLES])
def test_query_matches_sql(spark, con, sf, name):
    assert compare(spark, con, sf, name, entry.queries()[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in NAMES if n.values[0] not in ORACLES])
def test_query_gives_rows(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
