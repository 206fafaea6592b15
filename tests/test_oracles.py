"""Every query against its DuckDB form on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from checks import catalog
from checks.compare import differences, duck
from tapeloom.operators import spread

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_equals_sql(spark, connection, name):
    problem, _ = differences(spark, connection, FOLDER, name)
    assert problem is None, problem


def test_contract(spark):
    assert set(catalog.oracle_sql()) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(contract.queries()) >= set(contract.oracle_sql())
    assert contract.entry(spark).columns[:2] == ["report_id", "row_no"]


@pytest.mark.parametrize("name", ["report_market_table", "assemble_prompt", "join_split", "ingest_yields"])
def test_slicing_every_busy_key_changes_nothing(spark, connection, monkeypatch, name):
    """The same results when each key with two rows already counts as hot."""
    monkeypatch.setattr(spread, "ROWS_PER_SLICE", 1)
    problem, _ = differences(spark, connection, FOLDER, name)
    assert problem is None, problem


def test_span_tables_are_compared_in_every_bar_column(spark):
    rows = catalog.QUERIES["market_span_tables"](spark, FOLDER)
    assert rows.columns == [*catalog.DAY, "span", "row_no", *catalog.BARS]
    assert {r["span"] for r in rows.select("span").distinct().collect()} == set(catalog.HISTORY_SPANS)
