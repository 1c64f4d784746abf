"""Every query that has SQL is held against DuckDB on the smallest data; the others must run with a stable schema."""

import compare
import pytest

from sedimenta.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, con, name):
    assert compare.differences(catalogue.QUERIES[name](spark, SF), catalogue.SQL[name], con) is None


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {f"p{n}_found" for n in (2, 3, 4, 5, 6)} <= set(e.queries())


def test_core_does_not_import_llm():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "sedimenta"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "sedimenta.llm" not in p.read_text(), p
