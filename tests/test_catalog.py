"""Every query of the library runs, and those with SQL agree with it."""

import pytest
from oracle import check

from specfold import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_agrees_with_sql(spark, name):
    check(spark, catalog.QUERIES[name], catalog.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_llm_is_not_imported_by_the_rest():
    from pathlib import Path

    root = Path(catalog.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "specfold.llm" not in p.read_text(), p
