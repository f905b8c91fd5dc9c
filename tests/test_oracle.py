"""Every query of the panel and document halves against the same in SQL."""

import pytest
from compare import connect, same

from ledgerlens.plans import document_queries, panel_queries

CASES = [(m, k) for m in (panel_queries, document_queries) for k in m.queries()]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize(("module", "name"), CASES, ids=[k for _, k in CASES])
def test_query(spark, sf_dir, con, module, name):
    df = module.queries()[name](spark, sf_dir)
    sql = module.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        df.collect()
    else:
        same(df, con, sql)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
