"""The registered queries against SQL, and their contracts on a small table."""

import pytest
from compare import connect, same

from ledgerlens.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, sf_dir, name):
    df = Q.queries()[name](spark, sf_dir)
    sql = Q.oracle_sql().get(name)
    if sql is not None:
        same(df, connect(sf_dir), sql)
    elif name != "op2_packing":
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        assert df.count() == docs.count()


def test_all_ten_are_registered():
    assert sorted({int(k[2:].split("_")[0]) for k in Q.queries()}) == list(range(1, 11))
