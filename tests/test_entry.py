"""The driver contract: entry, queries and oracle keys."""

import os

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["uid", "expid", "tn", "sec"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from adfunnel.queries import QUERIES

    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(QUERIES) <= set(sqls)
    assert len(QUERIES) >= 36


def test_queries_read_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    from adfunnel.queries import QUERIES

    for name, q in QUERIES.items():
        files = q(spark, sf).inputFiles()
        assert files and all(os.path.basename(f).endswith(".parquet") for f in files), name
