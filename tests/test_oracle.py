"""Every registered query against its DuckDB text on the smallest shared tables."""

import os

import pytest

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables absent")
def test_queries_match_duckdb(spark):
    import check

    bad = check.run(spark, SF)
    assert not bad, "\n".join(f"{k}: {v}" for k, v in bad.items())


def test_entry_is_lazy_and_has_columns(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert {"series", "Stage", "MAE_MWH"} <= set(df.columns)


def test_oracle_names_are_queries():
    from __spark_entry__ import oracle_sql, queries

    assert set(oracle_sql()) <= set(queries())
