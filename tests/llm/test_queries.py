"""Registered queries of this subpackage against their SQL."""

import os

import duckdb
import pandas as pd
import pytest

from conftest_llm import SMALL
from pricewh.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_spark_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    spark_rows, sql_rows = QUERIES[name](spark, SMALL).toPandas(), con.execute(ORACLE[name]).df()
    columns = sorted(spark_rows.columns)
    assert columns == sorted(sql_rows.columns)
    plain = lambda df: sorted((tuple(None if pd.isna(v) else v for v in r)
                               for r in df[columns].astype(object).itertuples(index=False)), key=repr)
    assert plain(spark_rows) == plain(sql_rows)


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
