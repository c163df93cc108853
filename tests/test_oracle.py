"""A sample of registered queries against their DuckDB oracle at sf0.001 (the full set: tools/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tools.oracle_check import TABLES, digest

SAMPLE = ["m6_popularity_eval", "p9_log_count", "j7_dot_top_k", "j8_release_year", "j9_w1_artist_tags",
          "j10_ragged_slices", "t5_multi_key_top_k", "g1_graph_expansion", "c2_align_features", "a11_a12_mse_r2", "e1_pca_variance",
          "c9_true_factor_eval"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s = digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d = digest([x[0] for x in res.description], res.fetchall())
    assert s[:3] == d[:3]


def test_every_oracle_sql_plans_in_duckdb(con):
    for name, sql in E.oracle_sql().items():
        con.execute("EXPLAIN " + sql)
