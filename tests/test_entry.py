import __spark_entry__ as E


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"map", "n_users", "ndcg_at_10"}


def test_small_queries_run(spark):
    from tests.conftest import SF
    for name in ("m6_popularity_eval", "j8_release_year", "c1_catalogue_features", "j7_dot_top_k"):
        assert E.queries()[name](spark, SF).count() > 0
