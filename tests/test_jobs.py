import os

from pyspark.sql import functions as F

from cadenza.plans import jobs as J
from cadenza.sources.tables import Tables, item_factors, plays
from tests.conftest import SF


def test_subsample_and_preprocess_jobs(spark, tmp_path):
    t = Tables(spark, SF)
    p = plays(t.orders, t.lineitem)
    b = F.pmod(F.xxhash64("user_id", "track_id"), F.lit(3))
    paths = {}
    for name, cond in (("train", b == 0), ("validation", b == 1), ("test", b == 2)):
        paths[name] = str(tmp_path / f"{name}.parquet")
        p.where(cond).write.parquet(paths[name])
    s = J.subsample_job(spark, paths["train"], str(tmp_path), 0.5, seed=1)
    assert s.endswith("train_050.parquet") and 0 < spark.read.parquet(s).count() < p.count()
    u = J.subsample_job(spark, paths["train"], str(tmp_path / "byuser"), 0.5, by_user="user_id")
    users = spark.read.parquet(u).groupBy("user_id").count()
    full = spark.read.parquet(paths["train"]).groupBy("user_id").count()
    assert users.join(full, ["user_id", "count"], "left_anti").count() == 0
    out = J.preprocess_job(spark, paths, str(tmp_path / "idx"))
    tr = spark.read.parquet(out["train"])
    assert tr.columns == ["user_id_index", "count", "track_id_index"]
    total = sum(spark.read.parquet(v).count() for v in out.values())
    assert total == p.count()
    n_users = p.select("user_id").distinct().count()
    idx = spark.read.parquet(str(tmp_path / "idx" / "index_user_id"))
    assert sorted(r[0] for r in idx.select("user_id_index").collect()) == list(range(n_users))


def test_feature_and_search_jobs(spark, tmp_path):
    J.feature_job(spark, SF, str(tmp_path / "c1"))
    assert spark.read.csv(str(tmp_path / "c1"), header=True).count() == Tables(spark, SF).part.count()
    f = item_factors(Tables(spark, SF).embeddings).select("id", "features")
    res = J.search_job(spark, f.limit(60), f, [5], str(tmp_path / "timings"), loops=1,
                       forest_kw=dict(n_trees=8, bucket=16), ivf_kw=dict(n_cells=4, n_probe=2))
    rows = {r.method: r for r in res.collect()}
    assert set(rows) == {"bruteforce", "forest", "ivfpq"}
    assert rows["bruteforce"].recall_at_5 == 1.0
    assert os.path.isdir(str(tmp_path / "timings"))


def test_coldstart_job_writes_tables(spark, tmp_path):
    res = J.coldstart_job(spark, SF, str(tmp_path / "cs"), alphas=(0.1, 1.0))
    assert res["best_alpha"] in (0.1, 1.0) and res["test_mse"] >= 0
    alphas = spark.read.parquet(str(tmp_path / "cs" / "alpha_search"))
    assert alphas.count() == 2 and alphas.where("best").count() == 1
    coef = spark.read.parquet(str(tmp_path / "cs" / "coefficients"))
    assert coef.where("feature_idx = -1").count() == 64
