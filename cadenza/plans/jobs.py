"""Batch jobs with the same inputs and outputs as the source workload's scripts.

Each job reads parquet / CSV, runs the operators, and writes its result with a
plain DataFrame writer; the driver only sequences jobs.

* :func:`subsample_job`  - S1 -> R1 -> S8, output name suffixed with the fraction (R2)
* :func:`preprocess_job` - S1 x 3 splits -> U1 -> M1 (one index over all splits) -> P1/P9 -> S8
* :func:`feature_job`    - C1 catalogue features -> S9 CSV
* :func:`search_job`     - N1 / N2 / N3 top-k over factor tables, timed (S12) with recall (N5)
* :func:`coldstart_job`  - C2-C8: design matrix, alpha search, coefficients -> S8
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import sample_suffix
from cadenza.operators import interactions as I
from cadenza.sources import files as FI


def subsample_job(spark, in_path: str, out_dir: str, fraction: float, seed: int | None = None,
                  by_user: str | None = None) -> str:
    """Sample an interaction table and write it next to the others (``<name>_<suffix>.parquet``).

    ``by_user`` keeps or drops whole users (R6) and writes the sample partitioned
    by that key; otherwise rows are sampled independently (R1).
    """
    df = spark.read.parquet(in_path)
    name = os.path.splitext(os.path.basename(in_path.rstrip("/")))[0]
    out = os.path.join(out_dir, f"{name}_{sample_suffix(fraction)}.parquet")
    if by_user:
        I.key_sample(df, by_user, fraction).repartition(by_user).write.parquet(out)
    else:
        I.bernoulli_sample(df, fraction, seed).write.parquet(out)
    return out


def preprocess_job(spark, split_paths: dict, out_dir: str, log_scale: bool = False,
                   user_col: str = "user_id", item_col: str = "track_id") -> dict:
    """Index the splits with one user index and one item index fitted on their union; write each.

    Also writes the two id maps (``<out_dir>/index_<col>``), which are what a later
    job needs to map recommendations back (M2).
    """
    splits = {k: I.drop_incomplete(spark.read.parquet(p)) for k, p in split_paths.items()}
    out, uidx, iidx = I.index_interactions(splits, user_col, item_col, log_scale=log_scale)
    written = {}
    for k, df in out.items():
        path = os.path.join(out_dir, f"{k}{'_logcount' if log_scale else ''}.parquet")
        FI.write_parquet(df, path)
        written[k] = path
    FI.write_parquet(uidx, os.path.join(out_dir, f"index_{user_col}"), mode="overwrite")
    FI.write_parquet(iidx, os.path.join(out_dir, f"index_{item_col}"), mode="overwrite")
    return written


def feature_job(spark, sf_dir: str, out_path: str) -> str:
    """C1 on the stand-in tables, exported as CSV (terms list as JSON text, so a comma in a term is kept)."""
    from cadenza.operators import features as FE
    from cadenza.sources import tables as TB
    t = TB.Tables(spark, sf_dir)
    c1 = FE.catalogue_features(TB.catalog(t.part), TB.artist_term(t.part), TB.artist_location(t.nation, t.region),
                               FE.clean_extras(TB.acoustic_extras(t.lineitem)))
    FI.write_csv(c1.withColumn("term", F.to_json("term")), out_path, mode="overwrite")
    return out_path


def search_job(spark, queries: DataFrame, items: DataFrame, ks, out_dir: str, loops: int = 3,
               forest_kw=None, ivf_kw=None) -> DataFrame:
    """N1-N5 as one job per method and k: time each search (S12 records under ``out_dir``) and
    report recall@k against the exact search with the same metric."""
    from cadenza.operators import ann as A
    from cadenza.operators import retrieve as RT
    from cadenza.operators.report import time_runs, timing_stats
    rows = None
    for k in ks:
        exact = RT.exact_top_k(queries, items, k, metric="cosine")
        methods = {
            "bruteforce": lambda k=k: RT.exact_top_k(queries, items, k, metric="cosine"),
            "forest": lambda k=k: A.forest_search(queries, items, k, **(forest_kw or {})),
            "ivfpq": lambda k=k: A.ivf_pq_search(queries, items, k, **(ivf_kw or {})),
        }
        for name, make in methods.items():
            time_runs(spark, f"{name}_factors_k{k}", lambda make=make: make().write.format("noop")
                      .mode("overwrite").save(), loops=loops, out_dir=out_dir)
            rec = A.recall_at_k(make(), exact, k).withColumn("method", F.lit(name)).withColumn("k", F.lit(k))
            rows = rec if rows is None else rows.unionByName(rec)
    stats = timing_stats(FI.read_timings(spark, out_dir + "/*.json"))
    return stats.join(rows.drop("n_queries"), ["method", "k"], "left")


def coldstart_job(spark, sf_dir: str, out_dir: str, alphas=(0.0, 0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)) -> dict:
    """Fit the features -> factors ridge, write the alpha table and the coefficients."""
    from cadenza.operators import ridge as RG
    from cadenza.plans import coldstart as CP
    from cadenza.sources.tables import Tables
    res, _ = CP.fit(spark, Tables(spark, sf_dir), alphas)
    FI.write_parquet(CP.alpha_table(spark, res), os.path.join(out_dir, "alpha_search"), mode="overwrite")
    FI.write_parquet(RG.coefficient_table(res["refit"](), res["best_alpha"]),
                     os.path.join(out_dir, "coefficients"), mode="overwrite")
    return {"best_alpha": res["best_alpha"], "test_mse": res["test_mse"], "test_r2": res["test_r2"]}
