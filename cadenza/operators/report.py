"""Timing statistics."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def timing_stats(samples: DataFrame, keys=("method", "k"), value: str = "seconds") -> DataFrame:
    """A10: mean, population std, min, max and ``log10(mean +- std)`` per method and k.

    ``log10(mean - std)`` is NULL when the difference is not positive.
    """
    g = samples.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                                   F.min(value).alias("best"), F.max(value).alias("worst"),
                                   F.count(F.lit(1)).alias("loops"))
    lo = F.col("mean") - F.col("std")
    return g.withColumn("log_mean", F.log10("mean")).withColumn(
        "log_lo", F.when(lo > 0, F.log10(lo))).withColumn("log_hi", F.log10(F.col("mean") + F.col("std")))


def time_runs(spark, label: str, run, loops: int = 3, out_dir: str | None = None):
    """Run ``run()`` (which must trigger a Spark action) ``loops`` times; wall seconds per loop.

    With ``out_dir`` the S12 record is written through Spark as ``<out_dir>/<label>.json``,
    so the folder may be on any file system the cluster shares.
    """
    from cadenza.sources.files import timing_record, write_timing
    ts = []
    for _ in range(loops):
        t0 = time.perf_counter()
        run()
        ts.append(time.perf_counter() - t0)
    if out_dir:
        write_timing(timing_record(spark, ts), f"{out_dir}/{label}.json")
    return ts
