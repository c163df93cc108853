"""Cold start: item features -> latent factors; the ridge is in :mod:`cadenza.operators.ridge`.

A design row is sparse: ``idx`` (feature numbers) and ``val``, one entry per categorical column (its level)
and one per numeric column, so width costs nothing per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.ordering import exclusive_prefix_sum


# ----------------------------------------------------------------------- C3 - C5
def level_index(df: DataFrame, col: str) -> DataFrame:
    """``(col, col_idx)``, levels numbered from 0 by falling frequency, ties by value; no level is gathered
    on the driver and no slot is added for values that do not occur."""
    levels = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return exclusive_prefix_sum(levels, [F.col("_n").desc(), F.col(col)], F.lit(1), f"{col}_idx").select(col, f"{col}_idx")


def one_hot(df: DataFrame, cols):
    """``df`` with ``<col>_idx`` for every categorical column, and the number of levels of each. A value
    without a level (NULL) stops the job."""
    sizes = []
    for c in cols:
        levels = level_index(df, c)
        sizes.append(levels.count())
        df = df.join(levels, c, "left").withColumn(f"{c}_idx", F.when(F.col(f"{c}_idx").isNull(), F.raise_error(
            F.lit(f"no level for a value of {c}"))).otherwise(F.col(f"{c}_idx")))
    return df, sizes


def impute_mean(df: DataFrame, cols, missing_value: float = 0.0) -> DataFrame:
    """C4: replace ``missing_value`` (and NULL / NaN) by the column mean of the other values.

    NaN is mapped to NULL first because ``Imputer`` would pass NaN through.
    """
    from pyspark.ml.feature import Imputer
    clean = df
    for c in cols:
        clean = clean.withColumn(c, F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c).cast("double")))
    imp = Imputer(inputCols=list(cols), outputCols=list(cols), strategy="mean", missingValue=missing_value)
    return imp.fit(clean).transform(clean)


def assemble(df: DataFrame, cols, sizes, numeric) -> tuple[DataFrame, int]:
    """``idx`` and ``val`` of the sparse design row, and the number of features."""
    idx, base = [], 0
    for c, n in zip(cols, sizes, strict=True):
        idx.append((F.col(f"{c}_idx") + base).cast("int"))
        base += n
    idx += [F.lit(base + j) for j in range(len(numeric))]
    val = [F.lit(1.0)] * len(cols) + [F.col(c).cast("double") for c in numeric]
    return df.withColumns({"idx": F.array(*idx), "val": F.array(*val)}), base + len(numeric)


# ------------------------------------------------------------------ A11 / A12
def mse_r2(df: DataFrame, y_col: str, p_col: str, decimals: int | None = None) -> DataFrame:
    """A11 + A12 for multi-output predictions: MSE (mean over rows, then outputs) and
    uniform-average R^2 (per output ``1 - SSE / SST``). Constant outputs give NULL R^2."""
    long = df.select(F.posexplode(F.arrays_zip(F.col(y_col).alias("y"), F.col(p_col).alias("p"))).alias("j", "yp"))
    per = long.groupBy("j").agg(F.avg((F.col("yp.y") - F.col("yp.p")) ** 2).alias("mse"),
                                F.sum((F.col("yp.y") - F.col("yp.p")) ** 2).alias("sse"),
                                (F.var_pop("yp.y") * F.count(F.lit(1))).alias("sst"))
    out = per.agg(F.avg("mse").alias("mse"),
                  F.avg(F.lit(1.0) - F.try_divide(F.col("sse"), F.nullif(F.col("sst"), F.lit(0.0)))).alias("r2"))
    if decimals is not None:
        out = out.select(*[F.bround(c, decimals).alias(c) for c in out.columns])
    return out
