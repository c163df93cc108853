"""Interaction tables: cleaning, splitting, sampling and dense id indexing.

SURVEY rows P1, P2, P9, U1, M1, M2, R1, R3-R7.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import hash_bucket, log_count
from cadenza.session import reliable_checkpoint
from cadenza.sources.store import BatchStore


# ------------------------------------------------------------------- P2 / U1
def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a NULL in any (or the given) column."""
    return df.dropna(how="any", subset=subset)


def union_all(dfs) -> DataFrame:
    """Union by column name (schemas may list columns in different orders)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


# ------------------------------------------------------------------------ M1
def build_id_index(dfs, col: str, index_col: str | None = None) -> DataFrame:
    """M1: dense 0-based index over the distinct values of ``col`` in the union of ``dfs``.

    Values are numbered in ascending order (``dense_rank() - 1``). Instead of a
    single-task global window, the distinct values are range-partitioned and
    sorted; each task numbers its rows locally and a tiny per-partition offset
    table (one row per partition, broadcast) turns local numbers into global
    ones. The sorted, tagged values are checkpointed so the numbering is stable
    if an executor is lost and parts are recomputed. NULL ids raise an error.
    """
    index_col = index_col or f"{col}_index"
    if isinstance(dfs, DataFrame):
        dfs = [dfs]
    values = union_all([d.select(col) for d in dfs])
    checked = values.select(
        F.when(F.col(col).isNull(), F.raise_error(F.lit(f"NULL value in id column {col}")))
        .otherwise(F.col(col)).alias(col))
    tagged = (checked.distinct()
              .orderBy(col)
              .select(col,
                      F.spark_partition_id().alias("_p"),
                      F.monotonically_increasing_id().alias("_m"))
              .transform(reliable_checkpoint))
    offsets = (tagged.groupBy("_p")
               .agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
               .withColumn("_off", F.coalesce(
                   F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0))))
    # offsets has one row per partition of the sorted id set: bounded, safe to broadcast.
    return (tagged.join(F.broadcast(offsets), "_p")
            .select(col, (F.col("_off") + F.col("_m") - F.col("_m0")).cast("int").alias(index_col)))


def build_id_indexes(dfs, cols) -> dict:
    """M1 for several id columns at once: one sort, one checkpoint, one offset table.

    Values of all columns are tagged with their column, numbered together in
    ``(column, value)`` order, and each column's numbering restarts at 0 by
    subtracting the column's first global position (a grouped min, broadcast:
    one row per column). Returns ``{col: DataFrame(col, col_index)}``.
    """
    if isinstance(dfs, DataFrame):
        dfs = [dfs]
    if any(dict(dfs[0].dtypes)[c] != "string" for c in cols):
        # Mixed types would be ordered as text; number non-text ids column by column.
        return {c: build_id_index(dfs, c) for c in cols}
    parts = []
    for c in cols:
        for d in dfs:
            v = F.col(c).cast("string")
            parts.append(d.select(F.lit(c).alias("_c"),
                                  F.when(v.isNull(), F.raise_error(F.lit(f"NULL value in id column {c}")))
                                  .otherwise(v).alias("_v")))
    tagged = (union_all(parts).distinct()
              .orderBy("_c", "_v")
              .select("_c", "_v", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
              .transform(reliable_checkpoint))
    offsets = (tagged.groupBy("_p")
               .agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
               .withColumn("_off", F.coalesce(
                   F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0))))
    numbered = tagged.join(F.broadcast(offsets), "_p").select(
        "_c", "_v", (F.col("_off") + F.col("_m") - F.col("_m0")).alias("_g"))
    base = numbered.groupBy("_c").agg(F.min("_g").alias("_b"))
    both = numbered.join(F.broadcast(base), "_c").select("_c", "_v", (F.col("_g") - F.col("_b")).cast("int").alias("_i"))
    out = {}
    for c in cols:
        typ = dict(dfs[0].dtypes)[c]
        out[c] = both.where(F.col("_c") == c).select(F.col("_v").cast(typ).alias(c), F.col("_i").alias(f"{c}_index"))
    return out


class StoredIdIndex:
    """M1: an id index that a later job loads and extends. Ids keep their number; ``grow`` numbers the unseen ids of a
    table after the old maximum, in ascending order, as a new batch of the store."""

    def __init__(self, spark, path: str, col: str):
        self.store, self.col = BatchStore(spark, path), col

    def size(self) -> int:
        return sum(c["n"] for c in self.store.commits)

    def read(self) -> DataFrame:
        """``(col, col_index)`` of all committed batches."""
        return self.store.read("ids")

    def grow(self, df: DataFrame) -> int:
        """Number the ids of ``df`` that the index does not know; how many those were. NULL ids raise an error."""
        ids = df.select(self.col).distinct()
        if self.store.commits:
            ids = ids.join(self.read(), self.col, "left_anti")
        new = build_id_index(ids, self.col).withColumn(f"{self.col}_index", F.col(f"{self.col}_index") + self.size()).transform(reliable_checkpoint)
        n = new.count()
        if n:
            self.store.append({"ids": new}, n=n)
        return n


def apply_id_index(df: DataFrame, index: DataFrame, col: str, index_col: str | None = None,
                   keep_original: bool = False) -> DataFrame:
    """M1 transform: replace ``col`` by its index; an id missing from the index raises."""
    index_col = index_col or f"{col}_index"
    j = df.join(index, on=col, how="left")
    j = j.withColumn(index_col, F.when(F.col(index_col).isNull(),
                                       F.raise_error(F.concat(F.lit(f"unseen {col}: "), F.col(col).cast("string"))))
                     .otherwise(F.col(index_col)))
    return j if keep_original else j.drop(col)


def inverse_id_index(df: DataFrame, index: DataFrame, index_col: str, col: str) -> DataFrame:
    """M2: map an integer index back to the original id (inner join on the index)."""
    return df.join(index.select(index_col, col), on=index_col, how="inner")


def index_interactions(splits: dict, user_col: str = "user_id", item_col: str = "track_id",
                       count_col: str = "count", log_scale: bool = False):
    """Fit one user index and one item index over all splits, apply them to each split.

    Returns ``(indexed_splits, user_index, item_index)``. Output columns are
    ``user_id_index INT, count INT, track_id_index INT`` or, with ``log_scale``,
    ``user_id_index INT, track_id_index INT, count FLOAT`` (P9).
    """
    frames = list(splits.values())
    idx = build_id_indexes(frames, [user_col, item_col])
    uidx, iidx = idx[user_col], idx[item_col]
    out = {}
    for name, df in splits.items():
        d = apply_id_index(apply_id_index(df, uidx, user_col), iidx, item_col)
        if log_scale:
            d = d.select(f"{user_col}_index", f"{item_col}_index", log_count(count_col).alias(count_col))
        else:
            d = d.select(f"{user_col}_index", F.col(count_col).cast("int").alias(count_col), f"{item_col}_index")
        out[name] = d
    return out, uidx, iidx


# -------------------------------------------------------------- R1, R3 - R7
def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Keep each row with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def pair_key(user_col: str = "user_id", item_col: str = "track_id"):
    return F.concat_ws("|", F.col(user_col).cast("string"), F.col(item_col).cast("string"))


def hash_split(df: DataFrame, key, train_buckets: int = 8, n: int = 10):
    """Reproducible train/validation split by a hash bucket of ``key`` (80/20 by default)."""
    b = hash_bucket(key, n)
    return df.where(b < train_buckets), df.where(b >= train_buckets)


def nested_holdout(df: DataFrame, key):
    """Buckets 0-1 are test (20 %); of the rest, a second hash keeps 20 % as validation."""
    b1 = hash_bucket(key, 10)
    b2 = hash_bucket(F.concat(key.cast("string"), F.lit("#2")), 10)
    test = df.where(b1 < 2)
    rest = df.where(b1 >= 2)
    return rest.where(b2 >= 2), rest.where(b2 < 2), test


def fixed_size_sample(df: DataFrame, n: int, id_col: str, seed: int = 123) -> DataFrame:
    """Exactly ``n`` rows (or all if fewer), chosen by a seeded hash order.

    Planned as a per-partition top-n followed by one merge of n rows per task.
    """
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
    return df.orderBy(order, F.col(id_col)).limit(n)


def key_sample(df: DataFrame, key_col: str, fraction: float, n: int = 10000) -> DataFrame:
    """Keep every row of a hash-selected ``fraction`` of keys (all rows of a user or none)."""
    return df.where(hash_bucket(F.col(key_col), n) < int(round(fraction * n)))


def random_neighbours(edges: DataFrame, n: int = 10, seed: int = 0,
                      src: str = "src", dst: str = "dst") -> DataFrame:
    """Keep ``n`` pseudo-random neighbours per node (seeded hash order, ties by id).

    ``row_number() <= n`` is planned as a window group limit, applied before and
    after the shuffle, so a node with millions of neighbours ships only n rows
    per map task.
    """
    order = F.md5(F.concat_ws("|", F.col(src).cast("string"), F.col(dst).cast("string"), F.lit(str(seed))))
    w = Window.partitionBy(src).orderBy(order, F.col(dst))
    return edges.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
