"""Order-dependent numbering without a single-task window.

A running total over a whole ordered table (offsets of ragged arrays, row
positions inside one huge file) would need ``Window.orderBy`` with no
partition, i.e. one task. Here the table is range-partitioned and sorted, each
task streams its partition once with a carried running total, and a table with
one row per partition gives the partition offsets (broadcast: its size is the
partition count); nothing is shuffled again. The numbered, sorted table is
checkpointed so the numbering is stable if a task is re-run after an executor
loss. Several running totals over the same order are computed in the same pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import reliable_checkpoint


def _weights(weight, out_col):
    if isinstance(weight, dict):
        return {k: (F.col(v) if isinstance(v, str) else v) for k, v in weight.items()}
    return {out_col: F.col(weight) if isinstance(weight, str) else weight}


def exclusive_prefix_sum(df: DataFrame, order_cols, weight, out_col: str = "offset") -> DataFrame:
    """``out_col`` = sum of ``weight`` over all rows strictly before this one in ``order_cols`` order.

    ``weight`` may be a dict ``{out_col: weight}`` for several totals at once.
    ``order_cols`` must give a total order (break ties with a unique key).
    """
    ws = _weights(weight, out_col)
    names = {k: f"_w{i}" for i, k in enumerate(ws)}
    tagged = df
    for k, w in ws.items():
        tagged = tagged.withColumn(names[k], F.coalesce(w.cast("long"), F.lit(0).cast("long")))
    at = [tagged.columns.index(n) for n in names.values()]

    def running(batches):
        total = [0] * len(at)
        for b in batches:
            new = []
            for j, i in enumerate(at):
                w = b.column(i).to_numpy(zero_copy_only=False)
                new.append(pa.array(np.cumsum(w) - w + total[j], pa.int64()))
                total[j] += int(w.sum())
            yield pa.RecordBatch.from_arrays(b.columns + new, names=b.schema.names + [f"{n}_l" for n in names.values()])

    tagged = tagged.orderBy(*order_cols).withColumn("_p", F.spark_partition_id())
    schema = T.StructType([*tagged.schema.fields, *[T.StructField(f"{n}_l", T.LongType()) for n in names.values()]])
    tagged = tagged.mapInArrow(running, schema).transform(reliable_checkpoint)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy("_p").agg(*[F.sum(n).alias(f"{n}_t") for n in names.values()])
    offsets = offsets.select("_p", *[F.coalesce(F.sum(f"{n}_t").over(before), F.lit(0)).cast("long").alias(f"{n}_o")
                                     for n in names.values()])
    out = tagged.join(F.broadcast(offsets), "_p")
    for k, n in names.items():
        out = out.withColumn(k, F.col(f"{n}_o") + F.col(f"{n}_l"))
    return out.drop("_p", *names.values(), *[f"{n}{x}" for n in names.values() for x in ("_o", "_l")])


def offsets_within(df: DataFrame, group_cols, order_cols, weight, out_col: str = "offset") -> DataFrame:
    """Exclusive running total(s) of ``weight`` restarting at each group (e.g. per source file).

    Global prefix sum minus the group's first value; the per-group minimum is a
    partial + final aggregate, so one group holding a third of all rows is
    still spread over every task.
    """
    g = list(group_cols)
    ws = _weights(weight, out_col)
    tmp = {k: f"_g_{k}" for k in ws}
    pre = exclusive_prefix_sum(df, g + list(order_cols), {tmp[k]: w for k, w in ws.items()})
    base = pre.groupBy(*g).agg(*[F.min(t).alias(f"_b_{k}") for k, t in tmp.items()])
    out = pre.join(base, g)
    for k, t in tmp.items():
        out = out.withColumn(k, F.col(t) - F.col(f"_b_{k}"))
    return out.drop(*tmp.values(), *[f"_b_{k}" for k in ws])
