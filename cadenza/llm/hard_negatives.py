"""Hard-negative mining by threshold joins over pruned inverted indexes.

Every anchor gets its best ``positives`` rows of the same label, and for each of these the best ``negatives`` rows of
other labels whose score lies in [low %, high %] of the positive's. Scores are inner products of the components
floor(scale * x); higher first, ties by smaller id.

Join. Anchors and rows meet in blocks of bounded size (a stated query set against all rows). Each block of rows is an
index shard: dimensions are ordered by their energy in the shard, and a row's list entries end where the norm of
the rest of the row can no longer reach any threshold of the block's anchors; those last dimensions are not in the
index. List by list the partial scores grow, and a pair is pruned once its partial score plus the product of the
remaining norms lies under the anchor's threshold. The few pairs left get the missing dimensions and are exact.

Thresholds. A block gives an anchor at most its best ``positives`` (or ``negatives`` per window) pairs at or above the
threshold. If over all blocks the list is full, it is final, as nothing below the threshold can enter it; if not,
the anchor stays open, and the next round runs with a lower threshold for the open anchors only, down to none for
the positives and to the lower end of the window for the negatives. Where thresholds start only costs time.

Rows with a null id, a null label, a null vector or a null or non-finite component take no part. Missing trailing
components count as zero. Every row counts for itself, equal ones too (a repeated anchor gives its rows as often).
A positive with a negative score has an empty window. An empty table, or one without anchors, gives an empty result.
Scores are exact while the sums stay below 2^53.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import materialise, tidy

ROW_BLOCK = 4096
ANCHOR_BLOCK = 512
LISTS = 8                       # dimensions between two prunings
SPARSE = 1 / 32                 # share of pairs below which the rest is computed pair by pair
STEPS = (1 / 8, 1 / 2, 1)       # share of a window that is searched, round by round


def _tails(m: np.ndarray) -> np.ndarray:
    """Norm of what stands at and after each dimension."""
    out = np.zeros((m.shape[0], m.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1])
    return out


def threshold_pairs(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray, alive: np.ndarray):
    """(i, j, score) of the pairs of ``alive`` with anchors[i] . rows[j] >= least[i]."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    n, d = rows.shape
    if not n or not len(anchors):
        return none
    if not d:
        i, j = np.nonzero(alive & (least <= 0)[:, None])
        return i, j, np.zeros(len(i))
    order = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
    a, x = anchors[:, order], rows[:, order]
    ta, tx = _tails(a), _tails(x)
    floor = least - 1e-6 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
    # A row's lists end at the first dimension from which on its norm reaches no anchor's threshold.
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.where(floor[:, None] > 0, ta / floor[:, None], np.inf).max(axis=0)
    covered = np.where(np.isinf(reach), False, tx * np.where(np.isinf(reach), 0, reach) < 1)
    covered[:, -1] = True
    cut = covered.argmax(axis=1)
    by = np.argsort(-cut, kind="stable")
    x, tx, cut, alive = x[by], tx[by], cut[by], alive[:, by]
    alive[:, np.searchsorted(-cut, 0):] = False
    lists = np.where(np.arange(d) < cut[:, None], x, 0.0)
    score = np.zeros((len(a), n))
    done = np.zeros(n, np.int64)  # dimensions added so far
    for at in range(0, d, LISTS):
        end = min(at + LISTS, d)
        k, full = np.searchsorted(-cut, -at), np.searchsorted(-cut, -end, side="right")
        if not k:
            break
        score[:, :k] += a[:, at:end] @ lists[:k, at:end].T
        done[:k] = np.minimum(cut[:k], end)
        alive[:, :full] &= score[:, :full] + ta[:, end, None] * tx[None, :full, end] >= floor[:, None]
        if k > full:
            p = done[full:k]
            alive[:, full:k] &= score[:, full:k] + ta[:, p] * tx[np.arange(full, k), p] >= floor[:, None]
        if np.count_nonzero(alive) <= SPARSE * alive.size:
            break
    i, j = np.nonzero(alive)
    total = score[i, j]
    for s in range(0, len(i), 1 << 15):
        p, q = i[s:s + (1 << 15)], j[s:s + (1 << 15)]
        rest = np.where(np.arange(d) >= done[q][:, None], x[q], 0.0)
        total[s:s + (1 << 15)] += np.einsum("pd,pd->p", a[p], rest)
    ok = total >= least[i]
    return i[ok], by[j[ok]], total[ok]


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _best(i, j, score, ids, k: int) -> np.ndarray:
    """Positions of the ``k`` best of each anchor: higher scores first, then smaller ids."""
    order = np.lexsort((j, ids[j], -score, i))
    first = np.concatenate([[True], i[order][1:] != i[order][:-1]]) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else np.zeros(0, np.int64)
    return order[np.arange(len(order)) - start < k]


def _round(asked: DataFrame, rows: DataFrame, blocks: tuple[int, int], k: int, same: bool) -> DataFrame:
    """qid, slot, rid, id, score: each block's best rows of every request (qid, label, vec, least, slots). A slot is a
    window (least, most) with a number; without slots (``same``), rows of the anchor's label are asked for."""
    n_a, n_r = blocks
    q = asked.select("qid", F.col("label").alias("own"), F.col("vec").alias("qvec"), F.col("least").alias("floor"), "slots",
                     F.pmod(F.xxhash64("qid"), F.lit(n_a)).cast("int").alias("ab"), F.explode(F.sequence(F.lit(0), F.lit(n_r - 1))).alias("rb"))
    r = rows.select("rid", "id", "label", "vec", F.pmod(F.xxhash64("rid"), F.lit(n_r)).cast("int").alias("rb"),
                    F.explode(F.sequence(F.lit(0), F.lit(n_a - 1))).alias("ab"))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [], "slot": [], "rid": [], "id": [], "score": []}
        if len(left) and len(right):
            width = max(max(map(len, left["qvec"])), max(map(len, right["vec"])))
            qid, rid, ids = left["qid"].to_numpy(), right["rid"].to_numpy(), right["id"].to_numpy()
            alike = left["own"].to_numpy()[:, None] == right["label"].to_numpy()[None, :]
            alive = alike & (qid[:, None] != rid[None, :]) if same else ~alike
            i, j, s = threshold_pairs(_matrix(left["qvec"], width), _matrix(right["vec"], width), left["floor"].to_numpy(float), alive)
            slots = [None] if same else sorted({w["slot"] for ws in left["slots"] for w in ws})
            for slot in slots:
                pi, pj, ps = i, j, s
                if slot is not None:
                    lo, hi = np.full(len(left), np.inf), np.full(len(left), -np.inf)
                    for row, ws in enumerate(left["slots"]):
                        for w in ws:
                            if w["slot"] == slot:
                                lo[row], hi[row] = w["least"], w["most"]
                    ok = (s >= lo[i]) & (s <= hi[i])
                    pi, pj, ps = i[ok], j[ok], s[ok]
                best = _best(pi, pj, ps, ids, k)
                out["qid"].append(qid[pi[best]])
                out["slot"].append(np.full(len(best), slot or 0))
                out["rid"].append(rid[pj[best]])
                out["id"].append(ids[pj[best]])
                out["score"].append(ps[best])
        cols = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
        return pd.DataFrame({c: v.astype("int32" if c == "slot" else "int64") for c, v in cols.items()})

    found = q.groupBy("ab", "rb").cogroup(r.groupBy("ab", "rb")).applyInPandas(
        score, "qid bigint, slot int, rid bigint, id bigint, score bigint")
    w = Window.partitionBy("qid", "slot").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    v = v.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(fine)
    return v.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double"))) \
        .withColumn("rid", F.monotonically_increasing_id())


@tidy
def mine(vectors: DataFrame, anchor: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchor`` tells the anchors."""
    rows = materialise(_usable(vectors, id_col, vec_col, label_col, anchor, scale), "vectors")
    anchors = rows.where("anchor").select(F.col("rid").alias("qid"), F.col("id").alias("anchor_id"), "label", "vec")
    norm2 = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("m"), F.approx_count_distinct("label").alias("labels"),
                    F.avg(norm2).alias("energy"), F.max(F.size("vec")).alias("d")).first()
    n, m = size["n"], size["m"]
    spread = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(m / ANCHOR_BLOCK)), max(1, math.ceil(n / ROW_BLOCK), min(2 * spread, math.ceil(n / 256)))
    table = rows.select("rid", "id", "label", "vec")

    # Positives. The first threshold is where a normal score would leave four times the rows asked for.
    share = min(0.5, 4 * positives * max(1, size["labels"]) / max(1, n))
    level = NormalDist().inv_cdf(1 - share)
    sigma = math.sqrt((size["energy"] or 0.0) / max(1, size["d"] or 1))
    open_ = anchors.withColumn("norm", F.sqrt(norm2))
    got = []
    while True:
        least = F.col("norm") * level * sigma if level > -1 else F.lit(float("-inf"))
        found = materialise(_round(open_.withColumn("least", least).withColumn("slots", F.lit(None).cast("array<int>")), table, blocks,
                                   positives, True), "positives")
        if level <= -1:
            got.append(found)
            break
        full = found.groupBy("qid").count().where(F.col("count") >= positives).select("qid")
        got.append(found.join(full, "qid", "left_semi"))
        open_ = materialise(open_.join(full, "qid", "left_anti"), "open_anchors")
        if open_.isEmpty():
            break
        level = level - 1
    best = got[0]
    for g in got[1:]:
        best = best.unionByName(g)
    best = materialise(best.select("qid", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Negatives, window by window: 100 * score between low and high times the positive's score.
    ends = (F.expr(f"({low} * positive_score + 99) div 100").cast("double").alias("bottom"),
            F.expr(f"({high} * positive_score) div 100").cast("double").alias("most"))
    open_ = best.where("positive_score >= 0").select("qid", "slot", *ends).where("bottom <= most")
    got = []
    for step in STEPS:
        least = F.greatest("bottom", F.col("most") - F.ceil((F.col("most") - F.col("bottom")) * step)) if step < 1 else F.col("bottom")
        wanted = open_.withColumn("least", least)
        asked = wanted.groupBy("qid").agg(F.min("least").alias("least"), F.collect_list(F.struct("slot", "least", "most")).alias("slots"))
        asked = anchors.join(asked, "qid").select("qid", "label", "vec", "least", "slots")
        found = materialise(_round(asked, table, blocks, negatives, False), "negatives")
        full = found.groupBy("qid", "slot").count().where(F.col("count") >= negatives).select("qid", "slot")
        if step == STEPS[-1]:
            got.append(found)
            break
        got.append(found.join(full, ["qid", "slot"], "left_semi"))
        open_ = materialise(open_.join(full, ["qid", "slot"], "left_anti").select("qid", "slot", "bottom", "most"), "open_windows")
        if open_.isEmpty():
            break
    worst = got[0]
    for g in got[1:]:
        worst = worst.unionByName(g)
    out = worst.join(best, ["qid", "slot"]).join(anchors.select("qid", "anchor_id"), "qid")
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
