"""Exact top-k retrieval over factor vectors.

All (query, item) scores are needed. ``exact_top_k`` deals the queries into blocks that fit a task's memory; a task holds
one block and the best items of each of its queries so far, and the items stream past it in id order, batch by batch.
What a task keeps follows its queries and ``k`` only, and a list leaves the task whole: nothing is merged afterwards,
unless the queries are too few to give every core a block. Then the items are dealt into blocks as well, and a
``row_number() <= k`` (planned as a window group limit) merges the lists. Where the blocks are more than the cores need and
a task can hold the items (``HELD_BYTES``), it is sent these once and passes its blocks over them.

``blocked_top_k`` scores pairs that share a key (the probed cells of ``ann.py``): both sides of a key are cut into hash
blocks and every (query block, item block) pair is scored inside ``cogroup().applyInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import array_norm


# ----------------------------------------------------------------- P16 / P17
def l2_normalize(df: DataFrame, vec_col: str, out_col: str | None = None) -> DataFrame:
    """``v / ||v||`` as array<double>; a zero vector gives NULL (no division error).

    The norm is computed once per row and paired with the elements through
    ``array_repeat`` + ``zip_with``: a norm referenced inside the element lambda
    would be recomputed for every element (d^2 work per row).
    """
    out_col = out_col or vec_col
    v = F.col(vec_col)
    n = array_norm(vec_col)
    return df.withColumn(out_col, F.when(n > 0, F.zip_with(v, F.array_repeat(n, F.size(v)),
                                                            lambda x, m: x.cast("double") / m)))


def users_with_targets(queries: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Keep only the query rows whose key has at least one target (left semi join)."""
    return queries.join(targets.select(key), key, "left_semi")


# ---------------------------------------------------------------- kernel
def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest scores per row; among equal scores the leftmost columns."""
    n, width = scores.shape
    if k >= width:
        return np.repeat(np.arange(n), width), np.tile(np.arange(width), n)
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    better, ties = scores > kth, scores == kth
    room = k - better.sum(axis=1, keepdims=True)
    return np.nonzero(better | (ties & (np.cumsum(ties, axis=1) <= room)))


def _scores_top_k(qids, qmat, iids, imat, k: int, cells: int = 1 << 22):
    """Local top-k per query row, scoring ``cells`` pairs at a time: arrays (qid, pos, iid, score), in rank order.

    Scores are compared by 10 decimals, so that equal vectors tie wherever the matrix product puts them;
    ties go to the lower item id (items are sorted by id first).
    """
    order = np.argsort(iids, kind="stable")
    iids, imat = np.asarray(iids)[order], imat[order]
    out_q, out_p, out_i, out_s = [], [], [], []
    chunk = max(1, min(512, cells // max(1, len(iids))))
    width = min(k, len(iids))
    for s in range(0, len(qids), chunk):
        sc = qmat[s:s + chunk] @ imat.T
        rounded = np.round(sc, 10)
        rows, cols = best_columns(rounded, k)
        n = len(sc)
        cols = cols.reshape(n, width)
        by = np.argsort(-np.take_along_axis(rounded, cols, axis=1), axis=1, kind="stable")
        cols = np.take_along_axis(cols, by, axis=1).ravel()
        out_q.append(np.asarray(qids[s:s + chunk])[rows])
        out_p.append(np.tile(np.arange(width), n))
        out_i.append(iids[cols])
        out_s.append(sc[rows, cols])
    if not out_q:
        return np.array([], dtype=np.int64), np.array([], dtype=np.int64), np.array([], dtype=np.int64), np.array([], dtype=np.float64)
    return np.concatenate(out_q), np.concatenate(out_p), np.concatenate(out_i), np.concatenate(out_s)


def _stack(series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0), dtype=np.float64)
    return np.vstack([np.asarray(v, dtype=np.float64) for v in series])


def block_counts(n_queries: int, n_items: int, parallelism: int, max_query_block: int = 16384,
                 max_item_block: int = 16384, k: int = 10, dim: int = 64):
    """Numbers of query and item blocks for the blocked product.

    At least ``2 x parallelism`` (query block, item block) groups so every core
    has work. Every extra item block costs each query one more copy of its
    vector *and* one more local top-k (``3k`` values) to merge; every extra
    query block costs each item one more copy of its vector. The split
    minimises ``n_q (3k + dim) n_item_blocks + n_i dim n_query_blocks``; with one
    item block, more query blocks than groups would only send the items again. Block
    sizes never exceed the memory caps ``max_query_block`` / ``max_item_block``.
    """
    nq, ni = max(1, n_queries), max(1, n_items)
    groups = max(1, 2 * parallelism)
    q_mem, i_mem = math.ceil(nq / max_query_block), math.ceil(ni / max_item_block)
    per_item_block = nq * (3 * k + dim)
    per_query_block = ni * dim
    qb = max(q_mem, min(nq, groups, round(math.sqrt(groups * per_item_block / per_query_block)) or 1))
    ib = max(i_mem, min(ni, math.ceil(groups / qb)))
    return int(qb), int(ib)


def _sides(queries: DataFrame, items: DataFrame, metric: str):
    """``queries(qid, qvec, ...)`` and ``items(iid, ivec, ...)`` with vectors whose dot product is the metric."""
    if metric not in ("dot", "cosine"):
        raise ValueError("metric must be 'dot' or 'cosine'")
    if metric == "dot":
        return queries, items
    q, it = l2_normalize(queries, "qvec"), l2_normalize(items, "ivec")
    return q.where(F.col("qvec").isNotNull()), it.where(F.col("ivec").isNotNull())


def _merged(local: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query over the lists of all item blocks: (qid, pos, iid, score)."""
    w = Window.partitionBy("qid").orderBy(F.round("score", 10).desc(), F.col("iid").asc())
    # Filter on the bare row_number so the planner inserts a window group limit
    # (top-k per query before the shuffle as well as after it).
    return (local.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= k)
            .select("qid", (F.col("_rn") - 1).cast("int").alias("pos"), "iid", "score"))


def _where(mask: np.ndarray) -> np.ndarray:
    """Flat places of a mask's few true cells, found eight cells at a time."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    cells = (words[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([cells[flat[cells]], whole + np.flatnonzero(flat[whole:])])


class RunningBest:
    """The best ``k`` items of a block of queries among those seen so far. Items come in ascending id order, so the earlier
    of equal scores (by 10 decimals, as in ``_scores_top_k``) stays and no more than ``k`` are ever kept per query."""

    def __init__(self, qids: np.ndarray, q: np.ndarray, k: int):
        self.qids, self.q, self.k, self.seen = qids, q, k, 0
        self.scores, self.ids = np.empty((len(qids), k)), np.empty((len(qids), k), np.int64)
        self.floor = np.full(len(qids), -np.inf)  # a full list's lowest score: only higher ones enter it

    def add(self, iids: np.ndarray, items: np.ndarray) -> None:
        """A batch of items, in parts no larger than what was seen before them: by then few items enter a list."""
        while len(iids):
            n = self.k - self.seen if self.seen < self.k else self.seen
            (self._fill if self.seen < self.k else self._score)(iids[:n], items[:n])
            self.seen += len(iids[:n])
            iids, items = iids[n:], items[n:]

    def _fill(self, iids: np.ndarray, items: np.ndarray) -> None:
        at = slice(self.seen, self.seen + len(iids))
        sc = self.q @ items.T
        self.scores[:, at], self.ids[:, at] = np.where(np.isnan(sc), -np.inf, sc), iids  # no number ranks last
        if at.stop == self.k:
            self.floor = np.round(self.scores, 10).min(axis=1)

    def _score(self, iids: np.ndarray, items: np.ndarray, rows: int = 128, width: int = 1024) -> None:
        """Score ``rows`` queries and ``width`` items at a time in one buffer."""
        buffer, above = np.empty(rows * width), np.empty(rows * width, bool)
        for a in range(0, len(self.qids), rows):
            q, floor = self.q[a:a + rows], self.floor[a:a + rows, None]
            found = []
            for c in range(0, len(iids), width):
                part = items[c:c + width]
                shape = len(q), len(part)
                sc = np.matmul(q, part.T, out=buffer[:len(q) * len(part)].reshape(shape))
                hit = _where(np.greater(sc, floor, out=above[:sc.size].reshape(shape)))
                found.append((hit // len(part), c + hit % len(part), sc.ravel()[hit]))
            row, col, value = (np.concatenate(x) for x in zip(*found, strict=True))
            higher = np.round(value, 10) > self.floor[a + row]
            if not higher.any():
                continue
            by = np.flatnonzero(higher)
            by = by[np.argsort(row[by], kind="stable")]
            row, col, value = row[by], col[by], value[by]
            touched, first, n = np.unique(row, return_index=True, return_counts=True)
            at = np.repeat(np.arange(len(touched)), n), self.k + np.arange(len(row)) - np.repeat(first, n)
            wide, ids = np.full((len(touched), self.k + n.max()), -np.inf), np.zeros((len(touched), self.k + n.max()), np.int64)
            wide[:, :self.k], ids[:, :self.k] = self.scores[a + touched], self.ids[a + touched]
            wide[at], ids[at] = value, iids[col]
            rounded = np.round(wide, 10)
            best = best_columns(rounded, self.k)
            self.scores[a + touched], self.ids[a + touched] = wide[best].reshape(-1, self.k), ids[best].reshape(-1, self.k)
            self.floor[a + touched] = rounded[best].reshape(-1, self.k).min(axis=1)

    def lists(self, cells: int = 1 << 18):
        """(qids, ids, scores) of some queries at a time, each row in rank order."""
        width = min(self.k, self.seen)
        step = max(1, cells // max(1, width))
        for a in range(0, len(self.qids) if width else 0, step):
            scores, ids = self.scores[a:a + step, :width], self.ids[a:a + step, :width]
            by = np.argsort(-np.round(scores, 10), axis=1, kind="stable")
            yield self.qids[a:a + step], np.take_along_axis(ids, by, axis=1), np.take_along_axis(scores, by, axis=1)


def _vectors(column, kind=np.float64) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return (values.astype(kind) if kind else values).reshape(len(column), -1)


def _answers(best: RunningBest, as_lists: bool):
    """Arrow batches of (qid, pos, iid, score) or (qid, items)."""
    for qids, ids, scores in best.lists():
        n, width = ids.shape
        if as_lists:
            items = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(ids.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(qids), items], ["qid", "items"])
        else:
            pos = np.tile(np.arange(width, dtype=np.int32), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids, width)), pa.array(pos), pa.array(ids.ravel()),
                                              pa.array(scores.ravel())], ["qid", "pos", "iid", "score"])


def _stream_top_k(k: int, as_lists: bool):
    """One task: its rows are the queries (side 0), then the items in id order; (qid, pos, iid, score) or (qid, items)."""
    def fn(batches):
        queries, best = [], None
        for batch in batches:
            side = batch.column("side").to_numpy()
            n_queries = int(np.searchsorted(side, 1))
            ids, vec = batch.column("id").to_numpy(), _vectors(batch.column("vec"))
            if n_queries:
                queries.append((ids[:n_queries], vec[:n_queries]))
            if n_queries < len(ids) and queries:
                if best is None:
                    best = RunningBest(np.concatenate([q for q, _ in queries]), np.vstack([v for _, v in queries]), k)
                best.add(ids[n_queries:], vec[n_queries:])
        if best:
            yield from _answers(best, as_lists)
    return fn


def _held_top_k(k: int, as_lists: bool, n_items: int, dim: int, block: int):
    """One task: its rows are all items (side 0) in id order, then its queries, ``block`` of which are scored at a time."""
    def fn(batches):
        ids, vec, held, waiting, n = np.empty(n_items, np.int64), None, 0, [], 0

        def answers():
            best = RunningBest(np.concatenate([q for q, _ in waiting]), np.vstack([v for _, v in waiting]), k)
            best.add(ids[:held], vec[:held])
            yield from _answers(best, as_lists)

        for batch in batches:
            first = int(np.searchsorted(batch.column("side").to_numpy(), 1))
            if first:
                own = _vectors(batch.column("vec").slice(0, first), None)
                vec = np.empty((n_items, dim), own.dtype) if vec is None else vec
                ids[held:held + first], vec[held:held + first] = batch.column("id").slice(0, first).to_numpy(), own
                held += first
            while first < batch.num_rows and held:
                part = batch.slice(first, block - n)
                waiting.append((part.column("id").to_numpy(), _vectors(part.column("vec"))))
                first, n = first + part.num_rows, n + part.num_rows
                if n == block:
                    yield from answers()
                    waiting, n = [], 0
        if waiting:
            yield from answers()
    return fn


BLOCK_BYTES = 128 << 20  # of a task's query block: vectors and lists
HELD_BYTES = 384 << 20  # of the items that a task may hold


def _streamed(queries: DataFrame, items: DataFrame, k: int, metric: str, id_col: str, vec_col: str, as_lists: bool,
              query_block: int | None, item_block: int | None) -> DataFrame:
    q, it = _sides(queries.select(F.col(id_col).cast("long").alias("qid"), F.col(vec_col).alias("qvec")),
                   items.select(F.col(id_col).cast("long").alias("iid"), F.col(vec_col).alias("ivec")), metric)
    size = (q.agg(F.count("*").alias("n"), F.max(F.size("qvec")).alias("d"), F.lit(0).alias("side"))
            .unionByName(it.agg(F.count("*").alias("n"), F.max(F.size("ivec")).alias("d"), F.lit(1).alias("side"))))
    counts = {r["side"]: r for r in size.collect()}
    dim, n_items = int(counts[0]["d"] or 1), max(1, counts[1]["n"])
    nq, ni = block_counts(counts[0]["n"], n_items, q.sparkSession.sparkContext.defaultParallelism,
                          query_block or max(1, BLOCK_BYTES // (16 * min(k, n_items) + 8 * dim)), item_block or n_items, k=k, dim=dim)
    # More blocks than the cores need would each be sent all items. Where a task can hold these, it has them once, and
    # its queries pass them block by block.
    groups = 2 * q.sparkSession.sparkContext.defaultParallelism
    wide = 4 if all(df.schema[c].dataType.elementType == T.FloatType() for df, c in ((q, "qvec"), (it, "ivec"))) else 8
    if ni == 1 and nq > groups and n_items * (wide * dim + 8) <= HELD_BYTES:
        block = min(query_block or n_items, max(1, BLOCK_BYTES // 4 // (16 * min(k, n_items) + 8 * dim)))
        rows = (it.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_p"), F.lit(0).alias("side"), F.col("iid").alias("id"), F.col("ivec").alias("vec"))
                .unionByName(q.select(F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int").alias("_p"), F.lit(1).alias("side"),
                                      F.col("qid").alias("id"), F.col("qvec").alias("vec"))))
        dealt = rows.repartitionById(groups, F.col("_p")).select("side", "id", "vec").sortWithinPartitions("side", "id")
        return dealt.mapInArrow(_held_top_k(k, as_lists, n_items, dim, block),
                                "qid long, items array<long>" if as_lists else "qid long, pos int, iid long, score double")
    # The task of (query block, item block) is their partition: blocks are as even as a hash deals them.
    rows = (q.select((F.pmod(F.xxhash64("qid"), F.lit(nq)) * ni).alias("_q"), F.col("qid").alias("id"), F.col("qvec").alias("vec"))
            .select(F.explode(F.sequence(F.col("_q"), F.col("_q") + (ni - 1))).alias("_p"), F.lit(0).alias("side"), "id", "vec")
            .unionByName(it.select(F.pmod(F.xxhash64("iid"), F.lit(ni)).alias("_i"), F.col("iid").alias("id"), F.col("ivec").alias("vec"))
                         .select(F.explode(F.sequence(F.col("_i"), F.col("_i") + F.lit((nq - 1) * ni).cast("long"), F.lit(ni).cast("long"))).alias("_p"),
                                 F.lit(1).alias("side"), "id", "vec")))
    dealt = rows.repartitionById(nq * ni, F.col("_p").cast("int")).select("side", "id", "vec").sortWithinPartitions("side", "id")
    if as_lists and ni == 1:
        return dealt.mapInArrow(_stream_top_k(k, True), "qid long, items array<long>")
    found = dealt.mapInArrow(_stream_top_k(k, False), "qid long, pos int, iid long, score double")
    if ni > 1:
        found = _merged(found.drop("pos"), k)
    return top_k_lists(found, out_col="items") if as_lists else found


def blocked_top_k(queries: DataFrame, items: DataFrame, k: int, *, group_col: str, q_blocks: DataFrame, i_blocks: DataFrame,
                  q_id: str = "qid", i_id: str = "iid", q_vec: str = "qvec", i_vec: str = "ivec", metric: str = "dot") -> DataFrame:
    """Exact top-k items per query by inner product (or cosine) among the pairs sharing ``group_col`` (a probed cell):
    ``(qid, pos, iid, score)``. ``q_blocks`` / ``i_blocks`` are per-group block counts ``(group_col, n)``.
    """
    q, it = _sides(queries.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).alias("qvec"), F.col(group_col).alias("g")),
                   items.select(F.col(i_id).cast("long").alias("iid"), F.col(i_vec).alias("ivec"), F.col(group_col).alias("g")), metric)
    # Per-group block counts, one row per group; groups may be as many as rows, so they are never broadcast.
    qb = q_blocks.select(F.col(group_col).alias("g"), F.col("n").alias("nqb"))
    ib = i_blocks.select(F.col(group_col).alias("g"), F.col("n").alias("nib"))
    both = qb.join(ib.hint("merge"), "g", "inner").hint("merge")
    q = q.join(both, "g", "inner")
    it = it.join(both, "g", "inner")

    # Each query row goes to its own query block and to every item block of its group;
    # each item row to its item block and every query block: the blocked matmul layout.
    q_rep = (q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("nqb")).cast("int"))
             .withColumn("ib", F.explode(F.sequence(F.lit(0), F.col("nib").cast("int") - 1)))
             .select("g", "qb", "ib", "qid", "qvec"))
    i_rep = (it.withColumn("ib", F.pmod(F.xxhash64("iid"), F.col("nib")).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nqb").cast("int") - 1)))
             .select("g", "qb", "ib", "iid", "ivec"))

    kk = int(k)

    def score(qpdf: pd.DataFrame, ipdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(ipdf) == 0:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "pos": pd.Series([], dtype="int32"),
                                 "iid": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        qi, pos, ii, ss = _scores_top_k(qpdf["qid"].to_numpy(), _stack(qpdf["qvec"]),
                                        ipdf["iid"].to_numpy(), _stack(ipdf["ivec"]), kk)
        return pd.DataFrame({"qid": qi.astype("int64"), "pos": pos.astype("int32"), "iid": ii.astype("int64"), "score": ss.astype("float64")})

    local = (q_rep.groupBy("g", "qb", "ib")
             .cogroup(i_rep.groupBy("g", "qb", "ib"))
             .applyInPandas(score, schema="qid long, pos int, iid long, score double"))
    local = local.groupBy("qid", "iid").agg(F.max("score").alias("score"))  # a pair may meet in several groups
    return _merged(local, kk).select(F.col("qid").alias(q_id), "pos", F.col("iid").alias(i_id), "score")


def exact_top_k(queries: DataFrame, items: DataFrame, k: int, *, id_col: str = "id", vec_col: str = "features",
                metric: str = "dot", query_block: int | None = None, item_block: int | None = None) -> DataFrame:
    """Exact top-k for every query row; output ``(qid, pos, iid, score)``.

    ``query_block`` is the most queries a task holds (default: as many as fit ``BLOCK_BYTES`` with their lists),
    ``item_block`` the most items a task scores (default: all).
    """
    return _streamed(queries, items, int(k), metric, id_col, vec_col, False, query_block, item_block)


def exact_top_k_lists(queries: DataFrame, items: DataFrame, k: int, *, id_col: str = "id", vec_col: str = "features",
                      metric: str = "dot", query_block: int | None = None, item_block: int | None = None) -> DataFrame:
    """:func:`exact_top_k` as one row per query, ``(qid, items array<long>)`` in rank order; a list leaves its task whole."""
    return _streamed(queries, items, int(k), metric, id_col, vec_col, True, query_block, item_block)


def top_k_lists(ranked: DataFrame, q_id: str = "qid", i_id: str = "iid", pos_col: str = "pos",
                out_col: str = "items") -> DataFrame:
    """One ranked list per query (at most k entries each, so the group is bounded)."""
    return (ranked.groupBy(q_id)
            .agg(F.array_sort(F.collect_list(F.struct(pos_col, i_id))).alias("_s"))
            .select(q_id, F.col(f"_s.{i_id}").alias(out_col)))
