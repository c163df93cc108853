import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import ann as A
from cadenza.operators import retrieve as RT


def _vectors(spark, m, start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in row]) for i, row in enumerate(m)],
                                 "id long, features array<double>")


def test_exact_top_k_matches_numpy(spark):
    rng = np.random.default_rng(1)
    q, it = rng.standard_normal((37, 8)), rng.standard_normal((211, 8))
    got = RT.exact_top_k(_vectors(spark, q), _vectors(spark, it), 5, query_block=8, item_block=32)
    rows = got.collect()
    want = np.argsort(-(q @ it.T), axis=1)[:, :5]
    got_m = {}
    for r in rows:
        got_m.setdefault(r.qid, {})[r.pos] = r.iid
    assert all([got_m[i][p] for p in range(5)] == list(want[i]) for i in range(37))


@pytest.mark.parametrize("k", [10, 100, 500])
def test_ties_go_to_the_lower_id(spark, k):
    """Three score levels over 900 items in shuffled blocks."""
    rng = np.random.default_rng(4)
    level = rng.integers(0, 3, 900)
    items = _vectors(spark, np.stack([level, np.ones(900)], axis=1)).repartition(7)
    query = _vectors(spark, [[1.0, 0.5]], 5000)
    got = [r.iid for r in RT.exact_top_k(query, items, k, item_block=128).orderBy("pos").collect()]
    assert got == sorted(range(900), key=lambda i: (-level[i], i))[:k]


def test_best_columns_keeps_the_leftmost_of_equals():
    rng = np.random.default_rng(0)
    for k in (1, 3, 7, 20, 50):
        s = rng.integers(0, 4, (11, 20)).astype(float)
        rows, cols = RT.best_columns(s, k)
        for i in range(11):
            want = sorted(range(20), key=lambda j: (-s[i, j], j))[:k]
            assert sorted(cols[rows == i]) == sorted(want)


def test_running_best_matches_a_full_sort():
    """Batches of any size, many equal scores, rows without a number: the lists of one sort over all items."""
    rng = np.random.default_rng(2)
    for k, n in ((1, 40), (7, 5), (30, 700), (600, 2500)):
        q, items = rng.integers(-2, 3, (300, 3)).astype(float), rng.integers(-2, 3, (n, 3)).astype(float)
        items[::11] = np.nan
        best = RT.RunningBest(np.arange(300), q, k)
        for part in np.split(np.arange(n), np.sort(rng.integers(0, n, 6))):
            best.add(part, items[part])
            assert best.scores.nbytes == 8 * 300 * k  # what is kept does not follow the items
        got = np.vstack([ids for _, ids, _ in best.lists()])
        sc = np.nan_to_num(q @ items.T, nan=-np.inf)
        want = np.argsort(-sc, axis=1, kind="stable")[:, :k]
        wanted = np.take_along_axis(sc, want, axis=1)
        assert (np.take_along_axis(sc, got, axis=1) == wanted).all()
        assert (got == want)[np.isfinite(wanted)].all()


def test_lists_of_many_items_are_not_merged(spark):
    """A list leaves its task whole however many items there are: no window over the lists of item blocks."""
    big = spark.range(16500).select("id", F.array(*[F.rand(i) for i in range(64)]).alias("features"))
    for k in (500, 600):
        plan = RT.exact_top_k(big, big, k)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and plan.count("Exchange") == 1
    lists = RT.exact_top_k_lists(big, big, 500)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in lists and "Window" not in lists


def test_lists_equal_ranked_rows(spark):
    rng = np.random.default_rng(6)
    q, it = _vectors(spark, rng.standard_normal((40, 5)), 900), _vectors(spark, rng.standard_normal((300, 5)))
    for kw in ({}, {"query_block": 7}, {"item_block": 50}):
        rows = RT.exact_top_k(q, it, 12, **kw).collect()
        lists = {r.qid: r["items"] for r in RT.exact_top_k_lists(q, it, 12, **kw).collect()}
        assert len(rows) == 480 and all(lists[r.qid][r.pos] == r.iid for r in rows)


def test_metric_gap(spark):
    items = spark.createDataFrame([(0, [1.0, 0.0]), (1, [3.0, 3.0])], "id long, features array<double>")
    query = spark.createDataFrame([(9, [1.0, 0.1])], "id long, features array<double>")
    assert RT.exact_top_k(query, items, 1, metric="dot").first().iid == 1
    assert RT.exact_top_k(query, items, 1, metric="cosine").first().iid == 0


def _planted(spark, n=600, dim=16, clusters=12, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((clusters, dim)) * 5
    lab = rng.integers(0, clusters, n)
    m = centers[lab] + 0.3 * rng.standard_normal((n, dim))
    return _vectors(spark, m)


def test_recall_of_both_indexes(spark):
    items = _planted(spark)
    exact = RT.exact_top_k(items, items, 10, metric="cosine", query_block=256, item_block=256)
    for approx in (A.forest_search(items, items, 10, n_trees=8, bucket=24, seed=1), A.ivf_pq_search(items, items, 10, reorder=60)):
        assert approx.join(items.select(F.col("id").alias("iid")), "iid", "left_anti").count() == 0
        assert A.recall_at_k(approx, exact, 10).first()[0] >= 0.9


def test_ivf_recall_rises_with_the_rerank_list(spark):
    items = _planted(spark)
    exact = RT.exact_top_k(items, items, 10, metric="cosine", query_block=256, item_block=256)
    r1, r4 = (A.recall_at_k(A.ivf_pq_search(items, items, 10, n_cells=12, n_probe=6, reorder=r), exact, 10).first()[0] for r in (20, 200))
    assert r4 >= r1 and r4 > 0.9
    assert A.recall_at_k(exact, exact, 10).first()[0] == pytest.approx(1.0)


@pytest.mark.parametrize("search", [A.forest_search, A.ivf_pq_search])
@pytest.mark.parametrize("n,k", [(900, 500), (30, 50)])
def test_every_query_gets_min_k_n_rows(spark, search, n, k):
    """Queries that are no items, and two thirds of the items equal vectors."""
    rng = np.random.default_rng(1)
    m = rng.standard_normal((n, 15))
    m[: 2 * n // 3] = m[0]
    queries = _vectors(spark, rng.standard_normal((25, 15)) * 3, 100_000)
    got = search(queries, _vectors(spark, m), k).groupBy("qid").agg(F.count("*").alias("n"), F.max("pos").alias("p")).collect()
    assert len(got) == 25 and {(r.n, r.p) for r in got} == {(min(k, n), min(k, n) - 1)}


def test_stored_forest_is_read_and_grows(spark, tmp_path, monkeypatch):
    """A second job opens the index: the same rows as a fresh one, and no item is hashed again."""
    items = _planted(spark)

    def rows(df):
        return sorted((r.qid, r.pos, r.iid, round(r.score, 9)) for r in df.collect())

    want = rows(A.forest_search(items, items, 7, n_trees=6, bucket=24, seed=1))
    A.ForestIndex.build(items, str(tmp_path / "a"), n_trees=6, bucket=24, seed=1, k=7)
    hashed = []
    codes = A._codes
    monkeypatch.setattr(A, "_codes", lambda df, planes, name: hashed.append(name) or codes(df, planes, name))
    got = A.ForestIndex.open(spark, str(tmp_path / "a")).search(items, 7)
    assert rows(got) == want and hashed == ["qid"]
    grown = A.ForestIndex.build(items.where("id < 200"), str(tmp_path / "b"), n_trees=6, bucket=24, seed=1, k=7, capacity=600)
    grown.append(items.where("id between 200 and 350"))
    grown.append(items.where("id > 350"))
    assert grown.size() == 600
    again = A.ForestIndex.open(spark, str(tmp_path / "b"))
    assert rows(again.search(items, 7)) == want
    with pytest.raises(ValueError, match="there is an index"):
        A.ForestIndex.build(items, str(tmp_path / "a"))


def test_stored_cells_are_read_and_grow(spark, tmp_path):
    rng = np.random.default_rng(8)
    items = _planted(spark)
    queries = _vectors(spark, rng.standard_normal((40, 16)), 5000)
    exact = RT.exact_top_k(queries, items, 10, metric="cosine")
    index = A.PartitionedIndex.build(items.where("id % 4 != 0"), str(tmp_path / "c"))
    index.append(items.where("id % 4 = 0"))
    again = A.PartitionedIndex.open(spark, str(tmp_path / "c"))
    got = again.search(queries, 10)
    assert got.count() == 400 and got.where("iid % 4 = 0").count() > 0
    assert A.recall_at_k(got, exact, 10).first()[0] >= 0.9


def test_uncommitted_batches_are_not_read(spark, tmp_path):
    from cadenza.sources.store import BatchStore
    path = str(tmp_path / "s")
    store = BatchStore(spark, path)
    store.append({"t": spark.range(3)}, note="first")
    spark.range(100).write.parquet(f"{path}/t/batch=1")  # a writer that died before its commit
    assert BatchStore(spark, path).read("t").count() == 3
    store.append({"t": spark.range(5), "u": lambda: store.read("t", 1).selectExpr("id * 2 AS id")})
    again = BatchStore(spark, path)
    assert again.read("t").count() == 8 and again.read("u").count() == 5 and again.notes["note"] == "first"


def test_lloyd_steps_match_numpy(spark):
    rng = np.random.default_rng(3)
    m = rng.standard_normal((500, 6))
    items = _vectors(spark, m).repartition(7)
    centers = m[:9].copy()
    want = centers.copy()
    for _ in range(3):
        c = A._nearest(m, want)
        want = np.stack([m[c == k].mean(axis=0) if (c == k).any() else want[k] for k in range(9)])
        centers = A.lloyd_step(items, lambda x, y: (A._nearest(x, y), x), centers)
    assert np.allclose(centers, want, atol=1e-12)
    cells, books = A.fit_quantiser(items, 9, n_codes=5)
    assert cells.shape == (9, 6) and books.shape == (3, 5, 2)
    r = A._sub_blocks(m - cells[A._nearest(m, cells)])
    spread = ((r - books[np.arange(3), A._assign_codes(r, books)]) ** 2).sum()
    assert spread < 0.6 * (r ** 2).sum()


def test_cells_are_built_over_partitions_without_rows(spark):
    """A file may be split finer than its row groups: tasks without rows send nothing, and the index is whole."""
    m = np.random.default_rng(8).standard_normal((12, 6))
    spread, together = _vectors(spark, m).repartition(40), _vectors(spark, m).coalesce(1)
    first = m[:3].copy()
    steps = [A.lloyd_step(items, lambda x, y: (A._nearest(x, y), x), first) for items in (spread, together)]
    assert np.allclose(*steps, atol=1e-12)
    got = A.ivf_pq_search(together, spread, 4, n_cells=3).collect()
    assert {r.qid: sum(x.qid == r.qid for x in got) for r in got} == dict.fromkeys(range(12), 4)
    assert all(r.iid == r.qid for r in got if r.pos == 0)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_query_blocks_share_the_items(spark, monkeypatch, kind):
    """More blocks than the cores need: every task is sent the items once, not once per block; lists, ties by the lower id and
    queries past the last whole block are those of numpy."""
    rng = np.random.default_rng(6)
    q, it = rng.integers(-3, 4, (203, 5)).astype(float), rng.integers(-3, 4, (90, 5)).astype(float)
    queries, items = (_vectors(spark, m).withColumn("features", F.col("features").cast(f"array<{kind}>")).repartition(3) for m in (q, it))
    monkeypatch.setattr(RT, "BLOCK_BYTES", 900)  # blocks of some queries
    lists = RT.exact_top_k_lists(queries, items, 7)
    want = [sorted(range(90), key=lambda i: (-s[i], i))[:7] for s in q @ it.T]
    assert {r.qid: r["items"] for r in lists.collect()} == dict(enumerate(want))
    groups = 2 * spark.sparkContext.defaultParallelism
    assert lists.rdd.getNumPartitions() == groups < RT.block_counts(203, 90, groups // 2, 900 // (16 * 7 + 8 * 5), 90, k=7, dim=5)[0]
    rows = {(r.qid, r.pos): (r.iid, r.score) for r in RT.exact_top_k(queries, items, 7).collect()}
    assert rows == {(i, p): (j, float(q[i] @ it[j])) for i, x in enumerate(want) for p, j in enumerate(x)}
    monkeypatch.setattr(RT, "HELD_BYTES", 0)  # items that no task can hold go to every block
    again = RT.exact_top_k_lists(queries, items, 7)
    assert again.rdd.getNumPartitions() > groups and {r.qid: r["items"] for r in again.collect()} == dict(enumerate(want))


def test_forest_search_broadcasts_nothing(spark):
    """Paths, codes and nodes grow with the items: no join of them goes through the driver."""
    from cadenza.operators.ann import ForestIndex, _fresh_store
    rows = [(i, [float((i * 7 + j * j) % 11 - 5) for j in range(8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    index = ForestIndex.build(df, _fresh_store(spark, "forest"), n_trees=4, bucket=16, k=5)
    plan = index.search(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_probes_are_pairs_of_ids_in_bounded_slices(spark, monkeypatch):
    """Probes carry no vectors, and many cells do not make a batch's tables grow: the same probes by slices of one row."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, features array<double>").coalesce(1)
    centers, sizes = rng.normal(size=(30, 6)), rng.integers(0, 9, 30)
    got = A._probed(df, centers, sizes, 3, 40)
    assert got.columns == ["qid", "cell"]
    want = set()
    for i, v in rows:
        best = np.argsort(-(centers @ np.array(v)), kind="stable")
        n = max(3, next(t for t in range(1, 31) if sizes[best[:t]].sum() >= 40))
        want |= {(i, int(c)) for c in best[:n]}
    assert {tuple(r) for r in got.collect()} == want
    assert [s.stop - s.start for s in A._slices(5, 1 << 21)] == [1] * 5 and A._slices(10_000, 300)[0].stop * 300 <= 1 << 21
    m = rng.normal(size=(7, 6))
    whole = A._nearest(m, centers)
    monkeypatch.setattr(A, "_slices", lambda n, width: [slice(i, i + 1) for i in range(n)])
    assert (A._nearest(m, centers) == whole).all() and len(A._nearest(m[:0], centers)) == 0


def test_recall_asks_every_vector(spark):
    """N5 takes every row of the embeddings as a query."""
    from cadenza.plans import queries as Q
    from tests.conftest import SF
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert {(r.method, r.n_queries, r.recall_from_09) for r in Q.n5_recall(spark, SF).collect()} == {("forest", n, True), ("ivf_pq", n, True)}
