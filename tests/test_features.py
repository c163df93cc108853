import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import features as FE


def test_summaries(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, None]
    df = spark.createDataFrame([(v, t) for v, t in zip(vals, ["a", "b", "b", None, "c", "b"])], "x double, t string")
    r = FE.describe_numeric(df, ["x"]).first()
    arr = np.array([v for v in vals if v is not None])
    assert (r["count"], r["min"], r["max"]) == (5, 1.0, 10.0)
    assert r["mean"] == pytest.approx(arr.mean()) and r["std"] == pytest.approx(arr.std(ddof=1))
    assert (r.q25, r.q50, r.q75) == tuple(np.quantile(arr, [0.25, 0.5, 0.75]))
    t = FE.describe_text(df, "t").first()
    assert (t["count"], t["unique"], t["top"], t["freq"]) == (5, 3, "b", 3)
    nan_df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert FE.null_count(nan_df, "x").first().n_missing == 2
    assert FE.distinct_counts(df, ["t"]).first()[0] == 3
    vc = FE.value_counts(df, "t").collect()
    assert [(r.t, r.n) for r in vc][0] == ("b", 3)


def test_list_per_key_and_dedup_and_expand(spark):
    df = spark.createDataFrame([("a1", "rock", 2), ("a1", "jazz", 5), ("a1", "rock", 9), ("a2", "pop", 1)],
                               "artist_id string, term string, pos int").repartition(3)
    got = {r.artist_id: list(r.term) for r in FE.list_per_key(df, "artist_id", "term", "pos").collect()}
    assert got == {"a1": ["rock", "jazz", "rock"], "a2": ["pop"]}  # input order, repeats kept
    rows = spark.createDataFrame([(3, "x", 1.0), (1, "x", 1.0), (2, "y", 1.0)], "id int, a string, b double")
    assert sorted(map(tuple, FE.dedup_rows(rows, "id").collect())) == [(1, "x", 1.0), (2, "y", 1.0)]
    e = spark.createDataFrame([(1, [0.5, 1.5])], "id int, f array<double>")
    assert FE.expand_array(e, "f", 2).columns == ["id", "feature_0", "feature_1"]
    s = spark.createDataFrame([(0, None), (1, 2.0)], "y int, v double")
    out = FE.sentinels_to_null(s, {"y": 0}).collect()
    assert out[0].y is None and out[1].y == 1
    assert FE.keep_not_equal(spark.createDataFrame([("other",), ("rock",), (None,)], "g string"), "g", "other").count() == 1


def test_catalogue_full_outer_keeps_both_sides(spark):
    tracks = spark.createDataFrame([("t1", "a1"), ("t2", "a3")], "track_id string, artist_id string")
    terms = spark.createDataFrame([("a1", "rock", 0), ("a2", "pop", 1)], "artist_id string, term string, pos int")
    loc = spark.createDataFrame([("a1", 1.0, 2.0, "n1", "L1"), ("a3", 3.0, 4.0, "n3", "L3")],
                                "artist_id string, latitude double, longitude double, artist_name string, location string")
    out = {r.track_id: (None if r.term is None else list(r.term), r.location)
           for r in FE.catalogue_features(tracks, terms, loc).collect()}
    assert out == {"t1": (["rock"], "L1"), "t2": (None, "L3")}


def test_catalogue_lists_are_joined_last(spark):
    """A track's row is not shuffled once it has its artist's list: in the plan, the join that adds the list is above the
    join with the extras; few artists are dealt over many tasks; texts and sizes are made per artist."""
    tracks = spark.createDataFrame([(f"t{i}", f"a{i % 2}", float(i)) for i in range(200)] + [("t", None, 0.0)],
                                   "track_id string, artist_id string, duration double")
    terms = spark.createDataFrame([(f"a{i % 3}", f"w{i}", i) for i in range(30)], "artist_id string, term string, pos int")
    loc = spark.createDataFrame([("a0", 1.0, 2.0, "n", "L0")], "artist_id string, latitude double, longitude double, artist_name string, location string")
    extras = spark.createDataFrame([(f"t{i}", float(-i)) for i in range(0, 200, 2)], "track_id string, tempo double")
    out = FE.catalogue_features(tracks, terms, loc, extras, lambda c: F.array_join(c, ","))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") > plan.index("tempo") and plan.count("Join LeftOuter") == 2
    assert plan.index("_part") < plan.index("collect_list") and "artist_id" in plan[plan.index("Join LeftOuter"):].split("\n")[0]
    assert out.columns == ["track_id", "artist_id", "duration", "term", "latitude", "longitude", "location", "tempo"]
    got = {r.track_id: tuple(r)[1:] for r in out.collect()}
    lists = {f"a{a}": ",".join(f"w{i}" for i in range(30) if i % 3 == a) for a in range(3)}
    assert len(got) == 201 and got["t"] == (None, 0.0, None, None, None, None, None)
    for i in range(200):
        place = (1.0, 2.0, "L0") if i % 2 == 0 else (None, None, None)
        assert got[f"t{i}"] == (f"a{i % 2}", float(i), lists[f"a{i % 2}"], *place, float(-i) if i % 2 == 0 else None)
    sizes = FE.catalogue_features(tracks, terms, loc, extras, F.size).select("term").distinct().collect()
    assert {r.term for r in sizes} == {10, None}


def test_list_per_key_beginning(spark):
    """The first n values of each list are the beginning of the whole list, NULLs and equal positions included."""
    rows = [(f"k{i % 3}", f"v{i * 7 % 5}" if i % 4 else None, i // 6) for i in range(40)] + [(None, "x", 0), ("one", None, 3)]
    df = spark.createDataFrame(rows, "k string, v string, o int").repartition(4)
    whole = {r.k: list(r.v) for r in FE.list_per_key(df, "k", "v", "o").collect()}
    for n in (1, 2, 100):
        assert {r.k: list(r.v) for r in FE.list_per_key(df, "k", "v", "o", first=n).collect()} == {k: v[:n] for k, v in whole.items()}


def test_items_carry_one_term(spark):
    """The genre queries give an item no more of its artist's list than the first term."""
    from cadenza.plans import queries as Q
    from cadenza.sources.tables import Tables
    from tests.conftest import SF
    assert {r.n for r in Q._item_terms(Tables(spark, SF)).select(F.size("term").alias("n")).distinct().collect()} == {1}


def test_ranked_tracks_carry_no_list(spark):
    """T5 ranks by the number of an artist's terms: what is joined to the tracks is the number."""
    from cadenza.plans import queries as Q
    from tests.conftest import SF
    plan = Q.t5_multi_key_top_k(spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    lists = [i for i, line in enumerate(plan) if "collect_list" in line]
    sizes = [i for i, line in enumerate(plan) if "size(" in line and "Generate" not in line]
    joins = [i for i, line in enumerate(plan) if "Join LeftOuter" in line]
    assert lists and all(any(j < s <= c for s in sizes for j in joins) for c in lists)
    assert not any("size(" in line for line in plan[:joins[0]])


def test_csv_export_grows_with_the_parts(spark, tmp_path):
    """Four times the parts of the same artists: the CSV files grow in proportion, and all rows come back whole."""
    import os
    from cadenza.plans import queries as Q
    from tests.conftest import SF
    size, made, real = {}, [], Q.FI.scratch_dir

    def folder(spark, name):
        made.append(real(spark, name))
        return made[-1]

    Q.FI.scratch_dir = folder
    try:
        for n in (1, 4):
            for t in ("lineitem", "nation", "region"):
                os.makedirs(tmp_path / str(n), exist_ok=True)
                os.symlink(f"{SF}/{t}.parquet", tmp_path / str(n) / f"{t}.parquet")
            part = spark.read.parquet(f"{SF}/part.parquet")
            part.crossJoin(spark.range(n).select(F.col("id").alias("r"))).withColumn("p_partkey", F.col("p_partkey") + F.col("r") * 100000) \
                .drop("r").write.parquet(f"{tmp_path}/{n}/part.parquet")
            made.clear()
            rows = {r.track_id: r for r in Q.s2_s9_csv_roundtrip(spark, f"{tmp_path}/{n}").collect()}
            want = {r.track_id: r for r in Q.c1_catalogue_features(spark, f"{tmp_path}/{n}").collect()}
            assert {k: (r.term, r.title, r.duration) for k, r in rows.items()} == {k: (r.term, r.title, r.duration) for k, r in want.items()}
            texts = [spark.read.text(p).agg(F.sum(F.length("value"))).first()[0] for p in made]
            size[n] = sum(texts)
    finally:
        Q.FI.scratch_dir = real
    assert size[4] < 5 * size[1]


def test_a_task_holds_one_long_value(spark, tmp_path):
    """Two keys with values of 0.6 MB each, more than a column's dictionary holds: every file has one of them, once; rows whose
    key is missing or null come back without a value, and many keys give the same rows."""
    import os
    rows = spark.createDataFrame([(i, ["a", "b", "c", None][i % 4]) for i in range(400)], "id int, k string").repartition(3)
    table = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3), (None, 4)], "k string, v int").select(
        "k", F.concat(F.col("v").cast("string"), F.repeat(F.lit("word "), 120_000)).alias("text"))
    got = FE.join_per_key(rows, table, "k", "id")
    got.write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r.id: (r.k, r.t) for r in back.select("id", "k", F.substring("text", 1, 1).alias("t")).collect()} == {
        i: (["a", "b", "c", None][i % 4], ["1", "2", None, None][i % 4]) for i in range(400)}
    held = back.where("text IS NOT NULL").groupBy(F.col("_metadata.file_path")).agg(F.count_distinct("k").alias("n")).collect()
    assert held and {r.n for r in held} == {1}
    assert sum(os.path.getsize(tmp_path / "out" / f) for f in os.listdir(tmp_path / "out")) < 16_000_000  # 120 MB in full
    most, FE.MOST_KEYS = FE.MOST_KEYS, 2
    try:
        cut = lambda df: sorted((r.id, r.k, r.t) for r in df.where("k IS NOT NULL").select("id", "k", F.coalesce(F.substring("text", 1, 1), F.lit("")).alias("t")).collect())
        assert cut(FE.join_per_key(rows, table, "k", "id")) == cut(got)
    finally:
        FE.MOST_KEYS = most


def test_align_joins_long_columns_after_the_dedup(spark):
    """The lists of a key are no grouping column, and the rows are those of the plain way."""
    idmap = spark.createDataFrame([(f"t{i}", i) for i in range(12)], "track_id string, mapped_id int")
    feats = spark.createDataFrame([(f"t{i}", f"a{i % 3}" if i % 4 else None, float(i % 2)) for i in range(12)], "track_id string, artist_id string, x double")
    terms = spark.createDataFrame([("a0", "w0,w3"), ("a1", "w1")], "artist_id string, term string")
    factors = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(10)], "id int, features array<double>")
    keep = ["artist_id", "term", "x"]
    got = FE.align_features(idmap, feats, factors, keep, rank=2, per_key=(terms, "artist_id"))
    plain = FE.align_features(idmap, feats.join(terms, "artist_id", "left"), factors, keep, rank=2)
    assert got.columns == plain.columns == ["mapped_id", *keep, "feature_0", "feature_1"]
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() < 10
    grouping = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in line]
    assert grouping and not any("term" in line for line in grouping)


def test_quartiles_by_rank_selection(spark):
    """Skewed, tied, huge, tiny and missing values, against numpy."""
    import numpy as np
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(0, 8, 500), np.zeros(300), -rng.lognormal(0, 3, 200), [1e300, -1e300, 5e-324]])
    y = rng.integers(0, 4, len(x)).astype(float)
    rows = [(float(a), float(b), None, 7.0) for a, b in zip(x, y, strict=True)] + [(None, None, None, 7.0)] * 5
    df = spark.createDataFrame(rows, "x double, y double, z double, c double").repartition(5)
    got = FE.quartiles(df, ["x", "y", "z", "c"], (0.0, 0.1, 0.25, 0.5, 0.75, 1.0))
    assert got["z"] == [None] * 6 and got["c"] == [7.0] * 6
    for c, v in (("x", x), ("y", y)):
        assert np.allclose(got[c], np.quantile(v, (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)), rtol=1e-12)
    assert "percentile" not in FE.describe_numeric(df, ["x"])._jdf.queryExecution().toString()


def test_stored_id_index_keeps_numbers(spark, tmp_path):
    from cadenza.operators.interactions import StoredIdIndex
    path = str(tmp_path / "ids")
    assert StoredIdIndex(spark, path, "u").grow(spark.createDataFrame([("c",), ("a",), ("c",)], "u string")) == 2
    again = StoredIdIndex(spark, path, "u")
    assert again.grow(spark.createDataFrame([("b",), ("a",), ("d",)], "u string")) == 2
    assert again.grow(spark.createDataFrame([("d",)], "u string")) == 0
    assert {r.u: r.u_index for r in StoredIdIndex(spark, path, "u").read().collect()} == {"a": 0, "c": 1, "b": 2, "d": 3}
