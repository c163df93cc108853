import pytest
from pyspark.sql import functions as F

from cadenza.operators import interactions as I


def test_id_index_dense_ascending_shared(spark):
    a = spark.createDataFrame([("b",), ("a",)], "v string")
    b = spark.createDataFrame([("c",), ("a",)], "v string")
    idx = I.build_id_index([a, b], "v")
    assert sorted(map(tuple, idx.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    out = I.apply_id_index(b, idx, "v", keep_original=True)
    assert sorted(map(tuple, out.select("v", "v_index").collect())) == [("a", 0), ("c", 2)]


def test_id_index_many_partitions_is_bijection(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.format_string("id%05d", F.col("id") * 3 % 5000).alias("v"))
    idx = I.build_id_index(df, "v")
    rows = idx.orderBy("v").collect()
    assert [r.v_index for r in rows] == list(range(5000))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_id_index_null_and_unseen_raise(spark):
    with pytest.raises(Exception):
        I.build_id_index(spark.createDataFrame([("a",), (None,)], "v string"), "v")
    idx = I.build_id_index(spark.createDataFrame([("a",)], "v string"), "v")
    with pytest.raises(Exception):
        I.apply_id_index(spark.createDataFrame([("z",)], "v string"), idx, "v").collect()


def test_hash_split_partitions_rows(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("u"), (F.col("id") % 37).cast("string").alias("t"))
    tr, va = I.hash_split(df, I.pair_key("u", "t"))
    assert tr.count() + va.count() == 2000
    assert tr.join(va, ["u", "t"]).count() == 0
    assert 0.7 < tr.count() / 2000 < 0.9


def test_nested_holdout_and_samples(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("u"), F.lit("x").alias("t"))
    tr, va, te = I.nested_holdout(df, I.pair_key("u", "t"))
    assert tr.count() + va.count() + te.count() == 3000
    assert I.fixed_size_sample(df, 123, "u").count() == 123
    ks = I.key_sample(df.withColumn("k", F.col("u") % 10), "k", 0.5)
    per_key = ks.groupBy("k").count().collect()
    assert all(r["count"] == 300 for r in per_key)


def test_random_neighbours_bounded(spark):
    e = spark.range(500).select((F.col("id") % 5).alias("src"), F.col("id").alias("dst"))
    out = I.random_neighbours(e, 10, 1)
    assert sorted(r["count"] for r in out.groupBy("src").count().collect()) == [10] * 5


def test_id_index_equals_dense_rank_and_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    from pyspark.sql import Window
    df = spark.range(0, 800, numPartitions=5).select(F.format_string("k%d", F.col("id") % 97).alias("v"))
    ours = {r.v: r.v_index for r in I.build_id_index(df, "v").collect()}
    dr = {r.v: r.i for r in df.distinct().select("v", (F.dense_rank().over(Window.orderBy("v")) - 1).alias("i")).collect()}
    si = StringIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc").fit(df)
    assert ours == dr == {lab: i for i, lab in enumerate(si.labels)}
